"""The registered queries: every operator over whole tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions.columns import (
    AREA_ID,
    CUSTOMER_ID,
    DRIVER_ID,
    ORDER_ID,
    alert_type,
    minutes_after,
    minutes_before,
    padded_id,
    point,
    prefixed_id,
    rescaled,
    rescaled_around,
    status_by_remainder,
    to_one_decimal,
)
from haulmark.functions.messages import encoded, json_text, point_in
from haulmark.functions.moments import latest_time, newer_than
from haulmark.operators import alerts as al
from haulmark.operators import catalog, ingest, inserts, kpis, lag, reports
from haulmark.plans import stand_ins as si
from haulmark.schemas import DELIVERY_UPDATE, DRIVER_PING, with_event_date
from haulmark.settings import fresh_folder
from haulmark.sources import keys
from haulmark.sources.messages import replay
from haulmark.sources.tables import register
from haulmark.streaming import progress, runner, sinks
from haulmark.streaming.compaction import compact, tidy
from haulmark.streaming.stored import current_rows, stored_table

MIN_DELAY = 120

DAY = timedelta(hours=24)
WEEK = timedelta(days=7)

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.pings(si.events(spark, sf_dir))


def _updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.updates(si.events(spark, sf_dir))


def _now(events: DataFrame) -> datetime | None:
    """The moment the reports look back from: the newest event."""
    return latest_time(events, "ts")


def _alert_records(events: DataFrame) -> DataFrame:
    """Key/value records as they lie in one store: alerts, and others beside them."""
    alerts = al.alert_records(al.all_alerts(si.updates(events), MIN_DELAY))
    drivers = si.pings(events).select(
        F.concat_ws(":", F.lit("driver"), "driver_id").alias("key"),
        json_text(F.struct("speed", "status")).alias("value"),
    )
    return alerts.unionByName(drivers)


# --- ingest -----------------------------------------------------------------


@query
def ingest_driver_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.stamped(ingest.driver_pings(encoded(_pings(spark, sf_dir))))
    return si.plain_times(rows.drop("processed_at"))


@query
def ingest_delivery_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.stamped(ingest.delivery_updates(encoded(_updates(spark, sf_dir))))
    text = [F.get_json_object("location_text", f"$.{c}").cast("double").alias(f"text_{c}") for c in ("lat", "lng")]
    rows = rows.select("*", "location.lat", "location.lng", *text)
    return si.plain_times(rows.drop("processed_at", "location", "location_text"))


@query
def ingest_traffic_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.stamped(ingest.traffic_updates(encoded(si.traffic(si.events(spark, sf_dir)))))
    return si.plain_times(rows.drop("processed_at"))


@query
def encode_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields; the place as numbers, which have more than one spelling."""
    text = F.col("value").cast("string")
    place = [F.get_json_object(text, f"$.location.{c}").cast("double").alias(c) for c in ("lat", "lng")]
    rest = F.regexp_replace(text, r'"location":\{[^}]*\},', "")
    return encoded(_updates(spark, sf_dir)).select(rest.alias("message"), *place)


# --- streams ----------------------------------------------------------------


@query
def replay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = si.event_stream(spark, sf_dir)
    root = fresh_folder(spark, "replay_events")
    runner.wait_for_all(
        [sinks.append_to_table(stream, f"{root}/table", "replay", f"{root}/state", every=None, by=())]
    )
    return stored_table(spark, f"{root}/table", stream.schema)


@query
def append_pings_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = encoded(si.pings(si.event_stream(spark, sf_dir)))
    rows = ingest.dated(ingest.stamped(ingest.driver_pings(messages)))
    root = fresh_folder(spark, "append_pings_to_table")
    runner.wait_for_all(
        [sinks.append_to_table(rows, f"{root}/table", "pings", f"{root}/state", every=None)]
    )
    stored = stored_table(spark, f"{root}/table", with_event_date(DRIVER_PING))
    return si.plain_times(stored.drop("processed_at"))


def _messages_of_all_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows parsed from messages; dealt out first, as a message costs much more than its shuffle."""
    events = si.events(spark, sf_dir)
    events = events.repartition(_pieces(events.count()))
    return ingest.dated(ingest.stamped(ingest.delivery_updates(encoded(si.updates(events)))))


def _stream_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.updates(si.with_stream_time(si.event_stream(spark, sf_dir)))


@query
def kpi_status_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.status_counts(_updates(spark, sf_dir)).drop("kpi_calculated_at")


@query
def kpi_stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the order of time, in several batches; counts folded after each."""
    root = fresh_folder(spark, "kpi_stream_update")
    events = si.with_stream_time(_event_batches(spark, sf_dir, f"{root}/events", 6))
    counts = kpis.status_counts(si.updates(events))
    runner.wait_for_all(
        [sinks.fold_counts(counts, f"{root}/counts", "status_counts", f"{root}/state", every=None)]
    )
    now = current_rows(spark, f"{root}/counts", counts.schema)
    return si.plain_times(now.drop("kpi_calculated_at"))


#: Rows per file of a stream's batch, about; each file is read by a task.
PIECE_ROWS = 50_000


def _pieces(rows: int) -> int:
    """Files that a batch of so many rows is stored in; every one of them gets rows."""
    return max(1, rows // PIECE_ROWS)


def _event_batches(spark: SparkSession, sf_dir: str, path: str, batches: int) -> DataFrame:
    """All events as a stream of about so many batches, each of a stretch of time."""
    events = si.events(spark, sf_dir)
    pieces = _pieces(events.count() // batches)
    events.repartitionByRange(batches * pieces, "ts", "event_id").sortWithinPartitions("ts").write.parquet(path)
    files = [row["f"] for row in spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.min("ts").alias("t")).orderBy("t").collect()]
    # A file source goes by the time a file was written: one batch after the other.
    for number in range(0, len(files), pieces):
        part = spark.read.parquet(*files[number : number + pieces]).repartition(pieces)
        part.write.parquet(f"{path}-in-order/part={number // pieces}")
    return replay(spark, f"{path}-in-order/*", events.schema, files_per_trigger=pieces)


def out_of_order(events: DataFrame, batches: int) -> DataFrame:
    """Events dealt to ``batch`` 0 to ``batches - 1`` by their time, every tenth two batches
    later, and some without a time. Any batch engine can tell which of them come too late."""
    moment = F.unix_micros(F.col("ts").cast("timestamp"))
    bounds = events.agg(F.min(moment).alias("least"), F.max(moment).alias("most")).first()
    least, most = (bounds[c] / 1_000_000 for c in ("least", "most"))
    stretch = F.floor((moment / 1_000_000 - F.lit(least)) * batches / F.lit(most - least + 1))
    late = F.when(F.col("event_id") % 10 == 3, 2).otherwise(0)
    timeless = F.col("event_id") % 97 == 5
    return events.withColumn("batch", F.least(stretch + late, F.lit(batches - 1)).cast("int")).withColumn(
        "ts", F.when(~timeless, F.col("ts"))
    )


@query
def kpi_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per status: events, those without a time, those that came too late, and the rest, by minute.

    A stream of eight batches counts them; what it drops is what is missing from its counts."""
    root = fresh_folder(spark, "kpi_late_rows")
    events = out_of_order(si.events(spark, sf_dir), 8)
    # Every batch has as many files, so that the stream takes one at a time.
    rows = {row["batch"]: row["count"] for row in events.groupBy("batch").count().collect()}
    pieces = _pieces(min(rows.get(batch, 0) for batch in range(8)))
    for batch in range(8):
        part = events.where(F.col("batch") == batch).drop("batch")
        part.repartition(pieces).write.parquet(f"{root}/in/part={batch}")
    stream = replay(spark, f"{root}/in/*", events.drop("batch").schema, files_per_trigger=pieces)
    counts = kpis.status_counts(si.updates(si.with_stream_time(stream)))
    runner.wait_for_all([sinks.fold_counts(counts, f"{root}/counts", "status_counts", f"{root}/state", every=None)])
    counted = current_rows(spark, f"{root}/counts", counts.schema).groupBy("status")
    counted = counted.agg(
        F.sum("delivery_count").alias("counted"),
        F.count("kpi_calculated_at").alias("minutes"),
    )
    given = si.updates(events).groupBy("status").agg(
        F.count(F.lit(1)).alias("events"), F.count(F.when(F.col("timestamp").isNull(), 1)).alias("without_time")
    )
    late = (F.col("events") - F.col("without_time") - F.col("counted")).alias("too_late")
    return given.join(counted, "status").select("status", "events", "without_time", "counted", "minutes", late)


@query
def kpi_stream_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = kpis.status_counts(_stream_updates(spark, sf_dir))
    root = fresh_folder(spark, "kpi_stream_closed")
    runner.wait_for_all(
        [sinks.append_to_table(counts, f"{root}/table", "closed", f"{root}/state", every=None, by=())]
    )
    closed = stored_table(spark, f"{root}/table", counts.schema)
    return si.plain_times(closed.drop("kpi_calculated_at"))


@query
def alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = al.all_alerts(_stream_updates(spark, sf_dir), MIN_DELAY)
    root = fresh_folder(spark, "alerts_stream")
    runner.wait_for_all(
        [sinks.append_to_table(alerts, f"{root}/table", "alerts", f"{root}/state", every=None, by=())]
    )
    return si.plain_times(stored_table(spark, f"{root}/table", alerts.schema))


@query
def streams_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings, updates and counts as three queries of one session; rows of each table."""
    root = fresh_folder(spark, "streams_together")
    state = f"{root}/state"
    events = si.with_stream_time(si.event_stream(spark, sf_dir))
    messages = encoded(si.updates(events))
    pings = ingest.dated(ingest.stamped(ingest.driver_pings(encoded(si.pings(events)))))
    updates = ingest.dated(ingest.stamped(ingest.delivery_updates(messages)))
    counts = kpis.status_counts(ingest.delivery_states(messages))
    runner.wait_for_all(
        runner.start_all(
            [
                lambda: sinks.append_to_table(pings, f"{root}/pings", "pings", state, every=None),
                lambda: sinks.append_to_table(updates, f"{root}/updates", "updates", state, every=None),
                lambda: sinks.fold_counts(counts, f"{root}/counts", "counts", state, every=None),
            ]
        )
    )
    return catalog.row_counts(
        spark,
        {
            "driver_locations": stored_table(spark, f"{root}/pings", with_event_date(DRIVER_PING)),
            "delivery_analytics": stored_table(spark, f"{root}/updates", with_event_date(DELIVERY_UPDATE)),
            "status_counts": current_rows(spark, f"{root}/counts", counts.schema),
        },
    )


@query
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input and late rows of two streams, one over more than a hundred batches."""
    root = fresh_folder(spark, "stream_progress")
    log = progress.ProgressLog(spark, f"{root}/log")
    updates = _stream_updates(spark, sf_dir)
    counts = kpis.status_counts(updates)
    events = si.events(spark, sf_dir)
    parts = events.select("event_id", "event_type", (F.col("event_id") % 120).alias("part"))
    parts.repartition(8, "part").write.partitionBy("part").parquet(f"{root}/parts")
    slices = replay(spark, f"{root}/parts/*", parts.drop("part").schema, files_per_trigger=1)
    spark.streams.addListener(log)
    try:
        queries = runner.start_all(
            [
                lambda: sinks.append_to_table(counts, f"{root}/counts", "counts", f"{root}/state", every=None, by=()),
                lambda: sinks.append_to_table(slices, f"{root}/slices", "slices", f"{root}/state", every=None, by=()),
            ]
        )
        runner.wait_for_all(queries)
        log.flush(queries)
    finally:
        spark.streams.removeListener(log)
    return (
        log.rows()
        .groupBy("query_name")
        .agg(
            F.sum("input_rows").alias("input_rows"),
            F.sum("late_rows_dropped").alias("late_rows_dropped"),
        )
    )


# --- reports ----------------------------------------------------------------


@query
def report_active_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = si.events(spark, sf_dir)
    return reports.active_drivers(si.pings(events), _now(events), DAY)


@query
def report_deliveries_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = si.events(spark, sf_dir)
    return reports.deliveries_today(si.updates(events), _now(events))


@query
def report_avg_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = si.events(spark, sf_dir)
    return reports.avg_delay(si.updates(events), _now(events), DAY)


@query
def report_kpi_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = si.events(spark, sf_dir)
    return reports.kpi_record(
        si.pings(events),
        si.updates(events),
        al.active_alerts(_alert_records(events)),
        _now(events),
        active_within=DAY,
        delay_within=DAY,
    )


@query
def report_recent_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = si.events(spark, sf_dir)
    return reports.recent_positions(si.pings(events), _now(events), DAY)


@query
def report_hourly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = si.events(spark, sf_dir)
    return reports.hourly_trend(si.updates(events), _now(events), WEEK)


@query
def trend_of_stored_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend on the table a stream has written, of which it reads the last date folders."""
    stream = si.event_stream(spark, sf_dir)
    rows = ingest.dated(ingest.stamped(ingest.delivery_updates(encoded(si.updates(stream)))))
    root = fresh_folder(spark, "trend_of_stored_updates")
    runner.wait_for_all(
        [sinks.append_to_table(rows, f"{root}/table", "updates", f"{root}/state", every=None)]
    )
    stored = stored_table(spark, f"{root}/table", with_event_date(DELIVERY_UPDATE))
    return si.plain_times(reports.hourly_trend(stored, latest_time(stored), WEEK))


@query
def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables by name, and one that is not there."""
    register({name: si.table(spark, sf_dir, name) for name in si.TABLES})
    return catalog.row_counts(spark, catalog.named_tables(spark, [*si.TABLES, "delivery_analytics"]))


@query
def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: si.table(spark, sf_dir, name) for name in si.TABLES}
    register(tables)
    names = catalog.list_tables(spark).where(F.col("table_name").isin(si.TABLES))
    return names.join(catalog.row_counts(spark, tables), "table_name", "left")


# --- alerts -----------------------------------------------------------------


@query
def alerts_high_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.high_delay_alerts(_updates(spark, sf_dir), MIN_DELAY)


@query
def alerts_cancellation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.cancellation_alerts(_updates(spark, sf_dir))


@query
def alerts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.all_alerts(_updates(spark, sf_dir), MIN_DELAY)


@query
def alerts_by_key_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.plain_times(al.active_alerts(_alert_records(si.events(spark, sf_dir))))


@query
def alert_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.alert_count(al.active_alerts(_alert_records(si.events(spark, sf_dir))))


@query
def alert_type_or_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _updates(spark, sf_dir)
    kind = F.when(F.col("status") == "cancelled", "cancellation").when(
        F.col("delay_minutes") >= MIN_DELAY, "high_delay"
    )
    value = json_text(F.struct(kind.alias("anomaly_type"), "order_id"))
    return updates.select("order_id", alert_type(value).alias("anomaly_type"))


@query
def alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = al.active_alerts(_alert_records(si.events(spark, sf_dir)))
    return al.alert_messages(alerts).select("order_id", "anomaly_type", "message")


@query
def latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.latest_alerts(al.all_alerts(_updates(spark, sf_dir), MIN_DELAY))


# --- inserts and lag --------------------------------------------------------


@query
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as incoming rows, several per order; finished orders are held already."""
    incoming = si.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_shipdate").alias("shipped"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("supplier"),
    )
    held = si.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    held = held.select(F.col("o_orderkey").alias("order_key"))
    return inserts.absent_rows(incoming, held, ["order_key"], ["shipped"])


@query
def insert_by_key_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a bucketed table of the held keys, which is not shuffled."""
    incoming = si.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_shipdate").alias("shipped"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("supplier"),
    )
    held = si.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    held = held.select(F.col("o_orderkey").alias("order_key"))
    path = fresh_folder(spark, "insert_by_key_table")
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys.add_keys(held, path, ["order_key"], buckets)
    return inserts.absent_rows(incoming, keys.key_table(spark, path, held.schema, buckets), ["order_key"], ["shipped"])


@query
def insert_into_stored_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases stored by a stream, then all updates inserted by order, twice."""
    stream = si.event_stream(spark, sf_dir).where("event_type = 'purchase'")
    rows = ingest.dated(ingest.stamped(ingest.delivery_updates(encoded(si.updates(stream)))))
    root = fresh_folder(spark, "insert_into_stored_updates")
    runner.wait_for_all([sinks.append_to_table(rows, f"{root}/table", "updates", f"{root}/state", every=None)])
    new = _messages_of_all_updates(spark, sf_dir).persist()
    for _ in range(2):
        inserts.insert_if_absent(new, f"{root}/table", ["order_id"], ["timestamp"])
    new.unpersist()
    held = stored_table(spark, f"{root}/table", new.schema)
    return si.plain_times(held.select("order_id", "status", "timestamp", "delay_minutes", "event_date"))


@query
def insert_by_two_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two clients insert the same keys at once, into a table that holds some of them."""
    new = ingest.dated(_updates(spark, sf_dir).select("order_id", "status", "timestamp", "delay_minutes"))
    path = f"{fresh_folder(spark, 'insert_by_two_clients')}/table"
    inserts.insert_if_absent(new.where("status = 'delivered'"), path, ["order_id"], ["timestamp"])
    with ThreadPoolExecutor(2) as clients:
        for done in [clients.submit(inserts.insert_if_absent, new, path, ["order_id"], ["timestamp"]) for _ in range(2)]:
            done.result()
    return si.plain_times(stored_table(spark, path, new.schema))


@query
def compacted_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates that a stream has stored in ten batches, with an insert of those there already;
    read after two compactions and the deletion of what they replaced."""
    root = fresh_folder(spark, "compacted_updates")
    stream = _event_batches(spark, sf_dir, f"{root}/events", 10)
    rows = ingest.dated(ingest.stamped(ingest.delivery_updates(encoded(si.updates(stream)))))
    runner.wait_for_all([sinks.append_to_table(rows, f"{root}/table", "updates", f"{root}/state", every=None)])
    more = _messages_of_all_updates(spark, sf_dir)
    inserts.insert_if_absent(more, f"{root}/table", ["order_id"], ["timestamp"])
    schema = with_event_date(DELIVERY_UPDATE)
    for _ in range(2):
        compact(spark, f"{root}/table", schema, least=1)
        tidy(spark, f"{root}/table", timedelta(0))
    held = stored_table(spark, f"{root}/table", schema)
    return si.plain_times(held.select("order_id", "status", "timestamp", "delay_minutes", "event_date"))


@query
def alerts_of_stored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of the last week in a table that a stream has stored by date."""
    stream = _stream_updates(spark, sf_dir)
    records = al.alert_records(al.all_alerts(stream, MIN_DELAY), dated=True)
    root = fresh_folder(spark, "alerts_of_stored_records")
    runner.wait_for_all([sinks.append_to_table(records, f"{root}/table", "alerts", f"{root}/state", every=None)])
    held = stored_table(spark, f"{root}/table", records.schema)
    found = al.active_alerts(held, WEEK, _now(si.events(spark, sf_dir)))
    return si.plain_times(found.drop("key"))


@query
def partition_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages of three topics with three partitions; consumers of two
    topics are a day behind, the third topic has none."""
    events = si.events(spark, sf_dir)
    topic = (
        F.when(F.col("event_type") == "view", "driver_locations")
        .when(F.col("event_type") == "error", "traffic_conditions")
        .otherwise("delivery_status")
    )
    sent = events.select(
        topic.alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"), "ts"
    )
    behind = newer_than(events, DAY, _now(events), "ts")
    read = sent.where(~behind & (F.col("topic") != "traffic_conditions"))
    by = ["topic", "partition"]
    return lag.partition_lag(
        sent.groupBy(*by).agg(F.count(F.lit(1)).alias("end_offset")),
        read.groupBy(*by).agg(F.count(F.lit(1)).alias("committed_offset")),
    )


# --- scalar expressions -----------------------------------------------------


@query
def project_ping_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pings(spark, sf_dir).select(*reports.POSITION_COLUMNS)


@query
def derive_entity_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id")
    return si.events(spark, sf_dir).select(
        "event_id",
        prefixed_id("driver_", number, 5).alias("driver_id"),
        prefixed_id("del_", number).alias("delivery_id"),
        prefixed_id("cust_", number).alias("customer_id"),
    )


@query
def classify_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.events(spark, sf_dir).select(
        "event_id", status_by_remainder(F.col("event_id")).alias("status"), F.lit("NYC").alias("location")
    )


@query
def rescale_to_coordinate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.events(spark, sf_dir).select(
        "event_id",
        rescaled_around(si.fraction(), 40.7128, 0.1).alias("latitude"),
        rescaled_around(si.fraction(), -74.0060, 0.1).alias("longitude"),
        rescaled(si.fraction(), 20.0, 60.0).alias("speed"),
        rescaled(si.fraction(), 0.0, 360.0).alias("heading"),
    )


@query
def format_entity_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.events(spark, sf_dir).select(
        "event_id",
        padded_id(ORDER_ID, F.col("event_id")).alias("order_id"),
        padded_id(DRIVER_ID, F.col("user_id")).alias("driver_id"),
        padded_id(CUSTOMER_ID, F.col("user_id")).alias("customer_id"),
        padded_id(AREA_ID, F.col("user_id") % 50 + 1).alias("area_id"),
    )


@query
def estimate_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.events(spark, sf_dir).select(
        "event_id",
        minutes_after(F.col("ts"), si.minutes()).alias("estimated_arrival"),
        minutes_before(F.col("ts"), si.minutes()).alias("order_time"),
    )


@query
def flatten_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.to_json(point(si.latitude(), si.longitude()))
    placed = si.events(spark, sf_dir).select("event_id", point_in(text).alias("location"))
    return placed.select("event_id", "location.lat", "location.lng")


@query
def round_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.events(spark, sf_dir).select("event_id", to_one_decimal(F.col("value")).alias("rating"))
