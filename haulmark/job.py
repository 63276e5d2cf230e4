"""The fleet streams as one Spark application.

    spark-submit --packages <kafka connector> --py-files haulmark.zip run_job.py \\
        --servers broker:9092 --tables /shared/fleet --min-delay 60

Reads the message topics and keeps the tables of the reports up to date. With
``--replay DIR`` in place of ``--servers`` it reads stored messages from
``DIR/<topic>`` and ends when they are done.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from haulmark.operators import alerts, ingest, kpis
from haulmark.settings import STATE_STORES, shared_root, use_state_store, with_settings
from haulmark.schemas import ALERT_RECORD, DELIVERY_UPDATE, DRIVER_PING, STATUS_COUNT, TRAFFIC_UPDATE, with_event_date
from haulmark.sources.messages import message_stream
from haulmark.streaming import runner, sinks
from haulmark.streaming.compaction import compact, tidy
from haulmark.streaming.progress import ProgressLog, topic_lag
from haulmark.streaming.stored import KEEP, REFUSE, REPLACE, current_rows, stored_table

# The topics of the three message kinds.
PING_TOPIC = "driver_locations"
DELIVERY_TOPIC = "delivery_status"
TRAFFIC_TOPIC = "traffic_conditions"
TOPICS = (PING_TOPIC, DELIVERY_TOPIC, TRAFFIC_TOPIC)

# Names of the tables, as the reports know them.
PINGS = "driver_locations"
UPDATES = "delivery_analytics"
TRAFFIC = "traffic_conditions"
COUNTS = "delivery_status_counts"
ALERTS = "alerts"
LAG = "lag"

# Fixed value: how often the lag is written.
LAG_SECONDS = 60


def fleet_streams(
    topics: Mapping[str, DataFrame],
    tables: str,
    checkpoints: str,
    min_delay_minutes: int,
    *,
    ingest_every: str | None = sinks.INGEST_EVERY,
    kpi_every: str | None = sinks.KPI_EVERY,
    others: str = REFUSE,
) -> list[Callable[[], StreamingQuery]]:
    """The streams over the given topics, ready to start. Each reads its topic on its
    own and has its own progress, so one may lag or restart without the others; the
    deliveries are read twice for that, for the counts and for the updates with their
    alerts. ``others`` says what to do about tables that
    streams with other checkpoint folders have written."""

    def stored(rows: DataFrame, name: str) -> Callable[[], StreamingQuery]:
        path = f"{tables}/{name}"
        return lambda: sinks.append_to_table(rows, path, name, checkpoints, every=ingest_every, others=others)

    def stamped(rows: DataFrame) -> DataFrame:
        return ingest.dated(ingest.stamped(rows))

    deliveries = topics[DELIVERY_TOPIC]
    counts = kpis.status_counts(ingest.delivery_states(deliveries))

    def records(updates: DataFrame) -> DataFrame:
        return alerts.alert_records(alerts.all_alerts(updates, min_delay_minutes), dated=True)

    # One reader of the topic and one parse for the updates and their alerts.
    both = {f"{tables}/{UPDATES}": stamped, f"{tables}/{ALERTS}": records}
    return [
        stored(stamped(ingest.driver_pings(topics[PING_TOPIC])), PINGS),
        lambda: sinks.append_to_tables(
            ingest.delivery_updates(deliveries), both, UPDATES, checkpoints, every=ingest_every, others=others
        ),
        stored(stamped(ingest.traffic_updates(topics[TRAFFIC_TOPIC])), TRAFFIC),
        lambda: sinks.fold_counts(
            counts, f"{tables}/{COUNTS}", COUNTS, checkpoints, every=kpi_every, others=REFUSE if others == KEEP else others
        ),
    ]


#: The tables by date, with the columns that are read back.
DATED = {
    PINGS: with_event_date(DRIVER_PING),
    UPDATES: with_event_date(DELIVERY_UPDATE),
    TRAFFIC: with_event_date(TRAFFIC_UPDATE),
    ALERTS: ALERT_RECORD,
}


class Housekeeping:
    """Once per date: past dates of all tables become few files, and those nobody reads are deleted."""

    def __init__(self, spark: SparkSession, tables: str):
        self._spark, self._tables, self._done = spark, tables, None

    def __call__(self, today: date | None = None) -> None:
        today = today or datetime.now(timezone.utc).date()
        if today == self._done:
            return
        for name, schema in DATED.items():
            compact(self._spark, f"{self._tables}/{name}", schema, before=today)
            tidy(self._spark, f"{self._tables}/{name}")
        self._done = today


def fleet_tables(spark: SparkSession, tables: str) -> dict[str, DataFrame]:
    """The stored tables by name, as the reports and alerts take them."""
    found = {name: stored_table(spark, f"{tables}/{name}", schema) for name, schema in DATED.items()}
    return {**found, COUNTS: current_rows(spark, f"{tables}/{COUNTS}", STATUS_COUNT)}


def console_streams(
    topics: Mapping[str, DataFrame],
    checkpoints: str,
    *,
    ingest_every: str | None = sinks.INGEST_EVERY,
    kpi_every: str | None = sinks.KPI_EVERY,
) -> list[Callable[[], StreamingQuery]]:
    """The same rows and counts to look at, nothing stored."""
    pings = ingest.stamped(ingest.driver_pings(topics[PING_TOPIC]))
    updates = ingest.stamped(ingest.delivery_updates(topics[DELIVERY_TOPIC]))
    counts = kpis.status_counts(ingest.delivery_states(topics[DELIVERY_TOPIC]))
    return [
        lambda: sinks.show_on_console(pings, "show_pings", checkpoints, every=ingest_every),
        lambda: sinks.show_on_console(updates, "show_updates", checkpoints, every=ingest_every),
        lambda: sinks.show_on_console(
            counts,
            "show_counts",
            checkpoints,
            mode="update",
            rows=sinks.KPI_CONSOLE_ROWS,
            every=kpi_every,
        ),
    ]


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--replay", help="folder of stored messages, one folder per topic")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--tables", help="folder of the tables to append to")
    target.add_argument("--console", action="store_true", help="show rows, store nothing")
    parser.add_argument("--checkpoints", help="folder of the progress of the streams")
    parser.add_argument("--min-delay", type=int, help="minutes from which a delay is an alert")
    parser.add_argument(
        "--state-partitions",
        type=int,
        default=8,
        help="partitions of the counts; fixed by the first start on a checkpoint folder",
    )
    parser.add_argument("--max-offsets", type=int, help="most messages of a topic in one batch")
    parser.add_argument("--min-partitions", type=int, help="least tasks that read a topic")
    parser.add_argument("--files-per-trigger", type=int, help="most stored files of a topic in one batch")
    parser.add_argument(
        "--others",
        choices=[REFUSE, KEEP, REPLACE],
        default=REFUSE,
        help="rows that streams with other checkpoint folders have left in the tables; counts are never kept",
    )
    parser.add_argument("--state-store", choices=sorted(STATE_STORES), default="heap", help="where the counts keep their state")
    parser.add_argument("--compact", action="store_true", help="once a day, rewrite the files of past dates as few")
    chosen = parser.parse_args(arguments)
    if chosen.tables and chosen.min_delay is None:
        parser.error("--tables needs --min-delay")

    spark = with_settings(SparkSession.builder.appName("haulmark")).getOrCreate()
    spark.conf.set("spark.sql.shuffle.partitions", chosen.state_partitions)
    use_state_store(spark, chosen.state_store)
    checkpoints = chosen.checkpoints or f"{shared_root(spark)}/haulmark"
    topics = {
        name: message_stream(
            spark, name, servers=chosen.servers, replay_root=chosen.replay,
            files_per_trigger=chosen.files_per_trigger, **broker_options(chosen.max_offsets, chosen.min_partitions),
        )
        for name in TOPICS
    }
    once = {"ingest_every": None, "kpi_every": None} if chosen.replay else {}
    if chosen.console:
        runner.wait_for_all(runner.start_all(console_streams(topics, checkpoints, **once)))
        return
    log = ProgressLog(spark, f"{chosen.tables}/progress")
    spark.streams.addListener(log)
    try:
        streams = fleet_streams(topics, chosen.tables, checkpoints, chosen.min_delay, others=chosen.others, **once)
        queries = runner.start_all(streams)
        house = Housekeeping(spark, chosen.tables) if chosen.compact else None

        def report() -> None:
            write_lag(log, f"{chosen.tables}/{LAG}")
            if house:
                house()

        runner.wait_for_all(queries, report=report, report_every=LAG_SECONDS)
        log.flush(queries)
    finally:
        spark.streams.removeListener(log)


def broker_options(max_offsets: int | None, min_partitions: int | None) -> dict[str, str]:
    given = {"maxOffsetsPerTrigger": max_offsets, "minPartitions": min_partitions}
    return {name: str(value) for name, value in given.items() if value is not None}


def write_lag(log: ProgressLog, path: str) -> None:
    """Append how far each stream is behind in each partition, as of its last batch."""
    offsets = log.newest_offsets()
    lag = topic_lag(offsets.where(F.col("latest_offset").startswith("{") & ~F.col("latest_offset").contains("logOffset")))
    lag.withColumn("measured_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)


if __name__ == "__main__":
    main()
