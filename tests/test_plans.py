"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

from haulmark.functions.moments import latest_time
from haulmark.operators import ingest
from haulmark.operators.inserts import absent_rows
from haulmark.plans import stand_ins as si
from haulmark.plans.registered import QUERIES
from haulmark.schemas import MESSAGE

STREAMS = {n for n in QUERIES if "stream" in n} | {
    "replay_events", "append_pings_to_table", "trend_of_stored_updates", "insert_into_stored_updates",
    "alerts_of_stored_records",
}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_python_no_cross_join(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize(
    "name",
    ["report_active_drivers", "report_deliveries_today", "report_avg_delay", "report_recent_positions",
     "report_hourly_trend", "report_kpi_record"],
)
def test_time_bound_reaches_the_scan(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    pushed = re.findall(r"PushedFilters: \[(.*?), ReadSchema", text)
    assert any("GreaterThan" in p for p in pushed), pushed
    if name == "report_kpi_record":
        assert sum("GreaterThan" in p for p in pushed) == 2


@pytest.mark.parametrize(
    "name, columns",
    [
        ("kpi_status_per_minute", "ts:timestamp_ntz,event_type:string"),
        ("report_deliveries_today", "ts:timestamp_ntz,event_type:string"),
        ("round_rating", "event_id:bigint,value:double"),
        ("table_row_counts", ""),
    ],
)
def test_only_needed_columns_are_read(name, columns, spark, sf_dir):
    assert set(re.findall(r"ReadSchema: struct<(.*?)>", plan(QUERIES[name](spark, sf_dir)))) == {columns}


@pytest.mark.parametrize(
    "name",
    ["ingest_driver_pings", "ingest_delivery_updates", "ingest_traffic_updates", "alerts_all", "alerts_high_delay",
     "alerts_by_key_prefix", "latest_alerts", "report_recent_positions", "encode_events_json"],
)
def test_map_only(name, spark, sf_dir):
    assert "Exchange" not in plan(QUERIES[name](spark, sf_dir))


def test_stored_table_is_read_by_date_folder(spark, sf_dir):
    text = plan(QUERIES["trend_of_stored_updates"](spark, sf_dir))
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date#\d+\), \(event_date#\d+ >= ", text)


def test_counts_are_combined_before_their_only_shuffle(spark, sf_dir):
    text = plan(QUERIES["kpi_status_per_minute"](spark, sf_dir))
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_latest_alerts_sort_nothing_as_a_whole(spark, sf_dir):
    text = plan(QUERIES["latest_alerts"](spark, sf_dir))
    assert "TakeOrderedAndProject" in text and "Sort [" not in text


def test_each_message_is_parsed_once(spark):
    messages = spark.createDataFrame([], MESSAGE)
    text = plan(ingest.delivery_updates(messages))
    assert text.count("from_json(") == 2  # the message, and the place within it


def test_each_alert_is_parsed_once(spark, sf_dir):
    text = plan(QUERIES["alert_messages"](spark, sf_dir))
    assert text.count("from_json(key") + text.count("from_json(StructField(anomaly_type") == 1


def test_the_newest_time_is_looked_up_in_the_newest_folders(spark, tmp_path):
    rows = spark.range(90).select((F.col("id") * 86400).cast("timestamp").alias("timestamp"))
    rows.withColumn("event_date", F.to_date("timestamp")).write.partitionBy("event_date").parquet(f"{tmp_path}/t")
    held = spark.read.parquet(f"{tmp_path}/t")
    assert latest_time(held).timestamp() == 89 * 86400


def tables(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 10).alias("k"), "id").write.parquet(f"{tmp_path}/new")
    spark.range(1000).select("id", F.col("id").alias("k"), F.lit("x" * 50).alias("wide")).write.parquet(
        f"{tmp_path}/held"
    )
    return spark.read.parquet(f"{tmp_path}/new"), spark.read.parquet(f"{tmp_path}/held")


def test_small_increments_do_not_shuffle_the_table(spark, tmp_path):
    new, held = tables(spark, tmp_path)
    text = plan(absent_rows(new, held, ["k"], ["id"]))
    held_scan = text[text.index("LeftSemi") :]
    before_scan = held_scan[: held_scan.index("FileScan")]
    assert "BroadcastHashJoin" in text and "Exchange" not in before_scan
    assert "wide" not in text


def test_large_increments_combine_the_table_before_its_shuffle(spark, tmp_path):
    new, held = tables(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(absent_rows(new, held, ["k"], ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text and "SortAggregate" not in text
    held_side = text[text.index("LeftSemi") :]
    assert held_side.index("HashAggregate") < held_side.index("Exchange") < held_side.rindex("HashAggregate")
    # Whatever is sorted has been shuffled by its key just before.
    lines = [re.sub(r"^[\s:+\-*()0-9]+", "", x) for x in text.splitlines()]
    assert all(lines[n + 1].startswith(("Exchange", "HashAggregate", "SortMergeJoin", "Project")) for n, x in enumerate(lines) if x.startswith("Sort ["))


def test_stand_ins_name_every_table(sf_dir):
    import os

    assert {f.removesuffix(".parquet") for f in os.listdir(sf_dir)} == set(si.TABLES)
