from frames import rows_of
from pyspark.sql import functions as F

from haulmark.operators import catalog
from haulmark.operators.lag import partition_lag
from haulmark.sources.tables import register
from haulmark.streaming.progress import SOURCE_OFFSETS, topic_offsets


def test_lag(spark):
    ends = spark.createDataFrame([("t", n, 10) for n in range(5)], "topic string, partition int, end_offset long")
    done = spark.createDataFrame(
        [("t", 0, 4), ("t", 1, None), ("t", 2, 0), ("t", 3, 10), ("other", 4, 1)],
        "topic string, partition int, committed_offset long",
    )
    got = {r.partition: r.lag for r in partition_lag(ends, done).collect()}
    assert got == {0: 6, 1: 10, 2: 10, 3: 0, 4: 10}


def test_lag_of_a_stream_from_its_progress(spark):
    offsets = spark.createDataFrame(
        [("counts", 3, '{"t":{"0":40,"1":7}}', '{"t":{"0":50,"1":7,"2":5}}'), ("files", 0, '{"logOffset":0}', None)],
        SOURCE_OFFSETS,
    )
    rows = topic_offsets(offsets).where("query_name = 'counts'")
    by = ["topic", "partition"]
    got = partition_lag(rows.select(*by, "end_offset"), rows.select(*by, "committed_offset"))
    assert {r.partition: r.lag for r in got.collect()} == {0: 10, 1: 0, 2: 5}


def test_row_counts_with_a_missing_table(spark):
    counts = catalog.row_counts(spark, {"a": spark.range(7), "gone": None, "empty": spark.range(0)})
    assert rows_of(counts) == [("a", 7), ("empty", 0), ("gone", None)]


def test_named_tables(spark):
    register({"named_c": spark.range(3)})
    tables = catalog.named_tables(spark, ["named_c", "named_gone"])
    assert tables["named_gone"] is None
    assert rows_of(catalog.row_counts(spark, tables)) == [("named_c", 3), ("named_gone", None)]


def test_list_tables(spark):
    register({"haul_a": spark.range(1), "haul_b": spark.range(1)})
    names = catalog.list_tables(spark).where(F.col("table_name").startswith("haul_"))
    assert rows_of(names) == [("haul_a",), ("haul_b",)]
    assert spark.sql("SELECT count(*) AS n FROM haul_a").first().n == 1
    catalog.list_tables(spark, "default").collect()
