from collections import Counter

import pytest
from frames import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from haulmark.operators.inserts import absent_rows, insert_if_absent
from haulmark.sources.keys import add_keys, key_table
from haulmark.streaming.stored import stored_table

SCHEMA = "k string, part int, n int, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def least(row, first):
    """Order of rows of one key: by the first column, then the other, nulls first."""
    chosen = (row[2], row[3]) if first == "n" else (row[3], row[2])
    return [(v is not None, v if v is not None else 0) for v in chosen]


def brute_force(incoming, existing, first):
    held = {r[:2] for r in existing if None not in r[:2]}
    free = [r for r in incoming if None in r[:2]]
    best = {}
    for row in incoming:
        key = row[:2]
        if None not in key and key not in held and (key not in best or least(row, first) < least(best[key], first)):
            best[key] = row
    return sorted([*best.values(), *free], key=repr)


ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),
        st.sampled_from([1, 2, None]),
        st.one_of(st.none(), st.integers(0, 3)),
        st.sampled_from(["x", "y", None]),
    ),
    max_size=20,
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS, st.sampled_from(["n", "text"]))
def test_equals_brute_force(spark, incoming, existing, first):
    got = absent_rows(frame(spark, incoming), frame(spark, existing), ["k", "part"], [first])
    assert got.columns == ["k", "part", "n", "text"]
    assert rows_of(got) == brute_force(incoming, existing, first)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_hot_keys_on_both_sides(spark, threshold):
    """A third of all rows under one key, with and without broadcast joins."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
        incoming = spark.range(9000).select(hot.alias("k"), F.col("id").alias("n"))
        existing = spark.range(6000, 12000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
        got = absent_rows(incoming, existing, ["k"], ["n"])
        seen = {r.k: r.n for r in got.collect()}
        held = {-1 if i % 3 == 0 else i for i in range(6000, 12000)}
        assert seen == {0: 0, **{i: i for i in range(9000) if i % 3 and i not in held}}
        assert got.count() == len(seen)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_columns_only(spark):
    incoming = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    existing = spark.createDataFrame([("b",), (None,)], "k string")
    assert rows_of(absent_rows(incoming, existing, ["k"])) == [("a",), (None,), (None,)]


def test_insert_twice_adds_once(spark, tmp_path):
    path = str(tmp_path / "table")
    frame(spark, [("a", 1, 1, "old")]).write.parquet(path)
    new = frame(spark, [("a", 1, 9, "new"), ("b", 1, 2, "x"), ("b", 1, 1, "y")])
    for _ in range(2):
        insert_if_absent(new, path, ["k", "part"], ["n"])
    stored = Counter(tuple(r) for r in spark.read.parquet(path).collect())
    assert stored == {("a", 1, 1, "old"): 1, ("b", 1, 1, "y"): 1}


def test_inserts_into_an_absent_and_a_dated_table_are_visible(spark, tmp_path):
    path = str(tmp_path / "dated")
    rows = frame(spark, [("a", 1, 1, "x"), ("b", 1, 2, "y")]).withColumn("event_date", F.to_date(F.lit("2024-01-02")))
    insert_if_absent(rows.where("k = 'a'"), path, ["k"], ["n"])
    for _ in range(2):
        insert_if_absent(rows, path, ["k"], ["n"])
    assert sorted(r.k for r in stored_table(spark, path, rows.schema).collect()) == ["a", "b"]
    assert (tmp_path / "dated" / "event_date=2024-01-02").is_dir()


def test_a_key_table_is_not_shuffled(spark, tmp_path):
    """Beyond the broadcast bound, only incoming rows are dealt anew; keys added later count."""
    path = str(tmp_path / "keys")
    add_keys(spark.range(0, 5000).select(F.col("id").alias("k")), path, ["k"], 8)
    add_keys(spark.createDataFrame([(5000,), (None,), (3,)], "k long"), path, ["k"], 8)
    incoming = spark.range(4000, 7000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = absent_rows(incoming, key_table(spark, path, incoming.select("k").schema, 8), ["k"], ["n"])
        assert sorted(r.k for r in got.collect()) == list(range(5001, 7000))
        plan = got._jdf.queryExecution().executedPlan().toString()
        stored = [line for line in plan.split("== Initial Plan ==")[0].splitlines() if "keys" in line and "Scan" in line]
        assert stored and all("Bucketed: true" in line for line in stored)
        # Between a scan of the keys and the join above it there is no exchange.
        lines = plan.split("== Initial Plan ==")[0].splitlines()
        for at in (n for n, line in enumerate(lines) if "Scan" in line and "keys" in line):
            above = []
            depth = lines[at].index("Scan")
            for line in reversed(lines[:at]):
                start = len(line) - len(line.lstrip(" :+-*|"))
                if start < depth:
                    depth = start
                    above.append(line)
                    if "Join" in line:
                        break
            assert not any("Exchange" in line for line in above), above
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_the_caller_has_persisted_stay_so(spark, tmp_path):
    """Rows that are costly to make are inserted into several tables, or again, without being made anew."""
    rows = frame(spark, [("a", 1, 1, "x"), ("b", 1, 2, "y"), ("a", 1, 3, "z")]).persist()
    try:
        for _ in range(2):
            insert_if_absent(rows, f"{tmp_path}/t", ["k"], ["n"])
            assert rows.storageLevel.useMemory
    finally:
        rows.unpersist()
    assert stored_table(spark, f"{tmp_path}/t", rows.schema).count() == 2
    other = frame(spark, [("c", 1, 1, "x")])
    insert_if_absent(other, f"{tmp_path}/t", ["k"], ["n"])
    assert not other.storageLevel.useMemory
