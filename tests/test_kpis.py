"""The windowed count on tables and streams."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from frames import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from haulmark.operators.kpis import COUNT_KEY, status_counts
from haulmark.plans import stand_ins as si
from haulmark.settings import fresh_folder
from haulmark.sources.messages import replay
from haulmark.streaming import progress, runner, sinks, stored

START = datetime(2024, 1, 1, 10, 0, 0)
SCHEMA = "timestamp timestamp, status string"


def at(seconds):
    return None if seconds is None else START + timedelta(seconds=seconds)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(at(s), k) for s, k in rows], schema)


def write_files(spark, folder, files):
    """One file per list of rows, in the order of their names and times."""
    for n, rows in enumerate(files):
        frame(spark, rows).coalesce(1).write.parquet(f"{folder}/part={n:02d}")


def brute_force(rows):
    counted = Counter((s // 60 * 60, k) for s, k in rows if s is not None)
    return sorted(((at(s), at(s + 60), k, n) for (s, k), n in counted.items()), key=repr)


def flat(counts):
    return rows_of(counts.drop("kpi_calculated_at"))


def test_windows_are_half_open_and_null_times_leave(spark):
    rows = [(0, "a"), (59, "a"), (60, "a"), (-1, "a"), (30, None), (None, "a")]
    got = status_counts(frame(spark, rows))
    assert got.columns == [*COUNT_KEY, "delivery_count", "kpi_calculated_at"]
    assert flat(got) == brute_force(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.one_of(st.none(), st.integers(-200, 200)), st.sampled_from(["a", "b", None])), max_size=30
    )
)
def test_counts_equal_brute_force(spark, rows):
    for schema in (SCHEMA, SCHEMA.replace("timestamp,", "timestamp_ntz,")):
        assert flat(status_counts(frame(spark, rows, schema))) == brute_force(rows)


def test_hot_status_is_combined_before_the_shuffle(spark):
    rows = spark.range(30000).select(
        F.lit(START).cast("timestamp").alias("timestamp"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("status"),
    )
    counts = status_counts(rows)
    assert counts.where("status = 'hot'").first().delivery_count == 10000
    assert counts.count() == 20001


def run(spark, folder, root, *, files_per_trigger=1, name="counts"):
    source = replay(spark, f"{folder}/*", frame(spark, []).schema, files_per_trigger=files_per_trigger)
    query = sinks.fold_counts(status_counts(source), f"{root}/changes", name, f"{root}/state", every=None)
    runner.wait_for_all([query])
    return query


def current(spark, root):
    schema = status_counts(frame(spark, [])).schema
    return stored.current_rows(spark, f"{root}/changes", schema)


def test_stream_equals_table_over_many_files(spark, tmp_path):
    files = [[(60 * n + s, "ab"[s % 2]) for s in range(0, 100, 7)] for n in range(5)]
    write_files(spark, str(tmp_path), files)
    root = fresh_folder(spark, "test")
    run(spark, str(tmp_path), root)
    assert flat(current(spark, root)) == brute_force([r for rows in files for r in rows])


LATE_FILES = [
    [(0, "a"), (30, "b")],
    [(600, "a")],
    [(601, "b")],
    [(10, "a"), (590, "b"), (485, "a"), (455, "a")],
    [(1200, "a")],
]


def test_late_rows_are_dropped_by_the_watermark_of_the_batch_before(spark, tmp_path):
    write_files(spark, str(tmp_path), LATE_FILES)
    root = fresh_folder(spark, "test")
    log = progress.ProgressLog(spark, f"{root}/log")
    spark.streams.addListener(log)
    try:
        log.flush([run(spark, str(tmp_path), root)])
    finally:
        spark.streams.removeListener(log)
    rows = log.rows().orderBy("batch_id").collect()
    assert [r.watermark[11:19] for r in rows] == [
        "00:00:00", "09:58:30", "10:08:00", "10:08:01", "10:08:01", "10:18:00",
    ]
    assert [r.late_rows_dropped for r in rows] == [0, 0, 0, 2, 0, 0]
    assert [r.removed_rows for r in rows] == [0, 0, 2, 0, 0, 4]
    assert [r.state_rows for r in rows] == [2, 3, 2, 4, 5, 1]
    assert [r.input_rows for r in rows] == [2, 1, 1, 4, 1, 0]
    kept = [r for n, file in enumerate(LATE_FILES) for r in file if n != 3 or r[0] not in (10, 455)]
    assert flat(current(spark, root)) == brute_force(kept)


def test_closed_windows_only_in_append_mode(spark, tmp_path):
    write_files(spark, str(tmp_path), LATE_FILES)
    root = fresh_folder(spark, "test")
    source = replay(spark, f"{tmp_path}/*", frame(spark, []).schema)
    counts = status_counts(source)
    runner.wait_for_all(
        [sinks.append_to_table(counts, f"{root}/t", "closed", f"{root}/state", every=None, by=())]
    )
    closed = stored.stored_table(spark, f"{root}/t", counts.schema)
    expected = [r for r in brute_force([r for file in LATE_FILES for r in file]) if r[1] <= at(1200 - 120)]
    assert flat(closed) == expected and len(expected) == 7


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    files = [[(60 * n + s, "ab"[s % 2]) for s in range(0, 100, 9)] for n in range(4)]
    root = fresh_folder(spark, "test")
    write_files(spark, f"{tmp_path}", files[:2])
    run(spark, str(tmp_path), root)
    for n in (2, 3):
        frame(spark, files[n]).coalesce(1).write.parquet(f"{tmp_path}/part={n:02d}")
    second = run(spark, str(tmp_path), root)
    assert sum(p.numInputRows for p in second.recentProgress) == sum(map(len, files[2:]))
    assert flat(current(spark, root)) == brute_force([r for rows in files for r in rows])


def test_time_without_zone_is_refused_on_a_stream(spark, sf_dir):
    with pytest.raises(Exception, match="EVENT_TIME_IS_NOT_ON_TIMESTAMP_TYPE"):
        status_counts(si.updates(si.event_stream(spark, sf_dir)))


@pytest.mark.parametrize("parts", [1, 3])
def test_event_stream_reads_a_file_or_a_folder(spark, sf_dir, tmp_path, parts):
    events = si.events(spark, sf_dir)
    if parts > 1:
        events.repartition(parts).write.parquet(f"{tmp_path}/events.parquet")
        sf_dir = str(tmp_path)
    root = fresh_folder(spark, "test")
    stream = si.event_stream(spark, sf_dir)
    runner.wait_for_all([sinks.append_to_table(stream, f"{root}/t", "r", f"{root}/s", every=None, by=())])
    assert rows_of(stored.stored_table(spark, f"{root}/t", events.schema)) == rows_of(events)
