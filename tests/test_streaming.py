"""Sources, sinks, the runner and the whole application."""

import os
import subprocess
import sys
import time
from datetime import timedelta

import frames as f
import pytest
from frames import AS_OF, one, rows_of
from pyspark import TaskContext
from pyspark.sql import functions as F

from haulmark import job
from haulmark.functions.messages import encoded
from haulmark.operators import alerts as al
from haulmark.operators import ingest, kpis, reports
from haulmark.plans import registered
from haulmark.plans import stand_ins as si
from haulmark.schemas import DELIVERY_UPDATE, DRIVER_PING, MESSAGE, with_event_date
from haulmark import settings as st
from haulmark.settings import SESSION_SETTINGS, fresh_folder, shared_root
from haulmark.sources import messages as src
from haulmark.sources.tables import jdbc_options
from haulmark.streaming import progress, runner, sinks, stored


def test_kafka_source_options():
    options = src.kafka_options("b:1", "t", maxOffsetsPerTrigger="5")
    assert options == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "5",
    }
    assert src.kafka_options("b", "t", startingOffsets="earliest")["startingOffsets"] == "earliest"


def test_kafka_sink_options():
    options = sinks.topic_options("b:1", "t")
    assert options["topic"] == "t" and options["kafka.acks"] == "all" and options["kafka.retries"] == "3"


def test_source_is_chosen_by_argument(spark):
    with pytest.raises(ValueError):
        src.message_stream(spark, "t")
    with pytest.raises(ValueError):
        src.message_stream(spark, "t", servers="b", replay_root="r")


def test_missing_connector_is_an_error_and_no_silent_stand_in(spark):
    with pytest.raises(Exception, match="kafka"):
        src.message_stream(spark, "t", servers="b:1")


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "t", split_on="id", low="0", high="9", splits=4, fetchsize="1000")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4" and options["fetchsize"] == "1000"
    assert jdbc_options("jdbc:x", "t") == {"url": "jdbc:x", "dbtable": "t"}
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", split_on="id")


def test_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    first, second = fresh_folder(spark, "x"), fresh_folder(spark, "x")
    assert first != second and first.startswith(f"{root}/x-")


class Session:
    """Settings and nothing else."""

    def __init__(self, **settings):
        self.conf = settings


def test_only_a_local_session_may_use_the_named_folder(monkeypatch, tmp_path):
    local, cluster = Session(**{"spark.master": "local[2]"}), Session(**{"spark.master": "yarn"})
    monkeypatch.setattr(st, "_named", [])
    for session in (local, cluster):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_root(session)
    st.name_folder(f"{tmp_path}/")
    assert shared_root(local) == str(tmp_path)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(cluster)
    assert shared_root(Session(**{"spark.checkpoint.dir": "hdfs:///c/"})) == "hdfs:///c"


def test_settings_are_known_to_the_session(spark):
    assert all(spark.conf.get(key) == value for key, value in SESSION_SETTINGS.items())


def ping_messages(spark, sf_dir):
    return encoded(si.pings(si.event_stream(spark, sf_dir)))


def test_append_stamps_one_time_per_batch(spark, sf_dir, tmp_path):
    for n in range(3):
        si.events(spark, sf_dir).limit(5).coalesce(1).write.parquet(f"{tmp_path}/p={n}")
    events = src.replay(spark, f"{tmp_path}/*", si.events(spark, sf_dir).schema, files_per_trigger=1)
    rows = ingest.dated(ingest.stamped(ingest.driver_pings(encoded(si.pings(events)))))
    root = fresh_folder(spark, "test")
    runner.wait_for_all([sinks.append_to_table(rows, f"{root}/t", "p", f"{root}/s", every=None)])
    rows = stored.stored_table(spark, f"{root}/t", with_event_date(DRIVER_PING))
    assert rows.count() == 15
    assert rows.where("processed_at IS NULL").count() == 0
    assert rows.select("processed_at").distinct().count() == 3


def test_malformed_messages_are_stored_as_null_rows_and_leave_the_counts(spark, tmp_path):
    texts = ["junk", '{"status":"delivered","timestamp":"2024-01-01T00:00:00"}', None]
    f.messages(spark, texts).write.parquet(f"{tmp_path}/delivery_status")
    stream = src.message_stream(spark, "delivery_status", replay_root=str(tmp_path))
    rows = ingest.dated(ingest.stamped(ingest.delivery_updates(stream)))
    counts = kpis.status_counts(ingest.delivery_states(stream))
    root = fresh_folder(spark, "test")
    runner.wait_for_all(
        runner.start_all(
            [
                lambda: sinks.append_to_table(rows, f"{root}/t", "rows", f"{root}/s", every=None),
                lambda: sinks.fold_counts(counts, f"{root}/c", "counts", f"{root}/s", every=None),
            ]
        )
    )
    kept = stored.stored_table(spark, f"{root}/t", with_event_date(DELIVERY_UPDATE))
    assert kept.count() == 3 and kept.where("status IS NULL").count() == 2
    assert kept.where("event_date IS NULL").count() == 2
    now = stored.current_rows(spark, f"{root}/c", counts.schema)
    assert one(now).delivery_count == 1


def test_a_batch_that_runs_again_leaves_no_double(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1), ("b", 1)], "k string, n long")
    for batch, rows in [(0, frame), (1, frame), (1, frame.where("k = 'a'").unionAll(frame.where("k = 'b'")))]:
        stored.write_batch(rows, str(tmp_path), "w", batch, ["k"])
    assert rows_of(stored.stored_table(spark, str(tmp_path), frame.schema)) == [("a", 1)] * 2 + [("b", 1)] * 2
    assert frame.columns == ["k", "n"] == frame.schema.names


MINUTES = "window_start timestamp, window_end timestamp, status string, n long"


def changes(spark, *rows):
    minute = timedelta(minutes=1)
    return spark.createDataFrame([(AS_OF + a * minute, AS_OF + (a + 1) * minute, k, n) for a, k, n in rows], MINUTES)


def fold(frame, path, batch):
    stored.fold_changes(frame, path, "w", batch, ["window_start", "window_end", "status"], "window_start", "window_end", "2 minutes")


def test_folded_changes(spark, tmp_path):
    """The last change of a key counts, a batch may run again, and the read stays small."""
    path = str(tmp_path)

    def now():
        found = stored.current_rows(spark, path, first.schema).collect()
        return sorted(((r.window_start.minute, r.status, r.n) for r in found), key=repr)

    first = changes(spark, (0, "a", 1), (0, None, 1))
    fold(first, path, 0)
    for _ in range(2):
        fold(changes(spark, (0, "a", 2), (1, "a", 1)), path, 1)
        assert now() == [(0, "a", 2), (0, None, 1), (1, "a", 1)]
    for batch in range(2, 12):
        fold(changes(spark, (batch, "a", 1)), path, batch)
    assert len(now()) == 13
    assert len(os.listdir(f"{path}/writer=w/open")) <= 3
    rows = stored.current_rows(spark, path, first.schema)
    assert rows.count() == len({(r.window_start, r.status) for r in rows.collect()})
    open_rows = spark.read.parquet(f"{path}/writer=w/open/batch_id=11").count()
    assert open_rows <= 5


def file_stream(spark, folder, batches):
    for number, rows in enumerate(batches):
        spark.createDataFrame([(r,) for r in rows], "k string").coalesce(1).write.parquet(f"{folder}/{number}")
    schema = spark.createDataFrame([("a",)], "k string").schema
    return src.replay(spark, f"{folder}/*", schema, files_per_trigger=1)


def stored_keys(spark, path):
    return sorted(r.k for r in stored.stored_table(spark, path, spark.createDataFrame([("a",)], "k string").schema).collect())


@pytest.mark.parametrize("others, expected", [("keep", ["a", "b", "x", "y", "z"]), ("replace", ["x", "y", "z"]), ("refuse", None)])
def test_a_new_checkpoint_hides_no_rows(spark, tmp_path, others, expected):
    path = f"{tmp_path}/t"
    first = file_stream(spark, f"{tmp_path}/one", [["a"], ["b"]])
    runner.wait_for_all([sinks.append_to_table(first, path, "s", f"{tmp_path}/c1", every=None, by=())])
    second = file_stream(spark, f"{tmp_path}/two", [["x"], ["y", "z"]])

    def again():
        query = sinks.append_to_table(second, path, "s", f"{tmp_path}/c2", every=None, by=(), others=others)
        runner.wait_for_all([query])

    if expected is None:
        with pytest.raises(Exception, match="OtherWriter"):
            again()
        assert stored_keys(spark, path) == ["a", "b"]
    else:
        again()
        again()  # nothing new: a restart adds nothing
        assert stored_keys(spark, path) == expected


def test_counts_after_a_new_checkpoint_equal_the_batch_twin(spark, sf_dir, tmp_path):
    events = si.with_stream_time(si.events(spark, sf_dir))
    some = events.limit(40).cache()
    def run(rows, name, **how):
        rows.repartitionByRange(3, "ts").write.parquet(f"{tmp_path}/{name}/in")
        stream = src.replay(spark, f"{tmp_path}/{name}/in", rows.schema, files_per_trigger=3)
        counts = kpis.status_counts(si.updates(stream))
        runner.wait_for_all([sinks.fold_counts(counts, f"{tmp_path}/counts", "c", f"{tmp_path}/{name}/c", every=None, **how)])
        return stored.current_rows(spark, f"{tmp_path}/counts", counts.schema).drop("kpi_calculated_at")
    run(some.limit(3), "few")
    with pytest.raises(Exception, match="OtherWriter"):
        run(some, "more")
    got = run(some, "again", others="replace")
    assert rows_of(got) == rows_of(kpis.status_counts(si.updates(some)).drop("kpi_calculated_at"))
    with pytest.raises(ValueError):
        sinks.fold_counts(got, "p", "n", "c", others="keep")


def test_progress_of_more_than_a_hundred_batches(spark, tmp_path):
    spark.range(120).select(F.col("id").cast("string").alias("k"), "id").repartition(8, "id").write.partitionBy("id").parquet(f"{tmp_path}/in")
    schema = spark.createDataFrame([("a",)], "k string").schema
    stream = src.replay(spark, f"{tmp_path}/in/*", schema, files_per_trigger=1)
    log = progress.ProgressLog(spark, f"{tmp_path}/log", hold=50)
    spark.streams.addListener(log)
    try:
        query = sinks.append_to_table(stream, f"{tmp_path}/t", "many", f"{tmp_path}/c", every=None, by=())
        runner.wait_for_all([query])
        log.flush([query])
    finally:
        spark.streams.removeListener(log)
    rows = log.rows().where("input_rows > 0")
    assert rows.count() == 120 and one(rows.agg(F.sum("input_rows").alias("n"))).n == 120
    assert log.source_offsets().count() >= 120 and log.newest_offsets().count() == 1
    assert len(stored_keys(spark, f"{tmp_path}/t")) == 120


def test_console_application(spark, sf_dir, tmp_path):
    """In a process of its own, whose output can be read."""
    events = si.events(spark, sf_dir)
    for topic, rows in [
        (job.PING_TOPIC, si.pings(events)),
        (job.DELIVERY_TOPIC, si.updates(events)),
        (job.TRAFFIC_TOPIC, si.traffic(events)),
    ]:
        encoded(rows).write.parquet(f"{tmp_path}/{topic}")
    submit = "--master local[4] --conf spark.ui.enabled=false pyspark-shell"
    done = subprocess.run(
        [sys.executable, "-m", "haulmark.job", "--replay", str(tmp_path), "--console",
         "--checkpoints", f"{tmp_path}/state", "--state-partitions", "2"],
        capture_output=True,
        text=True,
        timeout=180,
        cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": submit},
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.count("only showing top 10 rows") == 2
    assert done.stdout.count("only showing top 20 rows") == 1
    assert "delivery_count" in done.stdout and "processed_at" in done.stdout


def test_triggers(spark, sf_dir):
    root = fresh_folder(spark, "test")
    query = sinks.append_to_table(
        si.event_stream(spark, sf_dir), f"{root}/t", "ticking", f"{root}/s", every="10 seconds", by=()
    )
    try:
        query.processAllAvailable()
        assert query.isActive and query.name == "ticking"
        assert "ProcessingTimeTrigger(10000)" in str(
            query._jsq.streamingQuery().trigger()
        )
    finally:
        runner.stop_all([query])
    assert not query.isActive


def fails(spark, sf_dir, root, name):
    broken = si.event_stream(spark, sf_dir).select(F.raise_error(F.lit("broken row")).cast("string").alias("x"))
    return sinks.append_to_table(broken, f"{root}/{name}", name, f"{root}/s", every="1 second", by=())


def test_a_failure_anywhere_stops_all_and_raises(spark, sf_dir):
    root = fresh_folder(spark, "test")
    queries = runner.start_all(
        [
            lambda: sinks.append_to_table(
                si.event_stream(spark, sf_dir), f"{root}/good", "good", f"{root}/s", every="1 second", by=()
            ),
            lambda: fails(spark, sf_dir, root, "bad"),
        ]
    )
    began = time.monotonic()
    with pytest.raises(Exception, match="broken row"):
        runner.wait_for_all(queries)
    assert time.monotonic() - began < 60
    assert not any(q.isActive for q in queries)


def test_a_failed_start_stops_those_before(spark, sf_dir):
    root = fresh_folder(spark, "test")

    def no_start():
        raise RuntimeError("no start")

    with pytest.raises(RuntimeError, match="no start"):
        runner.start_all(
            [
                lambda: sinks.append_to_table(
                    si.event_stream(spark, sf_dir), f"{root}/t", "first", f"{root}/s", every="1 second", by=()
                ),
                no_start,
            ]
        )
    assert "first" not in [q.name for q in spark.streams.active]


def test_whole_application_from_messages_to_reports(spark, sf_dir, tmp_path, monkeypatch):
    """Stored messages in, tables out; the reports on them equal those on the source rows."""
    events = si.events(spark, sf_dir)
    pings, updates, traffic = si.pings(events), si.updates(events), si.traffic(events)
    source, tables = f"{tmp_path}/in", f"{tmp_path}/out"
    for topic, rows in [(job.PING_TOPIC, pings), (job.DELIVERY_TOPIC, updates), (job.TRAFFIC_TOPIC, traffic)]:
        encoded(rows).write.parquet(f"{source}/{topic}")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        job.main(["--replay", source, "--tables", tables, "--min-delay", "100", "--state-partitions", "2",
                  "--checkpoints", f"{tmp_path}/state", "--files-per-trigger", "1"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)

    as_of = events.agg(F.max("ts")).first()[0]
    week = timedelta(days=7)
    found = job.fleet_tables(spark, tables)
    stored_pings, updates_held, records = found[job.PINGS], found[job.UPDATES], found[job.ALERTS]
    assert rows_of(reports.active_drivers(stored_pings, as_of, week)) == rows_of(
        reports.active_drivers(pings, as_of, week)
    )
    assert rows_of(si.plain_times(reports.hourly_trend(updates_held, as_of, week))) == rows_of(
        reports.hourly_trend(updates, as_of, week)
    )
    alerts = al.active_alerts(records)
    assert rows_of(reports.kpi_record(stored_pings, updates_held, alerts, as_of, delay_within=week)) == rows_of(
        reports.kpi_record(pings, updates, al.all_alerts(updates, 100), as_of, delay_within=week)
    )
    counts = kpis.status_counts(si.updates(si.with_stream_time(events)))
    assert rows_of(found[job.COUNTS].drop("kpi_calculated_at")) == rows_of(counts.drop("kpi_calculated_at"))
    assert found[job.TRAFFIC].count() == events.count()
    assert spark.read.parquet(f"{tables}/progress/progress").count() >= 5
    assert spark.read.parquet(f"{tables}/lag").columns[-1] == "measured_at"


def test_batch_bounds_and_lag_of_the_job(spark):
    assert job.broker_options(5, None) == {"maxOffsetsPerTrigger": "5"}
    assert job.broker_options(5, 9) == {"maxOffsetsPerTrigger": "5", "minPartitions": "9"}
    offsets = spark.createDataFrame(
        [("q", 3, '{"t":{"0":4}}', '{"t":{"0":9,"1":2}}')], progress.SOURCE_OFFSETS
    )
    got = rows_of(progress.topic_lag(offsets).select("query_name", "topic", "partition", "lag"))
    assert got == [("q", "t", 0, 5), ("q", "t", 1, 2)]


def test_arguments():
    for arguments in ([], ["--servers", "b"], ["--servers", "b", "--tables", "t"],
                      ["--servers", "b", "--replay", "r", "--console"]):
        with pytest.raises(SystemExit):
            job.main(arguments)


def test_sample_rows_as_of_are_plain(spark):
    assert one(f.pings(spark).agg(F.max("timestamp").alias("t"))).t == AS_OF
    assert MESSAGE.names == ["value"]


def test_folding_leaves_the_partitions_of_the_state_to_their_tasks(spark, tmp_path):
    """One task for all partitions would hold the memory of all their maps at once."""
    task = F.udf(lambda n: str(TaskContext.get().taskAttemptId()))
    minute = F.timestamp_seconds(F.col("id") * 60)
    rows = spark.range(0, 80, 1, 8).select(minute.alias("window_start"), (minute + F.expr("INTERVAL 1 MINUTE")).alias("window_end"), task("id").alias("status"), F.col("id").alias("n"))
    for batch in range(2):
        fold(rows.where(F.col("n") >= 40 * batch), str(tmp_path), batch)
        held = stored.current_rows(spark, str(tmp_path), rows.schema)
        assert held.where(F.col("n") >= 40 * batch).select("status").distinct().count() >= 4


def test_many_folded_counts_take_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "FILE_ROWS", 10, raising=False)
    monkeypatch.setattr(stored, "MERGED", 4)
    path = str(tmp_path)
    for batch in range(5):
        first = changes(spark, *((10 * batch + k, status, batch) for k in range(10) for status in "abc"))
        fold(first, path, batch)
        parts = [n for n in os.listdir(f"{path}/writer=w/open/batch_id={batch}") if n.endswith(".parquet")]
        assert len(parts) > 1
    (merged,) = (n for n in os.listdir(f"{path}/writer=w/closed") if n.startswith("batches-"))
    assert len([n for n in os.listdir(f"{path}/writer=w/closed/{merged}") if n.endswith(".parquet")]) > 1
    held = stored.current_rows(spark, path, first.schema)
    assert held.count() == held.distinct().count() == 150


def batch_files(root):
    return [sum(n.endswith(".parquet") for n in os.listdir(f"{root}/{part}")) for part in sorted(os.listdir(root))]


@pytest.mark.parametrize("name, folder, batches", [("kpi_late_rows", "in", 8), ("kpi_stream_update", "events-in-order", 6)])
def test_batches_of_several_files_give_the_same(spark, sf_dir, monkeypatch, tmp_path, name, folder, batches):
    """A batch in one file is written by one task, and read by one."""
    plain = lambda frame: rows_of(frame.drop("kpi_calculated_at"))
    expected = plain(registered.QUERIES[name](spark, sf_dir))
    monkeypatch.setattr(registered, "PIECE_ROWS", 25, raising=False)
    monkeypatch.setattr(registered, "fresh_folder", lambda spark, query: str(tmp_path))
    found = registered.QUERIES[name](spark, sf_dir)
    assert plain(found) == expected
    files = batch_files(f"{tmp_path}/{folder}")
    assert len(files) == batches and set(files) == {files[0]} and files[0] > 1
    assert len(os.listdir(f"{tmp_path}/state/status_counts/sources/0")) >= batches
