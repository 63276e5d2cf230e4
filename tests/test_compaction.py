"""Compaction, inserts at once and merged counts: each row once, whatever happens in between."""

import os
import random
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark import job
from haulmark.operators.inserts import insert_if_absent
from haulmark.streaming import compaction, sinks, stored
from haulmark.streaming.compaction import compact, tidy
from haulmark.streaming.ledger import Ledger

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType()), T.StructField("event_date", T.DateType())])
NOW = timedelta(0)


def put(path, writer, batch, day, rows):
    """The folder of a batch, as a stream leaves it."""
    folder = f"{path}/event_date={day}/writer={writer}/batch_id={batch}"
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.table({"k": [r[0] for r in rows], "n": pa.array([r[1] for r in rows], pa.int64())}), f"{folder}/part-0.parquet")


def held(spark, path):
    return Counter((r.k, r.n, str(r.event_date)) for r in stored.stored_table(spark, path, SCHEMA).collect())


def files_of(path, day):
    return [f for _, _, names in os.walk(f"{path}/event_date={day}") for f in names if f.endswith(".parquet")]


@pytest.fixture
def table(tmp_path):
    """500 batches of two streams over three dates."""
    path, rows = str(tmp_path / "table"), Counter()
    for batch in range(250):
        for writer in ("a", "b"):
            day = f"2024-01-0{1 + batch // 120}"
            put(path, writer, batch, day, [(writer, batch), ("x", batch)])
            rows.update([(writer, batch, day), ("x", batch, day)])
    return path, rows


def test_many_batches_become_few_files(spark, table):
    path, rows = table
    assert compact(spark, path, SCHEMA, before=date(2024, 1, 3)) == 4
    assert held(spark, path) == rows
    assert tidy(spark, path, NOW) == 480
    assert held(spark, path) == rows
    assert all(len(files_of(path, d)) <= 4 for d in ("2024-01-01", "2024-01-02")) and len(files_of(path, "2024-01-03")) == 20
    # A date before another is not touched again until folders come to it.
    assert compact(spark, path, SCHEMA, before=date(2024, 1, 3)) == 0
    put(path, "a", 250, "2024-01-01", [("late", 1)])
    put(path, "a", 251, "2024-01-01", [("late", 2)])
    put(path, "a", 252, "2024-01-03", [("new", 3)])
    rows.update([("late", 1, "2024-01-01"), ("late", 2, "2024-01-01"), ("new", 3, "2024-01-03")])
    assert held(spark, path) == rows
    assert compact(spark, path, SCHEMA, before=date(2024, 1, 3)) == 1
    assert held(spark, path) == rows and tidy(spark, path, NOW) == 3 and held(spark, path) == rows
    assert stored.stored_table(spark, path, SCHEMA).where("event_date = '2024-01-01'").count() == 482


def test_a_reader_sees_each_row_once_during_the_switch(spark, table, monkeypatch):
    path, rows = table
    before = stored.stored_table(spark, path, SCHEMA)
    seen = []
    commit = Ledger.commit

    def watched(self, state):
        seen.append(held(spark, path))
        done = commit(self, state)
        seen.append(held(spark, path))
        return done

    monkeypatch.setattr(Ledger, "commit", watched)
    compact(spark, path, SCHEMA)
    after = stored.stored_table(spark, path, SCHEMA)
    assert seen == [rows, rows]
    # Both go on while what was replaced is there for a while.
    assert tidy(spark, path, timedelta(hours=1)) == 0
    for frame in (before, after):
        assert Counter((r.k, r.n, str(r.event_date)) for r in frame.collect()) == rows


def test_the_newest_batch_of_a_stream_may_run_again(spark, tmp_path):
    path = str(tmp_path)
    for batch in range(3):
        put(path, "a", batch, "2024-01-01", [("a", batch)])
    assert compact(spark, path, SCHEMA) == 1
    rows = spark.createDataFrame([("a", 2, date(2024, 1, 1)), ("a", 2, date(2024, 1, 2))], SCHEMA)
    for _ in range(2):
        stored.write_batch(rows, path, "a", 2, ["event_date"])
    assert held(spark, path) == Counter([("a", 0, "2024-01-01"), ("a", 1, "2024-01-01"), ("a", 2, "2024-01-01"), ("a", 2, "2024-01-02")])


def test_a_compaction_that_dies_changes_nothing(spark, table, monkeypatch):
    path, rows = table
    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "commit", lambda self, state: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact(spark, path, SCHEMA)
    assert held(spark, path) == rows
    assert compact(spark, path, SCHEMA) == 6 and held(spark, path) == rows
    assert tidy(spark, path, NOW) > 0 and held(spark, path) == rows
    assert sum(len(files_of(path, f"2024-01-0{d}")) for d in (1, 2, 3)) <= 6 + 2


def test_the_slower_of_two_compactions_gives_way(spark, table, monkeypatch):
    path, rows = table
    rewrite, inner = compaction._rewrite, []

    def second(*arguments):
        rewrite(*arguments)
        if not inner:
            inner.append(None)
            inner[0] = compact(spark, path, SCHEMA)

    monkeypatch.setattr(compaction, "_rewrite", second)
    assert compact(spark, path, SCHEMA) == 0 and inner == [6]
    assert held(spark, path) == rows


def frame(spark, rows):
    return spark.createDataFrame([(k, n, date(2024, 1, d)) for k, n, d in rows], SCHEMA)


def test_inserts_compact_by_date_and_stay_keyed(spark, tmp_path):
    path = str(tmp_path)
    put(path, "a", 0, "2024-01-01", [("s", 0)])
    for n in range(3):
        insert_if_absent(frame(spark, [(f"k{n}", n, 1), (f"m{n}", n, 2), ("s", 9, 1)]), path, ["k"], ["n"])
    rows = Counter([("s", 0, "2024-01-01"), *((f"{c}{n}", n, f"2024-01-0{d}") for n in range(3) for c, d in (("k", 1), ("m", 2)))])
    assert held(spark, path) == rows
    assert compact(spark, path, SCHEMA, before=date(2024, 1, 2)) == 1 and held(spark, path) == rows
    assert len(Ledger(spark, path).newest().inserts) == 3  # their second date is as it was
    insert_if_absent(frame(spark, [("k1", 7, 1), ("m2", 7, 2), ("z", 7, 2)]), path, ["k"], ["n"])
    rows["z", 7, "2024-01-02"] += 1
    assert held(spark, path) == rows
    assert compact(spark, path, SCHEMA) == 1 and Ledger(spark, path).newest().inserts == []
    assert tidy(spark, path, NOW) > 0 and held(spark, path) == rows
    assert os.path.isdir(f"{path}/event_date=2024-01-01/writer=inserts")


def test_two_clients_insert_the_same_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    draw = random.Random(4)
    parts = [[(f"k{draw.randrange(60)}", c * 100 + n, draw.randrange(1, 4)) for n in range(40)] + [(None, c, 1)] for c in range(3)]
    with ThreadPoolExecutor(3) as clients:
        for done in [clients.submit(insert_if_absent, frame(spark, rows), path, ["k"], ["n"]) for rows in parts]:
            done.result()
    got = held(spark, path)
    keys = Counter(k for k, _, _ in got.elements())
    assert keys.pop(None) == 3
    assert set(keys) == {k for rows in parts for k, _, _ in rows if k} and set(keys.values()) == {1}


@pytest.mark.parametrize("compacted", [False, True])
def test_the_slower_insert_looks_at_what_the_faster_added(spark, tmp_path, monkeypatch, compacted):
    path, commit, other = str(tmp_path / "t"), Ledger.commit, []

    def slow(self, state):
        if not other:
            other.append(True)
            insert_if_absent(frame(spark, [("a", 1, 1), ("b", 1, 2)]), path, ["k"])
            if compacted:  # and the ledger forgets the steps between
                compact(spark, path, SCHEMA, least=1)
                self.forget(self.newest().number)
        return commit(self, state)

    monkeypatch.setattr(Ledger, "commit", slow)
    insert_if_absent(frame(spark, [("a", 2, 1), ("c", 2, 1)]), path, ["k"])
    assert held(spark, path) == Counter([("a", 1, "2024-01-01"), ("b", 1, "2024-01-02"), ("c", 2, "2024-01-01")])


def test_rows_of_an_insert_that_died_do_not_count(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    insert_if_absent(frame(spark, [("a", 1, 1)]), path, ["k"])
    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "commit", lambda self, state: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            insert_if_absent(frame(spark, [("b", 1, 1)]), path, ["k"])
    assert [k for k, _, _ in held(spark, path)] == ["a"]
    insert_if_absent(frame(spark, [("b", 2, 1)]), path, ["k"])
    assert held(spark, path) == Counter([("a", 1, "2024-01-01"), ("b", 2, "2024-01-01")])


def test_inserts_from_before_there_was_a_ledger_count(spark, tmp_path):
    path = str(tmp_path)
    put(path, "insert-old", 0, "2024-01-01", [("a", 1)])
    insert_if_absent(frame(spark, [("a", 2, 1), ("b", 2, 1)]), path, ["k"])
    assert held(spark, path) == Counter([("a", 1, "2024-01-01"), ("b", 2, "2024-01-01")])


def test_files_follow_dates_and_not_tasks(spark, tmp_path):
    days = F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 5).cast("int"))
    rows = spark.range(20_000, numPartitions=16).select(F.col("id").cast("string").alias("k"), F.col("id").alias("n"), days.alias("event_date"))
    stored.write_batch(rows, str(tmp_path), "w", 0, ["event_date"])
    assert sum(len(files_of(tmp_path, f"2024-01-0{d}")) for d in range(1, 6)) <= 8
    assert stored.stored_table(spark, str(tmp_path), SCHEMA).count() == 20_000


KEY = ["window_start", "window_end", "status"]


def fold(spark, path, batch, minute):
    """A batch whose newest window is ``minute``, with changes to the one before."""
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    rows = [(at(m), at(m + 1), "s", 100 * batch + m) for m in (minute - 1, minute)]
    changes = spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, status string, n long")
    stored.fold_changes(changes, path, "w", batch, KEY, "window_start", "window_end", "2 minutes")
    return changes.schema, {r[0]: r for r in rows}


def test_closed_windows_are_merged_in_tiers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "MERGED", 3)
    path, expected, most = str(tmp_path), {}, 0
    for batch in range(30):
        schema, rows = fold(spark, path, batch, 5 * batch)
        expected.update(rows)
        if batch in (9, 14, 27):  # a batch that runs again
            fold(spark, path, batch, 5 * batch)
        most = max(most, len(os.listdir(f"{path}/writer=w/closed")))
        if batch % 9 in (0, 4):
            got = stored.current_rows(spark, path, schema).collect()
            assert sorted(tuple(r) for r in got) == sorted(expected.values())
    names = stored._standing(os.listdir(f"{path}/writer=w/closed"))
    assert "batches-0-26" in names and len(names) <= 6 and most <= 13


def test_a_merge_that_dies_is_done_by_the_next_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "MERGED", 3)
    path, expected = str(tmp_path), {}
    for batch in range(3):
        schema, rows = fold(spark, path, batch, 5 * batch)
        expected.update(rows)
    with monkeypatch.context() as patch:
        patch.setattr(stored.Files, "rename", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fold(spark, path, 3, 15)
    schema, rows = fold(spark, path, 3, 15)
    expected.update(rows)
    assert sorted(map(tuple, stored.current_rows(spark, path, schema).collect())) == sorted(expected.values())
    assert "batches-0-2" in os.listdir(f"{path}/writer=w/closed")


def test_one_stream_writes_two_tables_once_each(spark, tmp_path):
    """The second table fails in the first run; the batch runs again, and both have each row once."""
    source = f"{tmp_path}/in"
    spark.range(50).write.parquet(source)
    state = {"fail": True}

    def doubled(rows):
        if state["fail"]:
            raise RuntimeError("no")
        return rows.select((F.col("id") * 2).alias("id"))

    targets = {f"{tmp_path}/a": lambda rows: rows, f"{tmp_path}/b": doubled}
    run = lambda: sinks.append_to_tables(spark.readStream.schema("id long").parquet(source), targets, "both", f"{tmp_path}/state", every=None, by=())
    with pytest.raises(Exception, match="no"):
        run().awaitTermination()
    state["fail"] = False
    run().awaitTermination()
    schema = spark.range(1).schema
    assert sorted(r.id for r in stored.stored_table(spark, f"{tmp_path}/a", schema).collect()) == list(range(50))
    assert sorted(r.id for r in stored.stored_table(spark, f"{tmp_path}/b", schema).collect()) == list(range(0, 100, 2))


def test_housekeeping_runs_once_per_date(spark, tmp_path, monkeypatch):
    done = []
    monkeypatch.setattr(job, "compact", lambda spark, path, schema, before: done.append((os.path.basename(path), before)))
    monkeypatch.setattr(job, "tidy", lambda spark, path: None)
    house = job.Housekeeping(spark, str(tmp_path))
    for day in (1, 1, 2):
        house(date(2024, 1, day))
    assert len(done) == 2 * len(job.DATED) and {before.day for _, before in done} == {1, 2}
