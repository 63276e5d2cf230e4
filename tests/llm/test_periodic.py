"""Periodic runs against a plain search of every period."""

import hashlib
import zlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from haulmark.llm import periodic, queries


def plain_runs(words, least=24, times=3):
    """Every stretch of every period, longest first; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(words) // times + 1):
        same = [a == b for a, b in zip(words, words[q:])]
        start = 0
        for i, equal in enumerate([*same, False]):
            if not equal:
                if i > start and i + q - start >= max(least, times * q):
                    found.setdefault((start, i + q), q)
                start = i + 1
    return sorted((a, q, b) for (a, b), q in found.items())


def collapsed(words, runs):
    gone = {i for a, q, b in runs for i in range(a + q, b)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


text = st.lists(st.integers(0, 3), max_size=12).flatmap(lambda unit: st.tuples(st.just(unit), st.integers(1, 9), st.lists(st.integers(0, 3), max_size=20)))


@settings(max_examples=150, deadline=None)
@given(st.lists(text, max_size=4), st.sampled_from([(24, 3), (6, 3), (12, 4)]))
def test_runs_equal_a_plain_search(parts, rule):
    docs = [unit * n + rest for unit, n, rest in parts]
    docs.append([w for d in docs for w in d])
    row = np.cumsum([0, *map(len, docs)])
    word = np.array([w for d in docs for w in d], np.int64)
    expected = [(row[k] + a, row[k] + b, q) for k, d in enumerate(docs) for a, q, b in plain_runs(d, *rule)]
    assert periodic.runs_of(word, row, *rule).tolist() == [list(map(int, e)) for e in expected]


def test_the_query_equals_a_plain_version(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, sf_dir).collect()}
    assert set(got) == set(docs)
    for k, r in got.items():
        words = brute.words(docs[k])
        n, h = len(words), zlib.crc32(str(k).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words)
        assert r.n_runs == len(runs)
        best = min(runs, key=lambda run: (-(run[2] - run[0]) / run[1], run[0], run[1]), default=None)
        expected = (None,) * 4 if best is None else (best[0], best[2] - best[0], best[1], 1000 * (best[2] - best[0]) // best[1])
        assert (r.start, r.length, r.period, r.exponent_milli) == expected
        lines = "".join(f"{a},{b - a},{q}\n" for a, q, b in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert sum(r.n_runs > 0 for r in got.values()) > 10


def test_awkward_rows(spark):
    unit = [f"w{n}" for n in range(20)]
    long = " ".join(unit * 10_000)
    rows = [(1, None), (None, ""), (2, " \n\t"), (3, " ".join(unit * 3)), (3, " ".join(unit * 3)), (4, " ".join(unit * 2 + unit[:19])), (5, long), (None, "a " * 30), (6, "x" * 2_000_000)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, id string, runs string")
    got = sorted(((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic.periodic_runs(docs).collect()), key=str)
    head = " ".join(unit)
    whole = [
        (1, 0, (), ""), (None, 0, (), ""), (2, 0, (), ""), (3, 60, ((0, 60, 20),), head), (3, 60, ((0, 60, 20),), head),
        (4, 59, (), rows[5][1]), (5, 200_000, ((0, 200_000, 20),), head), (None, 30, ((0, 30, 1),), "a"), (6, 1, (), rows[8][1]),
    ]
    assert got == sorted(whole, key=str)
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def test_ties_and_overlaps(spark):
    """Of equally strong runs the first counts; a word stays only if no run drops it."""
    a, b = ["a", "b", "c"] * 8, ["d", "e", "f"] * 8
    docs = spark.createDataFrame([(1, " ".join(a + b)), (2, " ".join((["x"] * 30 + ["y"]) * 3))], "doc_id long, text string")
    rows = periodic.periodic_runs(docs).withColumn("best", periodic.strongest("runs")).orderBy("doc_id").collect()
    assert tuple(rows[0].best) == (0, 24, 3) and rows[0].collapsed == "a b c d e f"
    assert [tuple(r) for r in rows[1].runs] == [(0, 30, 1), (0, 93, 31), (31, 30, 1), (62, 30, 1)] and rows[1].collapsed == "x y"
    with pytest.raises(ValueError):
        periodic.runs_of(np.zeros(9, np.int64), np.array([0, 9]), 4, 2)
