"""The divergence audit against its SQL, a plain version and plain skybands."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from haulmark.llm import divergence, queries

SCHEMA = "text string, lang string, source string"


def plain(rows, least=10, top=10):
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count, docs = defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate(small) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang].add(source)
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        held = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        whole = sum(held.values())
        p = {s: {t: 1 + 10**9 * (count[lang, s][t] + 2) // (held[s] + 2 * len(kept)) for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (sum(count[lang, s][t] for s in sources) + 2) // (whole + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -value, k + 1) for k, (value, _, item) in enumerate(items)]
    return sorted(out)


def got(frame):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in frame.collect())


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    letters = ["aa", "Ab", "ÄB", "ab", "zz", "é", "日本", "x1y", "it's", "[q]", "😀"]
    out = []
    for n in range(400):
        words = [draw.choice(letters) if draw.random() < 0.3 else f"w{'abcdefghij'[draw.randrange(10)]}{'klmno'[draw.randrange(5)]}" for _ in range(draw.randrange(40))]
        out.append((" ".join(words), draw.choice(["en", "de", None, ""]), draw.choice([None, "s1", "s2", "s3", "é", "Z"])))
    out += [(None, "xx", "a"), ("", "xx", "b"), (None, "lone", "a"), ("\x00\x1f ~~ 12", "en", "only"), ("aa " * 700_000, "en", "s1")]
    return out + out[:30]


def test_audit_equals_a_plain_version(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("term", "n", "docs", "tile", "rank", "doc_id")}).repartition(7)
    for least, top in ((10, 10), (1, 2)):
        assert got(divergence.audit(docs, least, top)) == plain(rows, least, top)
    # Cells of few terms and sources, and pieces of few bytes, give the same.
    for name, size in (("CELL_TERMS", 7), ("CELL_SOURCES", 2), ("PIECE", 9), ("HELD", 20)):
        monkeypatch.setattr(divergence, name, size)
    some = rows[:120]
    assert got(divergence.audit(spark.createDataFrame(some, SCHEMA), 3)) == plain(some, 3)


def test_audit_equals_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    frame = con.sql(queries.ORACLE["op11_source_divergence"]).df()
    expected = sorted(frame[["lang", "source", "part", "item", "value", "rank"]].itertuples(index=False, name=None))
    assert got(queries.op11_source_divergence(spark, sf_dir)) == expected and len(expected) > 100


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_terms_are_cut_as_the_expression_says():
    text = "Aé[b]{c}@D`e\x7ff9g ÀÉ h\x00I" * 3
    want = [t.translate(str.maketrans("ABCDEFGHI", "abcdefghi")) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
    assert [t.decode() for part in divergence.pieces(text.encode()) for t in part] == want


items = st.lists(st.tuples(st.integers(1, 6), st.integers(1, 12), st.text("abé", min_size=1, max_size=3)), max_size=60, unique_by=lambda r: r[2])


@settings(max_examples=200, deadline=None)
@given(items, st.integers(1, 3))
def test_skyband_rows_have_few_dominators(rows, top):
    rows = sorted(rows, key=lambda r: (-r[0], r[1], r[2].encode()))
    keep = divergence._undominated(np.array([r[1] for r in rows], np.int64), [r[2].encode() for r in rows], top)
    above = lambda a, b: a[0] >= b[0] and a[1] <= b[1] and a[2].encode() < b[2].encode()
    assert keep.tolist() == [sum(above(a, b) for a in rows) < top for b in rows]
