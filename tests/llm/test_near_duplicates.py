"""The two similarity joins against comparing all pairs."""

import random
from functools import partial

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from haulmark.llm import bottomk, jaccard, queries, stars
from haulmark.llm.scratch import Scratch

SCHEMA = "doc_id long, text string"


def plain(docs, size, percent):
    """``{id: (set size, class)}`` by all pairs that share a shingle."""
    sets = {k: brute.shingles(t, size) for k, t in docs.items()}
    holders = {}
    for k, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(k)
    root = {k: k for k in docs}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    seen = set()
    for at in holders.values():
        for i, a in enumerate(at):
            for b in at[i + 1 :]:
                if (a, b) in seen or find(a) == find(b):
                    continue
                seen.add((a, b))
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {k: (len(sets[k]), find(k)) for k in docs}


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def crowd():
    """Near copies in chains, families that share a long passage, short texts, one large family."""
    draw = random.Random(11)
    word = lambda: f"w{draw.randrange(4000)}"
    texts = []
    passage = " ".join(word() for _ in range(40))
    for _ in range(40):
        base = [word() for _ in range(draw.choice([3, 6, 20, 90, 300]))]
        for _ in range(draw.randrange(1, 12)):
            if len(base) > 4:
                base[draw.randrange(len(base))] = word()
            if draw.random() < 0.3:
                base = base[1:] + [word()]
            texts.append(" ".join(base))
    texts += [f"{passage} {' '.join(word() for _ in range(draw.randrange(14)))}" for _ in range(150)]
    base = [word() for _ in range(120)]
    for _ in range(200):
        copy = list(base)
        for _ in range(draw.randrange(6)):
            copy[draw.randrange(120)] = word()
        texts.append(" ".join(copy))
    texts += ["a b", "A b", "a  b c", "", " ", "a b"]
    draw.shuffle(texts)
    return {n * 3 - 50: t for n, t in enumerate(texts)}


@pytest.fixture(scope="module")
def docs():
    return crowd()


@pytest.mark.parametrize("module, size, percent, blocks", [(jaccard, 5, 75, False), (bottomk, 4, 80, False), (jaccard, 3, 50, True), (bottomk, 4, 65, True)])
def test_classes_equal_all_pairs(spark, docs, module, size, percent, blocks, monkeypatch):
    if blocks:  # lists and stars cut into many blocks, and all pairs left to them
        for name, value in (("PAIRED", 4), ("BLOCK_SKETCHES", 6), ("BLOCK_SETS", 3), ("BROADCAST", 0)):
            monkeypatch.setattr(stars, name, value)
        monkeypatch.setattr(stars.link_lists, "__defaults__", (0,))
    frame = spark.createDataFrame(list(docs.items()), SCHEMA).repartition(5)
    assert found(module.near_duplicates(frame, size, percent)) == plain(docs, size, percent)


def test_queries_equal_all_pairs(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert found(queries.op8_jaccard_join(spark, sf_dir)) == plain(docs, 5, 75)
    rows = queries.op12_bottom_k(spark, sf_dir)
    expected = plain(docs, 4, 80)
    assert found(rows) == expected and any(k != c for k, (_, c) in expected.items())
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows.collect())


def test_awkward_rows(spark):
    text = "Good morning to all of them, said the other"
    rows = [(None, text), (1, text.upper().replace("É", "é")), (1, text), (-8, f"{text} day"), (4, None), (5, ""), (6, " \n"), (None, None), (None, "lone words of no one else"), (7, "x " * 90_000), (8, "X " * 70_000)]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, node long, sketch string").coalesce(1)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in bottomk.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, 6, -8, False), (1, 6, -8, False), (1, 6, -8, False), (-8, 7, -8, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (None, 0, None, True), (None, 3, None, True), (7, 1, 7, True), (8, 1, 7, False)], key=str)
    assert bottomk.near_duplicates(docs.limit(0)).count() == 0 and jaccard.near_duplicates(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        bottomk.near_duplicates(docs, percent=40)


def test_union_sketch_is_exact_for_small_sets_and_close_for_others():
    draw = np.random.default_rng(2)
    for size, inside in ((30, 24), (30, 26), (4000, 3000), (4000, 3600), (4000, 3990)):
        x = draw.integers(0, 2**63, size).astype(np.uint64)
        y = np.concatenate([x[:inside], draw.integers(0, 2**63, size - inside).astype(np.uint64)])
        similar = 100 * inside >= 80 * (2 * size - inside)
        passed = bottomk.may_be_similar([bottomk.sketch(x).tobytes()], [bottomk.sketch(y).tobytes()], np.array([size]), np.array([size]), 80)[0]
        assert passed >= similar and (size > 128 or passed == similar)
    assert bottomk.least_common(80) == 25 and bottomk.least_common(100) == 64


def test_outlines_are_an_upper_bound_and_tell_long_sets_apart():
    draw = np.random.default_rng(4)
    for size, other, inside in ((40, 40, 35), (900, 1100, 850), (9000, 9100, 8400), (9000, 9000, 300), (30_000, 23_000, 100)):
        x = draw.integers(0, 2**63, size).astype(np.uint64)
        y = np.concatenate([x[:inside], draw.integers(0, 2**63, other - inside).astype(np.uint64)])
        similar = 100 * inside >= 75 * (size + other - inside)
        passed = jaccard.may_be_similar([jaccard.outline(x)], [jaccard.outline(y)], np.array([size]), np.array([other]), 75)[0]
        assert passed >= similar and (passed == similar or inside > size // 2)


def test_long_lists_cost_stars_not_pairs(spark, docs):
    """In a family of near copies nearly all are linked to hubs; few pairs are left to write."""
    base = [f"b{n}" for n in range(200)]
    texts = [(n, " ".join(base[:k] + [f"v{n}"] + base[k + 1 :])) for n in range(1500) for k in [n % 200]]
    frame = spark.createDataFrame(texts, SCHEMA).repartition(4)
    sets = [(n, jaccard.shingle_sets(__import__("pyarrow").array([t]))[0]) for n, t in texts]
    rows = [(n, len(s), *stars.fingerprint(s), jaccard.outline(s)) for n, s in sets]
    distinct = spark.createDataFrame(rows, "rep long, n long, p0 long, p1 long, sketch binary")
    lists = spark.createDataFrame([(1, n, len(s), 1) for n, s in sets], "name long, node long, n long, weight long")
    like = stars.Similarity(jaccard.shingle_sets, 75, partial(jaccard.may_be_similar, percent=75))
    entries = stars._labelled(lists, spark.createDataFrame([], "node long, component long"))
    assert stars._stars(entries, 75, 0).count() < 1500
    scratch = Scratch(spark, "test")
    got = stars.link_lists(lists, distinct.select(F.col("rep").alias("node"), "n", "sketch"), distinct, frame.withColumnRenamed("doc_id", "id"), like, scratch)
    assert got.count() == 1500 and got.select("component").distinct().count() == 1


def test_families_are_named_by_trees_not_pairs(spark):
    """Sets that sketches do not tell apart meet in many lists; rows follow the sets, and every set is in the family."""
    like = stars.Similarity(jaccard.shingle_sets, 75, partial(jaccard.may_be_similar, percent=75))
    sketches = spark.createDataFrame([(k, 50, None) for k in range(120)], "node long, n long, sketch binary")
    rows = [(f"{name}", k, 50, k) for name in range(3) for k in range(120) if k % 40 != name]
    blocks = spark.createDataFrame(rows, "pair string, node long, n long, label long")
    scratch = Scratch(spark, "test")
    ties = stars._remaining(blocks, sketches, like, scratch)
    assert ties.count() < 3 * 120
    families = stars.components(ties.toDF("u", "v"), scratch)
    assert families.count() == 120 and families.select("component").distinct().count() == 1


def test_lists_of_much_the_same_sets_are_merged(spark):
    rows = [(name, k, 50, 1, k) for name in range(60) for k in range(200) if k % 61 != name]
    merged = stars._merged(spark.createDataFrame(rows, "name long, node long, n long, weight long, label long")).collect()
    assert len(merged) <= 4 * 200 and all(r.sets > 190 for r in merged)


def test_packed_outlines_are_whole_and_take_half_of_what_shuffles_press_them_to():
    draw = np.random.default_rng(5)
    for size in (1, 60, 350, 1500, 30_000):
        outlines = [jaccard.outline(draw.integers(0, 2**63, size).astype(np.uint64)) for _ in range(50)]
        small = [jaccard.packed(x) for x in outlines]
        assert [jaccard.unpacked(x) for x in small] == outlines
        assert size < 60 or sum(map(len, small)) < 0.65 * len(pa.compress(b"".join(outlines), codec="lz4", asbytes=True))
    assert jaccard.packed(None) is None


@pytest.mark.parametrize("most", [100, 3])
def test_texts_to_compare_are_shuffled_once_where_their_places_are_few(spark, monkeypatch, most):
    """By their number, whatever Spark's threshold; beyond it by a shuffle, with the same links."""
    monkeypatch.setattr(stars, "BROADCAST_ROWS", most)
    monkeypatch.setattr(stars, "BROADCAST", most)
    texts = [(n, " ".join(f"w{k}" for k in range(n % 2 * 50, n % 2 * 50 + 40))) for n in range(8)]
    of = {n: s for n, s in zip(range(8), jaccard.shingle_sets(pa.array([t for _, t in texts])))}
    places = spark.createDataFrame([("b", n, *stars.fingerprint(of[n])) for n in range(8)], "block string, node long, p0 long, p1 long")
    like = stars.Similarity(jaccard.shingle_sets, 75, partial(jaccard.may_be_similar, percent=75))
    stored = []
    scratch = Scratch(spark, "test")
    monkeypatch.setattr(scratch, "store", lambda frame, name, store=scratch.store: (stored.append((name, frame)), store(frame, name))[1])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = stars._compared(places, spark.createDataFrame(texts, "id long, text string"), like, scratch).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    pairs = {frozenset((r.u, r.v)) for r in links}
    assert len(pairs) == 6 and all(len({n % 2 for n in pair}) == 1 for pair in pairs)
    plan = dict(stored)["links"]._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (most > 8)


@pytest.mark.parametrize("module, size, percent", [(jaccard, 5, 75), (bottomk, 4, 80)])
def test_classes_are_the_same_where_steps_are_not_few(spark, docs, module, size, percent, monkeypatch):
    monkeypatch.setattr(stars, "FEW", 0)
    frame = spark.createDataFrame(list(docs.items()), SCHEMA).repartition(3)
    assert found(module.near_duplicates(frame, size, percent)) == plain(docs, size, percent)


def counting(spark):
    """A scratch folder, and the names of what is stored there."""
    scratch, stored = Scratch(spark, "test"), []
    store = scratch.store
    scratch.store = lambda frame, name: (stored.append(name), store(frame, name))[1]
    return scratch, stored


def test_components_of_groups_take_few_shuffles(spark):
    """Each stored table is a shuffle or two of all tasks, whatever the number of edges."""
    edges = [(50, n) for n in range(200)] + [(n, n + 1) for n in range(300, 330)] + [(7, 7), (900, 900)]
    scratch, stored = counting(spark)
    got = {r.node: r.component for r in stars.components(spark.createDataFrame(edges, "u long, v long").repartition(7), scratch).collect()}
    assert got == {**dict.fromkeys(range(200), 0), **dict.fromkeys(range(300, 331), 300), 900: 900}
    assert len(stored) <= 4


def test_long_paths_over_many_tasks_take_few_levels(spark):
    """Neighbours are in other tasks, and ids rise along the path."""
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        scratch, stored = counting(spark)
        edges = spark.range(400).selectExpr("id - 60 AS u", "id - 59 AS v").repartition(40)
        got = stars.components(edges, scratch).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.node: r.component for r in got} == dict.fromkeys(range(-60, 341), -60)
    assert len(got) == 401 and 4 < len(stored) <= 20
