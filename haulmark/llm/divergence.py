"""How the sources of a language differ in their words: an audit by group and by term.

Tasks count the terms of whole texts by language and source, in documents too, and hand on
sums. A language keeps the terms of ``least`` documents or more. Shares are integers of a
thousand millionths, smoothed by two, and a divergence is ``(p - q)^2 / (p + q)``, rounded
down per term, so every figure is exact.

The terms that tell a source best come from a dominance skyband: a term counts at least as
much as another if its source holds it no less often, its language no more often, and it stands
earlier in UTF-8. Each partition retains the terms that fewer than ``top`` others dominate, the
retained ones of all partitions are merged by the same rule, and what is left is ranked.
Nothing dominated can rank, as the divergence grows with the source's count and falls
with the language's.

Sources are compared in cells, a block of terms and two tiles of sources each, so that no pair
is written out per term; cells yield sums.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.scratch import Scratch
from haulmark.llm.words import LOWER, slices

LEAST, TOP = 10, 10
#: Terms a counting task holds before it hands them on.
HELD = 500_000
#: Text bytes looked at in one go.
PIECE = 1 << 20
#: About so many terms and sources make up a cell.
CELL_TERMS, CELL_SOURCES = 2048, 128
#: Rows compared at a time for dominance.
BLOCK = 2048

_TERM, _REST = re.compile(rb"[A-Za-z\x80-\xff]+"), re.compile(rb"[^A-Za-z\x80-\xff]")
_SMALL = LOWER.tobytes()


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, lower-cased from A to Z, piece by piece: letters and all beyond ASCII."""
    text = text.translate(_SMALL)
    start = 0
    while start < len(text):
        cut = _REST.search(text, start + PIECE)
        stop = cut.start() if cut else len(text)
        yield _TERM.findall(text, start, stop)
        start = stop


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` of each task's share of ``lang, source, text``: occurrences and documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def hand_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in counts.items():
                terms = list(n)
                for a in range(0, len(terms), 10_000):
                    some = terms[a : a + 10_000]
                    columns = [[lang] * len(some), [source] * len(some)]
                    columns = [pa.array(c, pa.string()) for c in columns] + [pa.array(some, pa.binary()).cast(pa.string())]
                    columns += [pa.array([c[t] for t in some], pa.int64()) for c in (n, docs)]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
            counts.clear()

        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.large_binary())
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
                n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
                own: set[bytes] = set()
                for terms in pieces(text.as_py()):
                    n.update(terms)
                    own.update(terms)
                docs.update(own)
            if sum(len(n) for n, _ in counts.values()) > HELD:
                yield from hand_on()
        yield from hand_on()

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _share(n: str, total: str, kept: str) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept))."""
    return F.expr(f"1L + CAST({n} + 2 AS DECIMAL(20, 0)) * 1000000000L div ({total} + 2L * {kept})")


def _undominated(total: np.ndarray, terms: list[bytes], top: int) -> np.ndarray:
    """Which rows fewer than ``top`` others dominate; rows come by falling count, rising total, rising term."""
    rank = np.empty(len(terms), np.int64)
    rank[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
    keep = np.ones(len(terms), bool)
    step = 256
    for a in range(0, len(terms), step):
        b = min(a + step, len(terms))
        above = (total[:b] <= total[a:b, None]) & (rank[:b] < rank[a:b, None])
        above[:, a:] &= np.tri(b - a, k=-1, dtype=bool)
        keep[a:b] = above.sum(axis=1) < top
    return keep


def skyband(rows: DataFrame, top: int) -> DataFrame:
    """Of ``lang, source, term, n, total``, per partition and group, what fewer than ``top`` others dominate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "source", "term", "n", "total"]
        now, held = None, None

        def retained(table: pa.Table) -> pa.Table:
            terms = table.column("term").cast(pa.binary()).to_pylist()
            return table.filter(pa.array(_undominated(table.column("total").to_numpy(), terms, top)))

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
            cuts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if keys[a] != now:
                    if held is not None:
                        yield from held.to_batches()
                    now, held = keys[a], None
                for c in range(a, b, BLOCK):
                    part = pa.Table.from_batches([batch.slice(c, min(BLOCK, b - c)).select(names)])
                    held = retained(part if held is None else pa.concat_tables([held, part]).combine_chunks())
        if held is not None:
            yield from held.to_batches()

    ordered = rows.select("lang", "source", "term", "n", "total").sortWithinPartitions("lang", "source", F.desc("n"), "total", "term")
    return ordered.mapInArrow(run, "lang string, source string, term string, n long, total long")


def _cell_sums(table: pa.Table) -> pa.Table:
    """``lang, source, item, value, terms, none, kept`` of the pairs of sources of one cell.

    Rows without a term tell of each source the share ``p`` of a term it lacks.
    """
    source = table.column("source").combine_chunks().dictionary_encode()
    term = table.column("term").combine_chunks().dictionary_encode()
    own, p = np.asarray(source.indices), table.column("p").to_numpy()
    known = np.asarray(term.indices.is_valid())
    at = np.asarray(term.indices.fill_null(0))
    names, width = source.dictionary, len(term.dictionary)
    low, high = table.column("a")[0].as_py(), table.column("b")[0].as_py()
    none, tile = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    none[own[~known]] = p[~known]
    tile[own] = table.column("tile").to_numpy()
    share = np.repeat(none[:, None], width, axis=1)
    share[own[known], at[known]] = p[known]
    one, other, value, lacking = [], [], [], []
    for i in np.flatnonzero(tile == low).tolist():
        js = np.flatnonzero(tile == high)
        js = js[js > i] if low == high else js
        for c in range(0, len(js), 16):  # a few rows at a time
            j = js[c : c + 16]
            one.append(np.full(len(j), i))
            other.append(j)
            value.append(((share[i] - share[j]) ** 2 // np.maximum(share[i] + share[j], 1)).sum(axis=1))
            lacking.append((none[i] - none[j]) ** 2 // np.maximum(none[i] + none[j], 1))
    join = lambda parts: np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64)
    one, other = join(one), join(other)
    same = lambda c: pa.array([table.column(c)[0].as_py()] * len(one), table.schema.field(c).type)
    columns = [same("lang"), names.take(pa.array(one)), names.take(pa.array(other)), pa.array(join(value))]
    columns += [pa.array(np.full(len(one), width, np.int64)), pa.array(join(lacking)), same("kept")]
    return pa.Table.from_arrays(columns, ["lang", "source", "item", "value", "terms", "none", "kept"])


def _pairs(counted: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every two sources of a language, both ways."""
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = groups.join(sources, "lang")
    tiles, blocks = (F.greatest(F.lit(1), F.ceil(F.col(c) / size)).cast("int") for c, size in (("sources", CELL_SOURCES), ("kept", CELL_TERMS)))
    groups = groups.withColumn("tiles", tiles).withColumn("blocks", blocks)
    groups = groups.withColumn("tile", F.pmod(F.xxhash64("source"), "tiles").cast("int"))
    lacking = F.when(F.col("kept") > 0, _share("0L", "held", "kept")).otherwise(F.lit(0))
    every = lambda upto: F.explode(F.sequence(F.lit(0), F.col(upto) - 1))
    known = ["lang", "source", "kept", "tile", "tiles"]
    marks = groups.select(*known, every("blocks").alias("block"), F.lit(None).cast("string").alias("term"), lacking.alias("p"))
    terms = counted.join(groups.select(*known, "blocks", "held"), ["lang", "source"])
    block = F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block")
    terms = terms.select(*known, block, "term", _share("n", "held", "kept").alias("p"))
    rows = marks.unionAll(terms).withColumn("met", every("tiles"))
    rows = rows.withColumn("a", F.least("tile", "met")).withColumn("b", F.greatest("tile", "met"))
    rows = rows.select("lang", "block", "a", "b", "tile", "source", "term", "p", "kept")
    out = "lang string, source string, item string, value long, terms long, none long, kept long"
    sums = rows.groupBy("lang", "block", "a", "b").applyInArrow(_cell_sums, out)
    total = [F.sum("value").alias("value"), F.sum("terms").alias("terms"), F.max("none").alias("none"), F.max("kept").alias("kept")]
    # The order of two sources in a cell depends on the cell.
    two = F.sort_array(F.array("source", "item"))
    sums = sums.select("lang", two.alias("two"), "value", "terms", "none", "kept").groupBy("lang", "two").agg(*total)
    # Kept terms that neither tile holds count as lacking on both sides.
    value = (F.col("value") + (F.col("kept") - F.col("terms")) * F.col("none")).alias("value")
    both = F.explode(F.array(F.struct(F.col("two")[0].alias("x"), F.col("two")[1].alias("y")), F.struct(F.col("two")[1].alias("x"), F.col("two")[0].alias("y"))))
    return sums.select("lang", value, both.alias("way")).select("lang", F.col("way.x").alias("source"), F.col("way.y").alias("item"), "value")


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank`` for every language and source of ``docs``.

    Part ``pair`` ranks all other sources of the language by divergence over all kept terms; part
    ``term`` the ``top`` terms that the source has more of than its language. Equal values rank
    by item in UTF-8. Null texts, languages and sources count as empty strings, rows that
    repeat count each, an empty table gives no rows, further columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    groups = rows.select("lang", "source").distinct()
    # One shuffle serves the sums, their window and the language's totals.
    counts = term_counts(rows).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    counts = counts.withColumn("total", F.sum("n").over(whole)).withColumn("docs", F.sum("docs").over(whole))
    counts = counts.withColumn("one", F.row_number().over(whole.orderBy("source")) == 1).where(F.col("docs") >= least)
    counted = scratch.store(counts.select("lang", "source", "term", "n", "total", "one"), "counted")
    langs = counted.where("one").groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("all"))
    held = counted.groupBy("lang", "source").agg(F.sum("n").alias("held"))
    groups = groups.join(held, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["held", "kept", "all"])
    groups = scratch.store(groups, "groups")

    pairs = _pairs(counted.select("lang", "source", "term", "n"), groups)
    own = counted.drop("one").join(groups, ["lang", "source"])
    more = own.where(_share("n", "held", "kept") > _share("total", "all", "kept"))
    retained = skyband(skyband(more, top).repartition("lang", "source"), top)
    p, q = _share("n", "held", "kept"), _share("total", "all", "kept")
    terms = retained.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    terms = terms.select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    shown = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pairs.withColumn("rank", rank).withColumn("part", F.lit("pair"))
    terms = terms.withColumn("rank", rank).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return pairs.select(*shown).unionAll(terms.select(*shown))
