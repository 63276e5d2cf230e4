"""Near-duplicate classes by bottom-k sketches from one hash function.

A document's set is its distinct word shingles, and its sketch the ``WIDE`` smallest of their
hashes, of which the ``RETAINED`` smallest go to inverted lists. Similar sets have most of
these in common: of the 64 smallest values of two sets' union each is in both with a chance of their similarity, so at 0.8 fewer than 25 are with
a chance below 2e-13 (sets of at most 64 shingles are listed whole, which leaves no chance).
Inverted lists of the values therefore need not hold all of a sketch: without its 24 most
widely held values, two sketches with 25 in common still meet in a list. So lists of values of
text that many documents share stay out, where documents have enough of their own.

Where lists overlap, the similarity of two sets is estimated from the sketch of their union,
which is the 128 smallest values of both, by the same chance; what passes is compared exactly by whole texts. How sets of
one list meet without being paired off is told in ``stars``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.jaccard import shingle_sets
from haulmark.llm.scratch import Scratch
from haulmark.llm.stars import SLICE, Similarity, distinct_lists, fingerprint, link_lists
from haulmark.llm.words import mix, slices

SHINGLE, PERCENT = 4, 80
#: Values of a sketch in the lists, and in all.
RETAINED, WIDE = 64, 128
#: Sets a task remembers as sketched.
HELD = 1_000_000
_SALT = np.uint64(0x9FB21C651E98DF25)
_NONE = np.uint64(2**64 - 1)


def least_common(percent: int, retained: int = RETAINED, chance: float = 2e-13) -> int:
    """So many values two similar sketches have in common, but for ``chance``: a binomial tail."""
    share = percent / 100
    p = (1 - share) ** retained
    total, count = 0.0, 0
    while total + p <= chance and count < retained:
        total += p
        p *= (retained - count) / (count + 1) * share / max(1 - share, 1e-300)
        count += 1
    return max(count, 1)


def sketch(one: np.ndarray, retained: int = WIDE) -> np.ndarray:
    """The smallest hashes of a set, sorted, filled up with the largest number."""
    hashes = mix(one ^ _SALT)
    if len(hashes) > retained:
        hashes = np.partition(hashes, retained - 1)[:retained]
    out = np.full(retained, _NONE)
    out[: len(hashes)] = np.sort(hashes)
    return out


def may_be_similar(x: Sequence[bytes], y: Sequence[bytes], n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Row by row, whether the sketch of the union lets two sets be similar.

    A union of no more values than a sketch holds is known whole, and its similarity exactly.
    """
    x, y = (np.frombuffer(b"".join(z), np.uint64).reshape(len(z), -1) for z in (x, y))
    retained = x.shape[1]
    least = least_common(percent, retained)
    out = np.zeros(len(x), bool)
    for a in range(0, len(x), 4096):
        union = np.sort(np.concatenate([x[a : a + 4096], y[a : a + 4096]], axis=1), axis=1)
        twice = (union[:, 1:] == union[:, :-1]) & (union[:, 1:] != _NONE)
        first = np.ones(union.shape, bool)
        first[:, 1:] = ~twice
        first &= union != _NONE
        place = np.cumsum(first, axis=1)
        both = (twice & (place[:, 1:] <= retained)).sum(axis=1)
        total = place[:, -1]
        small = np.maximum(n[a : a + 4096], m[a : a + 4096]) <= retained
        out[a : a + 4096] = np.where(small, 100 * twice.sum(axis=1) >= percent * total, both >= least)
    return out & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))


def _sketched(rows: DataFrame, size: int) -> DataFrame:
    """``id, n, p0, p1, sketch`` of each row; ``sketch`` about once per set and task, else null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()
        for batch in slices(batches, "text", SLICE):
            sets = shingle_sets(batch.column("text"), size)
            prints = [fingerprint(one) for one in sets]
            sketches = []
            for one, key in zip(sets, prints):
                sketches.append(None if key in met else sketch(one).tobytes())
                met.add(key)
            if len(met) > HELD:
                met.clear()
            columns = [batch.column("id"), pa.array([len(one) for one in sets], pa.int64())]
            columns += [pa.array([p[k] for p in prints], pa.int64()) for k in (0, 1)]
            columns.append(pa.array(sketches, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "p0", "p1", "sketch"])

    return rows.mapInArrow(run, "id long, n long, p0 long, p1 long, sketch binary")


def _values(sketches: DataFrame) -> DataFrame:
    """``value, node, n``: the listed values of each sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint64)
            values = values.reshape(-1, WIDE)[:, :RETAINED].ravel()
            owner = np.repeat(np.arange(batch.num_rows), RETAINED)
            there = values != _NONE
            at = pa.array(owner[there])
            columns = [pa.array(values[there].view(np.int64)), batch.column("node").take(at), batch.column("n").take(at)]
            yield pa.RecordBatch.from_arrays(columns, ["value", "node", "n"])

    return sketches.select("node", "n", "sketch").mapInArrow(run, "value long, node long, n long")


def _shared(sketches: DataFrame) -> DataFrame:
    """``value, node, n, holders``: values that several sketches hold."""
    values = _values(sketches)
    held = values.groupBy("value").agg(F.count("*").alias("holders")).where("holders > 1")
    return values.join(held, "value")


def _lists(shared: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """``name, node, n, weight``: the inverted lists by which sketches with enough in common meet."""
    # Values of one sketch alone are its rarest, and no list.
    own = Window.partitionBy("node")
    shared = shared.withColumn("shared", F.count("*").over(own))
    shared = shared.withColumn("place", F.row_number().over(own.orderBy("holders", "value")))
    # Of a set known whole, the other holds percent hundredths of its size at least; a larger
    # set's sketch lacks at most its shingles beyond that.
    spare = RETAINED * (100 - percent) // percent
    whole = F.least(F.ceil(F.col("n") * percent / 100), F.lit(RETAINED - spare)).cast("int")
    least = F.when(F.col("n") <= RETAINED, F.greatest(whole, F.lit(1))).otherwise(F.lit(least_common(percent)))
    lists = shared.where(F.col("place") <= F.col("shared") - least + 1).select(F.col("value").alias("name"), "node", "n")
    lists = scratch.store(lists, "values")
    return lists.join(distinct_lists(lists), "name").select("name", "node", "n", "weight")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Two rows link when their sets' intersection is at least ``percent`` hundredths of their union;
    ``component_id`` is the smallest id that links lead to, its own included, and the row of
    that id is kept. A text of fewer words than a shingle has its whole sequence as its set; a null
    or wordless text has no set, links with nothing and stays. Ids are integers. Rows that repeat an id
    and a set are alike; a row without id belongs to the class of an equal set, and to none
    (null) without one, where it stays. Further columns are ignored.
    """
    if percent < 60:
        raise ValueError("sketches of this size tell sets apart from a similarity of 0.6 on")
    scratch = Scratch(docs.sparkSession, "bottomk")
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    sketched = scratch.store(_sketched(rows, size), "sketched")
    # Of equal sets, the smallest id stands for all.
    distinct = sketched.where("n > 0").groupBy("n", "p0", "p1").agg(F.min("id").alias("rep"), F.max("sketch").alias("sketch"))
    distinct = scratch.store(distinct.where("rep IS NOT NULL"), "distinct")
    # Two rows of one id may have unlike sets; the node of both is that id.
    sketches = distinct.select(F.col("rep").alias("node"), "n", "sketch")
    narrow = scratch.store(sketched.select("id", "n", "p0", "p1"), "rows")
    scratch.drop(sketched)
    like = Similarity(partial(shingle_sets, size=size), percent, partial(may_be_similar, percent=percent))
    texts = rows.where("id IS NOT NULL")
    shared = scratch.store(_shared(sketches), "shared")
    classes = link_lists(_lists(shared, percent, scratch), sketches, distinct, texts, like, scratch)
    scratch.drop(shared)
    classed = distinct.join(classes, distinct["rep"] == classes["node"], "left")
    classed = classed.select("n", "p0", "p1", F.coalesce("component", "rep").alias("component_id"))
    whole = narrow.join(classed, ["n", "p0", "p1"], "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    whole = whole.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"))
    kept = F.coalesce(F.col(doc_id) == F.col("component_id"), F.col("component_id").isNull())
    return whole.withColumn("kept", kept)
