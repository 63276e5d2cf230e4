"""Near-duplicate classes by a grouped prefix join over word shingles.

A document's set is its distinct word shingles. Shingles are ordered with those that many
documents hold last; two sets of a given similarity then share one of their first ones,
their prefixes. Documents with the same prefix and size form one group, and only groups meet,
in the lists of the shingles of their prefixes. Lists of one group are dropped, those of the
same groups count once, and the groups of the others expand to their distinct sets. Pairs are filtered by size, by the components they
are in already and by their outlines, and verified by whole texts; how the sets of one list
meet without being paired off is told in ``stars``. The connected components of the verified
links are the classes.

The order of the shingles changes the cost, not the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.scratch import Scratch, most_frequent
from haulmark.llm.stars import SLICE, Similarity, by_count, distinct_lists, fingerprint, link_lists
from haulmark.llm.words import LOWER, Words, mix, sequence_names, slices

SHINGLE = 5
PERCENT = 75
#: Shingle names a counting task holds before it hands on those that repeat.
HELD = 4_000_000
#: Shingles known as frequent; 8 bytes each in every task.
FREQUENT = 1 << 19
#: Least bins of a set's outline: how many of its shingles fall into each, up to 255. A larger set
#: has more, at most ``PER_BIN`` shingles for each, as unlike sets' full bins would look alike.
BINS, PER_BIN = 256, 4


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle names of each text, lower-casing A to Z.

    A text of fewer words has its whole sequence as the only shingle, one without words none.
    """
    words = Words(column, LOWER)
    names, at = words.windows(size)
    edge = np.searchsorted(at, words.row)
    out = []
    for k, count in enumerate(words.counts.tolist()):
        if count >= size:
            out.append(np.unique(names[edge[k] : edge[k + 1]]))
        elif count:
            out.append(sequence_names(words.name[words.row[k] : words.row[k + 1]], count))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def outline(one: np.ndarray) -> bytes | None:
    """Counts of a set's shingles by bin; None where a bin is too full for its byte."""
    bins = max(BINS, 1 << (-(-len(one) // PER_BIN) - 1).bit_length())
    counts = np.bincount((one & np.uint64(bins - 1)).astype(np.int64), minlength=bins)
    return None if counts.max() > 255 else counts.astype(np.uint8).tobytes()


def packed(bins: bytes | None) -> bytes | None:
    """An outline in about a third of its bytes, half of what shuffles press them to: most counts are small."""
    if bins is None:
        return None
    by_letter = zlib.compressobj(6, zlib.DEFLATED, -9, 5, zlib.Z_HUFFMAN_ONLY)
    return by_letter.compress(bins) + by_letter.flush()


def unpacked(sketch: bytes) -> bytes:
    return zlib.decompress(sketch, -9)


def may_be_similar(x: Sequence[bytes], y: Sequence[bytes], n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Row by row, whether two outlines let sets be similar: these have no more in common than the smaller count of each bin."""
    most = np.zeros(len(x), np.int64)
    widths = np.array([(len(a), len(b)) for a, b in zip(x, y)]).reshape(-1, 2)
    for pair in np.unique(widths, axis=0).tolist():
        rows = np.flatnonzero((widths == pair).all(axis=1))
        least = min(pair)
        step = max(1, (1 << 22) // max(pair))
        for a in range(0, len(rows), step):
            part = rows[a : a + step]
            # The bins of a narrower outline are sums of those of a wider one.
            u, v = (np.frombuffer(b"".join([z[k] for k in part]), np.uint8).reshape(len(part), -1, least).sum(axis=1, dtype=np.int32) for z in (x, y))
            most[part] = np.minimum(u, v).sum(axis=1)
    return 100 * most >= percent * (n + m - most)


def _prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def frequent_shingles(rows: DataFrame, size: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """Sorted names of at most ``FREQUENT`` shingles that many rows hold, and how many.

    Counts come from all rows; a task hands on what repeats among ``HELD`` names.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def hand_on() -> pa.RecordBatch:
            names = np.concatenate([*held, np.zeros(0, np.uint64)])
            held.clear()
            names.sort()
            often = np.unique(names[2:][names[2:] == names[:-2]])
            counts = np.searchsorted(names, often, "right") - np.searchsorted(names, often)
            return pa.RecordBatch.from_arrays([pa.array(often.view(np.int64)), pa.array(counts)], ["name", "n"])

        for batch in slices(batches, "text", SLICE):
            for one in shingle_sets(batch.column("text"), size):
                held.append(one)
                n += len(one)
            if n > HELD:
                yield hand_on()
                held, n = [], 0
        yield hand_on()

    counts = rows.select("text").mapInArrow(count, "name long, n long").groupBy("name").agg(F.sum("n").alias("n"))
    counts = scratch.store(counts, "counts")
    found = most_frequent(counts, "n", FREQUENT).toPandas()
    scratch.drop(counts)
    names = found["name"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(names)
    return names[order], found["n"].to_numpy(np.int64)[order]


def _sets(rows: DataFrame, frequent: tuple[np.ndarray, np.ndarray], size: int, percent: int) -> DataFrame:
    """``id, n, p0, p1, bunch, bins, rare, often`` of each row.

    ``rare`` and ``often`` are a group's prefix, shingles known as frequent apart; they come once per
    group and task, else null, and ``bins`` once per set and task. Only rows with an id bring a
    group's prefix, as its list is found by these.
    """
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        met: set[int] = set()
        drawn: set[tuple[int, int]] = set()
        for batch in slices(batches, "text", SLICE):
            out: dict[str, list] = {c: [] for c in ("n", "p0", "p1", "bunch", "bins", "rare", "often")}
            owned = batch.column("id").is_valid().to_pylist()
            for own, one in zip(owned, shingle_sets(batch.column("text"), size)):
                print_ = fingerprint(one)
                rare = often = None
                bunch = 0
                if len(one):
                    times = np.zeros(len(one), np.int64)
                    if len(known):
                        spot = np.minimum(np.searchsorted(known, one), len(known) - 1)
                        times = np.where(known[spot] == one, counts[spot], 0)
                    order = np.lexsort((one, times))[: _prefix_size(len(one), percent)]
                    first = one[order]
                    bunch = int(mix(sequence_names(first, len(first)) + np.uint64(len(one))).view(np.int64)[0])
                    if own and bunch not in met:
                        met.add(bunch)
                        cut = int((times[order] == 0).sum())
                        rare, often = first[:cut].view(np.int64), first[cut:].view(np.int64)
                for name, value in (("n", len(one)), ("p0", print_[0]), ("p1", print_[1]), ("bunch", bunch), ("rare", rare), ("often", often)):
                    out[name].append(value)
                out["bins"].append(None if print_ in drawn else packed(outline(one)))
                drawn.add(print_)
                if len(met) + len(drawn) > FREQUENT:
                    met.clear()
                    drawn.clear()
            ints = pa.int64()
            kinds = {"bins": pa.binary(), "rare": pa.list_(ints), "often": pa.list_(ints)}
            columns = [batch.column("id"), *(pa.array(v, kinds.get(c, ints)) for c, v in out.items())]
            yield pa.RecordBatch.from_arrays(columns, ["id", *out])

    return rows.mapInArrow(run, "id long, n long, p0 long, p1 long, bunch long, bins binary, rare array<long>, often array<long>")


def _met(sets: DataFrame) -> DataFrame:
    """``name, node``: shingles that may be in several prefixes, with the id of a row of each group."""
    # Most shingles are no one else's. To find the others, names travel with the id of a row of
    # the group, which costs the shuffle little; groups are looked up for what is left. A name that
    # may be in very many prefixes is known as frequent, and need not be counted.
    rare = sets.where("id IS NOT NULL").select(F.explode("rare").alias("name"), "id")
    rare = rare.withColumn("rows", F.count("*").over(Window.partitionBy("name"))).where("rows > 1").select("name", "id")
    often = sets.where("id IS NOT NULL").select(F.explode("often").alias("name"), "id")
    return rare.unionAll(often).withColumnRenamed("id", "node")


def _lists(met: DataFrame, sets: DataFrame, distinct: DataFrame, scratch: Scratch) -> DataFrame:
    """``name, node, n, weight``: the sets whose groups have a shingle in their prefixes."""
    first = scratch.store(distinct_lists(met), "first")
    of = sets.where("n > 0").select(F.col("id").alias("node"), "bunch")
    groups = met.join(by_count(first), "name").join(of, "node").groupBy("name", "bunch").agg(F.max("weight").alias("weight"))
    # The sets of one group are a list of their own.
    alone = distinct.groupBy("bunch").agg(F.count("*").alias("sets")).where("sets > 1")
    groups = groups.unionAll(alone.select(F.col("bunch").alias("name"), "bunch", F.lit(1).cast("long")))
    return groups.join(distinct, "bunch").select("name", F.col("rep").alias("node"), "n", "weight")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    Two rows link when their sets' intersection is at least ``percent`` hundredths of their
    union; ``component_id`` is the smallest id that links lead to, its own included. A null or
    wordless text has no shingles and links with nothing. Ids are integers. Rows that repeat
    an id and a set are alike; a row without id belongs to the class of an equal set, and to
    none (null) without one. Further columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    sets = scratch.store(_sets(rows, frequent_shingles(rows, size, scratch), size, percent), "sets")
    # Of equal sets, the smallest id stands for all.
    distinct = sets.where("n > 0").groupBy("bunch", "n", "p0", "p1").agg(F.min("id").alias("rep"), F.max("bins").alias("sketch"))
    distinct = scratch.store(distinct.where("rep IS NOT NULL"), "distinct")
    met = scratch.store(_met(sets), "met")
    lists = scratch.store(_lists(met, sets, distinct, scratch), "lists")
    whole = scratch.store(sets.select("id", "n", "p0", "p1"), "rows")
    # Prefixes have done their work.
    scratch.drop(sets, met)
    like = Similarity(partial(shingle_sets, size=size), percent, partial(may_be_similar, percent=percent), unpacked)
    sketches = distinct.select(F.col("rep").alias("node"), "n", "sketch")
    classes = link_lists(lists, sketches, distinct, rows.where("id IS NOT NULL"), like, scratch)
    classed = distinct.join(classes, distinct["rep"] == classes["node"], "left")
    classed = classed.select("n", "p0", "p1", F.coalesce("component", "rep").alias("component_id"))
    whole = whole.join(classed, ["n", "p0", "p1"], "left")
    own = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return whole.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), own.alias("component_id"))
