"""Links between similar sets that meet in lists, without writing out the pairs of a list.

Lists say which sets may be similar: an inverted list per shingle or retained value. A list
is not paired off. Lists of the same sets count as one. First come rounds of stars: in each
list and band of sizes one set, chosen by hash, is the hub, every set goes to the few hubs that
it shares most lists with, and they are compared exactly. That costs some comparisons per set,
and joins most of what a group of near copies has. Lists whose sets are all connected by then
are done. The others are merged where they hold much the same sets, and sets of different
components are compared by their sketches, an upper bound or an estimate of their similarity,
block by block. Pairs that pass are not written either: they tie sets to families, of which a
block names a tree. The sets of a family are then compared exactly, each with all others, by
their whole texts in blocks.

So nothing similar in a list stays unlinked, however long the list: the rounds change the cost.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.graph import components
from haulmark.llm.scratch import Scratch
from haulmark.llm.words import mix, slices

#: Rounds of stars; each chooses its hubs and cuts its bands otherwise.
ROUNDS = 2
#: Hubs that a set is compared with in a round. Where sets of a family are similar by halves, several
#: random ones connect nearly all of it, and few pairs are left.
HUBS = 6
#: Sets, and shingles, to be compared exactly in one go.
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1 << 19
#: Bytes of text to be cut into words in one go.
SLICE = 1 << 19
#: Sets of a list whose sketches are compared in one go.
BLOCK_SKETCHES = 512
#: Ids that are broadcast, at most: 8 bytes each, and some 32 in a task's table of them.
BROADCAST = 2_000_000
#: Rows of a few numbers each that are broadcast, at most.
BROADCAST_ROWS = 500_000
#: Rows of a step up to which its small tables are broadcast, where a shuffle costs more than it moves.
FEW = 100_000
#: Sets of a list up to which its pairs of different components are written: no more than two rows a set.
PAIRED = 5

#: Whether the sets of sketches ``x[i]``, ``y[i]``, of sizes ``n[i]``, ``m[i]``, may be similar.
Possible = Callable[[Sequence[bytes], Sequence[bytes], np.ndarray, np.ndarray], np.ndarray]


def as_it_is(sketch: bytes) -> bytes:
    return sketch


@dataclass(frozen=True)
class Similarity:
    """What sets are, when two are similar, and the sketches that tell most others apart."""

    sets: Callable[[pa.Array], list[np.ndarray]]
    percent: int
    possible: Possible
    #: From a sketch as it is stored to one that ``possible`` takes.
    unpacked: Callable[[bytes], bytes] = as_it_is


def fingerprint(one: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set."""
    sums = [mix(one ^ np.uint64(salt)).sum(dtype=np.uint64) for salt in (0x243F6A8885A308D3, 0x13198A2E03707344)]
    return tuple(int(x) for x in mix(np.array(sums) + np.uint64(len(one))).view(np.int64))


def linking_pairs(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs of similar sets that connect all that similar pairs connect."""
    n = len(sets)
    names = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(names, kind="stable")
    names, owner = names[order], owner[order]
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1
    keep = often[column]
    column, owner = (np.cumsum(often) - 1)[column[keep]], owner[keep]
    both = np.zeros((n, n), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    step = min(max(16, (1 << 22) // n), max(width, 1))
    for a in range(0, width, step):
        x, y = np.searchsorted(column, [a, a + step])
        part = np.zeros((n, step), np.float32)
        part[owner[x:y], column[x:y] - a] = 1
        both += part @ part.T
    size = np.array([len(s) for s in sets])
    inter = both.astype(np.int64)
    similar = 100 * inter >= percent * (size[:, None] + size[None, :] - inter)
    np.fill_diagonal(similar, False)
    out, seen = [], np.zeros(n, bool)
    for root in np.flatnonzero(similar.any(1)).tolist():
        if seen[root]:
            continue
        seen[root] = True
        queue = [root]
        while queue:
            k = queue.pop()
            for other in np.flatnonzero(similar[k] & ~seen).tolist():
                seen[other] = True
                out.append((k, other))
                queue.append(other)
    return out


def distinct_lists(lists: DataFrame) -> DataFrame:
    """One of all lists that hold the same sets, ``name, node``, and how many they are, ``weight``.

    A passage that documents share gives a list per shingle. Lists are known by three sums of
    hashes. ``lists`` is a stored table of ``name, node``; lists of one set are left out.
    """
    sums = [F.sum(F.xxhash64("node", F.lit(k)).bitwiseAND(F.lit((1 << 40) - 1))).alias(f"s{k}") for k in range(3)]
    known = lists.groupBy("name").agg(F.count("*").alias("sets"), *sums).where("sets > 1")
    first = known.groupBy("sets", "s0", "s1", "s2").agg(F.min("name").alias("name"), F.count("*").alias("weight"))
    return first.select("name", "weight")


def _held(frame: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """What to do with a table of at most the rows of ``frame``, a stored one, to be joined: broadcast it if they are ``FEW``."""
    return F.broadcast if frame.count() <= FEW else lambda other: other


def _labelled(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The entries of lists that hold several components, with their ``label``; without ``labels`` each set is alone."""
    if labels is None:
        named = lists.withColumn("label", F.col("node"))
    else:
        own = labels.select("node", F.col("component").alias("label"))
        named = lists.join(_held(labels)(own), "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = named.groupBy("name").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return named.join(several.select("name"), "name").select("name", "node", "n", "weight", "label")


def _stars(entries: DataFrame, percent: int, turn: int) -> DataFrame:
    """``hub, node``: for each set the hubs of other components that it shares most lists with."""
    # Bands of a factor that similar sets keep within, cut elsewhere in every other round.
    width = max(math.log(100 / percent), 1e-3)
    band = F.floor(F.log("n") / F.lit(width) + F.lit(turn % 2 / 2)).cast("int")
    # Another order of the sets in each list: those of a family get many hubs.
    salt = F.xxhash64("name", F.lit(turn))
    entries = entries.withColumn("band", band)
    place = F.col("node").bitwiseXOR(salt)
    hubs = entries.groupBy("name", "band").agg(F.min(place).alias("hub"), F.min_by("label", place).alias("hub_label"))
    hubs = hubs.withColumn("hub", F.col("hub").bitwiseXOR(salt))
    met = entries.join(hubs, ["name", "band"]).where("label <> hub_label")
    # A set's lists are few: they are summed where its hubs are chosen.
    shared = met.select("node", "hub", "weight").repartition("node").groupBy("node", "hub").agg(F.sum("weight").alias("lists"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("lists"), "hub"))
    return shared.withColumn("place", place).where(F.col("place") <= HUBS).select("hub", "node")


def by_count(frame: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A stored ``frame`` to be joined: broadcast up to ``most`` rows, as counted, else by a shuffle."""
    return F.broadcast(frame) if frame.count() <= most else frame


def _only(rows: DataFrame, key: str, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows whose ``key`` is in ``wanted``, one column of ids.

    Few of all sets are in a star or pair. Up to ``BROADCAST`` ids, as counted, go to the rows; more
    are met by a shuffle of the rows.
    """
    held = scratch.store(wanted.toDF(key).distinct(), "wanted")
    return rows.join(by_count(held, BROADCAST), key, "left_semi")


def _passing(pairs: DataFrame, sketches: DataFrame, like: Similarity, scratch: Scratch) -> DataFrame:
    """The ``hub, node`` whose sketches let them be similar."""
    pairs = scratch.store(pairs, "asked")
    if pairs.count() <= FEW:  # the sketches then are shuffled once, by hub
        own, held = sketches.select("node", F.struct("n", "sketch").alias("y")), F.broadcast(pairs)
        hubs = own.join(held, own["node"] == held["hub"], "left_semi")
        rows = own.join(held, "node")
    else:
        sketches = _only(sketches, "node", pairs.select("hub").unionAll(pairs.select("node")), scratch)
        hubs = own = sketches.select("node", F.struct("n", "sketch").alias("y"))
        rows = pairs.join(own, "node")
    rows = rows.join(hubs.select(F.col("node").alias("hub"), F.col("y").alias("x")), "hub")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 5000):
                part = batch.slice(a, 5000)
                keep = np.asarray(part.column("open")).copy()
                at = np.flatnonzero(~keep)
                some = part.take(pa.array(at))
                if len(at):
                    x, y = ([like.unpacked(z) for z in some.column(c).to_pylist()] for c in ("sx", "sy"))
                    keep[at] = like.possible(x, y, some.column("nx").to_numpy(), some.column("ny").to_numpy())
                yield part.filter(pa.array(keep)).select(["hub", "node"])

    columns = [F.col("x.sketch").alias("sx"), F.col("y.sketch").alias("sy"), F.col("x.n").alias("nx"), F.col("y.n").alias("ny")]
    is_open = (F.col("x.sketch").isNull() | F.col("y.sketch").isNull()).alias("open")
    return rows.select("hub", "node", is_open, *columns).mapInArrow(run, "hub long, node long")


def _merged(entries: DataFrame) -> DataFrame:
    """``name, node, n, label, sets``: one list instead of those whose first set, by hash, is the same.

    Sets that share passages meet in many lists, which differ by a few sets. Such lists mostly have
    one first set, and unlike ones seldom do. Sets of a list stay together.
    """
    held = _held(entries)
    first = entries.groupBy("name").agg(F.min(F.xxhash64("node")).alias("first"))
    merged = entries.join(held(first), "name").select(F.col("first").alias("name"), "node", "n", "label").distinct()
    return merged.join(held(merged.groupBy("name").agg(F.count("*").alias("sets"))), "name")


def _pairs(entries: DataFrame, percent: int) -> DataFrame:
    """``hub, node``: pairs of lists of few sets, of different components and near sizes."""
    few = entries.where(F.col("sets") <= PAIRED)
    other = few.select("name", F.col("node").alias("hub"), F.col("n").alias("n2"), F.col("label").alias("label2"))
    near = (F.col("n") * 100 >= F.col("n2") * percent) & (F.col("n2") * 100 >= F.col("n") * percent)
    pairs = few.join(other, "name").where((F.col("hub") < F.col("node")) & (F.col("label") != F.col("label2")) & near)
    return pairs.select("hub", "node").distinct()


def _blocks(entries: DataFrame, percent: int, most: Column, load: Column, held: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``pair`` and the columns of ``entries``: each entry once per pair of blocks that it takes part in.

    The entries of one ``name`` are a block if ``most`` is true of them. Others are cut by size,
    in steps that no similar pair skips, and by hash, into as many blocks as ``load`` tells.
    ``held`` is what to do with a table of names (see ``_held``).
    """
    columns = ["node", *(c for c in entries.columns if c not in ("name", "node"))]
    whole = entries.groupBy("name").agg(most.alias("whole"))
    entries = entries.join(held(whole), "name")
    small = entries.where("whole").withColumn("pair", F.concat_ws(":", "name"))
    step = F.floor(F.log("n") / F.log(F.lit(100 / percent)) + 1e-9).cast("int") if percent < 100 else F.col("n").cast("int")
    big = entries.where(~F.col("whole")).withColumn("step", step)
    cells = big.groupBy("name", "step").agg(F.ceil(load).cast("int").alias("cells"))
    own = big.join(held(cells), ["name", "step"]).withColumn("cell", F.pmod(F.xxhash64("node"), "cells").cast("int"))
    meets = cells.select("name", F.col("step").alias("step2"), F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell2"))
    near = own.withColumn("step2", F.explode(F.array(*(F.col("step") + d for d in (-1, 0, 1)))))
    met = near.join(held(meets), ["name", "step2"])
    mine, its = F.struct("step", "cell"), F.struct(F.col("step2").alias("step"), F.col("cell2").alias("cell"))
    low, high = F.when(mine <= its, mine).otherwise(its), F.when(mine <= its, its).otherwise(mine)
    met = met.withColumn("pair", F.concat_ws(":", "name", low["step"], low["cell"], high["step"], high["cell"]))
    return small.select("pair", *columns).unionAll(met.select("pair", *columns))


def _remaining(blocks: DataFrame, sketches: DataFrame, like: Similarity, scratch: Scratch) -> DataFrame:
    """``hub, node``: a tree of each family of a block, whose ties are pairs of different components that may be similar."""
    blocks = scratch.store(blocks, "blocks")
    if blocks.count() <= FEW:
        held = F.broadcast(blocks)
    else:
        held, sketches = blocks, _only(sketches, "node", blocks.select("node"), scratch)
    rows = sketches.select("node", "sketch").join(held, "node").select("pair", "node", "n", "label", "sketch")
    rows = rows.repartition("pair").sortWithinPartitions("pair")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def pairs(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(parts).combine_chunks()
            node, n, label = (table.column(c).to_numpy() for c in ("node", "n", "label"))
            sketch = np.array([None if x is None else like.unpacked(x) for x in table.column("sketch").to_pylist()], dtype=object)
            known = np.array([x is not None for x in sketch])
            family = np.arange(len(node))
            for i in range(len(node) - 1):
                js = np.arange(i + 1, len(node))
                js = js[(label[js] != label[i]) & (family[js] != family[i]) & (100 * np.minimum(n[js], n[i]) >= like.percent * np.maximum(n[js], n[i]))]
                if known[i] and len(js):
                    test = known[js]
                    at = js[test]
                    test[test] = ~like.possible([sketch[i]] * len(at), sketch[at].tolist(), np.full(len(at), n[i]), n[at])
                    js = js[~test]
                if len(js):
                    joined, at = np.unique(family[js], return_index=True)
                    family[np.isin(family, joined)] = family[i]
                    js = js[at]
                    low, high = np.minimum(node[i], node[js]), np.maximum(node[i], node[js])
                    yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["hub", "node"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("pair").to_pylist()
            cuts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if keys[a] != now and held:
                    yield from pairs(held)
                    held = []
                now = keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from pairs(held)

    return rows.mapInArrow(run, "hub long, node long").where("hub <> node")


def _star_places(stars: DataFrame, known: DataFrame) -> DataFrame:
    """``block, node, p0, p1`` of each star. One of many sets is cut into blocks, and its hub goes to each."""
    held = _held(stars)
    members = known.join(held(stars), "node")
    cells = members.groupBy("hub").agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("cells"))
    members = members.join(held(cells), "hub").select("hub", F.pmod(F.xxhash64("node"), "cells").cast("int").alias("cell"), "node", "p0", "p1")
    hubs = known.withColumnRenamed("node", "hub").join(held(cells), "hub")
    hubs = hubs.select("hub", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), F.col("hub").alias("node"), "p0", "p1")
    return members.unionAll(hubs).select(F.concat_ws(":", "hub", "cell").alias("block"), "node", "p0", "p1")


def _family_places(ties: DataFrame, known: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """``block, node, p0, p1``: blocks in which each set of a family meets all others of near size."""
    families = components(ties.select(F.col("hub").alias("u"), F.col("node").alias("v")), scratch)
    held = _held(families)
    members = known.join(held(families.select("node", F.col("component").alias("name"))), "node").select("name", "node", "n", "p0", "p1")
    load = F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)
    # Two blocks meet in a task, so each has half.
    blocks = _blocks(members, percent, load <= 1, 2 * load, held)
    return blocks.select(F.col("pair").alias("block"), "node", "p0", "p1")


def _compared(places: DataFrame, texts: DataFrame, like: Similarity, scratch: Scratch) -> DataFrame:
    """``u, v``: links that connect what is similar in each block of ``block, node, p0, p1``, by whole texts."""
    places = scratch.store(places, "places")
    if places.count() <= BROADCAST_ROWS:  # the texts then are shuffled once, by block
        held = F.broadcast(places)
    else:
        held, texts = places, _only(texts, "id", places.select("node"), scratch)
    rows = texts.join(held, texts["id"] == held["node"]).select("block", "node", "p0", "p1", "text")
    rows = rows.repartition("block").sortWithinPartitions("block")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sets = None, [], []

        def links() -> pa.RecordBatch:
            found = linking_pairs(sets, like.percent) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([ids[a] for a, _ in found], pa.int64()), pa.array([ids[b] for _, b in found], pa.int64())], ["u", "v"])

        for batch in slices(batches, "text", SLICE):
            own = (batch.column(c).to_pylist() for c in ("block", "node", "p0", "p1"))
            for block, node, p0, p1, one in zip(*own, like.sets(batch.column("text"))):
                if block != now:
                    yield links()
                    now, ids, sets = block, [], []
                if fingerprint(one) == (p0, p1):  # another row may have the same id
                    ids.append(node)
                    sets.append(one)
        yield links()

    found = scratch.store(rows.mapInArrow(compare, "u long, v long").where("u <> v"), "links")
    scratch.drop(places)
    return found


def link_lists(lists: DataFrame, sketches: DataFrame, distinct: DataFrame, texts: DataFrame, like: Similarity, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """``node, component`` of all sets that links connect; sets without a link are left out.

    ``lists`` has ``name, node, n, weight`` (see ``distinct_lists``), ``sketches`` ``node, n, sketch`` (null: always possible),
    ``distinct`` ``rep, n, p0, p1`` of every set, and ``texts`` ``id, text``, where a set's text
    is that of a row whose id is its ``node`` and whose fingerprint is its own.
    """
    known = distinct.select(F.col("rep").alias("node"), "n", "p0", "p1")
    lists = scratch.store(lists.distinct(), "lists")
    links = labels = None
    for turn in range(rounds):
        entries = scratch.store(_labelled(lists, labels), "entries")
        scratch.drop(lists)
        lists = entries.select("name", "node", "n", "weight")
        lists.scratch_path = entries.scratch_path
        stars = scratch.store(_passing(_stars(entries, like.percent, turn), sketches, like, scratch), "stars")
        if stars.isEmpty():
            break
        found = _compared(_star_places(stars, known), texts, like, scratch)
        scratch.drop(stars)
        links = found if links is None else links.unionAll(found)
        if found.isEmpty():
            break
        labels = components(links, scratch)
    entries = scratch.store(_labelled(lists, labels), "entries")
    scratch.drop(lists)
    merged = scratch.store(_merged(entries), "merged")
    scratch.drop(entries)
    blocks = _blocks(merged.where(F.col("sets") > PAIRED).drop("sets"), like.percent, F.count("*") <= BLOCK_SKETCHES, F.count("*") / BLOCK_SKETCHES, _held(merged))
    ties = _passing(_pairs(merged, like.percent), sketches, like, scratch)
    ties = scratch.store(ties.unionAll(_remaining(blocks, sketches, like, scratch)), "ties")
    scratch.drop(merged)
    if not ties.isEmpty():
        found = _compared(_family_places(ties, known, like.percent, scratch), texts, like, scratch)
        links = found if links is None else links.unionAll(found)
    scratch.drop(ties)
    return lists.sparkSession.createDataFrame([], "node long, component long") if links is None else components(links, scratch)
