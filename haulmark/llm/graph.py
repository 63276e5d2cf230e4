"""Connected components of an edge table, by contraction.

At each level edges are united in the tasks, twice: those that lie together, and, after one
shuffle by node, what the tasks have made of the nodes that they share. What is still apart are
parts of other tasks, and the edges between their names are the next level's. On the way back
names are looked up. No neighbourhood is collected, and a task holds ``HELD`` edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.scratch import Scratch
from haulmark.llm.words import mix

#: Edges that a task unites in one go.
HELD = 1 << 19
#: Levels at which the least node names a part. Later ones, which only long paths over many tasks reach,
#: take the first by hash, so that a third of the nodes at least, as expected, is no name and leaves.
BY_ID = 2


def united(u: np.ndarray, v: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges ``u, v``, sorted, and the name of the part that each is in: one of its nodes."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    order = np.arange(len(nodes)) if level < BY_ID else np.argsort(mix(nodes.view(np.uint64) + np.uint64(level)))
    rank = np.empty(len(nodes), np.int64)
    rank[order] = np.arange(len(nodes))
    a, b = np.split(rank[place], 2)
    part = np.arange(len(nodes))
    while len(a):
        x, y = part[a], part[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(part, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(part, up := part[part]):
            part = up
    return nodes, nodes[order[part[rank]]]


def _together(edges: DataFrame, level: int) -> DataFrame:
    """``node, part`` of the edges that lie in one task, the names' own rows included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def parts() -> pa.RecordBatch:
            u, v = (np.concatenate([np.asarray(batch.column(c)) for batch in held]) for c in ("u", "v"))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in united(u, v, level)], ["node", "part"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= HELD:
                yield parts()
                held, n = [], 0
        if n:
            yield parts()

    return edges.mapInArrow(run, "node long, part long")


def _by_node(parts: DataFrame, level: int) -> DataFrame:
    """``node, part`` of every node once, and, with ``edge`` set, edges between parts that share nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def met(node: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
            new = np.ones(len(node), bool)
            new[1:] = node[1:] != node[:-1]
            first = part[new]
            names, name = united(np.repeat(first, np.diff(np.append(np.flatnonzero(new), len(node)))), part, level)
            other = names != name
            columns = [np.concatenate([node[new], names[other]]), np.concatenate([name[np.searchsorted(names, first)], name[other]])]
            edge = np.arange(len(columns[0])) >= len(first)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (*columns, edge)], ["node", "part", "edge"])

        def whole() -> tuple[np.ndarray, np.ndarray]:
            return tuple(np.concatenate([x[k] for x in held]) for k in (0, 1))

        for batch in batches:
            held.append((np.asarray(batch.column("node")), np.asarray(batch.column("part"))))
            n += batch.num_rows
            if n >= HELD:  # all rows of a node, of which a task before gave one, are looked at in one go
                node, part = whole()
                cut = int(np.searchsorted(node, node[-1]))
                if cut:
                    yield met(node[:cut], part[:cut])
                held, n = [(node[cut:], part[cut:])], len(node) - cut
        if n:
            yield met(*whole())

    return parts.repartition("node").sortWithinPartitions("node").mapInArrow(run, "node long, part long, edge boolean")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` of every node on an edge ``u, v``; the least node names a component.

    Edges may repeat, point either way and join a node with itself. Null ends are left out.
    """
    edges = edges.select("u", "v").where("u IS NOT NULL AND v IS NOT NULL")
    levels = []
    while not levels or not edges.isEmpty():
        levels.append(scratch.store(_by_node(_together(edges, len(levels)), len(levels)), "parts"))
        edges = levels[-1].where("edge").select(F.col("node").alias("u"), F.col("part").alias("v"))
    named = [rows.where("NOT edge").select("node", "part") for rows in levels]
    found = named.pop()
    while named:
        found = named.pop().join(found.toDF("of", "name"), F.col("part") == F.col("of"), "left").select("node", F.coalesce("name", "part").alias("part"))
    if len(levels) > BY_ID:
        least = found.groupBy("part").agg(F.min("node").alias("least"))
        found = found.join(least, "part").select("node", F.col("least").alias("part"))
    stored = scratch.store(found.select("node", F.col("part").alias("component")), "components")
    scratch.drop(*levels)
    return stored
