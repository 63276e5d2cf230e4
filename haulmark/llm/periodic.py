"""Periodic runs of words, found by a dictionary of basic factors.

A run is a stretch of consecutive words that repeats itself with a smallest period, several
times over, and that no neighbouring word extends. For every power of two, all stretches of
that many words, the basic factors, get names: that of 2n words is the pair of names of its
halves, so equal names mean equal words. Where a factor occurs again at most twice its length
later, the distance is a proposed period, and neighbouring factors with one distance are one
arithmetic progression. Each progression is extended word by word as far as its period
holds. A run of period q is certain to be proposed at the first length of q or more: no
closer occurrence of so long a factor can lie in it, and three periods hold two of them.

Factors that occur once in a text take no part in longer ones, so ordinary texts cost a few
sorts. Texts are looked at whole, in slices of some two megabytes or one longer text.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.words import Words, joined, slices

#: A run has at least so many words, and so many periods.
LEAST, TIMES = 24, 3

RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

#: From a row's id and number of words: from word ``a`` on, the next ``p`` words over and over.
Rewrite = Callable[[int | None, int], tuple[int, int] | None]


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """A tenth of all rows with an id, chosen and cut by the checksum of the decimal id."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _progressions(word: np.ndarray, row: np.ndarray, from_length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per power of two: its length, and ``first, last, distance`` of the progressions of near successors."""
    size = len(word)
    doc = np.repeat(np.arange(len(row) - 1), np.diff(row))
    end = row[1:][doc]
    at, key, length = np.arange(size), doc * (int(word.max(initial=0)) + 1) + word, 1
    while len(at) > 1:
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        if length >= from_length:
            a = at[order[:-1][same]]
            d = at[order[1:][same]] - a
            near = d <= 2 * length
            a, d = a[near], d[near]
            order2 = np.lexsort((a, d))
            a, d = a[order2], d[order2]
            new = np.ones(len(a) + 1, bool)
            new[1:-1] = (d[1:] != d[:-1]) | (a[1:] != a[:-1] + 1)
            yield length, a[new[:-1]], a[new[1:]], d[new[:-1]]
        again = np.zeros(len(at), bool)
        again[1:] = same
        again[:-1] |= same
        rank = np.zeros(len(at), np.int64)
        rank[1:] = np.cumsum(~same)
        name = np.full(size, -1)
        name[at[order[again]]] = rank[again]
        at = at[np.sort(order[again])]
        at = at[at + 2 * length <= end[at]]
        half = name[at + length]
        at, half = at[half >= 0], half[half >= 0]
        key = name[at] * size + half
        length *= 2


def _extended(word: np.ndarray, low: int, high: int, d: int, first: int, last: int) -> tuple[int, int]:
    """The words around ``low .. high`` that keep period d, within ``first .. last``."""
    step = 32
    while low > first:
        a = max(first, low - step)
        other = np.flatnonzero(word[a:low] != word[a + d : low + d])
        if len(other):
            low = a + int(other[-1]) + 1
            break
        low, step = a, 2 * step
    step = 32
    while high < last:
        b = min(last, high + step)
        other = np.flatnonzero(word[high:b] != word[high - d : b - d])
        if len(other):
            high += int(other[0])
            break
        high, step = b, 2 * step
    return low, high


def runs_of(word: np.ndarray, row: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """``start, end, period`` of all runs, by start and period, of rows that begin (and end) at ``row``.

    ``word`` holds a small integer per word.
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods need not hold a factor twice")
    # A run of least words or more holds factors of a third of them twice, if its period is no longer.
    from_length = 1 << (max(least // times, 1).bit_length() - 1)
    found: dict[tuple[int, int], int] = {}
    for length, lows, lasts, distances in _progressions(word, row, from_length):
        rows = np.searchsorted(row, lows, "right") - 1
        period, low, high = 0, 0, 0
        for a, b, d, k in zip(lows.tolist(), lasts.tolist(), distances.tolist(), rows.tolist()):
            b += length + d
            if d == period and low <= a and b <= high:
                continue
            period = d
            low, high = _extended(word, a, b, d, int(row[k]), int(row[k + 1]))
            if high - low >= max(least, times * d):
                found[low, high] = min(d, found.get((low, high), d))
    runs = sorted((a, d, b) for (a, b), d in found.items())
    return np.array([(a, b, d) for a, d, b in runs], np.int64).reshape(-1, 3)


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, rewrite: Rewrite | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs``.

    ``runs`` holds ``start, length, period`` in words, by start and then period; ``collapsed``
    joins by one space the words that no run holds after its first period. Words are runs of
    bytes other than ``[\\x20\\x09-\\x0D]``, known by 64-bit names. A null, empty or wordless text has
    no runs and collapses to the empty string; rows that repeat are handled each for itself, an
    empty table gives none, further columns are ignored. ``rewrite`` changes a row's words first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            row, count = words.row, words.counts
            source = np.arange(len(words.name))
            ids = batch.column("id").to_pylist()
            if rewrite is not None:
                for k, (own, n) in enumerate(zip(ids, count.tolist())):
                    if (change := rewrite(own, n)) is not None:
                        a, p = int(row[k]) + change[0], change[1]
                        source[a : row[k + 1]] = a + np.arange(row[k + 1] - a) % p
            _, word = np.unique(words.name, return_inverse=True)
            found = runs_of(word.reshape(-1)[source], row, least, times)
            edge = np.zeros(len(source) + 1, np.int64)
            np.add.at(edge, found[:, 0] + found[:, 2], 1)
            np.add.at(edge, found[:, 1], -1)
            keep = np.cumsum(edge)[:-1] == 0
            collapsed = []
            for a, b in zip(row.tolist(), row[1:].tolist()):
                kept = source[a:b][keep[a:b]]
                collapsed.append(joined(words.data, words.start[kept], words.end[kept]))
            own = np.searchsorted(row, found[:, 0], "right") - 1
            first = np.append(np.searchsorted(own, np.arange(len(count))), len(own)).astype(np.int32)
            columns = [found[:, 0] - row[own], found[:, 1] - found[:, 0], found[:, 2]]
            runs = pa.ListArray.from_arrays(pa.array(first), pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(_RUN)))
            out = [pa.array(ids, pa.int64()), pa.array(count.astype(np.int64)), runs, pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(out, ["id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    found = rows.mapInArrow(run, f"id long, n_words long, runs {RUNS}, collapsed string")
    return found.withColumnRenamed("id", doc_id)


def strongest(runs: str | Column) -> Column:
    """The run with the greatest length by period, of equal ones the first; null without runs."""
    runs = F.col(runs) if isinstance(runs, str) else runs
    more = lambda best, run: F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)
    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), more)


def as_lines(runs: str) -> Column:
    """``start,length,period`` and a line feed per run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
