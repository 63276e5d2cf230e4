"""Repeated passages across documents by recompression.

Every task parses its texts into the same symbols (``recompression.py``). Each window of
words has an anchor, a stretch of symbols that it decides alone, so equal windows have equal
anchors wherever they stand. A first shuffle of anchors reveals those that several documents
share; only windows with such an anchor take part in a second one, which verifies whole
windows and finds the smallest document that holds each. Words covered by a window that an
earlier document holds are removed.

Tasks put the documents of an anchor or window together before the shuffles, so a passage in
a third of all texts is a row per task and some ids, not a row per text. The plan is one
query: the texts are shuffled by id once and that shuffle serves both later passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.recompression import anchors, parse
from haulmark.llm.words import Words, slices

WINDOW = 13
ROUNDS = 1
#: Keys a task holds before it puts equal ones together and hands them on.
HELD = 2_000_000
#: Bits of an anchor beyond those that count the rows: with some hundred anchors in a text, one
#: in some thousand has the bits of another by chance.
ANCHOR_BITS = 20
#: ``ids`` lists the documents of a key in order if there are several, ``id`` is the first.
_KEYS = "key long, id long, ids array<long>"


class _Held:
    """Keys with the documents that have them, gathered and put together by key."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.keys.append(keys)
        self.ids.append(ids)
        self.size += len(keys)
        if self.size > HELD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        keys, ids = np.concatenate(self.keys), np.concatenate(self.ids)
        self.__init__()
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
        keys, ids = keys[new], ids[new]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        end = np.append(first[1:], len(keys))
        # Keys of one document, the most by far, go in the order of documents: their ids then
        # take next to no space in the shuffle.
        one = end - first == 1
        alone = first[one][np.argsort(ids[first[one]], kind="stable")]
        for a in range(0, len(alone), 100_000):
            part = alone[a : a + 100_000]
            yield self._batch(keys[part], ids[part], pa.nulls(len(part), pa.list_(pa.int64())))
        first, end = first[~one], end[~one]
        for a in range(0, len(first), 100_000):
            f, e = first[a : a + 100_000], end[a : a + 100_000]
            size = e - f
            stop = np.cumsum(size)
            at = np.arange(stop[-1]) + np.repeat(f - (stop - size), size)
            yield self._batch(keys[f], ids[f], pa.ListArray.from_arrays(pa.array(np.append(0, stop), pa.int32()), pa.array(ids[at])))

    @staticmethod
    def _batch(keys: np.ndarray, ids: np.ndarray, lists: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids), lists], ["key", "id", "ids"])


def _windows(batch: pa.RecordBatch, size: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, the names and first words of all windows, and the row of each word."""
    words = Words(batch.column("text"))
    names, at = words.windows(size)
    return words, names, at, np.repeat(np.arange(batch.num_rows), words.counts)


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("id"), np.int64)


def remove_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row of ``docs``.

    A word goes if a window of ``window`` words covers it whose words also stand in a document
    with a smaller id; ``kept`` is the rest joined by blanks. Windows are judged on the input.
    A null text has no words. Ids are integers; rows that repeat an id are one document in
    this sense, rows without id neither lose words nor make others lose them. Texts shorter
    than a window keep all words. Further columns are ignored.
    """
    # Both joins below are outer ones on the same rows, so that Spark shuffles the texts once.
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))

    # An anchor only has to keep most texts apart, as windows are verified by themselves: so
    # many bits that few of them meet by chance, and no more in the shuffles.
    few = np.uint64((1 << min(63, docs.count().bit_length() + ANCHOR_BITS)) - 1)

    def emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for batch in slices(batches, "text"):
            words, _, at, row = _windows(batch, window)
            if len(at):
                found = anchors(parse(words.name, row, ROUNDS), at, window) & few
                ids = _ids(batch)[row[at]]
                # Windows side by side often share their anchor.
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (ids[1:] != ids[:-1])
                yield from held.add(found[new], ids[new])
        yield from held.flush()

    by_key = Window.partitionBy("key")
    shared = rows.where("id IS NOT NULL AND text IS NOT NULL").mapInArrow(emit_anchors, _KEYS)
    last, every = F.coalesce(F.element_at("ids", -1), "id"), F.coalesce("ids", F.array("id"))
    shared = shared.select("key", every.alias("ids"), F.min("id").over(by_key).alias("least"), F.max(last).over(by_key).alias("most")).where("least < most")
    alive = shared.select("key", F.explode("ids").alias("of")).groupBy("of").agg(F.collect_list("key").alias("keys"))

    def emit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for batch in slices((b.filter(b.column("keys").is_valid()) for b in batches), "text"):
            words, names, at, row = _windows(batch, window)
            if not len(at):
                continue
            found = anchors(parse(words.name, row, ROUNDS), at, window) & few
            keep = _listed(found, row[at], batch.column("keys"))
            yield from held.add(names[keep], _ids(batch)[row[at[keep]]])
        yield from held.flush()

    verified = rows.join(alive, rows["id"] == alive["of"], "left").select("id", "text", "keys").mapInArrow(emit_windows, _KEYS)
    verified = verified.select("key", every.alias("ids"), last.alias("last"), F.min("id").over(by_key).alias("least")).where("least < last")
    later = verified.select("key", "least", F.explode("ids").alias("of")).where("of > least")
    gone = later.groupBy("of").agg(F.collect_list("key").alias("keys"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, names, at, row = _windows(batch, window)
            hit = at[_listed(names, row[at], batch.column("keys"))] if len(at) else at
            change = np.zeros(len(words.name) + 1, np.int64)
            np.add.at(change, hit, 1)
            np.add.at(change, hit + window, -1)
            stay = np.cumsum(change[:-1]) == 0
            kept = [words.kept(k, stay[words.row[k] : words.row[k + 1]]) for k in range(batch.num_rows)]
            n_kept = np.diff(np.concatenate([[0], np.cumsum(stay)])[words.row])
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "n_words": pa.array(words.counts), "n_removed": pa.array(words.counts - n_kept), "kept": pa.array([k.decode() for k in kept], pa.string())})

    done = rows.join(gone, rows["id"] == gone["of"], "left").select("id", "text", "keys")
    return done.mapInArrow(cut, "id long, n_words long, n_removed long, kept string").withColumnRenamed("id", doc_id)


def _listed(names: np.ndarray, row: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Whether each name is in the list of its row."""
    out = np.zeros(len(names), bool)
    edge = np.searchsorted(row, np.arange(len(lists) + 1))
    valid = np.asarray(lists.is_valid())
    for k in np.flatnonzero(valid & (np.diff(edge) > 0)).tolist():
        own = np.sort(np.asarray(lists[k].values, np.int64).view(np.uint64))
        if len(own):
            part = names[edge[k] : edge[k + 1]]
            spot = np.minimum(np.searchsorted(own, part), len(own) - 1)
            out[edge[k] : edge[k + 1]] = own[spot] == part
    return out
