"""Byte-pair encoding and decoding through a transducer lexicon.

``frequent_pieces`` counts the pieces between white space over the whole corpus in Spark;
the frequent ones are compiled with their ids into a minimal acyclic transducer
(``lexicon.py``), whose file every executor maps into memory. Tasks look up all pieces of a
slice at once; the pieces it lacks are merged exactly. What the lexicon holds changes the
speed, never the ids.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.llm.lexicon import Lexicon, build, save
from haulmark.llm.scratch import Scratch, most_frequent
from haulmark.llm.token_counts import GONE, count_merges
from haulmark.llm.wordbpe import Vocabulary, parsed, pieces, read_vocabulary, words
from haulmark.llm.words import Words, slices

#: Pieces a counting task holds before it hands its counts on.
HELD = 400_000
#: Ids of unseen pieces a worker remembers, some 100 MB with the pieces. Bounds memory, not results.
REMEMBERED_IDS = 2_000_000
#: Bytes of text to be encoded in one go; the arrays for it take some 40 times as much.
SLICE = 1 << 19


def frequent_pieces(docs: DataFrame, vocabulary: str, limit: int, text: str = "text") -> DataFrame:
    """``piece, n``: at most ``limit`` pieces, the most frequent of all rows of ``docs``.

    Tasks count first and hand on each piece once; a piece seen once within ``HELD``
    distinct ones stays behind, so n may fall short for rare pieces.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = parsed(shared.value)
        held: Counter = Counter()

        def hand_on() -> pa.RecordBatch:
            often = [(p, n) for p, n in held.items() if n > 1]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in often], pa.string()), pa.array([n for _, n in often], pa.int64())], ["piece", "n"])

        for batch in slices(batches, "text", SLICE):
            for text in batch.column("text").to_pylist():
                for part, _ in vocabulary.parts(text or ""):
                    held.update(pieces(part))
            if len(held) > HELD:
                yield hand_on()
        yield hand_on()

    counts = docs.select(F.col(text).alias("text")).mapInArrow(count, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    scratch = Scratch(docs.sparkSession, "pieces")
    return most_frequent(scratch.store(counts, "counts"), "n", limit)


def merge(symbols: list[int], merges: dict[int, tuple[int, int]]) -> list[int]:
    """The ids of a word: the lowest pair, leftmost first, is joined until none is left.

    By heap and linked list, so that a word of a million letters takes seconds.
    """
    left = list(symbols)
    if len(left) > 1:
        count_merges(left, merges)
    return [k for k in left if k != GONE]


def piece_ids(piece: str, vocabulary: Vocabulary) -> list[int]:
    return [k for word in words(piece) for k in merge(vocabulary.symbols(word), vocabulary.merges)]


def compile_lexicon(spark: SparkSession, frequent: DataFrame, vocabulary: str) -> str:
    """Builds the transducer of the given pieces, hands its file to the executors, returns its name.

    The pieces pass through the driver; ``frequent_pieces`` bounds their number.
    """
    known = parsed(read_vocabulary(vocabulary))
    found = sorted(row["piece"] for row in frequent.select("piece").collect())
    folder = tempfile.mkdtemp(prefix="lexicon-")
    path = os.path.join(folder, "lexicon")
    save(build([p.encode() for p in found], [piece_ids(p, known) for p in found]), path)
    with open(path, "rb") as file:
        name = f"lexicon-{hashlib.sha256(file.read()).hexdigest()[:24]}"
    context = spark.sparkContext
    if _added.get(name) is not context:  # a file of a name is added to an application once
        target = os.path.join(folder, name)
        os.rename(path, target)
        context.addFile(target)
        _added[name] = context
    return name


_added: dict[str, SparkContext] = {}


class Encoder:
    """Encodes slices of texts in one task."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.forget()

    def forget(self) -> None:
        self.unseen: dict[bytes, int] = {}
        #: The lexicon's ids and then those of unseen pieces, and where each of these begins, with an end.
        self.table = np.array(self.lexicon.table["ids"])
        self.extra_first = np.array([len(self.table)])

    def place(self, piece: bytes) -> int:
        """Where an unseen piece's ids lie among the extra ones; merged at first sight."""
        at = self.unseen.get(piece)
        if at is None:
            ids = piece_ids(piece.decode(), self.vocabulary)
            at = self.unseen[piece] = len(self.unseen)
            begin = int(self.extra_first[at])
            end = begin + len(ids)
            self.table = _room(self.table, end)
            self.extra_first = _room(self.extra_first, at + 2)
            self.table[begin:end] = ids
            self.extra_first[at + 1] = end
        return at

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit numbers."""
        parts, special, owner = [], [], []
        for row, text in enumerate(texts):
            for part, k in self.vocabulary.parts(text or ""):
                parts.append(part if k is not None or part.isascii() else _plain_spaces(part))
                special.append(-1 if k is None else k)
                owner.append(row)
        # White space in the byte sense of Words; other white space has been replaced.
        found = Words.spans(pa.array(parts, pa.large_string()))
        place = self.lexicon.find(found.data, found.start, found.end)
        first, known = self.lexicon.table["first"], len(self.lexicon.table["ids"])
        begin, size = first[place], first[place + 1] - first[place]
        missing = np.flatnonzero(place < 0)
        data = found.data.tobytes()
        if len(missing):
            if self.extra_first[len(self.unseen)] - known > REMEMBERED_IDS:
                self.forget()
            at = np.array([self.place(data[a:b]) for a, b in zip(found.start[missing].tolist(), found.end[missing].tolist())])
            begin[missing] = self.extra_first[at]
            size[missing] = self.extra_first[at + 1] - self.extra_first[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.table[np.arange(total) + np.repeat(begin - (ends - size), size)]
        edge = np.concatenate([[0], ends])[found.row]
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for k, (row, one) in enumerate(zip(owner, special)):
            out[row].append(flat[edge[k] : edge[k + 1]] if one < 0 else np.array([one], np.uint32))
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """``array``, or a copy with zeros behind it, that has ``size`` items."""
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(size - len(array), len(array) // 4, 1024), array.dtype)])


def _plain_spaces(text: str) -> str:
    """Non-ASCII white space as blanks: pieces then end at blanks only."""
    return " ".join(pieces(text))


def _encoder(content: bytes, lexicon: str) -> Encoder:
    key = (content, lexicon)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(parsed(content), Lexicon(SparkFiles.get(lexicon)))
    return _encoders[key]


_encoders: dict[tuple[bytes, str], Encoder] = {}


def _blob(arrays: list[bytes]) -> pa.Array:
    return pa.array(arrays, pa.binary())


def _text_of(tokens: list[str], ids: np.ndarray) -> str:
    return " ".join([tokens[k] for k in ids.tolist()])


def encode(docs: DataFrame, vocabulary: str, lexicon: str, text: str = "text", doc_id: str = "doc_id", with_text: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit numbers) of every row, without a shuffle.

    A null text counts as empty: no tokens, empty ids. Ids may be null or repeat; further
    columns are ignored. Special strings in a text become their ids. ``with_text`` adds
    ``decoded``, what ``decode`` gives, in the same pass.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, lexicon)
        tokens = encoder.vocabulary.tokens
        for batch in slices(batches, "text", SLICE):
            ids = encoder.encode(batch.column("text").to_pylist())
            columns = {"id": batch.column("id"), "n_tokens": pa.array([len(x) for x in ids], pa.int64()), "ids": _blob([x.astype("<u4").tobytes() for x in ids])}
            if with_text:
                columns["decoded"] = pa.array([_text_of(tokens, x) for x in ids], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids binary" + ", decoded string" * with_text
    return rows.mapInArrow(run, schema).withColumnRenamed("id", doc_id)


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, decoded`` of every row: the tokens of its ids with a blank between them.

    The file names no decoder, so word ends and byte letters stay visible. Null ids give
    null.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = parsed(shared.value).tokens
        for batch in slices(batches, "ids"):
            texts = [None if x is None else _text_of(tokens, np.frombuffer(x, "<u4")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "decoded": pa.array(texts, pa.string())})

    rows = encoded.select(F.col(doc_id).alias("id"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, decoded string").withColumnRenamed("id", doc_id)


def encode_corpus(docs: DataFrame, vocabulary: str, lexicon_pieces: int = 32_768, text: str = "text", doc_id: str = "doc_id", with_text: bool = False) -> DataFrame:
    """Counts, compiles and encodes: two passes over ``docs``."""
    frequent = frequent_pieces(docs, vocabulary, lexicon_pieces, text)
    lexicon = compile_lexicon(docs.sparkSession, frequent, vocabulary)
    return encode(docs, vocabulary, lexicon, text, doc_id, with_text)
