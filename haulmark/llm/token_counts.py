"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a word form a linked list; a heap holds its adjacent pairs by rank. The
lowest pair is popped and joined until none is left. Each join makes one symbol fewer, so
the count is symbols minus merges and no identifier is ever put together.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.wordbpe import Vocabulary, parsed, pieces, read_vocabulary, words
from haulmark.llm.words import slices

#: Entries a task remembers; beyond, it starts anew. Bounds memory, not results.
REMEMBERED = 1_000_000
#: In the place of a symbol that has been joined with the one before it.
GONE = -1


def count_merges(symbols: list[int], merges: dict[int, tuple[int, int]]) -> int:
    """How many merges a word undergoes; ``symbols`` are left as they are after these."""
    n = len(symbols)
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    heap = []
    for at in range(n - 1):
        pair = symbols[at] << 32 | symbols[at + 1]
        found = merges.get(pair)
        if found:
            heap.append((found[0], at, pair, found[1]))
    heapify(heap)
    done = 0
    while heap:
        _, at, pair, merged = heappop(heap)
        after = right[at]
        if after >= n or symbols[at] << 32 | symbols[after] != pair:
            continue  # one of the two has been joined with another meanwhile
        done += 1
        symbols[at], symbols[after] = merged, GONE
        after = right[at] = right[after]
        if after < n:
            left[after] = at
            pair = merged << 32 | symbols[after]
            found = merges.get(pair)
            if found:
                heappush(heap, (found[0], at, pair, found[1]))
        before = left[at]
        if before >= 0:
            pair = symbols[before] << 32 | merged
            found = merges.get(pair)
            if found:
                heappush(heap, (found[0], before, pair, found[1]))
    return done


class _Words(dict):
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> int:
        symbols = self.vocabulary.symbols(word)
        n = len(symbols)
        n -= count_merges(symbols, self.vocabulary.merges) if n > 1 else 0
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = n
        return n


class _Pieces(dict):
    def __init__(self, words: _Words):
        self.words = words

    def __missing__(self, piece: str) -> int:
        n = sum(map(self.words.__getitem__, words(piece)))
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = n
        return n


_counters: dict[bytes, _Pieces] = {}


def count_tokens(text: str | None, content: bytes) -> int:
    """Tokens of one whole text; ``content`` is the vocabulary file."""
    if not text:
        return 0
    counter = _counters.get(content)
    if counter is None:
        counter = _counters[content] = _Pieces(_Words(parsed(content)))
    total = 0
    for part, special in counter.words.vocabulary.parts(text):
        total += sum(map(counter.__getitem__, pieces(part))) if special is None else 1
    return total


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``, without a shuffle.

    A null text counts as empty (0 bytes, 0 tokens, not over). Null and repeated ids stay as
    they are, further columns are ignored. Memory of a task: one slice of texts and at most
    ``REMEMBERED`` words and pieces.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = shared.value
        for batch in slices(batches, "text"):
            counts = pa.array([count_tokens(t, content) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), counts], ["id", "n_bytes", "n_tokens"])

    rows = docs.select(
        F.col(doc_id).alias("id"),
        F.col(text).alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(doc_id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
