"""Benchmark decontamination by latent semantic retrieval.

Texts become sequences of benchmark terms, cut into blocks; two neighbouring blocks are a
passage. Weighted by tf-idf over all blocks of the corpus, they span a latent space: a randomised
singular value decomposition of the blocks A and the benchmark items E. Its sketch
``(A'A + w E'E) R``, a power iteration on the start R, sums over all blocks in Spark; singular
vectors and values of the small factor follow on the driver. Passages and items are compared by
cosine there; what comes close is verified on the words themselves: the longest common
subsequence of the telling terms, and that of all words, must hold most of an item, or, for a
paraphrase, a good part of it and its answer.

Items with too few telling terms have no place in that space. All words are searched for
them, without a cosine: the same shares must be found within a short stretch.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.scratch import Scratch
from haulmark.llm.words import PLAIN, Words, slices

#: Words of a block; a passage is two neighbouring blocks.
HALF = 32
RANK = 64
#: Terms in a larger share of passages tell nothing.
COMMON = 0.1
#: Least cosine of a candidate, for an item of a passage's length.
NEAR = 0.5
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.5
#: Items of one search, and about the bytes of their texts: what the driver and a broadcast hold.
ITEMS, ITEM_BYTES = 8192, 2 << 20
#: What a task holds of items' terms, a byte per term.
MEMBER_BYTES = 16 << 20
#: Items with fewer telling words are also searched for by all their words.
TELLING = 4
_WORDS_AT_ONCE = 1 << 16


@dataclass
class Items:
    """Benchmark items as sequences of term numbers."""

    ids: list
    terms: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: np.ndarray  # sorted names


def read_items(benchmark: DataFrame, text: str = "text", item_id: str = "item_id", answer: str | None = None) -> Items:
    """The items of one search on the driver; those without words are left out.

    Without an answer column an item's last sentence counts as its answer.
    """
    rows = benchmark.where(F.col(text).isNotNull()).select(item_id, text, *([answer] if answer else [])).collect()
    rows = [r for r in rows if r[1].strip()]
    last = [(r[2] or "") if answer else ([s for s in re.split(r"[.?!\n]+", r[1]) if s.strip()] or [""])[-1] for r in rows]
    whole, ends = (_words(pa.array(t, pa.string())) for t in ([r[1] for r in rows], last))
    vocabulary = np.unique(whole.name)
    cut = [np.searchsorted(vocabulary, x.name[x.row[k] : x.row[k + 1]]) for x in (whole, ends) for k in range(len(rows))]
    terms, answers = cut[: len(rows)], cut[len(rows) :]
    keep = [k for k, t in enumerate(terms) if len(t)]
    top = len(vocabulary) - 1
    return Items([rows[k][0] for k in keep], [terms[k] for k in keep], [np.minimum(answers[k], top) for k in keep], vocabulary)


def _words(column: pa.Array) -> Words:
    """Words in lower case, apart from ASCII signs."""
    return Words(pc.utf8_lower(column), PLAIN)


def _term_bytes(column: pa.Array, known: np.ndarray) -> list[bytes]:
    words = _words(column)
    spot = np.minimum(np.searchsorted(known, words.name), len(known) - 1)
    terms = np.where(known[spot] == words.name, spot, len(known)).astype(np.uint32)
    return [terms[a:b].tobytes() for a, b in zip(words.row, words.row[1:])]


def _terms(rows: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``id, terms``: the number of each word's term, or the size of the vocabulary, as 4-byte numbers."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            parts = _term_bytes(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "terms": pa.array(parts, pa.binary())})

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, terms binary")


@dataclass
class _Passages:
    """Blocks of the words of some rows, and the passages of one or two blocks."""

    terms: np.ndarray
    first: np.ndarray  # first word of each row, and the end
    block: np.ndarray  # first word of each block
    head: np.ndarray  # first block of each passage
    tail: np.ndarray  # its last block
    row: np.ndarray  # of each passage

    @property
    def of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.block)), np.diff(np.append(self.block, len(self.terms))))


def _passages(column: pa.Array) -> _Passages | None:
    parts = [np.frombuffer(x, np.uint32) for x in column.to_pylist()]
    size = np.array([len(p) for p in parts])
    if not size.sum():
        return None
    first = np.concatenate([[0], np.cumsum(size)])
    blocks = -(-size // HALF)
    row = np.repeat(np.arange(len(parts)), blocks)
    begin = np.concatenate([[0], np.cumsum(blocks)])
    place = np.arange(len(row)) - begin[row]
    # A passage per block but the last, or the only one.
    is_head = (place < blocks[row] - 1) | (blocks[row] == 1)
    head = np.flatnonzero(is_head)
    return _Passages(np.concatenate(parts).astype(np.int64), first, first[row] + place * HALF, head, head + (blocks[row[head]] > 1), row[head])


def _table(terms: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array([v.tobytes() for v in values], pa.binary())], ["term", "vector"])


def _summed(rows: DataFrame, width: int) -> np.ndarray:
    """The sum of the vectors of each term: partial sums per task, then per term; ``width`` values each."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for term, vector in zip(batch.column("term").to_pylist(), batch.column("vector").to_pylist()):
                vector = np.frombuffer(vector, np.float64)
                sums[term] = sums[term] + vector if term in sums else vector
        if sums:
            yield _table(np.array(list(sums)), np.array(list(sums.values())))

    found = rows.repartition("term").mapInArrow(add, "term long, vector binary").toPandas().sort_values("term")
    return found["term"].to_numpy(), np.array([np.frombuffer(v, np.float64) for v in found["vector"]]).reshape(-1, width)


def _by_term(terms: np.ndarray, size: int) -> np.ndarray:
    """The order of terms below ``size``, equal ones as they come. Numbers of two bytes are dealt, not compared."""
    return np.argsort(terms.astype(np.uint16) if size <= 1 << 16 else terms, kind="stable")


def _weights(coded: DataFrame, size: int) -> np.ndarray:
    """idf of each term over all passages' blocks; zero for common and unknown ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2)
        for batch in slices(batches, "terms"):
            found = _passages(batch.column("terms"))
            if found is not None:
                known = found.terms < size
                terms, block = found.terms[known], found.of_word[known]
                order = _by_term(terms, size)
                terms, block = terms[order], block[order]
                # A block counts once for each of its terms.
                new = (np.diff(terms, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0)
                total[: size + 1] += np.bincount(terms[new], minlength=size + 1)
                total[size + 1] += len(found.block)
        yield _table(np.arange(size + 2), total[:, None])

    terms, total = _summed(coded.mapInArrow(count, "term long, vector binary"), 1)
    held = np.zeros(size + 2)
    held[terms] = total[:, 0]
    blocks = max(1.0, held[size + 1])
    idf = np.log((blocks + 1) / (held[: size + 1] + 1))
    idf[held[: size + 1] > COMMON * blocks] = 0
    idf[size] = 0
    return idf


def _project(items: Items, idf: np.ndarray, onto: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``E onto`` for the items' unit rows E, and E's entries: item, term, value."""
    rank = onto.shape[1]
    out = np.zeros((len(items.terms), rank), np.float32)
    entries = []
    for a in range(0, len(items.terms), 256):
        part = items.terms[a : a + 256]
        owner = np.repeat(np.arange(len(part)), [len(t) for t in part])
        pairs, count = np.unique(owner * len(idf) + np.concatenate(part), return_counts=True)
        owner, terms = pairs // len(idf), pairs % len(idf)
        values = idf[terms] * count
        norm = np.sqrt(np.bincount(owner, values**2, len(part)))
        values = (values / np.maximum(norm, 1e-9)[owner]).astype(np.float32)
        # Each item has words, so each has a run of entries.
        out[a : a + len(part)] = np.add.reduceat(onto[terms] * values[:, None], np.flatnonzero(np.diff(owner, prepend=-1)))
        entries.append((owner + a, terms, values))
    return out, *(np.concatenate(x) for x in zip(*entries))


def latent_space(coded: DataFrame, items: Items, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """The leading right singular vectors (terms by rank), those of no weight left out."""
    size = len(idf) - 1
    rank = min(rank, size)
    start = np.random.Generator(np.random.PCG64(7)).standard_normal((size + 1, rank)).astype(np.float32)
    start[size] = 0
    shared = coded.sparkSession.sparkContext.broadcast((idf.astype(np.float32), start))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, start = shared.value
        weighted = start * idf[:, None]
        total = np.zeros((size + 1, rank))
        for batch in slices(batches, "terms", 4 * _WORDS_AT_ONCE):
            found = _passages(batch.column("terms"))
            if found is None:
                continue
            keep = idf[found.terms] > 0
            terms, block = found.terms[keep], found.of_word[keep]
            if not len(terms):
                continue
            # Of each block with its own norm: y = a R, then a y' is added term by term.
            edge = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            y = np.add.reduceat(weighted[terms], edge)
            norm = np.add.reduceat(idf[terms] ** 2, edge)
            y /= norm[:, None]
            order = _by_term(terms, size)
            of = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(terms))))[order]
            terms = terms[order]
            cut = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
            total[terms[cut]] += np.add.reduceat(y[of], cut) * idf[terms[cut], None]
        used = np.flatnonzero(total.any(axis=1))
        if len(used):
            yield _table(used, total[used])

    terms, sums = _summed(coded.mapInArrow(sketch, "term long, vector binary"), rank)
    corpus = np.zeros((size + 1, rank))
    corpus[terms] = sums
    # E'(E R): the items' entries only, some at a time.
    y, owner, held, values = _project(items, idf, start)
    wanted = np.zeros((size + 1, rank), np.float32)
    for a in range(0, len(held), _WORDS_AT_ONCE):
        part = slice(a, a + _WORDS_AT_ONCE)
        np.add.at(wanted, held[part], y[owner[part]] * values[part, None])
    # The items weigh so much that the space holds them before the corpus's own directions.
    scale = 10 * np.linalg.norm(corpus) / max(float(np.linalg.norm(wanted)), 1e-9) or 1.0
    vectors, values = _decomposed(corpus + scale * wanted, start)
    return vectors[:, values > 1e-6 * values.max(initial=0)].astype(np.float32)


def _decomposed(sketch: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular vectors and values of A from ``sketch = A'A start``, without another pass over A.

    A'A is approximated by its part in the sketched space, which needs no more than the sketch
    itself; a small shift keeps the factor positive.
    """
    basis, inner = np.linalg.qr(start.astype(np.float64))
    # As if the start had been orthonormal.
    y = np.linalg.solve(inner.T, sketch.T).T
    shift = 1e-7 * max(float(np.linalg.norm(y)), 1e-300)
    y += shift * basis
    core = basis.T @ y
    factor = np.linalg.cholesky((core + core.T) / 2)
    left, values, _ = np.linalg.svd(np.linalg.solve(factor, y.T).T, full_matrices=False)
    return left, np.sqrt(np.maximum(values**2 - shift, 0))


def places_of(a: np.ndarray) -> dict[int, int]:
    """Where each value stands, a bit per element of ``a``."""
    places: dict[int, int] = {}
    for k, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << k
    return places


def common_subsequence(a: np.ndarray, b: np.ndarray, places: dict[int, int] | None = None) -> int:
    """Length of the longest common subsequence, a bit per element of ``a``, whose ``places_of`` may be given."""
    places = places_of(a) if places is None else places
    row = every = (1 << len(a)) - 1
    for x in b.tolist():
        hit = row & places.get(x, 0)
        if hit:
            row = (row + hit | row - hit) & every
    return len(a) - row.bit_count()


class _Search:
    def __init__(self, items: Items, idf: np.ndarray, basis: np.ndarray):
        self.idf = idf
        self.vectors = (basis * idf[:, None]).astype(np.float32)
        latent = _project(items, idf, basis)[0]
        self.items = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)).T
        size = np.array([len(t) for t in items.terms])
        self.near = (NEAR * np.sqrt(np.minimum(1, size / (2 * HALF)))).astype(np.float32)
        # Items without enough telling terms are compared by all their terms.
        self.telling = [int((idf[t] > 0).sum()) >= TELLING for t in items.terms]
        # Those with common words are hidden from the latent space, wholly or in part.
        self.hidden = [k for k, t in enumerate(items.terms) if not self.telling[k] and (idf[t] == 0).any()]
        self.size = size
        self._members: dict[int, np.ndarray] = {}
        self.terms = [t[idf[t] > 0] if k else t for t, k in zip(items.terms, self.telling)]
        self.answers = [t[idf[t] > 0] if k else t for t, k in zip(items.answers, self.telling)]
        self.least = [PARAPHRASE * len(t) for t in self.terms]
        self.whole = items.terms
        self.ends = items.answers

    def member(self, item: int) -> np.ndarray:
        """Which terms are the item's."""
        known = self._members.get(item)
        if known is None:
            if len(self._members) * len(self.idf) >= MEMBER_BYTES:
                self._members.clear()
            known = self._members[item] = np.zeros(len(self.idf), bool)
            known[self.terms[item]] = True
            known[self.answers[item]] = True
        return known

    def find(self, column: pa.Array) -> Iterator[tuple[int, int, float, float, float]]:
        """Row, item, cosine, share of the item and of its answer in common."""
        found = _passages(column)
        if found is None:
            return
        keep = self.idf[found.terms] > 0
        terms, block = found.terms[keep], found.of_word[keep]
        blocks = np.zeros((len(found.block), self.vectors.shape[1]), np.float32)
        if len(terms):
            edge = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            blocks[block[edge]] = np.add.reduceat(self.vectors[terms], edge)
        # Stretches are first searched without words that no item has.
        is_known = found.terms < len(self.idf) - 1
        known, before = found.terms[is_known], np.concatenate([[0], np.cumsum(is_known)])
        spread = blocks[found.head] + np.where((found.tail > found.head)[:, None], blocks[found.tail], 0)
        spread /= np.maximum(np.linalg.norm(spread, axis=1, keepdims=True), 1e-9)
        for a in range(0, len(self.size), 4096):
            cosine = spread @ self.items[:, a : a + 4096]
            passage, item = np.nonzero(cosine >= self.near[a : a + 4096])
            close, item = cosine[passage, item], item + a
            row, at = found.row[passage], found.block[found.head[passage]]
            begin = np.maximum(found.first[row], at - self.size[item])
            end = np.minimum(found.first[row + 1], at + 2 * HALF + self.size[item])
            for k in self._likely(known, before[begin], before[end], item):
                one, words = int(item[k]), found.terms[begin[k] : end[k]]
                values = self._verified(one, words, words)
                if values is not None:
                    yield int(row[k]), one, float(close[k]), *values
        yield from self._exact(found, spread)

    def _likely(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray, item: np.ndarray) -> Iterator[int]:
        """Which stretches ``words[begin:end]`` have enough of their items' terms in order, item by item."""
        order = np.argsort(item, kind="stable")
        begin, size, item = begin[order], (end - begin)[order], item[order]
        total = np.cumsum(size)
        # Stretches of one item, of so many words in all that a task can hold them.
        piece = (total - size) // _WORDS_AT_ONCE
        cuts = np.flatnonzero((np.diff(item, prepend=-1) != 0) | (np.diff(piece, prepend=-1) != 0)).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(item)]):
            one = int(item[a])
            stop = total[a:b] - (total[a] - size[a])
            start = stop - size[a:b]
            some = words[np.arange(stop[-1]) + np.repeat(begin[a:b] - start, size[a:b])]
            held = self.member(one)[some]
            count = np.concatenate([[0], np.cumsum(held)])
            # No more can be in common.
            enough = np.flatnonzero(count[stop] - count[start] >= self.least[one]).tolist()
            places = places_of(self.terms[one]) if enough else None
            for k in enough:
                x, y = start[k], stop[k]
                if common_subsequence(self.terms[one], some[x:y][held[x:y]], places) >= self.least[one]:
                    yield int(order[a + k])

    def _verified(self, item: int, words: np.ndarray, around: np.ndarray) -> tuple[float, float] | None:
        """Share of all of the item's words in ``words`` and of its answer's in ``around``, if they make a finding."""
        own, wanted = self.whole[item], self.ends[item]
        share = common_subsequence(own, words) / len(own)
        if share < PARAPHRASE:
            return None
        answer = common_subsequence(wanted, around) / len(wanted) if len(wanted) else 1.0
        return (share, answer) if share >= COPY or answer >= ANSWER else None

    def _exact(self, found: _Passages, spread: np.ndarray) -> Iterator[tuple[int, int, float, float, float]]:
        """Findings of the hidden items: in every row, the best stretch of at most ``size / PARAPHRASE`` words."""
        if not self.hidden:
            return
        row_of = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
        stop, place = found.first[row_of + 1], np.arange(len(found.terms))
        for item in self.hidden:
            size = int(self.size[item])
            member = self.member(item)[found.terms]
            held = np.concatenate([[0], np.cumsum(member)])
            end = np.minimum(stop, place + int(np.ceil(size / PARAPHRASE)))
            most = held[end] - held[:-1]
            starts = np.flatnonzero(member & (most >= PARAPHRASE * size))
            # Of each row, stretches that can hold most first: the rest is left when no more can be gained.
            starts = starts[np.lexsort((-most[starts], row_of[starts]))]
            done, best = -1, None
            for at in starts.tolist():
                row = int(row_of[at])
                if row != done:
                    if best is not None:
                        yield done, item, self._cosine(found, spread, done, item), *best
                    done, best = row, None
                if best is not None and min(1.0, int(most[at]) / size) <= best[0]:
                    continue
                begin, last = max(int(found.first[row]), at - size), min(int(stop[at]), int(end[at]) + size)
                words, around = found.terms[at : end[at]][member[at : end[at]]], found.terms[begin:last][member[begin:last]]
                values = self._verified(item, words, around)
                if values is not None and (best is None or values > best):
                    best = values
            if best is not None:
                yield done, item, self._cosine(found, spread, done, item), *best

    def _cosine(self, found: _Passages, spread: np.ndarray, row: int, item: int) -> float:
        """The largest cosine of a row's passages with an item, or 0."""
        return max(0.0, float((spread[found.row == row] @ self.items[:, item]).max()))


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id", answer: str | None = None) -> DataFrame:
    """``doc_id, item_id, cosine, lcs, answer`` for each document and item it contains.

    ``lcs`` is the share of the item's words found in order, ``answer`` that of its answer's;
    with too few telling terms ``cosine`` may be 0. Whole
    texts of all rows are searched; null and empty texts contain nothing, items without words
    are contained nowhere. Repeated rows give repeated findings, a null id stays null. Without
    items the result is empty. Further columns are ignored.

    A benchmark of more than ``ITEMS`` items or ``ITEM_BYTES`` is searched for in parts of
    about that size, each with a latent space of its own and passes over ``docs``.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "leaks")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kinds = [rows.schema["id"].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()]
    schema = f"{doc_id} {kinds[0]}, {item_id} {kinds[1]}, cosine double, lcs double, answer double"
    every = spark.createDataFrame([], schema)
    searches = list(_item_parts(benchmark, text=item_text, item_id=item_id, answer=answer, scratch=scratch))
    if len(searches) == 1:
        found = _contaminated(rows, searches[0](), schema, scratch)
        return every if found is None else found
    for items in searches:
        found = _contaminated(rows, items(), schema, scratch)
        if found is not None:
            every = every.unionAll(scratch.store(found, "found"))
            found.release()
    return every


def _item_parts(benchmark: DataFrame, text: str, item_id: str, answer: str | None, scratch: Scratch) -> Iterator[Callable[[], Items]]:
    """What reads the items of each search, one search at a time."""
    # The number of a stored row, not its id or text: repeated items spread over the parts too.
    columns = [F.col(item_id), F.col(text), *([F.col(answer)] if answer else [])]
    held = scratch.store(benchmark.where(F.col(text).isNotNull()).select(*columns), "items")
    size = held.agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("bytes")).first()
    parts = max(1, -(-size["n"] // ITEMS), -(-(size["bytes"] or 0) // ITEM_BYTES))
    if parts == 1:
        yield partial(read_items, held, text, item_id, answer)
        return
    dealt = held.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).alias("part"), F.struct(*columns).alias("item"))
    dealt = scratch.store(dealt, "parts")
    for part in range(parts):
        yield partial(read_items, dealt.where(F.col("part") == part).select("item.*"), text, item_id, answer)


def without_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", answer: str | None = None) -> DataFrame:
    """The rows of ``docs`` in which ``contaminated`` finds no item, with all columns.

    Each row is judged where it lies: no text is shuffled, and rows need no id. Null and empty texts stay.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "leaks")
    rows = docs.where(F.col(text).isNotNull()).select(F.lit(0).alias("id"), F.col(text).alias("text"))
    kept = docs
    for part in _item_parts(benchmark, item_text, item_id, answer, scratch):
        items = part()
        if not items.ids:
            continue
        coded = scratch.store(_terms(rows, items.vocabulary), "terms")
        idf = _weights(coded, len(items.vocabulary))
        shared = spark.sparkContext.broadcast((_Search(items, idf, latent_space(coded, items, idf)), items.vocabulary))
        scratch.drop(coded)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search, vocabulary = shared.value
            for batch in slices(batches, text, 4 * _WORDS_AT_ONCE):
                found = {row for row, *_ in search.find(pa.array(_term_bytes(batch.column(text), vocabulary), pa.binary()))}
                yield batch.filter(pa.array([row not in found for row in range(batch.num_rows)], pa.bool_()))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept


def _contaminated(rows: DataFrame, items: Items, schema: str, scratch: Scratch) -> DataFrame | None:
    """The findings of the items of one search, or None without items."""
    if not items.ids:
        return None
    spark = rows.sparkSession
    coded = scratch.store(_terms(rows.where("text IS NOT NULL"), items.vocabulary), "terms")
    idf = _weights(coded, len(items.vocabulary))
    search = _Search(items, idf, latent_space(coded, items, idf))
    shared = spark.sparkContext.broadcast((search, items.ids))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, ids = shared.value
        for batch in slices(batches, "terms", 4 * _WORDS_AT_ONCE):
            best: dict[tuple[int, int], tuple[float, float, float]] = {}
            for row, item, *values in search.find(batch.column("terms")):
                best[row, item] = tuple(map(max, best.get((row, item), values), values))
            owner = batch.column("id").to_pylist()
            out = [(owner[row], ids[item], *values) for (row, item), values in sorted(best.items())]
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.schema.field("id").type), pa.array(columns[1], kind), *(pa.array(c, pa.float64()) for c in columns[2:])], names)

    names = [part.split()[0] for part in schema.split(", ")]
    kind = {"bigint": pa.int64(), "int": pa.int32()}.get(schema.split(", ")[1].split()[1], pa.string())
    found = coded.mapInArrow(find, schema)

    def release() -> None:
        scratch.drop(coded)
        shared.destroy()

    found.release = release
    return found
