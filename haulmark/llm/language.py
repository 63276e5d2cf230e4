"""Language identification by language-bitmask n-gram filters.

A language's set holds the character n-grams that are typical of it. All sets share one
bit-sliced Bloom filter: row h of the filter is a bitmask with one bit per language, and
the masks at an n-gram's rows, and-ed, name every language that contains it. Per text, the
bits are counted by language, what false positives add is taken off, and the language with
the largest corrected count wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.folds import bounded_sample, held_out
from haulmark.llm.scratch import Scratch
from haulmark.llm.words import mix, powers, slices

SIZES = (2, 3)
UNKNOWN = "und"
_BLANK = 0x20
_letters = np.zeros(0x110000, np.uint8)  # 0: not looked at, 1: letter, 2: other


def text_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts, others than letters as blanks, and each text's first."""
    low = [f" {t.lower()} " if t else "" for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    for c in np.flatnonzero(seen & (_letters == 0)).tolist():
        _letters[c] = 1 if chr(c).isalpha() else 2
    codes = np.where(_letters[codes] == 1, codes, _BLANK)
    return codes, np.cumsum([0, *map(len, low)])


def grams(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the n-grams with a letter in second place, and where each begins.

    Texts begin and end with a blank, so none of these reaches into another text unless its
    last letter does, which is a blank again.
    """
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(codes[1 : n + 1] != _BLANK)
    total = np.full(len(at), size, np.uint64)
    for k, factor in enumerate(powers(size + 1)[1:]):
        total += codes[at + k].astype(np.uint64) * factor
    return mix(total), at


@dataclass
class Filters:
    """``rows[h]``: one mask per language word; language k is bit ``k % 64`` of word ``k // 64``."""

    languages: list[str]
    rows: np.ndarray
    hashes: int
    prior: int

    def __post_init__(self):
        bits = [(self.rows[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1) for k in range(len(self.languages))]
        self.false_rate = np.array([float(b.mean()) ** self.hashes for b in bits])

    def masks(self, names: np.ndarray) -> np.ndarray:
        """Of each n-gram, the languages that contain it (and false positives)."""
        out = None
        for at in _rows_of(names, len(self.rows), self.hashes):
            out = self.rows[at] if out is None else out & self.rows[at]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        codes, first = text_codes(texts)
        n = len(texts)
        hits = np.zeros((n, len(self.languages)))
        total = np.zeros(n)
        for size in SIZES:
            names, at = grams(codes, size)
            edge = np.searchsorted(at, first)
            total += np.diff(edge)
            masks = self.masks(names)
            for k in range(len(self.languages)):
                bit = (masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
                hits[:, k] += np.diff(np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])[edge])
        corrected = np.maximum(0, (hits - total[:, None] * self.false_rate) / np.maximum(1e-9, 1 - self.false_rate))
        mass = corrected.sum(axis=1)
        best = np.where(mass > 0, corrected.argmax(axis=1), self.prior)
        score = np.where(mass > 0, corrected[np.arange(n), best] / np.maximum(mass, 1e-9), 1 / len(self.languages))
        letter = total > 0
        return [self.languages[b] if x else UNKNOWN for b, x in zip(best, letter)], np.where(letter, score, 0.0)


def _rows_of(names: np.ndarray, size: int, hashes: int) -> list[np.ndarray]:
    shift = size.bit_length() - 1
    return [((names >> np.uint64(k * shift)) & np.uint64(size - 1)).astype(np.int64) for k in range(hashes)]


def learn_filters(
    docs: DataFrame,
    docs_per_language: int = 4000,
    grams_per_language: int = 20_000,
    typical: float = 0.5,
    rows: int = 1 << 18,
    hashes: int = 3,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
) -> Filters | None:
    """Filters from rows with a text and a language; None if there is no such row.

    Learns from whole texts of about ``docs_per_language`` rows of each language. An n-gram
    is typical of a language if its share there is at least ``1 / grams_per_language`` (so
    at most that many are) and at least ``typical`` times its largest share in any.
    """
    known = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sample = bounded_sample(known, "lang", "id", docs_per_language)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            names = np.array(batch.column("lang").to_pylist(), object)
            texts = np.array(batch.column("text").to_pylist(), object)
            for one in sorted(set(names)):
                codes, _ = text_codes(texts[names == one].tolist())
                for size in SIZES:
                    found, n = np.unique(grams(codes, size)[0], return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([one] * len(found), pa.string()), "gram": pa.array(found.view(np.int64)), "size": pa.array(np.full(len(found), size)), "n": pa.array(n)})

    counted = sample.select("text", "lang").mapInArrow(count, "lang string, gram long, size long, n long")
    scratch = Scratch(docs.sparkSession, "grams")
    counts = scratch.store(counted.groupBy("lang", "gram", "size").agg(F.sum("n").alias("n")), "counts")
    totals = {(r["lang"], r["size"]): r["total"] for r in counts.groupBy("lang", "size").agg(F.sum("n").alias("total")).collect()}
    if not totals:
        return None
    total = F.lit(None).cast("double")
    for (one, size), n in totals.items():
        total = F.when((F.col("lang") == one) & (F.col("size") == size), F.lit(float(n))).otherwise(total)
    shares = counts.select("gram", "lang", (F.col("n") / total).alias("share"))
    largest = shares.groupBy("gram").agg(F.max("share").alias("largest"), F.collect_list(F.struct("lang", "share")).alias("all"))
    chosen = largest.select("gram", "largest", F.inline("all")).where((F.col("share") >= typical * F.col("largest")) & (F.col("share") >= 1 / grams_per_language))
    languages = sorted({one for one, _ in totals})
    table = np.zeros((rows, -(-len(languages) // 64)), np.uint64)
    found = chosen.select("lang", "gram").toPandas()
    scratch.drop(counts)
    for k, one in enumerate(languages):
        names = found["gram"][found["lang"] == one].to_numpy(np.int64).view(np.uint64)
        for at in _rows_of(names, rows, hashes):
            table[at, k // 64] |= np.uint64(1 << k % 64)
    prior = max(languages, key=lambda one: (totals.get((one, SIZES[-1]), 0), one))
    return Filters(languages, table, hashes, languages.index(prior))


def identify(docs: DataFrame, filters: Filters | None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row of ``docs``, from its whole text alone.

    A null text, or one without a letter, is ``und`` with score 0, as is every text if
    nothing was learned. Equal counts: the language first by name. Texts none of whose
    n-grams is known get the language with most training text. Ids may be null or repeat;
    further columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        for batch in slices(batches, "text"):
            if filters is None:
                names, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                names, score = filters.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(score, pa.float64())})

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double").withColumnRenamed("id", doc_id)


def identify_held_out(docs: DataFrame, **settings) -> DataFrame:
    """Learns from the rows that are not held out and identifies all: adds ``held_out``."""
    filters = learn_filters(docs.where(~held_out("doc_id")), **settings)
    found = identify(docs, filters)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
