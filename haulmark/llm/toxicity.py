"""Toxic spans by a linear-chain conditional random field.

Two states, clean and toxic. A token's features are its word and the word's first letters,
as far as they tell toxic documents from clean ones; every other token is background. The
field learns from tokens that are marked by document labels: in a toxic document, the
tokens with a feature that hardly occurs in clean ones. Forward-backward marginals of a
whole text give its offending spans, and together the score of the document.

Background tokens share one transfer matrix, so stretches of them are crossed in one step by
the matrix's power. This is exact, and the cost follows the few other tokens.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.folds import bounded_sample, held_out
from haulmark.llm.words import slices

PREFIXES = (4, 5, 6, 7)
CHUNK = 32
REMEMBERED = 1_000_000
_TOKEN = re.compile(r"\S+")
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def features(token: str) -> list[str]:
    """The word without what stands around it, and its beginnings."""
    word = _EDGE.sub("", token.lower())
    if not word:
        return []
    return [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) > k)]


@dataclass
class Field:
    weights: dict[str, float]  # of a feature, for the toxic state
    bias: float
    moves: np.ndarray  # log weight of going from a state to a state
    start: float  # log weight of beginning toxic
    document: tuple[float, float, float]  # odds of the document from those of its tokens

    def __post_init__(self):
        self._known: dict[str, float | None] = {}
        step = np.exp(self.moves + np.array([0.0, self.bias]))
        values, right = np.linalg.eig(step)
        order = np.argsort(-values.real)
        values, right = values.real[order], right.real[:, order]
        left = np.linalg.inv(right)
        self._steady = np.outer(right[:, 0], left[0])
        self._fading = np.outer(right[:, 1], left[1])
        self._ratio = float(values[1] / values[0])

    def weight(self, token: str) -> float:
        """Weight of a token for the toxic state; NaN for background."""
        known = self._known.get(token)
        if known is None:
            found = [self.weights[f] for f in features(token) if f in self.weights]
            known = sum(found) + self.bias if found else np.nan
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[token] = known
        return known

    def _cross(self, n: int) -> np.ndarray:
        return self._steady + self._ratio**n * self._fading if n else np.eye(2)

    def marginals(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens that are not background, and the probability that each is toxic."""
        weights = np.fromiter(map(self.weight, tokens), float, len(tokens))
        at = np.flatnonzero(~np.isnan(weights))
        if not len(at):
            return at, np.zeros(0)
        moves = np.exp(self.moves)
        emits = np.exp(np.stack([np.zeros(len(at)), np.minimum(weights[at], 50.0)], 1))
        # Between two of these tokens: n background steps, then the step into the token.
        into = []
        before = -1
        for place in at.tolist():
            gap = place - before - 1
            if before < 0:
                state = np.array([1.0, np.exp(self.start + (self.bias if gap else 0.0))])
                into.append(state @ self._cross(gap - 1) @ moves if gap else state)
            else:
                into.append(self._cross(gap) @ moves)
            before = place
        forward = np.empty((len(at), 2))
        for k, emit in enumerate(emits):
            state = (into[k] if k == 0 else forward[k - 1] @ into[k]) * emit
            forward[k] = state / state.sum()
        backward = np.empty((len(at), 2))
        state = self._cross(len(tokens) - before - 1) @ np.ones(2)
        backward[-1] = state / state.sum()
        for k in range(len(at) - 1, 0, -1):
            state = into[k] @ (emits[k] * backward[k])
            backward[k - 1] = state / state.sum()
        both = forward * backward
        return at, both[:, 1] / both.sum(axis=1)

    def score(self, text: str | None) -> tuple[float, list[str]]:
        """Of a whole text: its probability to be toxic and its offending ``start:end`` spans."""
        text = text or ""
        tokens = text.split()
        at, chance = self.marginals(tokens)
        a, b, c = self.document
        score = float(1 / (1 + np.exp(-np.clip(a * _any_odds(chance) + b * np.log1p(len(tokens)) + c, -30, 30))))
        bad = set(at[chance >= 0.5].tolist())
        spans: list[list[int]] = []
        if bad:
            last = max(bad)
            for k, found in enumerate(_TOKEN.finditer(text)):
                if k in bad:
                    if spans and k - 1 in bad:
                        spans[-1][1] = found.end()
                    else:
                        spans.append([found.start(), found.end()])
                if k == last:
                    break
        return score, [f"{x}:{y}" for x, y in spans]


def _any_odds(chance: np.ndarray) -> float:
    """Log odds that any token is toxic, within -10 and 10."""
    none = float(np.log1p(-np.minimum(chance, 1 - 1e-9)).sum())
    return float(np.clip(np.log(max(-np.expm1(none), 1e-9)) - none, -10, 10))


def learn_field(
    docs: DataFrame,
    labels: DataFrame,
    docs_per_label: int = 4000,
    least: int = 5,
    text: str = "text",
    label: str = "toxic",
    doc_id: str = "doc_id",
) -> Field:
    """A field from whole texts of about ``docs_per_label`` documents of each label.

    Rows without id, text or label are left out; of several labels of an id the largest
    counts. Without documents of both labels the field knows no word and scores about the
    share of label 1 (0.25 without any document).
    """
    marked = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    marked = marked.groupBy("id").agg(F.max("y").alias("y"))
    sample = F.broadcast(bounded_sample(marked, "y", "id", docs_per_label))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text IS NOT NULL").join(sample, "id").select("text", "y")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found: tuple[Counter, Counter] = (Counter(), Counter())
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                found[y > 0].update({f for t in set(text.split()) for f in features(t)})
                found[y > 0][""] += 1
            keys = list({**found[0], **found[1]})
            yield pa.RecordBatch.from_pydict({"f": pa.array(keys, pa.string()), "clean": pa.array([found[0][k] for k in keys], pa.int64()), "bad": pa.array([found[1][k] for k in keys], pa.int64())})

    counts = rows.mapInArrow(count, "f string, clean long, bad long").groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    found = {r["f"]: (r["clean"], r["bad"]) for r in counts.where((F.col("bad") >= least) | (F.col("f") == "")).collect()}
    clean, bad = found.pop("", (0, 0))
    plain = Field({}, -8.0, np.array([[0.0, -2.0], [0.0, 0.0]]), -2.0, (0.0, 0.0, float(np.log((bad + 0.5) / (clean + 1.5)))))
    if not clean or not bad:
        return plain
    # How much more often a feature occurs in a toxic document than in a clean one.
    ratio = {f: (b / bad) / ((c + 0.5) / clean) for f, (c, b) in found.items()}
    telling = {f for f, r in ratio.items() if r >= 12}
    known = sorted(f for f, r in ratio.items() if r >= 3)
    if not known:
        return plain
    number = {f: k for k, f in enumerate(known)}

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            doc, size, place, feature, mark = [], [], [], [], []
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                tokens = text.split()
                for begin in range(0, len(tokens), CHUNK):
                    part = tokens[begin : begin + CHUNK]
                    row = [(k, number[f], int(y > 0 and f in telling)) for k, t in enumerate(part) for f in features(t) if f in number]
                    doc.append(int(y > 0))
                    size.append(len(part))
                    place.append([x[0] for x in row])
                    feature.append([x[1] for x in row])
                    mark.append([x[2] for x in row])
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_pydict({"y": pa.array(doc, pa.int32()), "size": pa.array(size, pa.int32()), "place": pa.array(place, ints), "feature": pa.array(feature, ints), "mark": pa.array(mark, ints)})

    cut = rows.mapInArrow(chunks, "y int, size int, place array<int>, feature array<int>, mark array<int>")
    # Chunks that look the same to the field are one with a weight.
    cut = cut.groupBy("size", "place", "feature", "mark").agg(F.count("*").alias("n"))
    field = _fit(cut.toPandas(), known)

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            odds, size = [], []
            for text in batch.column("text").to_pylist():
                tokens = text.split()
                odds.append(_any_odds(field.marginals(tokens)[1]))
                size.append(float(np.log1p(len(tokens))))
            yield pa.RecordBatch.from_pydict({"odds": pa.array(odds, pa.float64()), "size": pa.array(size, pa.float64()), "y": batch.column("y")})

    seen = rows.mapInArrow(tokens_of, "odds double, size double, y int").toPandas()
    field.document = _logistic(seen[["odds", "size"]].to_numpy(), (seen["y"] > 0).to_numpy(float))
    return field


def _fit(chunks, known: list[str], rounds: int = 150, decay: float = 1e-3) -> Field:
    """Maximises the conditional likelihood of the marked chunks by Adam, all at once."""
    n = len(chunks)
    size = chunks["size"].to_numpy()
    weight = chunks["n"].to_numpy(float)
    weight /= weight.sum()
    row = np.repeat(np.arange(n), [len(x) for x in chunks["place"]])
    place = np.concatenate([*chunks["place"], []]).astype(int)
    feature = np.concatenate([*chunks["feature"], []]).astype(int)
    toxic = np.zeros((n, CHUNK), bool)
    marked = np.concatenate([*chunks["mark"], []]).astype(bool)
    toxic[row[marked], place[marked]] = True
    inside = np.arange(CHUNK) < size[:, None]
    state = toxic.astype(int)
    pairs = inside[:, 1:]
    seen_moves = np.zeros((2, 2))
    for i in (0, 1):
        for j in (0, 1):
            seen_moves[i, j] = (((state[:, :-1] == i) & (state[:, 1:] == j) & pairs).sum(1) * weight).sum()
    spot = row * CHUNK + place
    each = weight[row]
    values = np.zeros(len(known) + 6)  # features, bias, moves, start
    values[len(known)] = -2.0
    m, v = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, rounds + 1):
        emit = np.bincount(spot, values[feature], n * CHUNK).reshape(n, CHUNK) + values[len(known)]
        moves = values[len(known) + 1 : len(known) + 5].reshape(2, 2)
        chance, pair = _forward_backward(emit, np.exp(moves), values[-1], inside)
        gap = (toxic - chance) * inside
        slope = np.empty_like(values)
        slope[: len(known)] = np.bincount(feature, gap.ravel()[spot] * each, len(known))
        slope[len(known)] = (gap.sum(1) * weight).sum()
        slope[len(known) + 1 : len(known) + 5] = (seen_moves - np.tensordot(weight, pair, 1)).ravel()
        slope[-1] = (gap[:, 0] * weight).sum()
        slope -= decay * weight.min() * values + 1e-6 * values
        m = 0.9 * m + 0.1 * slope
        v = 0.99 * v + 0.01 * slope**2
        values += 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Field(dict(zip(known, values.tolist())), float(values[len(known)]), values[len(known) + 1 : len(known) + 5].reshape(2, 2).copy(), float(values[-1]), (1.0, 0.0, 0.0))


def _forward_backward(emit: np.ndarray, moves: np.ndarray, start: float, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of the toxic state at each place, and expected moves of each chunk."""
    n, size = emit.shape
    factor = np.stack([np.ones_like(emit), np.exp(np.clip(emit, -50, 50))], 2)
    forward, backward = np.empty((n, size, 2)), np.ones((n, size, 2))
    now = factor[:, 0] * np.array([1.0, np.exp(np.clip(start, -50, 50))])
    forward[:, 0] = now / now.sum(1, keepdims=True)
    for k in range(1, size):
        now = (forward[:, k - 1] @ moves) * factor[:, k]
        now /= now.sum(1, keepdims=True)
        forward[:, k] = np.where(inside[:, k, None], now, forward[:, k - 1])
    pair = np.zeros((n, 2, 2))
    for k in range(size - 1, 0, -1):
        after = factor[:, k] * backward[:, k]
        both = forward[:, k - 1, :, None] * moves * after[:, None, :]
        both /= both.sum((1, 2), keepdims=True)
        pair += both * inside[:, k, None, None]
        now = after @ moves.T
        backward[:, k - 1] = np.where(inside[:, k, None], now / now.sum(1, keepdims=True), backward[:, k - 1])
    both = forward * backward
    return both[..., 1] / both.sum(2), pair


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float, float]:
    """Weights of two columns and a constant, by Newton steps with a little shrinkage."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 0.1 * w
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3), slope)
    return tuple(w.tolist())


def score_toxicity(docs: DataFrame, field: Field, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, score, spans`` of every row, from its whole text alone, without a shuffle.

    ``score`` lies between 0 and 1; ``spans`` are the offending ``start:end`` places in code
    points, joined tokens together. A null text counts as empty and is scored as such. Ids may
    be null or repeat; further columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in slices(batches, "text"):
            found = [field.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "score": pa.array([s for s, _ in found], pa.float64()), "spans": pa.array([s for _, s in found], pa.list_(pa.string()))})

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double, spans array<string>").withColumnRenamed("id", doc_id)


def score_column(docs: DataFrame, field: Field, text: str = "text") -> Column:
    """The score of each row of ``docs`` as a column, to filter rows with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shared.value.score(t)[0] for t in batch], dtype=float)

    return score(F.col(text))


def learn_from_folds(docs: DataFrame, labels: DataFrame, **settings) -> Field:
    """Learns from labels of rows that are not held out."""
    return learn_field(docs, labels.where(~held_out("doc_id")), **settings)
