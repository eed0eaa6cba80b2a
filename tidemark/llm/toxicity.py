"""Toxicity of whole texts, scored after obfuscated words are restored.

Three passes over the documents: one counts the character language model over all of them, one
takes the labelled sample, one restores and scores every text. The sample is at most ``SAMPLE``
labelled rows, those of least hash of doc_id, whatever the corpus; it is small enough to broadcast.
Of rows that share a doc_id one text is in the sample.

Signals are words, and openings of words of ``OPENINGS`` letters, that stand in significantly more
toxic documents of the sample than in others; the ``SIGNALS`` strongest are kept. A document's
score is a logistic function of how many different signal words it holds, how strong they are and
how many words it has. Only the text is looked at: not labels, language, source or doc_id.

A null or empty text has no words and scores like any text without signals. Null labels are none;
a document with several labels counts as toxic if one says so. A null doc_id counts as the empty
text in the fold rule. Repeated rows are scored each. A very long text is restored and scored whole;
its length enters the score. Signals of equal strength are taken in byte order. Without labels of both kinds the score is the
share of toxic labels, or 0. No documents give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import released, slices, texts
from tidemark.llm.charmodel import (
    Restorer,
    costs,
    count_letters,
    folded_words,
    may_be_obfuscated,
)
from tidemark.sources.shared import save_shared

FOLDS = 5  # the fold with remainder 0 is held out
SAMPLE = 30_000
SIGNALS = 5_000
OPENINGS = (4, 5, 6)
LEAST_DOCUMENTS = 3
LEAST_Z = 4.0
_REMEMBERED = 40_000


@dataclass(frozen=True)
class Model:
    letters: np.ndarray  # cost of each symbol after each context
    signals: dict[bytes, float]
    weights: np.ndarray


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % FOLDS == 0


# --- restored texts ---


def restored(column: pa.Array, restorer: Restorer) -> Iterator[tuple[bytes, int]]:
    """Every text with its obfuscated words restored, and how many there were."""
    data, offsets = texts(column)
    for first, last in slices(offsets):
        inner = offsets[first : last + 1]
        part = data[inner[0] : inner[-1]]
        flags = may_be_obfuscated(part, inner - inner[0])
        raw, bounds = part.tobytes(), (inner - inner[0]).tolist()
        for i in range(last - first):
            text = raw[bounds[i] : bounds[i + 1]]
            if flags[i]:
                changed, n = restorer.text(text.decode())
                yield changed.encode(), n
            else:
                yield text, 0


def _features(word: bytes) -> list[bytes]:
    return [word, *(b"^" + word[:n] for n in OPENINGS if len(word) > n)]


# --- learning ---


def _count_features(
    letters: np.ndarray,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(letters)
        for batch in batches:
            counts = (Counter(), Counter())
            for (text, _), toxic in zip(
                restored(batch.column("text"), restorer), batch.column("toxic").to_pylist()
            ):
                counts[toxic].update({f for w in set(folded_words(text)) for f in _features(w)})
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array(names, pa.binary()),
                    "clean": pa.array([counts[0][f] for f in names], pa.int64()),
                    "toxic": pa.array([counts[1][f] for f in names], pa.int64()),
                }
            )

    return count


def _signals(sample: DataFrame, letters: np.ndarray, n_clean: int, n_toxic: int) -> dict:
    rows = sample.select("text", "toxic").mapInArrow(
        _count_features(letters), "feature binary, clean long, toxic long"
    )
    counted = rows.groupBy("feature").agg(F.sum("clean").alias("a"), F.sum("toxic").alias("b"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    strength = F.log(b / (n_toxic + 1.0)) - F.log(a / (n_clean + 1.0))
    z = strength / F.sqrt(1.0 / a + 1.0 / b)
    best = (
        counted.filter(F.col("b") >= LEAST_DOCUMENTS)
        .select("feature", strength.alias("strength"), z.alias("z"))
        .filter(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "feature")
        .limit(SIGNALS)
    )
    return {bytes(row["feature"]): row["strength"] for row in best.collect()}


class _Evidence(dict):
    """The strength of a word's strongest signal, 0 where it has none; remembers words."""

    def __init__(self, signals: dict[bytes, float]):
        super().__init__()
        self._signals = signals

    def __missing__(self, word: bytes) -> float:
        if len(self) >= _REMEMBERED:
            self.clear()
        found = self[word] = max(self._signals.get(f, 0.0) for f in _features(word))
        return found


INPUTS = 4


def _inputs(text: bytes, evidence: _Evidence) -> list[float]:
    words = folded_words(text)
    found = [strength for word in set(words) if (strength := evidence[word]) > 0]
    total = sum(found)
    return [1.0, math.log1p(total), max(found, default=0.0), total / math.log(len(words) + 8.0)]


def _input_rows(
    letters: np.ndarray, signals: dict
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, evidence = Restorer(letters), _Evidence(signals)
        for batch in batches:
            found = [_inputs(t, evidence) for t, _ in restored(batch.column("text"), restorer)]
            yield pa.RecordBatch.from_pydict(
                {
                    "toxic": batch.column("toxic"),
                    "inputs": pa.array(found, pa.list_(pa.float64())),
                }
            )

    return rows


def fit_weights(inputs: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method, with a ridge on all weights."""
    weights = np.zeros(inputs.shape[1])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (labels - chance) - ridge * weights
        curve = (inputs.T * (chance * (1 - chance))) @ inputs + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights += step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return weights


def training_sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic`` of at most ``SAMPLE`` labelled documents outside the held-out fold."""
    usable = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (
        usable.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE)
    )
    texts = documents.select(F.col("doc_id").cast("long"), "text")
    joined = texts.join(F.broadcast(chosen), "doc_id")
    # Of rows that share a doc_id one text stands for all, so the bound holds for rows as well.
    one = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text")))
    return joined.groupBy("doc_id").agg(one.alias("text"), F.first("toxic").alias("toxic")).drop(
        "doc_id"
    )


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    letters = costs(count_letters(documents))
    sample = save_shared(training_sample(documents, labels), "labelled")
    sizes = {row["toxic"]: row["n"] for row in
             sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        share = n_toxic / max(n_clean + n_toxic, 1)
        constant = math.log((share + 1e-6) / (1 - share + 1e-6))
        return Model(letters, {}, np.array([constant] + [0.0] * (INPUTS - 1)))
    signals = _signals(sample, letters, n_clean, n_toxic)
    rows = sample.mapInArrow(_input_rows(letters, signals), "toxic int, inputs array<double>")
    table = rows.toArrow()
    inputs = np.array(table.column("inputs").to_pylist())
    return Model(letters, signals, fit_weights(inputs, table.column("toxic").to_numpy()))


# --- scoring ---


def _scores(batch: pa.RecordBatch, model: Model, restorer: Restorer, evidence: _Evidence):
    counts, inputs = [], []
    for text, n in restored(batch.column("text"), restorer):
        counts.append(n)
        inputs.append(_inputs(text, evidence))
    margin = np.clip(np.array(inputs).reshape(-1, INPUTS) @ model.weights, -30, 30)
    return 1 / (1 + np.exp(-margin)), counts


def _score(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, evidence = Restorer(model.letters), _Evidence(model.signals)
        for batch in batches:
            chance, counts = _scores(batch, model, restorer, evidence)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "score": pa.array(chance, pa.float64()),
                    "predicted": pa.array((chance >= 0.5).astype(np.int32)),
                    "n_restored": pa.array(counts, pa.int64()),
                }
            )

    return score


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_restored`` of every row."""
    columns = documents.select(
        F.col("doc_id").cast("long"), "text", held_out(F.col("doc_id")).alias("held_out")
    )
    return columns.mapInArrow(
        _score(model),
        "doc_id long, held_out boolean, score double, predicted int, n_restored long",
    )


def _keep_clean(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, evidence = Restorer(model.letters), _Evidence(model.signals)
        for batch in released(batches):
            chance, _ = _scores(batch, model, restorer, evidence)
            yield batch.filter(pa.array(chance < 0.5))

    return keep


def reject_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    return documents.mapInArrow(_keep_clean(model), documents.schema)
