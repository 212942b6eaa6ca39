"""Quality by a byte-level convolutional network in numpy.

A text's bytes are embedded and cut into overlapping chunks that cover all of it. Learnt filters run
over every chunk, each filter keeps its largest answer in the whole text, and a logistic
layer combines these into one probability. Its weights are not positive: a filter can only
find something that speaks against a text, so a short text is not marked down for what it lacks. Embedding and filter are linear, so a filter's answer to a chunk is a
sum of table entries, one per byte. In training only the chunk with the largest answer has a slope.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposcan.llm.labelled import fold, labelled_sample, shift_to

#: Most training texts of each class, and most bytes of each.
PER_CLASS = 1_500
MOST_BYTES = 20_000
WIDTH, STEP, FILTERS, EMBEDDED = 8, 4, 12, 8
ROUNDS, BATCH, RATE = 12, 32, 0.02
#: Chunks looked at together.
BLOCK = 1 << 15
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0


def chunks(text: bytes) -> np.ndarray:
    """Chunks of WIDTH bytes, one every STEP bytes, as rows; the end is filled with zero bytes."""
    size = WIDTH + max(0, -(-(len(text) - WIDTH) // STEP)) * STEP
    return np.lib.stride_tricks.sliding_window_view(np.frombuffer(text.ljust(size, b"\0"), np.uint8), WIDTH)[::STEP]


def pooled(tables: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Largest answer of every filter, and the chunk that gives it."""
    rows = chunks(text)
    best, where = np.full(tables.shape[2], -np.inf, np.float32), np.zeros((tables.shape[2], WIDTH), np.uint8)
    for at in range(0, len(rows), BLOCK):
        block = rows[at:at + BLOCK]
        answer = tables[0][block[:, 0]]
        for k in range(1, WIDTH):
            answer += tables[k][block[:, k]]
        top = answer.argmax(axis=0)
        value = answer[top, np.arange(len(top))]
        better = value > best
        best[better], where[better] = value[better], block[top[better]]
    return best, where


@dataclass
class QualityModel:
    tables: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    intercept: float

    def logit(self, text: bytes) -> float:
        best, _ = pooled(self.tables, text)
        return float(np.tanh(best + self.bias) @ self.weights + self.intercept)


def train_quality(sample: list[tuple[int, bytes]], seed: int = 5) -> QualityModel:
    """Adam on the log loss with equally weighted classes; every fifth text is kept for calibration.

    With one class only, the score is that class throughout.
    """
    made, kept = [s for k, s in enumerate(sample) if k % 5], [s for k, s in enumerate(sample) if k % 5 == 0]
    random = np.random.default_rng(seed)
    values = {
        "embed": random.normal(0, 0.5, (256, EMBEDDED)), "filters": random.normal(0, 0.4, (WIDTH, EMBEDDED, FILTERS)),
        "bias": np.full(FILTERS, -1.5), "weights": -np.abs(random.normal(0, 0.3, FILTERS)), "intercept": np.zeros(1),
    }

    def tables():
        return np.einsum("be,kef->kbf", values["embed"], values["filters"]).astype(np.float32)

    share = np.mean([y for y, _ in made]) if made else 1.0
    if share in (0.0, 1.0):
        return QualityModel(tables() * 0, np.zeros(FILTERS), np.zeros(FILTERS), 30.0 * (2 * share - 1))
    first, second, count = {k: 0 * v for k, v in values.items()}, {k: 0 * v for k, v in values.items()}, 0
    for round_ in range(ROUNDS):
        order = random.permutation(len(made))
        for at in range(0, len(order), BATCH):
            slope, table = {k: 0 * v for k, v in values.items()}, tables()
            for y, text in (made[k] for k in order[at:at + BATCH]):
                best, where = pooled(table, text)
                h = np.tanh(best + values["bias"])
                p = 1 / (1 + np.exp(-np.clip(h @ values["weights"] + values["intercept"][0], -30, 30)))
                d = (p - y) * (0.5 / share if y else 0.5 / (1 - share)) / BATCH
                slope["weights"] += d * h
                slope["intercept"] += d
                back = d * values["weights"] * (1 - h * h)
                slope["bias"] += back
                seen = values["embed"][where]  # filter, place in the chunk, embedding
                slope["filters"] += np.einsum("fke,f->kef", seen, back)
                np.add.at(slope["embed"], where, np.einsum("kef,f->fke", values["filters"], back))
            count += 1
            rate = RATE * (1 - round_ / ROUNDS)
            for k, g in slope.items():
                g = g + 1e-5 * values[k]
                first[k], second[k] = 0.9 * first[k] + 0.1 * g, 0.999 * second[k] + 0.001 * g * g
                values[k] = values[k] - rate * (first[k] / (1 - 0.9**count)) / (np.sqrt(second[k] / (1 - 0.999**count)) + 1e-8)
            values["weights"] = np.minimum(values["weights"], 0)
    model = QualityModel(tables(), values["bias"].astype(np.float32), values["weights"].astype(np.float32), float(values["intercept"][0]))
    if kept:
        model.intercept += shift_to(np.array([model.logit(t) for _, t in kept]), np.array([y for y, _ in kept]), THRESHOLD, 1)
    return model


def _scored(model: QualityModel):
    def run(batches):
        for batch in batches:
            logits = np.array([model.logit(t.as_py() or b"") for t in batch.column("text").cast(pa.binary())], float)
            scores = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    """Rows no label is learnt from; a null id counts as not held out."""
    return F.coalesce(fold(doc_id, FOLDS) == HELD_OUT, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs`` (doc_id, text).

    Null and empty texts are one chunk of zero bytes. Each row is scored by itself, so
    repeated rows and ids get a row each. Label rows with nulls teach nothing. Other columns are ignored.
    """
    sample = labelled_sample(docs, labels, "quality", held_out(F.col("doc_id")), PER_CLASS, MOST_BYTES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(_scored(train_quality(sample)), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
