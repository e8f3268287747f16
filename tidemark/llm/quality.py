"""Quality classifier: a support vector machine on naive Bayes features.

Features are indicators of n-grams: byte trigrams (hashed), 4-grams of byte classes, and runs
of a word that repeats itself.  Each is scaled by the log ratio of its (smoothed) counts in
the two classes, vectors have unit length, and a linear model with hinge loss is fitted by
dual coordinate descent.  Margins become scores by a logistic curve, fitted on rows that
the descent did not see and weighted by the share of the classes among all training labels.

The fit takes at most ``per_class`` labelled documents of each class, chosen by hash of the
id, as a list of feature numbers each, ``fit_bytes`` of lists at most; the model has a fixed
size.  Everything is scored by a
scan, whole texts, without a shuffle.

Defined cases: null and empty texts have no n-gram and get the model's score for that.
Labels other than 0 and 1 or without an id are ignored; of several labels of one id the
smallest counts.  Without training documents of both classes, all scores are the share of
label 1 among those there are, counting one more of each.  Extra columns are kept by
:func:`scored` and never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh, map_columns, query, read, utf8, written

GRAM_BITS = 18
GRAMS, SHAPES, RUNS = 1 << GRAM_BITS, 1 << 16, 4
SLAB = 1 << 20
FIT_BYTES = 1 << 28
ACCEPT = 0.7
BLEND = 0.25  # weight of the fitted model against its mean magnitude


def _byte_classes() -> np.ndarray:
    """16 classes: letters, digits, white space, and punctuation by kind."""
    classes = np.full(256, 1, dtype=np.uint32)  # bytes of other scripts count as lower case
    groups = ["", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r\v\f", ".", ",;:", "!?",
              "'\"", "()[]{}<>", "|", "*#&%$", "@/\\", "-_", "+=~^`"]
    classes[:32] = 5
    for number, group in enumerate(groups):
        classes[list(group.encode())] = number
    classes[list(range(97, 123))] = 0
    return classes


CLASSES = _byte_classes()


class Features:
    """Turns texts into sorted lists of feature numbers."""

    size = GRAMS + SHAPES + RUNS

    def __init__(self) -> None:
        self.seen = np.zeros(self.size, dtype=bool)

    def __call__(self, text: bytes) -> np.ndarray:
        seen = self.seen
        for start in range(0, len(text), SLAB):
            values = np.frombuffer(text[start : start + SLAB + 3], dtype=np.uint8)
            b = values.astype(np.uint32)
            if len(b) >= 3:
                code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
                seen[(code * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BITS)] = True
            if len(b) >= 4:
                c = CLASSES[values]
                seen[GRAMS + ((c[:-3] << 12) | (c[1:-2] << 8) | (c[2:-1] << 4) | c[3:])] = True
        words = text.split()
        same = bytes(map(eq, words, words[1:]))
        for length in range(1, RUNS + 1):
            seen[GRAMS + SHAPES + length - 1] = b"\1" * length in same
        found = np.flatnonzero(seen)
        seen[found] = False
        return found.astype(np.int32)


@dataclass
class Model:
    ratio: np.ndarray  # log count ratio per feature
    weight: np.ndarray  # weight of the scaled feature times its ratio
    bias: float
    slope: float
    shift: float

    def margin(self, features: np.ndarray) -> float:
        norm = float(np.sqrt(np.square(self.ratio[features]).sum())) or 1.0
        return float(self.weight[features].sum()) / norm + self.bias

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(features) + self.shift, -500, 500))))


def constant(share: float) -> Model:
    nothing = np.zeros(Features.size, dtype=np.float32)
    return Model(nothing, nothing, 0.0, 0.0, float(np.log(share / (1 - share))))


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    counts = [
        np.bincount(np.concatenate([r for r, y in zip(rows, labels) if y == label]), minlength=Features.size)
        + smoothing
        for label in (1, 0)
    ]
    return (np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())).astype(np.float32)


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, cost: float, epochs: int
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise half their squared norm plus ``cost`` times the hinge
    losses; one dual variable moves at a time."""
    weight, bias = np.zeros(Features.size), 0.0
    alpha = np.zeros(len(rows))
    sign = np.where(labels == 1, 1.0, -1.0)
    square = np.array([np.square(v).sum() + 1.0 for v in values])
    order = np.random.default_rng(0)
    for _ in range(epochs):
        largest = 0.0
        for i in order.permutation(len(rows)):
            gradient = sign[i] * (weight[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            if step := new - alpha[i]:
                weight[rows[i]] += step * sign[i] * values[i]
                bias += step * sign[i]
                alpha[i] = new
                largest = max(largest, abs(step))
        if largest < 1e-3 * cost:
            break
    return weight, bias


def calibrate(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton steps on smoothed targets."""
    ones = max(1, int((labels == 1).sum())), max(1, int((labels == 0).sum()))
    target = np.where(labels == 1, (ones[0] + 1) / (ones[0] + 2), 1 / (ones[1] + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        pull = 1e-3 * (beta - [1.0, 0.0])
        gradient = x.T @ (weights * (p - target)) + pull
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray, share: float, cost: float = 4.0, epochs: int = 20) -> Model:
    """A model from feature lists; ``share`` is the share of label 1 the scores should assume.
    Every fourth row calibrates."""
    held = np.arange(len(rows)) % 4 == 3
    train = [r for r, h in zip(rows, held) if not h]
    if len(set(labels[~held])) < 2:
        return constant(share)
    ratio = log_count_ratio(train, labels[~held])
    norms = [float(np.sqrt(np.square(ratio[r]).sum())) or 1.0 for r in train]
    weight, bias = dual_coordinate_descent(
        train, [ratio[r] / n for r, n in zip(train, norms)], labels[~held], cost, epochs
    )
    weight = (1 - BLEND) * np.abs(weight).mean() + BLEND * weight
    model = Model(ratio, (weight * ratio).astype(np.float32), BLEND * bias, 1.0, 0.0)
    part = held if len(set(labels[held])) == 2 else ~held
    margins = np.array([model.margin(r) for r, h in zip(rows, part) if h])
    ones = labels[part].mean()
    model.slope, model.shift = calibrate(
        margins, labels[part], np.where(labels[part] == 1, share / ones, (1 - share) / (1 - ones))
    )
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels may not be learned from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 4000, fit_bytes: int = FIT_BYTES) -> Model:
    """Fit on at most ``per_class`` documents of each class, from the labels that may be
    learned from, and as many of them as have lists of ``fit_bytes`` together."""
    known = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    counts = {row["quality"]: row["n"] for row in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    chosen = [
        known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        for label in (0, 1)
    ]
    chosen = chosen[0].union(chosen[1]).withColumnsRenamed({"doc_id": "_id", "quality": "_quality"})
    # At most 2 * per_class ids of 12 bytes.
    docs = docs.select("doc_id", "text")
    texts = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["_id"]).select("_id", "_quality", "text")

    def listed(ids, quality, texts):
        features = Features()
        yield [ids, quality, [features(text).tobytes() for text in utf8(texts)]]

    found = map_columns(
        texts, listed, "id long, quality int, features binary",
        F.col("_id").cast("long"), F.col("_quality").cast("int"), F.col("text"),
    )
    order = [F.xxhash64("id"), "id", "features"]
    found = written(found.orderBy(*order).limit(2 * per_class))
    # Sizes first, a number per row: the lists that reach the driver are bounded in bytes.
    sizes = [row["n"] for row in found.orderBy(*order).select(F.octet_length("features").alias("n")).collect()]
    fitting = int(np.searchsorted(np.cumsum(sizes), fit_bytes, side="right"))
    rows = found.orderBy(*order).limit(fitting).collect()
    lists = [np.frombuffer(row["features"], dtype=np.int32) for row in rows]
    classes = np.array([row["quality"] for row in rows], dtype=int)
    if len(set(classes.tolist())) < 2:
        return constant(share)
    return fit(lists, classes, share)


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with one more column, ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, features = shared.value, Features()
        for batch in batches:
            scores = [model.score(features(text)) for text in utf8(batch.column(place))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, type=pa.float64())], [*batch.schema.names, name]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def quality_filter(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """The documents whose score is at least ``accept``."""
    score = fresh(docs, "score")
    return scored(docs, train(docs, labels), score).where(F.col(score) >= accept).select(*docs.columns)


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, train(docs, read(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
