"""Quality scores by regularised quadratic discriminant analysis over document statistics.

A text becomes some transformed statistics (logs and square roots of shares, so that classes are roughly
bell-shaped). Each class has a mean and a covariance, shrunk towards a scaled identity by the OAS estimate
(Chen et al., 2010). A text's score is the difference of the classes' log densities, from Mahalanobis
distances through Cholesky factors that are computed once and sent with the job, then calibrated to a
probability by a logistic curve over the training rows' differences.

Training needs the classes' counts, sums and products, which Spark adds up over all training rows: no
sample. What reaches the driver is bounded by the number of statistics and of calibration bins.

Defined results: a null text counts as empty; an empty text has the statistics of no words; repeated rows
give repeated rows; of several labels of a document the smallest counts, null labels and null ids teach
nothing; a class without two training rows gives every text the share of label 1 (one half without
labels); an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rhythmica.llm.common import schema_of, slices, text_of
from rhythmica.session import settled

STATISTICS = (
    "log_words", "log_word_length", "upper", "digit", "blank", "stop_marks", "marks", "symbols", "bars", "shouts",
    "outside_ascii", "distinct_words", "repeated_neighbours", "distinct_lines", "words_per_line", "spread", "capitals", "long_words",
)
#: Width and half-range of the calibration bins over log-density differences.
BIN, RANGE = 0.25, 100.0

_CLASS = np.full(256, -1)
for _i, _set in enumerate((range(65, 91), range(48, 58), b" \t\n\r\x0b\x0c", b".,;:", b"'\"()-?", b"#$%&*@^~`+=<>\\_/{}[]", b"|", b"!", range(128, 256))):
    _CLASS[list(_set)] = _i


def statistics(text: bytes) -> list[float]:
    size = max(1, len(text))
    letters = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(_CLASS + 1, letters, 10)[1:] / size
    words, lines = text.split(), text.split(b"\n")
    n = max(1, len(words))
    long = sum(len(w) > 14 for w in words)
    repeated = sum(map(bytes.__eq__, words, words[1:]))
    used = letters[letters > 0] / size
    share = np.sqrt(kinds)
    return [
        math.log1p(len(words)), math.log1p(len(text) / n), *share, math.sqrt(len(set(words)) / n), math.sqrt(repeated / n),
        math.sqrt(len(set(lines)) / len(lines)), math.log1p(n / len(lines)), float(-(used * np.log(used)).sum()) if len(used) else 0.0,
        math.sqrt(sum(w[:1].isupper() for w in words) / n), math.sqrt(long / n),
    ]


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", others: Sequence[str] = ()) -> DataFrame:
    rows = text_of(docs, id_col, text_col, others)
    along = ["text", "others"] if others else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            found = pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column(0), found, *map(part.column, along)], ["doc_id", "x", *along])

    return rows.mapInArrow(run, ", ".join([schema_of(rows, ["doc_id"]), "x array<double>", *([schema_of(rows, along)] if along else [])]))


def label_of(labels: DataFrame, column: str, id_col: str = "doc_id") -> DataFrame:
    """One row per labelled document."""
    rows = labels.select(F.col(id_col).alias("doc_id"), F.col(column).cast("int").alias("label"))
    return rows.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"))


@dataclass
class Discriminant:
    means: list[np.ndarray]
    inverse_factors: list[np.ndarray]  # of the Cholesky factors
    log_scales: list[float]  # log determinants of the factors
    prior: float
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, with the prior."""
        part = [-0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) - s for m, f, s in zip(self.means, self.inverse_factors, self.log_scales, strict=True)]
        return part[1] - part[0] + self.prior

    def chance(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * np.clip(self.difference(x), -RANGE, RANGE) + self.offset, -700, 700)
        return 1 / (1 + np.exp(-z))


def shrunk(covariance: np.ndarray, n: float) -> np.ndarray:
    """OAS: towards the identity times the mean variance."""
    p = len(covariance)
    square, trace = float((covariance**2).sum()), float(np.trace(covariance))
    below = (n + 1 - 2 / p) * (square - trace**2 / p)
    weight = 1.0 if below <= 0 else min(1.0, ((1 - 2 / p) * square + trace**2) / below)
    return (1 - weight) * covariance + (weight * trace / p + 1e-6) * np.eye(p)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.array(batch.column("x").to_pylist())
        x = np.hstack([np.ones((len(x), 1)), x])
        label = batch.column("label").to_numpy(zero_copy_only=False)
        for c in (0, 1):
            part = x[label == c]
            total[c] = total.get(c, 0) + part.T @ part
    for c, m in total.items():
        place = np.arange(m.size)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, c)), pa.array(place), pa.array(m.ravel())], ["label", "place", "value"])


def fit(rows: DataFrame) -> Discriminant | float:
    """From rows (x, label 0 or 1). The share of label 1 where a class has fewer than two rows."""
    p = len(STATISTICS)
    sums = np.zeros((2, (p + 1) ** 2))
    for r in rows.mapInArrow(_sums, "label bigint, place bigint, value double").groupBy("label", "place").agg(F.sum("value").alias("value")).collect():
        sums[r.label, r.place] = r.value
    products = sums.reshape(2, p + 1, p + 1)
    n = products[:, 0, 0]
    if n.min() < 2:
        return float((n[1] + 1) / (n.sum() + 2))
    means = [m[0, 1:] / m[0, 0] for m in products]
    within = [m[1:, 1:] / m[0, 0] - np.outer(mu, mu) for m, mu in zip(products, means, strict=True)]
    scale = np.sqrt(np.maximum(1e-8, np.diag(sum(k * c for k, c in zip(n, within, strict=True)) / n.sum())))
    factors = [np.linalg.cholesky(shrunk(c / np.outer(scale, scale), k)) for c, k in zip(within, n, strict=True)]
    model = Discriminant(means, [np.linalg.inv(f) / scale for f in factors], [float(np.log(np.diag(f)).sum()) for f in factors], math.log(n[1] / n[0]))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = np.clip(model.difference(np.array(batch.column("x").to_pylist())), -RANGE, RANGE)
                yield pa.RecordBatch.from_arrays([pa.array(np.rint(d / BIN).astype(np.int64)), batch.column("label").cast(pa.int64())], ["bin", "label"])

    bins = rows.mapInArrow(binned, "bin bigint, label bigint").groupBy("bin", "label").count().collect()
    d, y, w = (np.array(x, float) for x in zip(*((r.bin * BIN, r.label, r["count"]) for r in bins), strict=True))
    # Platt's targets, Newton steps with a small ridge
    y = np.where(y == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    beta, design = np.array([0.0, 0.0]), np.stack([d, np.ones_like(d)], 1)
    for _ in range(50):
        z = np.clip(design @ beta, -30, 30)
        q = 1 / (1 + np.exp(-z))
        step = np.linalg.solve((design.T * (w * q * (1 - q))) @ design + 1e-6 * np.eye(2), design.T @ (w * (y - q)))
        beta = beta + np.clip(step, -1, 1)
    model.slope, model.offset = max(1e-3, float(beta[0])), float(beta[1])
    return model


def score(docs: DataFrame, labels: DataFrame, learn: Column | None = None, column: str = "quality", threshold: float = 0.7, others: Sequence[str] = ()) -> DataFrame:
    """Per row: doc_id, score, predicted (1 from ``threshold`` on), fitted (whether both classes were learned).
    ``learn``: which doc_ids may teach; ``others``: columns that come along, in a struct, with the text."""
    rows = settled(with_statistics(docs, others=others), "statistics")
    along = ["text", "others"] if others else []
    taught = label_of(labels, column)
    taught = taught if learn is None else taught.where(learn)
    training = settled(rows.join(taught, "doc_id").where("label IN (0, 1)").select("x", "label"), "training")
    model = fit(training)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column("x").to_pylist())
            chance = np.full(len(x), model) if isinstance(model, float) else model.chance(x)
            results = [batch.column("doc_id"), pa.array(chance), pa.array((chance >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*results, *map(batch.column, along)], ["doc_id", "score", "predicted", *along])

    scored = rows.mapInArrow(run, ", ".join([schema_of(rows, ["doc_id"]), "score double, predicted int", *([schema_of(rows, along)] if along else [])]))
    return scored.withColumn("fitted", F.lit(not isinstance(model, float)))
