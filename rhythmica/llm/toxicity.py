"""Toxicity by a chain of linear classifiers.

Features of a text: the distinct words (letters, lower-cased) and the heads of 4, 5 and 6 letters of longer
words, since abuse is inflected. Of all features of the training texts, counted by Spark, those that mark toxic texts best make a vocabulary of VOCABULARY at most (by the likelihood ratio
of their counts). A text is the set of vocabulary features it has.

Categories, in the order of the chain, each a 0/1 target of a labelled text:
``direct`` toxic and with a marking whole word, ``oblique`` toxic without one, ``repeated`` toxic with three
or more marking features, ``toxic`` the label itself. Each has an L2-penalised logistic model over the
features and the log odds of all earlier categories. Those log odds are out-of-fold while fitting: a text's
come from models that were not fitted on its fold. Scoring feeds the chain with the full models.

Vocabulary and models are fitted on at most SAMPLE labelled documents of each label (those with the smallest
id hashes); the models on the driver, from the texts' feature numbers. Scoring covers all rows.

Defined results: null and empty texts have no features, and get the models' offsets; repeated rows give
repeated rows; of several labels of a document the smallest counts; without texts of both labels every
probability is the share of toxic labels (0 without labels); an empty table gives an empty table; further
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rhythmica.llm.common import schema_of, slices, splitmix, text_of
from rhythmica.llm.quality import label_of
from rhythmica.session import settled

CATEGORIES = ("direct", "oblique", "repeated", "toxic")
VOCABULARY, SAMPLE, FOLDS = 1024, 20_000, 5
#: Toxic texts that a feature needs, and the odds from which a word marks.
SUPPORT, MARKS = 5, 8.0
HEADS = (4, 5, 6)
THRESHOLD = 0.5

_WORD = re.compile(r"[^\W\d_]+")


def features(text: bytes) -> set[str]:
    """Words as "=word", heads as "head-"."""
    words = set(_WORD.findall(text.decode().lower()))
    found = {"=" + w for w in words}
    for k in HEADS:
        found.update([w[:k] + "-" for w in words if len(w) > k])
    return found


def labelled_texts(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """The texts of SAMPLE documents of each label at most. Their ids are broadcast, so no text is shuffled."""
    known = settled(label_of(labels, column).where("label IN (0, 1)"), "labels")
    chosen = [known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for label in (0, 1)]
    return text_of(docs).join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").select("doc_id", "text", "label")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())

    def flush():
        names = list(counts[0].keys() | counts[1].keys())
        out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in counts)], ["feature", "clean", "toxic"])
        for c in counts:
            c.clear()
        return out

    for part, texts in slices(batches):
        for text, label in zip(texts, part.column("label").to_pylist(), strict=True):
            counts[label].update(features(text))
        if len(counts[0]) + len(counts[1]) > 300_000:
            yield flush()
    yield flush()


def vocabulary(texts: DataFrame) -> tuple[list[tuple[str, float]], tuple[int, int]]:
    """The features that mark toxic texts best, with their odds; and how many texts have each label."""
    sizes = {r.label: r["count"] for r in texts.groupBy("label").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    counts = texts.select("text", "label").mapInArrow(_counted, "feature string, clean bigint, toxic bigint")
    counts = counts.groupBy("feature").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t")).where(F.col("t") >= SUPPORT)
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    share = toxic / max(1.0, clean + toxic)  # what t and c would be if the feature told nothing
    expected_t, expected_c = (F.col("t") + F.col("c")) * share, (F.col("t") + F.col("c")) * (1 - share)
    ratio = F.col("t") * F.log(F.col("t") / expected_t) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / expected_c)).otherwise(0.0)
    best = counts.where(F.lit(clean > 0 and toxic > 0)).select("feature", odds.alias("odds"), F.round(ratio, 6).alias("g")).where("odds > 0 AND g > 2")
    rows = best.orderBy(F.desc("g"), "feature").limit(VOCABULARY).collect()
    return [(r.feature, float(r.odds)) for r in rows], (clean, toxic)


class Finder:
    """The vocabulary features of texts."""

    def __init__(self, names: list[str]):
        self.words = {x[1:]: i for i, x in enumerate(names) if x[0] == "="}
        self.heads = [(k, {x[:-1]: i for i, x in enumerate(names) if x[0] != "=" and len(x) == k + 1}) for k in HEADS]

    def __call__(self, text: bytes) -> list[int]:
        words = set(_WORD.findall(text.decode().lower()))
        found = [self.words[w] for w in words & self.words.keys()]
        for k, heads in self.heads:
            if heads:
                found += [heads[h] for h in {w[:k] for w in words if len(w) > k} & heads.keys()]
        return sorted(found)


class Sparse:
    """Texts by features, as flat index lists."""

    def __init__(self, rows: list[list[int]], width: int):
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.column = np.array([i for r in rows for i in r], np.int64)
        self.shape = (len(rows), width)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.shape[0])

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, r[self.row], self.shape[1])


def logit(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-4, 1 - 1e-4) / np.clip(1 - p, 1e-4, 1))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: Sparse, chain: np.ndarray, y: np.ndarray, use: np.ndarray, penalty: float = 1.0, steps: int = 400) -> np.ndarray:
    """Weights of features, chain columns and offset: gradient steps with momentum on the penalised loss,
    each coordinate scaled by its curvature's bound."""
    k = chain.shape[1]
    w = np.zeros(x.shape[1] + k + 1)
    use = use.astype(float)
    per_row = np.bincount(x.row, minlength=x.shape[0]) + k + 1  # the Hessian is below diag(columns' squares times row sizes) / 4
    curve = np.concatenate([x.back(use * per_row), ((chain**2).T @ (use * per_row)), [(use * per_row).sum()]]) / 4 + penalty
    ridge = np.concatenate([np.full(x.shape[1] + k, penalty), [1e-6]])
    ahead, pace = w.copy(), 1.0
    for _ in range(steps):
        p = sigmoid(x.times(ahead[: x.shape[1]]) + chain @ ahead[x.shape[1] : -1] + ahead[-1])
        r = use * (p - y)
        slope = np.concatenate([x.back(r), chain.T @ r, [r.sum()]]) + ridge * ahead
        new, faster = ahead - slope / curve, (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead, w, pace = new + (pace - 1) / faster * (new - w), new, faster
    return w


def predict_linear(w: np.ndarray, x: Sparse, chain: np.ndarray) -> np.ndarray:
    return sigmoid(x.times(w[: x.shape[1]]) + chain @ w[x.shape[1] : -1] + w[-1])


def fit_chain(x: Sparse, targets: list[np.ndarray], fold: np.ndarray) -> list[np.ndarray]:
    models, chain = [], np.zeros((x.shape[0], 0))
    for y in targets:
        models.append(fit_linear(x, chain, y, np.ones(len(y))))
        held = np.zeros(len(y))
        for f in range(FOLDS):
            held[fold == f] = predict_linear(fit_linear(x, chain, y, fold != f), x, chain)[fold == f]
        chain = np.hstack([chain, logit(held)[:, None]])
    return models


def run_chain(models: list[np.ndarray], x: Sparse) -> list[np.ndarray]:
    chain, out = np.zeros((x.shape[0], 0)), []
    for w in models:
        out.append(predict_linear(w, x, chain))
        chain = np.hstack([chain, logit(out[-1])[:, None]])
    return out


def score(docs: DataFrame, labels: DataFrame, column: str = "toxic", threshold: float = THRESHOLD, others: Sequence[str] = ()) -> DataFrame:
    """Per row: doc_id, a probability for each category, predicted (1 if toxic's is ``threshold`` or more), fitted
    (whether there are models). ``others``: columns that come along, in a struct, with the text."""
    rows = text_of(docs, others=others)
    along = ["text", "others"] if others else []
    labelled = settled(labelled_texts(docs, labels, column), "labelled")
    chosen, sizes = vocabulary(labelled)
    finder = Finder([x for x, _ in chosen])
    models: list[np.ndarray] = []
    if chosen and min(sizes):

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, texts in slices(batches):
                yield pa.RecordBatch.from_arrays([part.column("place"), part.column("label"), pa.array([finder(t) for t in texts], pa.list_(pa.int64()))], ["place", "label", "found"])

        place = labelled.select(F.xxhash64("doc_id", "text").alias("place"), "label", "text")
        sample = [r for label in (0, 1) for r in place.where(F.col("label") == label).mapInArrow(found, "place bigint, label int, found array<bigint>").orderBy("place").collect()]
        x = Sparse([r.found for r in sample], len(chosen))
        toxic = np.array([r.label for r in sample], float)
        marks = np.array([name[0] == "=" and odds >= np.log(MARKS) for name, odds in chosen], float)
        direct = toxic * (x.times(marks) > 0)
        repeated = toxic * (x.times(np.ones(len(chosen))) >= 3)
        fold = (splitmix(np.array([r.place for r in sample], np.int64).view(np.uint64)) % np.uint64(FOLDS)).astype(int)
        models = fit_chain(x, [direct, toxic - direct, repeated, toxic], fold)
    share = sizes[1] / max(1, sum(sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            chances = run_chain(models, Sparse([finder(t) for t in texts], len(chosen))) if models else [np.full(len(texts), share)] * len(CATEGORIES)
            results = [part.column(0), *map(pa.array, chances), pa.array((chances[-1] >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*results, *map(part.column, along)], ["doc_id", *CATEGORIES, "predicted", *along])

    kinds = [schema_of(rows, ["doc_id"]), *(f"{c} double" for c in CATEGORIES), "predicted int", *([schema_of(rows, along)] if along else [])]
    return rows.mapInArrow(run, ", ".join(kinds)).withColumn("fitted", F.lit(bool(models)))
