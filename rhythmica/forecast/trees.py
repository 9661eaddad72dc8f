"""Tree learners on Spark ML, feature importance and hyper-parameter search."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rhythmica.forecast.regression import LinearForecaster, moments_of
from rhythmica.functions import metrics as M
from rhythmica.functions.calendar import literal
from rhythmica.operators.layout import keys_at
from rhythmica.operators.target_stats import OrderedTargetEncoder, dealt, is_large
from rhythmica.session import settled

#: Square root of the rows from which Spark's trees learn the distinct bins of a feature.
BINS_SEEN = 1024

#: Sums that one pass adds up for several trials: 30 cost 14 ns each and row, 36 cost 38, since code that long is not compiled.
SUMS_TOGETHER = 30


@dataclass
class TreeForecaster:
    """A fitted or unfitted tree model over named feature columns."""

    features: Sequence[str]
    target: str
    learner: object
    model: PipelineModel | None = None

    def fit(self, df: DataFrame) -> TreeForecaster:
        """Rows with a missing feature or target teach nothing."""
        assembler = VectorAssembler(inputCols=list(self.features), outputCol="features", handleInvalid="keep")
        known = df.where(complete(self.features) & complete([self.target]))
        return TreeForecaster(self.features, self.target, self.learner, Pipeline(stages=[assembler, self.learner]).fit(known))

    def fit_groups(self, df: DataFrame) -> TreeForecaster:
        """The same trees from one row per group of rows that share all their bins, which no split can part: its number of
        rows and its mean target. What targets differ by inside a group is the same on both sides of any comparison of
        splits. For large tables that are cheap to read more than once; learners that look at single rows are fitted by ``fit``."""
        if not self._groups(df):
            return self.fit(df)
        names, most = _bins(self.features), self.learner.getMaxBins()
        known = df.where(complete(self.features) & complete([self.target]))
        rows = known.count()
        share = min(1.0, max(most * most, 10_000) / max(rows, 1))  # as many as Spark's trees take for their thresholds
        seen = known.select(*[F.col(c).cast("double") for c in self.features]).sample(share, self.learner.getSeed()).toPandas()
        edges = [thresholds(seen[c].to_numpy(), most) for c in self.features]
        # a threshold belongs to the bin below it in trees, to the one above it here
        splits = [[-math.inf, *np.nextafter(e, math.inf).tolist(), math.inf] for e in edges]
        bins = Bucketizer(splitsArray=splits, inputCols=list(self.features), outputCols=names, handleInvalid="keep")
        bits = max(1, math.ceil(math.log2(max(len(e) for e in splits))))
        words = [names[i : i + 62 // bits] for i in range(0, len(names), 62 // bits)]
        packed = [sum((F.shiftleft(F.col(c).cast("bigint"), bits * k) for k, c in enumerate(w)), F.lit(0).cast("bigint")).alias(f"_w{i}") for i, w in enumerate(words)]
        keys = [f"_w{i}" for i in range(len(words))]
        sums = bins.transform(known).select(*packed, F.col(self.target).cast("double").alias("_y")).groupBy(*keys).agg(F.count("_y").cast("double").alias("_n"), F.avg("_y").alias(self.target))
        plain = [F.shiftright(f"_w{i}", bits * k).bitwiseAND((1 << bits) - 1).cast("double").alias(c) for i, w in enumerate(words) for k, c in enumerate(w)]
        groups = settled(sums.select(*plain, "_n", self.target), "groups")
        groups = dealt(groups, groups.count(), *names)  # a task's groups are kept through all rounds
        assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
        learner = self.learner.copy({self.learner.weightCol: "_n", self.learner.maxBins: max(BINS_SEEN, most)})
        return TreeForecaster(self.features, self.target, self.learner, PipelineModel([bins, assembler, learner.fit(assembler.transform(groups))]))

    def _groups(self, df: DataFrame) -> bool:
        """Whether the learner needs no more of the rows than sums: squares, all rows, leaves of any size."""
        learner = self.learner
        return (
            isinstance(learner, GBTRegressor)
            and learner.getLossType() == "squared"
            and learner.getSubsamplingRate() == 1.0
            and learner.getMinInstancesPerNode() == 1
            and not learner.isSet(learner.validationIndicatorCol)
            and not learner.isSet(learner.weightCol)
            and len(self.features) > 0
            and all(isinstance(df.schema[c].dataType, T.NumericType) for c in self.features)
        )

    def predict(self, df: DataFrame) -> DataFrame:
        """All rows; those with a missing feature get a null prediction."""
        if self.model is None:
            raise ValueError("fit the model first")
        scored = self.model.transform(df).drop("features", *_bins(self.features))
        return scored.withColumn("prediction", F.when(complete(self.features), F.col("prediction")))

    def importance(self, spark: SparkSession) -> DataFrame:
        """One row per feature, most important first."""
        return importance_table(spark, self.features, self.model.stages[-1])

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)


def _bins(features: Sequence[str]) -> list[str]:
    return [f"_bin_{c}" for c in features]


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Where Spark's trees part the values of a feature: half-way between neighbours, all of them or those next to equal shares."""
    found, counts = np.unique(values[np.isfinite(values)], return_counts=True)
    if len(found) < 2:
        return found if len(found) else np.zeros(1)
    middle = found[:-1] / 2 + found[1:] / 2
    if len(found) <= bins:
        return middle
    stride, out = counts.sum() / bins, []
    goal, seen = stride, counts[0]
    for i in range(1, len(found)):
        before, seen = seen, seen + counts[i]
        if abs(before - goal) < abs(seen - goal):
            out.append(middle[i - 1])
            goal += stride
    return np.array(out)


def complete(columns: Sequence[str]) -> Column:
    """Whether no column is null or NaN."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return out


def importance_table(spark: SparkSession, features: Sequence[str], model) -> DataFrame:
    """Importances of a tree model, or absolute coefficients of a linear one."""
    values = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    rows = [(name, abs(float(v))) for name, v in zip(features, values.toArray(), strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def random_forest(
    features: Sequence[str], target: str, trees: int = 100, depth: int = 5, min_leaf: int = 1, subset: str = "auto",
    bootstrap: bool = True, seed: int = 42,
) -> TreeForecaster:
    learner = RandomForestRegressor(
        featuresCol="features", labelCol=target, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy=subset, bootstrap=bootstrap, seed=seed,
    )
    return TreeForecaster(features, target, learner)


def boosted_trees(
    features: Sequence[str], target: str, rounds: int = 50, step: float = 0.1, depth: int = 5, subsample: float = 1.0,
    validation: str | None = None, tolerance: float = 0.01, seed: int = 42,
) -> TreeForecaster:
    """``validation`` names a Boolean column that marks the rows for early stopping."""
    early_stop = {"validationIndicatorCol": validation, "validationTol": tolerance} if validation else {}
    learner = GBTRegressor(
        featuresCol="features", labelCol=target, maxIter=rounds, stepSize=step, maxDepth=depth, subsamplingRate=subsample, seed=seed, **early_stop
    )
    return TreeForecaster(features, target, learner)


@dataclass
class CategoricalForecaster:
    """Trees over number columns and category columns; a category enters as its ordered target statistic."""

    learner: TreeForecaster
    encoder: OrderedTargetEncoder

    def fit(self, df: DataFrame) -> CategoricalForecaster:
        encoder = self.encoder.fit(df)
        if not is_large(df, df.count()):
            return CategoricalForecaster(self.learner.fit(encoder.encode_training(df)), encoder)
        used = dict.fromkeys(c for c in [*self.learner.features, self.learner.target] if c not in encoder.names)
        encoded = settled(encoder.encode_training(df, list(used)), "encoded")
        return CategoricalForecaster(self.learner.fit_groups(encoded), encoder)

    def predict(self, df: DataFrame) -> DataFrame:
        return self.learner.predict(self.encoder.encode(df)).drop(*self.encoder.names)


def categorical_boosted_trees(features: Sequence[str], categories: Sequence[str], target: str, order_by: Sequence[str], weight: float = 1.0, **settings) -> CategoricalForecaster:
    encoder = OrderedTargetEncoder(categories, target, order_by, weight)
    return CategoricalForecaster(boosted_trees([*features, *encoder.names], target, **settings), encoder)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def grid(space: dict[str, Sequence]) -> list[dict]:
    return [dict(zip(space, values, strict=True)) for values in itertools.product(*space.values())]


def sampled(space: dict[str, Sequence], n: int, seed: int = 42) -> list[dict]:
    """n distinct seeded draws from the grid."""
    points = grid(space)
    return random.Random(seed).sample(points, min(n, len(points)))


def search(
    build: Callable[..., object], trials: Sequence[dict], train: DataFrame, validation: DataFrame, y: str,
    metric: M.Metric = M.rmse, maximise: bool = False, patience: int | None = None,
) -> DataFrame:
    """Fit every trial on the training part, score it on the later validation part, return the trials
    as rows with the best first. A failing trial scores infinitely bad; ``patience`` stops after that
    many trials without a gain."""
    worst = float("-inf") if maximise else float("inf")
    best, since, rows = worst, 0, []
    for i, params in enumerate(trials):
        score, status = _trial_score(build, params, train, validation, y, metric, worst)
        rows.append((i, {k: str(v) for k, v in params.items()}, score, status))
        better = score > best if maximise else score < best
        best, since = (score, 0) if better else (best, since + 1)
        if patience is not None and since >= patience:
            break
    table = train.sparkSession.createDataFrame(rows, "trial int, params map<string,string>, score double, status string")
    return table.orderBy(F.col("score").desc() if maximise else F.col("score").asc(), "trial")


def _trial_score(build: Callable[..., object], params: dict, train: DataFrame, validation: DataFrame, y: str, metric: M.Metric, worst: float) -> tuple[float, str]:
    """Score and status of a trial; parameters that cannot be fitted score worst, a broken session is an error."""
    try:
        fitted = build(**params).fit(train)
        score = fitted.predict(validation).agg(metric(F.col(y), F.col("prediction")).alias("s")).first()["s"]
    except Exception as e:  # a learner may raise anything; if the session is gone, the next line raises as well
        train.sparkSession.range(1).count()
        return worst, f"failed: {type(e).__name__}"
    return _status(score, worst)


def _status(score: float | None, worst: float) -> tuple[float, str]:
    return (worst, "no score") if score is None or math.isnan(score) else (score, "ok")


def _built(build: Callable[..., object], params: dict) -> object:
    """The learner, or None where its parameters are refused, which the trial's own run reports."""
    try:
        return build(**params)
    except Exception:  # anything may be raised
        return None


def _together(learners: dict[int, object]) -> list[list[int]]:
    """Linear trials in groups that share their passes over the rows, each of as many as have ``SUMS_TOGETHER`` sums."""
    groups, room = [], 0
    for i, learner in learners.items():
        if not isinstance(learner, LinearForecaster):
            continue
        names = len(learner.features) + 1
        sums = 1 + names + names * (names + 1) // 2
        if sums > room:
            groups.append([])
            room = SUMS_TOGETHER
        groups[-1].append(i)
        room -= sums
    return groups


def _scores_together(learners: dict[int, LinearForecaster], train: DataFrame, validation: DataFrame, y: str, metric: M.Metric, worst: float) -> dict[int, tuple[float, str]]:
    """What ``_trial_score`` gives for each, from one pass over the training rows and one over the validation rows. Nothing if one
    cannot be fitted or scored, so that it fails by itself and not with the others."""
    try:
        moments = moments_of(train, [(m.target, m.features) for m in learners.values()])
        scored = validation
        for (i, learner), found in zip(learners.items(), moments, strict=True):
            scored = learner.fit(train, found).predict(scored).withColumnRenamed("prediction", f"_prediction_{i}")
        scores = scored.agg(*[metric(F.col(y), F.col(f"_prediction_{i}")).alias(str(i)) for i in learners]).first()
    except Exception:  # as there
        return {}
    return {i: _status(scores[str(i)], worst) for i in learners}


def successive_halving(
    build: Callable[..., object], trials: Sequence[dict], train: DataFrame, validation: DataFrame, y: str, order_by: Sequence[str],
    rungs: int = 3, eta: int = 2, metric: M.Metric = M.rmse, maximise: bool = False, parallel: int = 4,
) -> DataFrame:
    """Trials that fall behind on a short window of the latest training rows are dropped before the next, ``eta`` times longer one.

    The last rung trains on all rows. Of each rung the best ceil(n / eta) go on, ties to the smaller trial number; failed trials
    never do. Linear trials of a rung share one pass over its window and one over the validation rows, as far as their sums fit;
    these passes, and all other trials, are concurrent Spark jobs, at most ``parallel`` at a time. Equal times (the first of
    ``order_by``, which ends in a unique tiebreak) are in or out of a window together. One row per rung and trial.
    """
    if rungs < 1 or eta < 2:
        raise ValueError("one rung and a factor of two are needed at least")
    worst = float("-inf") if maximise else float("inf")
    time = order_by[0]
    timed = train.where(F.col(time).isNotNull())
    shares = [eta ** (rungs - 1 - k) for k in range(rungs)]
    starts = [*keys_at(timed, order_by, lambda n: [n - max(n // s, 1) if n else 0 for s in shares[:-1]]), None]
    kind, alive, rows = train.schema[time].dataType, list(range(len(trials))), []
    shared = "prediction" not in [c.lower() for c in validation.columns]  # else a trial takes away what the next one reads
    with ThreadPoolExecutor(max_workers=max(parallel, 1)) as pool:
        for rung, (share, start) in enumerate(zip(shares, starts, strict=True)):
            window = train if start is None else timed.where(F.col(time) >= literal(start[time], kind))
            learners = dict(zip(alive, pool.map(lambda i: _built(build, trials[i]), alive), strict=True))
            groups = [{i: learners[i] for i in group} for group in _together(learners)] if shared else []
            found = {}
            for part in pool.map(lambda group: _scores_together(group, window, validation, y, metric, worst), groups):  # noqa: B023
                found |= part
            alone = [i for i in alive if i not in found]
            own = {i: build if learners[i] is None else lambda learner=learners[i], **_: learner for i in alone}
            found |= zip(alone, pool.map(lambda i: _trial_score(own[i], trials[i], window, validation, y, metric, worst), alone), strict=True)  # noqa: B023
            scores = [found[i] for i in alive]
            ranked = sorted(zip(alive, scores, strict=True), key=lambda t: ((-t[1][0] if maximise else t[1][0]), t[0]))
            sound = [i for i, (_, status) in ranked if status == "ok"]
            kept = sound[: math.ceil(len(alive) / eta)] if rung < rungs - 1 else sound[:1]
            rows += [(rung, i, {k: str(v) for k, v in trials[i].items()}, share, score, status, i in kept) for i, (score, status) in ranked]
            alive = sorted(kept)
            if not alive:
                break
    schema = "rung int, trial int, params map<string,string>, share_of_rows int, score double, status string, kept boolean"
    return train.sparkSession.createDataFrame(rows, schema)
