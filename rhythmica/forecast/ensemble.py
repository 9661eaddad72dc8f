"""Voting and stacking over forecast columns of one table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rhythmica.forecast.regression import fit_one, moment_columns, solve_moments
from rhythmica.functions.calendar import literal
from rhythmica.functions.metrics import median_of
from rhythmica.operators.layout import keys_at


def vote(models: Sequence[str], weights: Sequence[float] | None = None, kind: str = "mean") -> Column:
    """Row-wise combination of forecast columns; the members stay beside it in the table."""
    if weights is not None:
        if len(weights) != len(models):
            raise ValueError("one weight per model is needed")
        if not math.isclose(sum(weights), 1.0, rel_tol=1e-5, abs_tol=1e-8):
            raise ValueError("weights must sum to 1")
    if kind == "median":
        return median_of(models)
    if kind != "mean":
        raise ValueError(f"unknown voting kind {kind!r}")
    shares = weights or [1.0 / len(models)] * len(models)
    if weights is None:
        total = F.lit(0.0)
        for m in models:
            total = total + F.col(m)
        return total / len(models)
    terms = [F.col(m) * F.lit(float(s)) for m, s in zip(models, shares, strict=True)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


@dataclass
class Stacking:
    """Ridge meta-learner over base forecast columns, optionally with raw features.

    Fitting on in-sample base forecasts reproduces the usual shortcut; pass a table of out-of-fold
    forecasts to avoid its optimism: ``expanding_out_of_fold`` for rows in time order, ``out_of_fold`` for others.
    """

    base: Sequence[str]
    features: Sequence[str] = ()
    alpha: float = 1.0
    coef: list[float] = field(default_factory=list)
    intercept: float = 0.0

    def fit(self, df: DataFrame, y: str) -> Stacking:
        self.coef, self.intercept = fit_one(df, y, [*self.base, *self.features], self.alpha)
        return self

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        if not self.coef:
            raise ValueError("fit the ensemble first")
        out = F.lit(self.intercept)
        for c, x in zip(self.coef, [*self.base, *self.features], strict=True):
            out = out + F.lit(c) * F.col(x)
        return df.withColumn(name, out)


def out_of_fold(df: DataFrame, models: dict[str, object], folds: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Base forecasts for every row from models that did not see its fold.

    ``models`` maps a column name to an object with ``fit(df)`` and ``predict(df)``; the fold of a row
    is a hash of its key, the same on every run.
    """
    tagged = df.withColumn("_fold", F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(folds)))
    out = None
    for k in range(folds):
        rest, held = tagged.filter(F.col("_fold") != k), tagged.filter(F.col("_fold") == k)
        for name, model in models.items():
            fitted = model.fit(rest) or model
            held = fitted.predict(held).withColumnRenamed("prediction", name)
        out = held if out is None else out.unionByName(held)
    return out.drop("_fold")


def expanding_folds(df: DataFrame, order_by: Sequence[str], folds: int, name: str = "fold") -> DataFrame:
    """Add a fold number that grows with time: about equal counts, equal times in one fold.

    ``order_by`` ends in a unique tiebreak; its first column is the time. Only the keys at the cuts are looked up,
    rows are then tagged by comparison. Rows without a time are in fold 0.
    """
    if folds < 2:
        raise ValueError("two folds are needed at least")
    timed = df.filter(F.col(order_by[0]).isNotNull())
    ends = keys_at(timed, order_by, lambda n: [max(0, n * k // folds - 1) for k in range(1, folds)])
    kind = df.schema[order_by[0]].dataType
    later = [(F.col(order_by[0]) > literal(e[order_by[0]], kind)).cast("int") for e in ends if e is not None]
    total = F.lit(0)
    for x in later:
        total = total + F.coalesce(x, F.lit(0))
    return df.withColumn(name, total)


def expanding_out_of_fold(
    df: DataFrame, y: str, models: dict[str, Sequence[str]], order_by: Sequence[str], folds: int = 3, alpha: float = 0.0, name: str = "fold"
) -> DataFrame:
    """Forecasts of linear base models (column name -> features) for each fold, learnt from all earlier folds only.

    One aggregation by fold gives the moments of all models; what a fold may learn from is the sum of the
    folds before it, so all fits need one pass over the rows. Rows of the first fold, and of a fold whose
    past cannot be fitted, have null forecasts.
    """
    tagged = expanding_folds(df, order_by, folds, name)
    sums = []
    for i, xs in enumerate(models.values()):
        sums += [c.alias(f"s{i}_{k}") for k, c in enumerate(moment_columns(y, xs))]
    rows = {r[name]: r for r in tagged.groupBy(name).agg(*sums).collect()}  # one row per fold
    out = tagged
    for i, (column, xs) in enumerate(models.items()):
        k = len(xs) + 1
        n, mean, cross = 0, np.zeros(k), np.zeros((k, k))
        forecast = F.lit(None).cast("double")
        for fold in range(folds):
            if n:
                cov = cross / n
                cells = {"_n": [n]} | {f"_m{a}": [mean[a]] for a in range(k)} | {f"_c{a}_{b}": [cov[a, b]] for a in range(k) for b in range(a + 1)}
                fit = solve_moments(pd.DataFrame(cells), k, alpha, True).iloc[0]
                if fit["ok"]:
                    value = F.lit(float(fit["intercept"]))
                    for c, x in zip(fit["coef"], xs, strict=True):
                        value = value + F.lit(float(c)) * F.col(x)
                    forecast = F.when(F.col(name) == fold, value).otherwise(forecast)
            n, mean, cross = _with(n, mean, cross, rows.get(fold), i, k)
        out = out.withColumn(column, forecast)
    return out


def _with(n: int, mean: np.ndarray, cross: np.ndarray, row, i: int, k: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, means and centred cross products with those of one more fold."""
    more = int(row[f"s{i}_0"]) if row is not None else 0
    if not more:
        return n, mean, cross
    theirs = np.array([row[f"s{i}_{1 + a}"] for a in range(k)], float)
    cov, at = np.zeros((k, k)), 1 + k
    for a in range(k):
        for b in range(a + 1):
            cov[a, b] = cov[b, a] = row[f"s{i}_{at}"]
            at += 1
    apart, total = theirs - mean, n + more
    return total, mean + apart * more / total, cross + cov * more + np.outer(apart, apart) * n * more / total
