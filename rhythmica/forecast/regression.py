"""Linear regression per group from covariances.

The rows are reduced by ordinary partial aggregation; only one small row of moments per group reaches
Python, where a batch of groups is solved at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIT_FIELDS = [
    T.StructField("n", T.LongType()),
    T.StructField("coef", T.ArrayType(T.DoubleType())),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("rss", T.DoubleType()),
    T.StructField("ok", T.BooleanType()),
]


def moment_columns(y: str, xs: Sequence[str], prefix: str = "") -> list[Column]:
    """Count, means and population covariances of the rows where nothing is missing."""
    names = [*xs, y]
    whole = F.lit(True)
    for c in names:
        whole = whole & F.col(c).isNotNull()
    cells = [F.when(whole, F.col(c).cast("double")) for c in names]
    out = [F.count_if(whole).alias(f"{prefix}_n")]
    out += [F.avg(c).alias(f"{prefix}_m{i}") for i, c in enumerate(cells)]
    out += [F.covar_pop(cells[i], cells[j]).alias(f"{prefix}_c{i}_{j}") for i in range(len(names)) for j in range(i + 1)]
    return out


def _stack(pdf: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = pdf["_n"].to_numpy(float)
    means = np.stack([pdf[f"_m{i}"].to_numpy(float) for i in range(k)], axis=1)
    cov = np.zeros((len(pdf), k, k))
    for i in range(k):
        for j in range(i + 1):
            cov[:, i, j] = cov[:, j, i] = pdf[f"_c{i}_{j}"].to_numpy(float)
    return n, np.nan_to_num(means), np.nan_to_num(cov)


def solve_moments(pdf: pd.DataFrame, k: int, alpha: float, intercept: bool) -> pd.DataFrame:
    """Normal equations for every row of moments; k counts the regressors plus the target."""
    n, means, cov = _stack(pdf, k)
    gram = cov if intercept else cov + means[:, :, None] * means[:, None, :]
    p = k - 1
    a, b, s_yy = gram[:, :p, :p].copy(), gram[:, :p, p], gram[:, p, p]
    safe_n = np.maximum(n, 1.0)
    if p:
        if alpha:
            a += (alpha / safe_n)[:, None, None] * np.eye(p)
        rank = np.linalg.matrix_rank(a, hermitian=True)
        coef = np.einsum("gij,gj->gi", np.linalg.pinv(a, hermitian=True), b)
        plain = gram[:, :p, :p]
        rss = n * (s_yy - 2 * (coef * b).sum(1) + np.einsum("gi,gij,gj->g", coef, plain, coef))
    else:
        rank, coef, rss = np.zeros(len(pdf)), np.zeros((len(pdf), 0)), n * s_yy
    const = means[:, p] - (coef * means[:, :p]).sum(1) if intercept else np.zeros(len(pdf))
    ok = (rank == p) & (n > p + int(intercept))
    return pd.DataFrame({"n": n.astype("int64"), "coef": list(coef), "intercept": const, "rss": np.maximum(rss, 0.0), "ok": ok})


def fit_linear(
    df: DataFrame, by: Sequence[str], y: str, xs: Sequence[str], alpha: float = 0.0, intercept: bool = True, extra: Sequence[Column] = ()
) -> DataFrame:
    """One row per group: n, coef (in the order of ``xs``), intercept, rss, ok. ``alpha`` is the ridge
    penalty on the uncentred scale of the sum of squares; the intercept is not penalised."""
    aggs = [*moment_columns(y, xs), *extra]
    moments = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    kept = [f for f in moments.schema if not f.name.startswith(("_n", "_m", "_c"))]
    k = len(xs) + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            solved = solve_moments(pdf, k, alpha, intercept)
            for f in kept:
                solved[f.name] = pdf[f.name].to_numpy()
            yield solved[[f.name for f in kept] + [f.name for f in FIT_FIELDS]]

    return moments.mapInPandas(run, T.StructType(kept + FIT_FIELDS))


def moments_of(df: DataFrame, regressions: Sequence[tuple[str, Sequence[str]]]) -> list[pd.DataFrame]:
    """The moments of several regressions, each a target and its regressors, from one pass over the whole table: one row each."""
    found = df.agg(*[c for i, (y, xs) in enumerate(regressions) for c in moment_columns(y, xs, f"_r{i}")]).toPandas()  # one row
    return [found.filter(regex=f"^_r{i}_").rename(columns=lambda c: c[c.index("_", 1) :]) for i in range(len(regressions))]


def fit_one(
    df: DataFrame, y: str, xs: Sequence[str], alpha: float = 0.0, intercept: bool = True, moments: pd.DataFrame | None = None
) -> tuple[list[float], float]:
    """Coefficients and intercept for the whole table: one aggregate row, solved on the spot. ``moments``: that row, where
    it was found together with others."""
    if moments is None:
        moments = moments_of(df, [(y, xs)])[0]
    solved = solve_moments(moments, len(xs) + 1, alpha, intercept).iloc[0]
    return [float(c) for c in solved["coef"]], float(solved["intercept"])


def predict_linear(coef: Column | str, intercept: Column | str, xs: Sequence[str]) -> Column:
    c = F.col(coef) if isinstance(coef, str) else coef
    b = F.col(intercept) if isinstance(intercept, str) else intercept
    out = b
    for i, x in enumerate(xs):
        out = out + c[i] * F.col(x)
    return out


@dataclass
class LinearForecaster:
    """Least squares (or ridge) over named columns, one model for the whole table."""

    features: Sequence[str]
    target: str
    alpha: float = 0.0
    coef: tuple[float, ...] = ()
    intercept: float = 0.0

    def fit(self, df: DataFrame, moments: pd.DataFrame | None = None) -> LinearForecaster:
        coef, intercept = fit_one(df, self.target, self.features, self.alpha, moments=moments)
        return LinearForecaster(self.features, self.target, self.alpha, tuple(coef), intercept)

    def predict(self, df: DataFrame) -> DataFrame:
        out = F.lit(self.intercept)
        for c, x in zip(self.coef, self.features, strict=True):
            out = out + F.lit(c) * F.col(x)
        return df.withColumn("prediction", out)
