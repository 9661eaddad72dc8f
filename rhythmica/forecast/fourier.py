"""Harmonic regression with autoregressive errors by iterated prewhitening, from one pass of moments.

y[t] = c + sum_k a_k cos(2 pi k t / m) + b_k sin(2 pi k t / m) + e[t], e an autoregression of order p. The loop
regresses, fits the autoregression to the residuals, filters both sides with it and regresses again. A
harmonic moved by i rows is a rotation of itself, so residuals at every lag and both filtered sides are
linear in (y[t], .., y[t-p], harmonics at t): all rounds of the loop work on the covariances of these
columns. Spark makes one pass of partial sums; a batch of series is then iterated at once, one small row
each. An error with moving-average terms is approached by a longer autoregression.

Rows without a target are left out before rows are numbered, so a gap shortens the series; t is the row's
number in its series. Moments are of the rows that have p rows before them. Series with fewer such rows than
coefficients plus two, or whose columns are dependent (a constant series), have ``ok`` false and no coefficients.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rhythmica.forecast.regression import _stack, moment_columns
from rhythmica.operators.layout import Layout, plan_layout, with_position, with_windows
from rhythmica.session import settled

DOUBLES = T.ArrayType(T.DoubleType())


@dataclass(frozen=True)
class FourierSpec:
    """``period``: rows of a season, need not be whole. ``order``: of the autoregression; ``rounds``: of the loop."""

    period: float
    harmonics: int = 2
    order: int = 1
    rounds: int = 20
    tolerance: float = 1e-10

    def terms(self) -> list[tuple[int, str]]:
        """(k, 'cos' or 'sin'); a sine at half the period would be zero at every row."""
        if not 0 < 2 * self.harmonics <= self.period:
            raise ValueError("harmonics must be at least 1 and at most half the period")
        return [(k, f) for k in range(1, self.harmonics + 1) for f in ("cos", "sin") if f == "cos" or 2 * k < self.period]

    def at(self, t: Column) -> list[Column]:
        cycle = F.pmod(t.cast("double"), F.lit(float(self.period)))
        return [getattr(F, f)(cycle * (2 * math.pi * k / self.period)) for k, f in self.terms()]

    def moved(self, rows: int) -> np.ndarray:
        """Matrix R with harmonics(t - rows) = harmonics(t) R."""
        terms = self.terms()
        out = np.zeros((len(terms), len(terms)))
        for j, (k, f) in enumerate(terms):
            angle = 2 * math.pi * k * rows / self.period
            out[j, j] = math.cos(angle)
            other = terms.index((k, "sin" if f == "cos" else "cos")) if (k, "sin") in terms else None
            if other is not None:
                out[other, j] = math.sin(angle) if f == "cos" else -math.sin(angle)
        return out


def prewhiten(cov: np.ndarray, spec: FourierSpec) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(harmonic coefficients, autoregression, residual variance, sound) of every covariance matrix.

    Columns of ``cov``: y at lags 1..p, the harmonics, y - the order of the moments.
    """
    p, q = spec.order, len(spec.terms())
    size = p + q + 1
    lag = np.eye(size)[[size - 1, *range(p)]]  # unit rows that pick y at lags 0..p
    turn = np.stack([spec.moved(i) for i in range(p + 1)])
    n = len(cov)
    beta, phi, sound = np.zeros((n, q)), np.zeros((n, p)), np.ones(n, bool)
    scale = np.sqrt(np.maximum(np.einsum("gii->gi", cov), 0.0))

    def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not a.shape[1]:
            return np.zeros((n, 0))
        sound[:] &= np.linalg.matrix_rank(a, hermitian=True) == a.shape[1]
        return np.einsum("gij,gj->gi", np.linalg.pinv(a, hermitian=True), b)

    def regress(phi: np.ndarray) -> np.ndarray:
        weights = np.concatenate([np.ones((n, 1)), -phi], axis=1)  # the filter
        left = weights @ lag
        right = np.zeros((n, size, q))
        right[:, p : p + q] = np.einsum("gi,ijk->gjk", weights, turn)
        moved = np.einsum("gis,gij->gsj", right, cov)
        return solve(moved @ right, np.einsum("gsj,gj->gs", moved, left))

    def residual_cov(beta: np.ndarray) -> np.ndarray:
        rows = np.repeat(lag[None], n, axis=0)
        rows[:, :, p : p + q] -= np.einsum("ijk,gk->gij", turn, beta)
        return rows @ cov @ rows.transpose(0, 2, 1)

    beta = regress(phi)
    for _ in range(spec.rounds):
        e = residual_cov(beta)
        phi = solve(e[:, 1:, 1:], e[:, 1:, 0])
        before, beta = beta, regress(phi)
        if np.all(np.abs(beta - before) <= spec.tolerance * (scale[:, -1:] + 1e-300)):
            break
    e = residual_cov(beta)
    weights = np.concatenate([np.ones((n, 1)), -phi], axis=1)
    return beta, phi, np.maximum(np.einsum("gi,gij,gj->g", weights, e, weights), 0.0), sound & (scale[:, -1] > 0)


@dataclass(frozen=True)
class FourierFit:
    series: tuple[str, ...]
    spec: FourierSpec
    models: DataFrame  # series, n (rows of the moments), beta, phi, intercept (of the filtered side), sigma, ok, rows, recent (latest first)

    def forecast(self, horizon: int, z: float = 1.959963984540054) -> DataFrame:
        """(series, step, yhat, std, lower, upper) of sound series, in built-in functions only."""
        spec, p = self.spec, self.spec.order
        rows = self.models.where("ok")

        def wave(t: Column) -> Column:
            return reduce(lambda a, c: a + c[1] * F.col("beta")[c[0]], enumerate(spec.at(t)), F.lit(0.0))

        def step(state: Column, h: Column) -> Column:
            """state: past (latest first), psi (latest first), steps so far."""
            t = F.col("rows") + h - 1
            yhat = F.col("intercept") + wave(t)
            psi = F.lit(0.0)
            for i in range(1, p + 1):
                yhat = yhat + F.col("phi")[i - 1] * (state["past"][i - 1] - wave(t - i))
                psi = psi + F.col("phi")[i - 1] * F.coalesce(F.get(state["psi"], F.lit(i - 1)), F.lit(0.0))
            psi = F.when(h == 1, F.lit(1.0)).otherwise(psi)
            spread = F.coalesce(F.try_element_at(state["out"], F.lit(-1))["spread"], F.lit(0.0)) + psi * psi
            return F.struct(
                F.slice(F.concat(F.array(yhat), state["past"]), 1, max(p, 1)).alias("past"),
                F.slice(F.concat(F.array(psi), state["psi"]), 1, max(p, 1)).alias("psi"),
                F.concat(state["out"], F.array(F.struct(h.alias("step"), yhat.alias("yhat"), spread.alias("spread")))).alias("out"),
            )

        start = F.struct(
            F.col("recent").alias("past"), F.array().cast("array<double>").alias("psi"), F.array().cast("array<struct<step:int,yhat:double,spread:double>>").alias("out")
        )
        done = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step)["out"]
        out = rows.select(*self.series, "sigma", F.explode(done).alias("_o"))
        std = F.col("sigma") * F.sqrt("_o.spread")
        yhat = F.col("_o.yhat")
        return out.select(*self.series, "_o.step", yhat.alias("yhat"), std.alias("std"), (yhat - z * std).alias("lower"), (yhat + z * std).alias("upper"))


def fit_fourier(df: DataFrame, series: Sequence[str], order_by: Sequence[str], y: str, spec: FourierSpec, layout: Layout | None = None) -> FourierFit:
    """One model per series."""
    series, order_by, p = tuple(series), tuple(order_by), spec.order
    value = F.col(y).cast("double")
    rows = df.select(*dict.fromkeys([*series, *order_by]), value.alias("_y")).where(F.col("_y").isNotNull() & ~F.isnan("_y"))
    layout = layout or plan_layout(rows, series, order_by, reach=p)
    placed = with_position(rows, series, order_by, "_t", "_rows", layout)
    lags = [f"_y{i}" for i in range(1, p + 1)]
    waves = [f"_x{i}" for i in range(len(spec.terms()))]
    lagged = with_windows(placed, series, order_by, lambda w: {c: F.lag("_y", i).over(w) for i, c in enumerate(lags, 1)}, p, layout) if p else placed
    wide = lagged.withColumns(dict(zip(waves, spec.at(F.col("_t")), strict=True)))
    names = [*lags, *waves]
    # the latest p values, written by their distance from the end
    recent = [F.max(F.when(F.col("_t") == F.col("_rows") - i, F.col("_y"))).alias(f"_e{i}") for i in range(1, p + 1)]
    moments = wide.groupBy(*series).agg(*moment_columns("_y", names), F.max("_rows").alias("rows"), *recent)
    schema = T.StructType(
        [*[moments.schema[c] for c in series], T.StructField("n", T.LongType()), T.StructField("beta", DOUBLES), T.StructField("phi", DOUBLES)]
        + [T.StructField(c, T.DoubleType()) for c in ("intercept", "sigma")]
        + [T.StructField("ok", T.BooleanType()), T.StructField("rows", T.LongType()), T.StructField("recent", DOUBLES)]
    )
    k, q = len(names) + 1, len(waves)
    turn = [spec.moved(i) for i in range(p + 1)]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            n, means, cov = _stack(pdf, k)
            beta, phi, variance, sound = prewhiten(cov, spec)
            free = n - (p + q + 1)
            ok = sound & (free >= 2)
            level = means[:, -1] - np.einsum("gj,gj->g", means[:, p : p + q], beta)
            for i in range(1, p + 1):
                level -= phi[:, i - 1] * (means[:, i - 1] - np.einsum("gj,jk,gk->g", means[:, p : p + q], turn[i], beta))
            sigma = np.sqrt(variance * n / np.maximum(free, 1))
            latest = pdf[[f"_e{i}" for i in range(1, p + 1)]].to_numpy(float)
            out = pdf[list(series)].assign(n=n.astype("int64"), ok=ok, rows=pdf["rows"], recent=list(latest))
            out["beta"] = [b if good else None for b, good in zip(beta, ok, strict=True)]
            out["phi"] = [b if good else None for b, good in zip(phi, ok, strict=True)]
            out["intercept"], out["sigma"] = np.where(ok, level, np.nan), np.where(ok, sigma, np.nan)
            yield out[schema.names]

    fitted = moments.mapInPandas(solve, schema)
    return FourierFit(series, spec, settled(fitted.withColumns({c: F.nanvl(c, F.lit(None)) for c in ("intercept", "sigma")}), "fourier"))
