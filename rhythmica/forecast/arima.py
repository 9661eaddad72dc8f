"""ARIMA-type forecasts for many series at once.

Differencing is a weighted sum of lags. The autoregressive part is a regression on lags; the moving
average part uses the two-stage regression of Hannan and Rissanen: residuals of a long autoregression
stand in for the unseen shocks. Both stages are window columns plus covariances, so a series is never
gathered in one task; Python sees one row of moments per series, and the last few values for the
recursion. Series whose regression is singular or too short fall back to order (1, 1, 0).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rhythmica.forecast.regression import fit_linear
from rhythmica.operators.features import difference_weights, lagged_sum
from rhythmica.operators.layout import COPY, Layout, plan_layout
from rhythmica.session import settled


@dataclass(frozen=True)
class ArimaOrder:
    p: int = 1
    d: int = 1
    q: int = 1
    seasonal_p: int = 0
    seasonal_d: int = 0
    seasonal_q: int = 0
    season: int = 0
    trend: bool = False
    long_ar: int | None = None

    @property
    def weights(self) -> dict[int, float]:
        return difference_weights(self.d, self.seasonal_d, self.season)

    @property
    def ar_lags(self) -> list[int]:
        return sorted({*range(1, self.p + 1), *(self.season * j for j in range(1, self.seasonal_p + 1))})

    @property
    def ma_lags(self) -> list[int]:
        return sorted({*range(1, self.q + 1), *(self.season * j for j in range(1, self.seasonal_q + 1))})

    @property
    def long_lags(self) -> list[int]:
        """Lags of the long autoregression that supplies the residuals."""
        if not self.ma_lags:
            return []
        n = self.long_ar or max(self.p, self.q) + 3
        return sorted({*range(1, n + 1), *self.ar_lags, *self.ma_lags})

    @property
    def reach(self) -> int:
        return max(self.weights) + max([*self.ar_lags, *self.long_lags], default=0) + max(self.ma_lags, default=0) + 2


@dataclass(frozen=True)
class ArimaFit:
    order: ArimaOrder
    series: tuple[str, ...]
    order_by: tuple[str, ...]
    y: str
    coefs: DataFrame  # series, n, coef, intercept, rss, ok, long_coef, long_intercept, fb_phi, fb_var
    history: DataFrame
    exog: tuple[str, ...] = ()

    def info(self) -> DataFrame:
        """Information criteria of the conditional least squares fit."""
        k = len(self.order.ar_lags) + len(self.order.ma_lags) + len(self.exog) + int(self.order.trend) + 1
        fit_term = F.col("n") * F.log(F.try_divide("rss", "n"))
        return self.coefs.select(
            *self.series, "n", "coef", "intercept", "ok",
            (fit_term + 2 * k).alias("aic"),
            (fit_term + k * F.log("n")).alias("bic"),
            (fit_term + 2 * k * F.log(F.log("n"))).alias("hqic"),
        )

    def tails(self) -> DataFrame:
        """The last ``reach`` values per series, oldest first. The row_number filter limits every task
        to that many rows per series before the shuffle."""
        newest = Window.partitionBy(*self.series).orderBy(*[F.col(c).desc() for c in self.order_by])
        n = self.order.reach
        last = self.history.select(*dict.fromkeys([*self.series, *self.order_by, self.y, *self.exog]))
        drivers = F.array(*[F.col(c).cast("double") for c in self.exog]).cast("array<double>")
        entry = F.struct((-F.col("_r")).alias("r"), F.col(self.y).cast("double").alias("v"), drivers.alias("x"))
        return (
            last.withColumn("_r", F.row_number().over(newest))
            .filter(F.col("_r") <= n)
            .groupBy(*self.series)
            .agg(F.array_sort(F.collect_list(entry)).alias("_t"))
            .select(*self.series, F.transform("_t", lambda e: e["v"]).alias("tail"), F.transform("_t", lambda e: e["x"]).alias("drivers"))
        )

    def forecast(self, horizon: int, confidence: float = 0.95, future: DataFrame | None = None) -> DataFrame:
        """Recursive h-step forecasts: (series, step, yhat, std, lower, upper).

        With exogenous columns ``future`` holds their values per series and step 1..horizon.
        """
        if bool(self.exog) != (future is not None):
            raise ValueError("future values are needed exactly when the model has exogenous columns")
        z = float(_normal_quantile((1 + confidence) / 2))
        order, keys = self.order, list(self.series)
        joined = self.tails().join(self.coefs, keys)
        if future is not None:
            values = F.struct("step", F.array(*[F.col(c).cast("double") for c in self.exog]).alias("x"))
            ahead = future.filter(F.col("step").between(1, horizon)).groupBy(*keys).agg(F.array_sort(F.collect_list(values)).alias("_f"))
            joined = joined.join(ahead.select(*keys, F.transform("_f", lambda e: e["x"]).alias("ahead")), keys)
        fields = [joined.schema[c] for c in keys]
        out_schema = T.StructType(
            fields + [T.StructField("step", T.IntegerType())] + [T.StructField(c, T.DoubleType()) for c in ("yhat", "std", "lower", "upper")]
        )

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield _forecast_batch(pdf, keys, order, horizon, z)

        return joined.mapInPandas(run, out_schema)


def _normal_quantile(p: float) -> float:
    from statistics import NormalDist

    return NormalDist().inv_cdf(p)


def fit_arima(
    df: DataFrame,
    series: Sequence[str],
    order_by: Sequence[str],
    y: str,
    order: ArimaOrder = ArimaOrder(),
    layout: Layout | None = None,
    exog: Sequence[str] = (),
) -> ArimaFit:
    """Fit one model per series. ``exog`` columns enter as regressors, differenced like the target.
    Rows without a target are left out."""
    series, order_by, exog = tuple(series), tuple(order_by), tuple(exog)
    rows = df.select(
        *series, *[c for c in order_by if c not in series], F.col(y).cast("double").alias(y), *[F.col(c).cast("double").alias(c) for c in exog]
    ).filter(F.col(y).isNotNull() & ~F.isnan(y))
    layout = layout or plan_layout(rows, series, order_by, reach=order.reach)
    split = layout.cuts is not None
    w = layout.window()
    lags = sorted({*order.ar_lags, *order.long_lags})
    columns = {"_w": lagged_sum(y, order.weights, w)}
    columns |= {f"_x{k}": lagged_sum(y, order.weights, w, k) for k in lags}
    columns |= {f"_z{i}": lagged_sum(c, order.weights, w) for i, c in enumerate(exog)}
    columns |= {"_f0": lagged_sum(y, {0: 1.0, 1: -1.0}, w), "_f1": lagged_sum(y, {0: 1.0, 1: -1.0}, w, 1)}
    table = layout.spread(rows, copies=split).withColumns(columns)
    own = (lambda t: t.filter(~F.col(COPY))) if split else (lambda t: t)
    pair = F.col("_f0").isNotNull() & F.col("_f1").isNotNull()
    fallback = [
        F.try_divide(F.sum(F.when(pair, F.col("_f0") * F.col("_f1"))), F.sum(F.when(pair, F.col("_f1") * F.col("_f1")))).alias("fb_phi"),
        F.avg(F.when(pair, F.col("_f0") * F.col("_f0"))).alias("fb_var"),
    ]

    xs = [f"_x{k}" for k in order.ar_lags]
    zs = [f"_z{i}" for i in range(len(exog))]
    if order.ma_lags:
        long_xs = [f"_x{k}" for k in order.long_lags] + zs
        stage1 = settled(
            fit_linear(own(table), series, "_w", long_xs, intercept=order.trend).select(
                *series, F.col("coef").alias("long_coef"), F.col("intercept").alias("long_intercept")
            ),
            "long-ar",
        )
        fitted = F.col("long_intercept")
        for i, x in enumerate(long_xs):
            fitted = fitted + F.col("long_coef")[i] * F.col(x)
        table = layout.attach(table, stage1, "left").withColumn("_e", F.col("_w") - fitted)
        w = layout.window()
        table = table.withColumns({f"_e{k}": F.lag("_e", k).over(w) for k in order.ma_lags})
        xs += [f"_e{k}" for k in order.ma_lags] + zs
        coefs = fit_linear(own(table), series, "_w", xs, intercept=order.trend, extra=fallback).join(stage1, list(series), "left")
    else:
        coefs = fit_linear(own(table), series, "_w", xs + zs, intercept=order.trend, extra=fallback).withColumns(
            {"long_coef": F.array().cast("array<double>"), "long_intercept": F.lit(0.0)}
        )
    return ArimaFit(order, series, order_by, y, settled(coefs, "arima-coefs"), rows, exog)


def _forecast_batch(pdf: pd.DataFrame, keys: list[str], order: ArimaOrder, horizon: int, z: float) -> pd.DataFrame:
    need = max(order.weights) + max(order.ar_lags, default=0)
    lengths = pdf["tail"].map(len).to_numpy()
    finite = pdf["tail"].map(lambda t: bool(np.isfinite(np.asarray(t, float)).all())).to_numpy()
    main = pdf["ok"].to_numpy(bool) & (lengths >= order.reach) & finite & (lengths >= need)
    parts = []
    if main.any():
        parts.append(_recurse(pdf[main], keys, order, horizon, z))
    if (~main).any():
        rest = pdf[~main].copy()
        rest["tail"] = [np.r_[[0.0] * max(0, 3 - len(t)), t][-3:] if len(t) else np.zeros(3) for t in (np.asarray(v, float) for v in rest["tail"])]
        rest["tail"] = rest["tail"].map(lambda t: np.nan_to_num(t))
        phi = np.where(rest["tail"].map(len).to_numpy() >= 3, rest["fb_phi"].to_numpy(float), 0.0)
        rest["coef"] = [np.array([v]) for v in np.nan_to_num(phi)]
        rest["intercept"], rest["long_coef"], rest["long_intercept"] = 0.0, [np.zeros(0)] * len(rest), 0.0
        rest = rest.drop(columns=[c for c in ("ahead",) if c in rest])
        rest["rss"], rest["n"] = np.nan_to_num(rest["fb_var"].to_numpy(float)), 1
        parts.append(_recurse(rest, keys, ArimaOrder(1, 1, 0), horizon, z))
    return pd.concat(parts, ignore_index=True)


def _recurse(pdf: pd.DataFrame, keys: list[str], order: ArimaOrder, horizon: int, z: float) -> pd.DataFrame:
    """All series of the batch advance together, one step at a time."""
    size = 3 if order == ArimaOrder(1, 1, 0) and len(pdf["tail"].iloc[0]) == 3 else order.reach
    y = np.stack([np.asarray(t, float)[-size:] for t in pdf["tail"]])
    coef = np.stack([np.asarray(c, float) for c in pdf["coef"]])
    const = pdf["intercept"].to_numpy(float)
    n_ar, n_ma = len(order.ar_lags), len(order.ma_lags)
    phi, theta, gamma = coef[:, :n_ar], coef[:, n_ar : n_ar + n_ma], coef[:, n_ar + n_ma :]
    lag0 = max(order.weights)

    def differenced(values: np.ndarray) -> np.ndarray:
        out = np.zeros((values.shape[0], values.shape[1] - lag0, *values.shape[2:]))
        for k, c in order.weights.items():
            out += c * values[:, lag0 - k : values.shape[1] - k]
        return out

    w = differenced(y)
    n_past = w.shape[1]
    drivers = np.zeros((len(pdf), n_past + horizon, 0))
    if "ahead" in pdf:
        past = np.stack([np.stack([np.asarray(x, float) for x in d])[-size:] for d in pdf["drivers"]])
        ahead = np.stack([np.stack([np.asarray(x, float) for x in d]) for d in pdf["ahead"]])
        drivers = differenced(np.concatenate([past, ahead], axis=1))
    e = np.zeros_like(w)
    if order.ma_lags:
        long = np.stack([np.asarray(c, float) for c in pdf["long_coef"]])
        start = max(order.long_lags)
        fit = np.repeat(pdf["long_intercept"].to_numpy(float)[:, None], w.shape[1] - start, axis=1)
        for i, k in enumerate(order.long_lags):
            fit += long[:, [i]] * w[:, start - k : w.shape[1] - k]
        fit += np.einsum("gtk,gk->gt", drivers[:, start:n_past], long[:, len(order.long_lags) :])
        e[:, start:] = w[:, start:] - fit

    future = []
    for h in range(horizon):
        step = const + (gamma * drivers[:, n_past + h]).sum(axis=1)
        for i, k in enumerate(order.ar_lags):
            step = step + phi[:, i] * w[:, -k]
        for i, k in enumerate(order.ma_lags):
            step = step + theta[:, i] * e[:, -k]
        nxt = step.copy()
        for k, c in order.weights.items():
            if k:
                nxt -= c * y[:, -k]
        w, e, y = np.c_[w, step], np.c_[e, np.zeros(len(pdf))], np.c_[y, nxt]
        future.append(nxt)
    yhat = np.stack(future, axis=1)

    # shock weights of the integrated process
    ar = np.zeros((len(pdf), max(order.ar_lags, default=0) + 1))
    ar[:, 0] = 1.0
    for i, k in enumerate(order.ar_lags):
        ar[:, k] = -phi[:, i]
    full = np.zeros((len(pdf), ar.shape[1] + lag0))
    for k, c in order.weights.items():
        full[:, k : k + ar.shape[1]] += c * ar
    psi = np.zeros((len(pdf), horizon))
    psi[:, 0] = 1.0
    for j in range(1, horizon):
        for k in range(1, min(j, full.shape[1] - 1) + 1):
            psi[:, j] -= full[:, k] * psi[:, j - k]
        if j in order.ma_lags:
            psi[:, j] += theta[:, order.ma_lags.index(j)]
    sigma2 = pdf["rss"].to_numpy(float) / np.maximum(pdf["n"].to_numpy(float), 1)
    std = np.sqrt(sigma2[:, None] * np.cumsum(psi**2, axis=1))

    out = {k: np.repeat(pdf[k].to_numpy(), horizon) for k in keys}
    out["step"] = np.tile(np.arange(1, horizon + 1, dtype="int32"), len(pdf))
    out["yhat"], out["std"] = yhat.ravel(), std.ravel()
    out["lower"], out["upper"] = (yhat - z * std).ravel(), (yhat + z * std).ravel()
    return pd.DataFrame(out)
