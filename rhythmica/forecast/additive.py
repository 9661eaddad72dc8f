"""Additive per-series model: piecewise linear trend, Fourier seasonalities and regressors.

Fitted by ridge regression. Each block of a series adds up its Gram matrix batch by batch, the blocks
of a series are summed and solved, so no task holds more than one Arrow batch and a few matrices.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rhythmica.functions.metrics import quantile_levels
from rhythmica.operators.joins import join_per_group
from rhythmica.operators.layout import BEFORE, BLOCK, TOTAL, Layout, plan_layout
from rhythmica.operators.quantiles import exact_quantiles
from rhythmica.session import settled

# Seconds per seasonal period
YEAR, WEEK, DAY = 365.25 * 86400, 7 * 86400.0, 86400.0


@dataclass(frozen=True)
class AdditiveSpec:
    changepoints: int = 25
    changepoint_range: float = 0.8
    yearly_order: int = 10
    weekly_order: int = 3
    daily_order: int = 0
    regressors: tuple[str, ...] = ()
    changepoint_scale: float = 0.05
    seasonality_scale: float = 10.0

    @property
    def hinges(self) -> int:
        return self.changepoints

    @property
    def width(self) -> int:
        return 2 + self.hinges + 2 * (self.yearly_order + self.weekly_order + self.daily_order) + len(self.regressors)

    def basis(self, seconds: np.ndarray, start: np.ndarray, length: np.ndarray, regressors: np.ndarray) -> np.ndarray:
        t = (seconds - start) / np.where(length > 0, length, 1.0)
        knots = np.linspace(0, self.changepoint_range, self.hinges + 1)[1:]
        parts = [np.ones((len(t), 1)), t[:, None], np.maximum(t[:, None] - knots[None, :], 0.0)]
        for period, order in ((YEAR, self.yearly_order), (WEEK, self.weekly_order), (DAY, self.daily_order)):
            if order:
                angle = 2 * np.pi * seconds[:, None] / period * np.arange(1, order + 1)[None, :]
                parts += [np.sin(angle), np.cos(angle)]
        return np.concatenate([*parts, regressors], axis=1)

    def penalty(self) -> np.ndarray:
        out = np.full(self.width, 1.0 / self.seasonality_scale**2)
        out[:2] = 1e-9
        out[2 : 2 + self.hinges] = 1.0 / self.changepoint_scale
        return out


@dataclass
class AdditiveModel:
    series: Sequence[str]
    order_by: Sequence[str]
    ts: str
    y: str
    spec: AdditiveSpec = field(default_factory=AdditiveSpec)
    interval_width: float = 0.8
    coefs: DataFrame | None = None  # series, start, length, scale, beta, n
    bands: DataFrame | None = None  # series, q_low, q_high

    def _rows(self, df: DataFrame, with_y: bool = True) -> DataFrame:
        seconds = (F.unix_micros(F.col(self.ts).cast("timestamp")) / 1e6).alias("_sec")
        regs = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_r{i}") for i, c in enumerate(self.spec.regressors)]
        target = [F.col(self.y).cast("double").alias("_y")] if with_y else []
        return df.select("*", seconds, *regs, *target)

    def fit(self, df: DataFrame, layout: Layout | None = None) -> AdditiveModel:
        keys, spec = list(self.series), self.spec
        rows = self._rows(df).select(*dict.fromkeys([*keys, *self.order_by]), "_sec", "_y", *[f"_r{i}" for i in range(len(spec.regressors))])
        rows = rows.filter(F.col("_y").isNotNull() & ~F.isnan("_y"))
        layout = layout or plan_layout(rows, keys, self.order_by)
        stats = rows.groupBy(*keys).agg(
            F.min("_sec").alias("start"), (F.max("_sec") - F.min("_sec")).alias("length"), F.max(F.abs("_y")).alias("scale")
        )
        tagged = layout.attach(layout.spread(rows), stats).drop(BEFORE, TOTAL)
        key_fields = [tagged.schema[c] for c in keys]
        numbers = [T.StructField(c, T.DoubleType()) for c in ("start", "length", "scale")]
        partial_schema = T.StructType([*key_fields, *numbers, T.StructField("n", T.LongType()), T.StructField("gram", T.ArrayType(T.DoubleType()))])
        fit_schema = T.StructType([*key_fields, *numbers, T.StructField("n", T.LongType()), T.StructField("beta", T.ArrayType(T.DoubleType()))])
        reg_names = [f"_r{i}" for i in range(len(spec.regressors))]

        def block_gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, n, head = np.zeros((spec.width + 1, spec.width + 1)), 0, None
            for pdf in batches:
                if not len(pdf):
                    continue
                head = pdf.iloc[[0]]
                scale = pdf["scale"].to_numpy(float)
                x = spec.basis(*(pdf[c].to_numpy(float) for c in ("_sec", "start", "length")), pdf[reg_names].to_numpy(float))
                full = np.c_[x, pdf["_y"].to_numpy(float) / np.where(scale > 0, scale, 1.0)]
                total += full.T @ full
                n += len(pdf)
            if head is not None:
                yield head[[*keys, "start", "length", "scale"]].assign(n=n, gram=[total.ravel()])

        def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, n, head = 0.0, 0, None
            for pdf in batches:
                for g, k in zip(pdf["gram"], pdf["n"], strict=True):
                    total = total + np.asarray(g, float)
                    n += int(k)
                head = pdf.iloc[[0]] if len(pdf) else head
            gram = np.asarray(total).reshape(spec.width + 1, spec.width + 1)
            beta = np.linalg.solve(gram[:-1, :-1] + np.diag(spec.penalty()), gram[:-1, -1])
            yield head[[*keys, "start", "length", "scale"]].assign(n=n, beta=[beta])

        grams = tagged.groupBy(*keys, BLOCK).applyInPandas(block_gram, partial_schema)
        self.coefs = settled(grams.groupBy(*keys).applyInPandas(solve, fit_schema), "additive")
        low, high = quantile_levels(self.interval_width)
        residuals = self._apply(layout.attach(layout.spread(rows), self.coefs).drop(BEFORE, TOTAL)).select(
            *keys, (F.col("_y") - F.col("yhat")).alias("_res")
        )
        self.bands = settled(exact_quantiles(residuals, keys, "_res", [low, high], ["q_low", "q_high"]), "additive-bands")
        return self

    def _apply(self, joined: DataFrame) -> DataFrame:
        spec = self.spec
        reg_names = [f"_r{i}" for i in range(len(spec.regressors))]

        @F.pandas_udf("double")
        def evaluate(sec: pd.Series, start: pd.Series, length: pd.Series, scale: pd.Series, beta: pd.Series, *regs: pd.Series) -> pd.Series:
            if not len(sec):
                return pd.Series([], dtype=float)
            r = np.stack([x.to_numpy(float) for x in regs], axis=1) if regs else np.zeros((len(sec), 0))
            x = spec.basis(sec.to_numpy(float), start.to_numpy(float), length.to_numpy(float), r)
            s = scale.to_numpy(float)
            return pd.Series((x * np.stack(beta.to_numpy())).sum(axis=1) * np.where(s > 0, s, 1.0))

        return joined.withColumn("yhat", evaluate("_sec", "start", "length", "scale", "beta", *reg_names))

    def predict(self, df: DataFrame) -> DataFrame:
        """``yhat`` with ``yhat_lower`` / ``yhat_upper`` for rows with a series key, a time and the regressors."""
        if self.coefs is None:
            raise ValueError("fit the model first")
        keys = list(self.series)
        rows = join_per_group(self._rows(df, with_y=False), self.coefs.drop("n").join(self.bands, keys, "left"), keys)
        out = self._apply(rows).withColumns({"yhat_lower": F.col("yhat") + F.col("q_low"), "yhat_upper": F.col("yhat") + F.col("q_high")})
        return out.select(*df.columns, "yhat", "yhat_lower", "yhat_upper")
