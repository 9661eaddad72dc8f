"""Seasonal-trend decomposition by loess, and forecasts from it, for many series.

The inner loop smooths the values of each season slot, takes a low-pass of that away and smooths the rest
into the trend; the outer loop weighs rows down whose rest is large. Every smoother looks a fixed number
of rows to both sides, so a stretch of a series is exact if it brings enough rows along: rows are numbered,
dealt to stretches, and repeated in the neighbouring ones they can reach. No task holds more than a
stretch and its margins, and a cut series gives the values of a whole one. An outer round is one pass
over the rows, between two of them lies one exact median per series.

Rows without a value are left out before they are numbered, so a gap shortens the series. A series
shorter than two seasons has season 0; its trend is the smoothed series. trend + season + rest is the value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rhythmica.forecast.ets import EtsSpec, fit_ets
from rhythmica.operators.joins import join_per_group, join_same
from rhythmica.operators.layout import Layout, rows_per_block, with_position
from rhythmica.operators.quantiles import exact_quantiles
from rhythmica.session import settled

#: Cells of a smoother's windows that are worked on at a time.
CELLS = 4_000_000


def odd(n: float) -> int:
    """The smallest odd number that is not below ``n``."""
    n = int(np.ceil(n))
    return n + 1 - n % 2


@dataclass(frozen=True)
class StlSpec:
    """``period``: rows of a season; spans are rows (for ``seasonal``: seasons) a smoother looks at, odd."""

    period: int
    seasonal: int = 7
    trend: int | None = None
    low_pass: int | None = None
    inner: int = 2
    outer: int = 0

    @property
    def trend_span(self) -> int:
        return self.trend or odd(1.5 * self.period / (1 - 1.5 / self.seasonal))

    @property
    def low_pass_span(self) -> int:
        return self.low_pass or odd(self.period)

    @property
    def margin(self) -> int:
        """Rows to either side on which the values of a row can depend in one pass; whole spans, as windows
        at the ends of a series lie to one side."""
        return self.inner * (self.trend_span + self.low_pass_span + self.period + 2 + (self.seasonal + 1) * self.period)


def loess(y: np.ndarray, span: int, weight: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Local lines with tricube weights through the ``span`` nearest of equally spaced values, at positions ``at``."""
    n = len(y)
    at = np.arange(n) if at is None else at
    if n == 1:
        return np.full(len(at), y[0])
    size, out = min(span, n), np.empty(len(at))
    step = max(1, CELLS // size)
    for a in range(0, len(at), step):
        x = at[a : a + step].astype(float)
        first = np.clip(np.round(x).astype(np.int64) - size // 2, 0, n - size)
        window = first[:, None] + np.arange(size)
        away = window - x[:, None]
        reach = np.abs(away).max(axis=1) + max(0, span - n) / 2
        # the farthest points keep a trace of weight, as a span of two would have none
        w = np.clip(1 - (np.abs(away) / (1.001 * reach[:, None])) ** 3, 0, 1) ** 3 * weight[window]
        total = w.sum(axis=1)
        plain = total <= 1e-12  # all weighed down: without the robustness weights
        if plain.any():
            w[plain] = np.clip(1 - (np.abs(away[plain]) / (1.001 * reach[plain, None])) ** 3, 0, 1) ** 3
            total = w.sum(axis=1)
        values = y[window]
        centre, mean = (w * away).sum(axis=1) / total, (w * values).sum(axis=1) / total
        spread = (w * (away - centre[:, None]) ** 2).sum(axis=1)
        tilt = (w * (away - centre[:, None]) * values).sum(axis=1)
        slope = np.where(spread > 1e-9 * total, tilt / np.where(spread > 0, spread, 1.0), 0.0)
        out[a : a + step] = mean - slope * centre
    return out


def moving(y: np.ndarray, size: int) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(y - y.mean())])
    return (sums[size:] - sums[:-size]) / size + y.mean()


def decompose_stretch(y: np.ndarray, slot: np.ndarray, trend: np.ndarray, weight: np.ndarray, spec: StlSpec, seasonal: bool) -> tuple[np.ndarray, np.ndarray]:
    """One round of the outer loop on neighbouring rows: trend, season. ``slot`` is the place in the season."""
    n, m, season = len(y), spec.period, np.zeros(len(y))
    if not seasonal:
        return loess(y, spec.trend_span, weight), season
    for _ in range(spec.inner):
        rest, cycles = y - trend, np.zeros(n + 2 * m)
        for s in range(m):
            own = np.flatnonzero(slot == s)
            if len(own):
                at = np.arange(-1, len(own) + 1)
                cycles[np.concatenate([[own[0]], own + m, [own[-1] + 2 * m]])] = loess(rest[own], spec.seasonal, weight[own], at)
        low = loess(moving(moving(moving(cycles, m), m), 3), spec.low_pass_span, np.ones(n))
        season = cycles[m : n + m] - low
        trend = loess(y - season, spec.trend_span, weight)
    return trend, season


def decompose(df: DataFrame, series: Sequence[str], order_by: Sequence[str], y: str, spec: StlSpec, layout: Layout | None = None) -> DataFrame:
    """Rows with a value: series, order columns, value, _pos, _n (rows of the series), trend, season, rest, weight."""
    series = list(series)
    names = list(dict.fromkeys([*series, *order_by]))
    rows = df.select(*names, F.col(y).cast("double").alias(y)).filter(F.col(y).isNotNull() & ~F.isnan(y))
    zero = F.lit(0.0)
    rows = with_position(rows, series, order_by, "_pos", "_n", layout).withColumns({"trend": zero, "season": zero, "rest": zero, "weight": F.lit(1.0)})
    margin, size = spec.margin, max(rows_per_block(df), spec.margin)
    out_schema = rows.schema

    def stretch(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos", ignore_index=True)
        values, position = pdf[y].to_numpy(float), pdf["_pos"].to_numpy()
        trend, season = decompose_stretch(values, position % spec.period, pdf["trend"].to_numpy(float), pdf["weight"].to_numpy(float), spec, pdf["_n"].iloc[0] >= 2 * spec.period)
        own = position // size == pdf["_stretch"].iloc[0]
        return pdf.assign(trend=trend, season=season, rest=values - trend - season)[own][out_schema.names]

    # a row goes to its own stretch and to those that can see it
    first, last = F.greatest(F.lit(0), F.col("_pos") - margin), F.least(F.col("_n") - 1, F.col("_pos") + margin)
    places = F.sequence(F.floor(first / size), F.floor(last / size))
    for turn in range(spec.outer + 1):
        dealt = rows.withColumn("_stretch", F.explode(places))
        rows = settled(dealt.groupBy(*series, "_stretch").applyInPandas(stretch, out_schema), "stl")
        if turn < spec.outer:
            sizes = rows.select(*series, F.abs("rest").alias("_size"))
            middle = settled(exact_quantiles(sizes, series, "_size", [0.5], ["_middle"]), "stl-median")
            share = F.abs("rest") / (6 * F.col("_middle"))
            weight = F.when(F.col("_middle") <= 0, 1.0).when(share < 1, (1 - share * share) * (1 - share * share)).otherwise(0.0)
            rows = join_per_group(rows, middle, series).withColumn("weight", weight).select(*out_schema.names)
    return rows


def forecast_stl(df: DataFrame, series: Sequence[str], order_by: Sequence[str], y: str, spec: StlSpec, horizon: int, ets: EtsSpec = EtsSpec(), layout: Layout | None = None) -> DataFrame:
    """(series, step, yhat, std, lower, upper): smoothing forecasts of the series without its season, plus its last season."""
    if ets.season:
        raise ValueError("the season is taken out before smoothing")
    series = list(series)
    parts = decompose(df, series, order_by, y, spec, layout)
    ahead = fit_ets(parts.withColumn("_adjusted", F.col(y) - F.col("season")), series, order_by, "_adjusted", ets, layout).forecast(horizon)
    newest = parts.where(F.col("_pos") >= F.col("_n") - spec.period).select(*series, (F.col("_pos") - F.col("_n") + spec.period).alias("_at"), "season")
    # one row per step that repeats this place of the last season
    again = F.sequence((F.col("_at") + 1).cast("int"), F.lit(horizon), F.lit(spec.period))
    season = newest.where(F.col("_at") < horizon).select(*series, F.explode(again).alias("step"), "season")
    joined = join_same(ahead, season, [*series, "step"], "left")
    add = F.coalesce("season", F.lit(0.0))
    return joined.select(*series, "step", *[(F.col(c) + add).alias(c) if c != "std" else F.col(c) for c in ("yhat", "std", "lower", "upper")])
