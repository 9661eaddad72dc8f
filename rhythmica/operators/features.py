"""Backward-looking features: lags, trailing means and deviations, seasonal differences."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from rhythmica.functions import calendar, cleaning
from rhythmica.operators.joins import join_per_group
from rhythmica.operators.layout import Layout, with_windows

# Defaults when no list is given
DEFAULT_LAGS = (1, 7, 14)
DEFAULT_WINDOWS = (7, 30)


def history_columns(target: str, lags: Sequence[int], windows: Sequence[int], suffix: str = ""):
    """A column builder for ``with_windows`` and the number of rows it looks back."""

    def build(w: WindowSpec) -> dict[str, Column]:
        out = {f"{target}_lag_{k}{suffix}": F.lag(target, k).over(w) for k in lags}
        for n in windows:
            trailing = w.rowsBetween(-n, -1)
            out[f"{target}_rolling_mean_{n}{suffix}"] = F.avg(target).over(trailing)
            out[f"{target}_rolling_std_{n}{suffix}"] = F.stddev_samp(target).over(trailing)
        return out

    return build, max([*lags, *windows], default=0)


def add_history(
    df: DataFrame,
    target: str,
    order_by: Sequence[str],
    groups: Sequence[str] = (),
    lags: Sequence[int] | None = None,
    windows: Sequence[int] | None = None,
    mode: str = "each",
    layout: Layout | None = None,
) -> DataFrame:
    """Lags and trailing mean / standard deviation that exclude the current row.

    ``mode="each"`` treats every group column as a series key of its own and puts its name into the
    feature name; ``mode="composite"`` uses all of them as one key. ``None`` means the default lags
    and windows, ``[]`` means none.
    """
    lags = DEFAULT_LAGS if lags is None else lags
    windows = DEFAULT_WINDOWS if windows is None else windows
    if not lags and not windows:
        return df
    if mode == "each" and groups:
        keys = [((g,), f"_{g}") for g in groups]
    elif mode in ("each", "composite"):
        keys = [(tuple(groups), "")]
    else:
        raise ValueError(f"unknown mode {mode!r}")
    if layout is not None and len(keys) > 1:
        raise ValueError("a layout describes one series key; with several group columns leave it out")
    for series, suffix in keys:
        build, reach = history_columns(target, lags, windows, suffix)
        df = with_windows(df, series, order_by, build, reach, layout)
    return df


def static_features(
    df: DataFrame,
    date: str | None = None,
    target: str | None = None,
    order_by: Sequence[str] = (),
    groups: Sequence[str] = (),
    lags: Sequence[int] | None = None,
    windows: Sequence[int] | None = None,
    date_features: bool = True,
    cyclical: Sequence[str] = (),
    fill: float | None = 0.0,
    mode: str = "each",
    layout: Layout | None = None,
) -> DataFrame:
    """Calendar parts, then lags and trailing statistics, then cyclical encodings, then fill."""
    if date and date in df.columns and date_features:
        df = calendar.add_date_features(df, date)
    if target:
        df = add_history(df, target, order_by, groups, lags, windows, mode, layout)
    if cyclical:
        df = calendar.add_cyclical(df, cyclical)
    return df if fill is None else cleaning.fill_constant(df, fill)


def difference_weights(d: int = 0, seasonal_d: int = 0, season: int = 0) -> dict[int, float]:
    """Weights of y[t-k] in (1-B)^d (1-B^s)^D y[t]."""
    poly = np.array([1.0])
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    for _ in range(seasonal_d):
        poly = np.convolve(poly, np.r_[1.0, np.zeros(season - 1), -1.0])
    return {k: float(c) for k, c in enumerate(poly) if c != 0}


def lagged_sum(y: str, weights: dict[int, float], w: WindowSpec, shift: int = 0) -> Column:
    """Sum of weighted lags; null until all of them exist."""
    terms = [F.lit(c) * (F.col(y) if k + shift == 0 else F.lag(y, k + shift).over(w)) for k, c in weights.items()]
    return sum(terms[1:], terms[0])


def nth_difference(y: str, n: int, w: WindowSpec) -> Column:
    """n times the first difference."""
    return lagged_sum(y, {k: float((-1) ** k * math.comb(n, k)) for k in range(n + 1)}, w)


def add_difference(
    df: DataFrame, y: str, series: Sequence[str], order_by: Sequence[str], d: int = 1, seasonal_d: int = 0, season: int = 0,
    name: str | None = None, layout: Layout | None = None,
) -> DataFrame:
    weights = difference_weights(d, seasonal_d, season)
    return with_windows(df, series, order_by, lambda w: {name or f"{y}_diff": lagged_sum(y, weights, w)}, max(weights), layout)


def series_with_history(df: DataFrame, series: Sequence[str], min_rows: int) -> DataFrame:
    """Rows of the series that have at least ``min_rows`` rows.

    The counts are pre-aggregated per task and come back by a join that leaves long series in place; a null
    key is a series of its own.
    """
    enough = df.groupBy(*series).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows).drop("_n")
    return join_per_group(df, enough, series, "left_semi")
