"""Seasonal naive forecasts and simple exponential smoothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rhythmica.operators.layout import Layout, with_position, with_windows


def seasonal_naive(
    df: DataFrame, series: Sequence[str], order_by: Sequence[str], y: str, season: int, name: str = "yhat", layout: Layout | None = None
) -> DataFrame:
    """In-sample forecast: the value one season earlier."""
    return with_windows(df, series, order_by, lambda w: {name: F.lag(y, season).over(w)}, season, layout)


def exponential_level(
    df: DataFrame, series: Sequence[str], order_by: Sequence[str], y: str, alpha: float, name: str = "level", layout: Layout | None = None
) -> DataFrame:
    """The final level of l[t] = alpha y[t] + (1 - alpha) l[t-1], l[0] = y[0]: the flat forecast.

    Rows without a value are left out before they are numbered. Unrolled, the level is a weighted sum of the values, so it is a plain aggregate over positions
    and long series are summed in parts.
    """
    known = df.select(*dict.fromkeys([*series, *order_by, y])).filter(F.col(y).isNotNull() & ~F.isnan(F.col(y).cast("double")))
    rows = with_position(known, series, order_by, "_pos", "_n", layout)
    age = F.col("_n") - 1 - F.col("_pos")
    share = F.when(F.col("_pos") == 0, F.lit(1.0)).otherwise(F.lit(float(alpha)))
    weighted = share * F.pow(F.lit(1.0 - alpha), age.cast("double")) * F.col(y)
    return rows.groupBy(*series).agg(F.sum(weighted).alias(name), F.max("_n").alias("n"))
