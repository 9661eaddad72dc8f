"""Prediction intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rhythmica.functions.metrics import quantile_levels
from rhythmica.operators.joins import join_per_group
from rhythmica.operators.quantiles import exact_quantiles


def spread_interval(df: DataFrame, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Forecast +- 1.96 population deviations of the forecasts, over the table or per group.

    The deviations are one aggregate; per group they come back by an equi-join.
    """
    half = F.lit(1.96) * F.col("_sd")
    if by:
        out = join_per_group(df, df.groupBy(*by).agg(F.stddev_pop(p).alias("_sd")), by)
    else:
        out = df.withColumn("_sd", df.agg(F.stddev_pop(p)).scalar())
    return out.withColumns({"lower": F.col(p) - half, "upper": F.col(p) + half}).drop("_sd")


def residual_quantiles(df: DataFrame, y: str, p: str, by: Sequence[str], confidence: float = 0.95) -> DataFrame:
    """Exact residual quantiles per group at the two ends of the confidence band."""
    low, high = quantile_levels(confidence)
    residuals = df.select(*by, (F.col(y) - F.col(p)).alias("_r"))
    return exact_quantiles(residuals, by, "_r", [low, 0.5, high], ["q_low", "q_mid", "q_high"])


def residual_interval(df: DataFrame, history: DataFrame, y: str, p: str, by: Sequence[str], confidence: float = 0.95) -> DataFrame:
    """Forecast plus residual quantiles measured on a table of past forecasts."""
    bands = residual_quantiles(history, y, p, by, confidence)
    return join_per_group(df, bands, by, "left").withColumns(
        {"lower": F.col(p) + F.col("q_low"), "upper": F.col(p) + F.col("q_high")}
    ).drop("q_low", "q_mid", "q_high")


def std_from_interval(lower: str, upper: str):
    """Deviation implied by a 95 % interval."""
    return (F.col(upper) - F.col(lower)) / (2 * 1.96)
