"""What a forecaster, a scaler and a feature builder look like, and batch scoring with stored models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rhythmica.forecast.regression import predict_linear
from rhythmica.operators.joins import join_per_group


@runtime_checkable
class Forecaster(Protocol):
    def fit(self, df: DataFrame) -> Forecaster: ...

    def predict(self, df: DataFrame) -> DataFrame: ...


@runtime_checkable
class Transformer(Protocol):
    """``fit`` is optional for stateless transformers."""

    def transform(self, df: DataFrame) -> DataFrame: ...

    def inverse(self, df: DataFrame) -> DataFrame: ...


FeatureBuilder = Callable[[DataFrame], DataFrame]


def score_with_table(df: DataFrame, models: DataFrame, series: Sequence[str], xs: Sequence[str], name: str = "prediction") -> DataFrame:
    """Score rows with the linear model stored for their series (coef, intercept).

    Rows of series without a model keep a null prediction.
    """
    joined = join_per_group(df, models.select(*series, "coef", "intercept"), series, "left")
    return joined.withColumn(name, predict_linear("coef", "intercept", xs)).drop("coef", "intercept")


def future_rows(
    df: DataFrame, series: Sequence[str], ts: str, horizon: int, step: str = "1 day", covariates: dict[str, object] | None = None
) -> DataFrame:
    """``horizon`` future rows per series after its last observed time, with constant covariates."""
    last = df.groupBy(*series).agg(F.max(ts).alias("_last"))
    unit = F.expr(f"interval {step}")
    times = F.sequence(F.col("_last") + unit, F.col("_last") + unit * F.lit(horizon), unit)
    out = last.select(*series, F.posexplode(times).alias("_i", ts))
    return out.select(
        *series, (F.col("_i") + 1).alias("step"), ts, *[F.lit(v).alias(k) for k, v in (covariates or {}).items()]
    )


