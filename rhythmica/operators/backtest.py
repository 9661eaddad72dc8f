"""Rolling-origin evaluation of simple forecasters, all folds in one pass over the history."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rhythmica.functions.calendar import literal
from rhythmica.operators.joins import join_per_group


@dataclass(frozen=True)
class Fold:
    """History ends before ``cutoff``; rows in [cutoff, end) are forecast."""

    number: int
    cutoff: date | datetime
    end: date | datetime


def rolling_folds(last: date | datetime, n_folds: int, horizon: timedelta) -> list[Fold]:
    """The last ``n_folds`` horizons of the calendar, oldest first; ``last`` is the final observation's
    first instant after it."""
    out = []
    for k in range(n_folds):
        cutoff = last - horizon * (n_folds - k)
        out.append(Fold(k, cutoff, cutoff + horizon))
    return out


def origin_table(df: DataFrame, series: Sequence[str], order_by: Sequence[str], ts: str, y: str, folds: Sequence[Fold]) -> DataFrame:
    """One row per series and fold: last value, mean and row count of the history before the cutoff.

    The folds are conditional aggregates, so the history is read once and never copied per fold.
    """
    kind = df.schema[ts].dataType

    def known(f: Fold, c: Column) -> Column:
        return F.when(F.col(ts) < literal(f.cutoff, kind), c)

    # one order column keeps the buffers primitive, and with them the hash aggregate
    key = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)
    aggs = []
    for f in folds:
        aggs += [
            F.max_by(F.col(y), known(f, key)).alias(f"last_{f.number}"),
            F.avg(known(f, F.col(y))).alias(f"mean_{f.number}"),
            F.count(known(f, F.col(y))).alias(f"n_{f.number}"),
        ]
    wide = df.groupBy(*series).agg(*aggs)
    cells = [
        F.struct(
            F.lit(f.number).alias("fold"),
            F.col(f"last_{f.number}").alias("last_value"),
            F.col(f"mean_{f.number}").alias("mean_value"),
            F.col(f"n_{f.number}").alias("n_history"),
        )
        for f in folds
    ]
    return wide.select(*series, F.explode(F.array(*cells)).alias("e")).select(*series, "e.*")


def fold_of(df: DataFrame, ts: str, folds: Sequence[Fold]) -> Column:
    """The folds (array) whose forecast range holds the row."""
    kind = df.schema[ts].dataType

    def inside(f: Fold) -> Column:
        return (F.col(ts) >= literal(f.cutoff, kind)) & (F.col(ts) < literal(f.end, kind))

    return F.array_compact(F.array(*[F.when(inside(f), F.lit(f.number)) for f in folds]))


def backtest(
    df: DataFrame, series: Sequence[str], order_by: Sequence[str], ts: str, y: str, folds: Sequence[Fold], min_history: int = 1
) -> DataFrame:
    """Forecast rows (series, time, fold, y_true, naive, mean) for every fold."""
    origins = origin_table(df, series, order_by, ts, y, folds).filter(F.col("n_history") >= min_history)
    tested = df.withColumn("fold", F.explode(fold_of(df, ts, folds)))
    return join_per_group(tested, origins, [*series, "fold"]).select(
        *dict.fromkeys([*series, *order_by]), "fold", F.col(y).alias("y_true"), F.col("last_value").alias("naive"), F.col("mean_value").alias("history_mean")
    )
