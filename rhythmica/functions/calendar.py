"""Calendar parts and cyclical encodings as plain column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted date shapes, day-first before month-first.
DATE_FORMATS = ("dd-MM-yyyy", "yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy")


def literal(value, dtype: T.DataType) -> Column:
    """A literal of a column's own type. Zone-free times go through text, so that neither the zone of
    the Python process nor that of the session can shift them."""
    if isinstance(dtype, T.TimestampNTZType) and isinstance(value, (date, datetime)):
        return F.lit(value.isoformat()).cast(dtype)
    return F.lit(value).cast(dtype)


def parse_date(col: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Day-first parsing of mixed date shapes; null when none fits."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def date_parts(day: Column | str) -> dict[str, Column]:
    """Deterministic date features; Monday is 0, weeks are ISO weeks, flags are 0/1."""
    d = F.to_date(F.col(day) if isinstance(day, str) else day)
    month_start = F.dayofmonth(d) == 1
    month_end = d == F.last_day(d)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "dayofweek": F.weekday(d),
        "quarter": F.quarter(d),
        "week": F.weekofyear(d),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
        "is_month_start": month_start.cast("int"),
        "is_month_end": month_end.cast("int"),
        "is_quarter_start": (month_start & (F.month(d) % 3 == 1)).cast("int"),
        "is_quarter_end": (month_end & (F.month(d) % 3 == 0)).cast("int"),
    }


def clock_parts(ts: Column | str) -> dict[str, Column]:
    """Further parts used by the demand tables."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return {
        "dayofyear": F.dayofyear(t),
        "hour_of_day": F.hour(t),
        "weekday": F.weekday(t),
        "week_of_year": F.weekofyear(t),
    }


def add_date_features(df: DataFrame, day: str) -> DataFrame:
    return df.withColumns(date_parts(day))


def cycle(col: Column | str, period: Column | float) -> tuple[Column, Column]:
    """Sine and cosine of the position inside a period."""
    c = F.col(col) if isinstance(col, str) else col
    p = period if isinstance(period, Column) else F.lit(float(period))
    angle = F.lit(2 * math.pi) * F.try_divide(c, p)
    return F.sin(angle), F.cos(angle)


def add_cyclical(df: DataFrame, columns: Sequence[str], period: float | None = None) -> DataFrame:
    """``{c}_sin`` and ``{c}_cos`` for every named column that exists.

    Without ``period`` each column is divided by its observed maximum: one aggregate for all columns,
    read back into the projection as a scalar subquery, so the rows are neither joined nor moved.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    new = {}
    if period is None:
        top = df.agg(F.struct(*[F.max(c).alias(c) for c in present]).alias("top")).scalar()
        df = df.withColumn("_top", top)
    for c in present:
        new[f"{c}_sin"], new[f"{c}_cos"] = cycle(c, F.col(f"_top.{c}") if period is None else period)
    return df.withColumns(new).drop("_top")
