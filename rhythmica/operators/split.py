"""Chronological train / validation / test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rhythmica.functions.calendar import literal
from rhythmica.operators.layout import Layout, keys_at, plan_layout, with_position


def split_points(n: int, train: float, validation: float) -> tuple[int, int]:
    """First validation row and first test row of n ordered rows."""
    return int(n * train), int(n * (train + validation))


def temporal_split(
    df: DataFrame, order_by: Sequence[str], train: float = 0.7, validation: float = 0.15, name: str = "split"
) -> DataFrame:
    """Tag each row of the whole table by its place in time.

    Only the two order keys at the cut points are looked up; the rows themselves are then tagged by
    comparison with them, without a shuffle.
    """
    at_val, at_test = keys_at(df, order_by, lambda n: split_points(n, train, validation))
    test_or_later = _at_or_after(df, order_by, at_test)
    val_or_later = _at_or_after(df, order_by, at_val)
    return df.withColumn(name, F.when(test_or_later, "test").when(val_or_later, "val").otherwise("train"))


def _at_or_after(df: DataFrame, order_by: Sequence[str], key: dict | None) -> Column:
    """Lexicographic comparison of the order columns with a key; rows before it are false or null."""
    if key is None:
        return F.lit(False)
    bound = {c: literal(key[c], df.schema[c].dataType) for c in order_by}
    *front, last = order_by
    cond = F.col(last) >= bound[last]
    for c in reversed(front):
        cond = (F.col(c) > bound[c]) | ((F.col(c) == bound[c]) & cond)
    return cond


def series_split(
    df: DataFrame,
    series: Sequence[str],
    order_by: Sequence[str],
    train: float = 0.7,
    validation: float = 0.15,
    name: str = "split",
    layout: Layout | None = None,
) -> DataFrame:
    """Tag rows by their place inside their own series."""
    out = with_position(df, series, order_by, "_pos", "_n", layout)
    first_val = F.floor(F.col("_n") * F.lit(float(train)))
    first_test = F.floor(F.col("_n") * F.lit(float(train + validation)))
    return out.withColumn(
        name, F.when(F.col("_pos") < first_val, "train").when(F.col("_pos") < first_test, "val").otherwise("test")
    ).drop("_pos", "_n")


def horizon_split(
    df: DataFrame,
    series: Sequence[str],
    order_by: Sequence[str],
    test_rows: int,
    validation_rows: int,
    min_train_rows: int = 0,
    name: str = "split",
    layout: Layout | None = None,
) -> DataFrame:
    """The last rows of each series are test, the ones before validation; series with too little
    training history are left out."""
    out = with_position(df, series, order_by, "_pos", "_n", layout or plan_layout(df, series, order_by))
    left = F.col("_n") - F.col("_pos")  # 1 for the last row
    return (
        out.filter(F.col("_n") - test_rows - validation_rows >= min_train_rows)
        .withColumn(name, F.when(left <= test_rows, "test").when(left <= test_rows + validation_rows, "val").otherwise("train"))
        .drop("_pos", "_n")
    )
