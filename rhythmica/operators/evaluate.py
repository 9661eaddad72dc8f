"""Scoring of stored forecasts: many metrics, any grouping, one pass."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from rhythmica.functions import metrics as M
from rhythmica.operators.features import lagged_sum, nth_difference
from rhythmica.operators.joins import join_same
from rhythmica.operators.layout import Layout, with_windows


def score(
    df: DataFrame,
    y: str = "y_true",
    p: str = "y_pred",
    by: Sequence[str] = (),
    metrics: dict[str, M.Metric] | None = None,
    extra: Sequence[Column] = (),
    prefix: str = "",
) -> DataFrame:
    """One row per group with one column per metric. A global call on an empty table is an error."""
    columns = [*M.collect_metrics(y, p, metrics, prefix), *extra]
    if by:
        return df.groupBy(*by).agg(*columns)
    if df.isEmpty():
        raise ValueError("no rows to score")
    return df.agg(*columns)


def score_or_null(df: DataFrame, y: str, p: str, metrics: dict[str, M.Metric]) -> dict[str, float | None]:
    """Scores as a plain dict; a metric that fails becomes null and the others still count."""
    good = {}
    out: dict[str, float | None] = {}
    for name, build in metrics.items():
        try:
            column = build(F.col(y), F.col(p)).cast("double")
            df.agg(column)  # analysed, not run
            good[name] = column
        except Exception:
            out[name] = None
    if good:
        row = df.agg(*[c.alias(n) for n, c in good.items()]).first()
        out.update(row.asDict())
    return {n: out[n] for n in metrics}


class Steps(NamedTuple):
    """A user metric for groups of any size: ``partial`` turns some rows (y_true, y_pred) into a few numbers,
    ``merge`` joins two such lists, ``finish`` gives the score."""

    partial: Callable[[pd.Series, pd.Series], Sequence[float]]
    merge: Callable[[Sequence[float], Sequence[float]], Sequence[float]]
    finish: Callable[[Sequence[float]], float]


# groups whose partial results a task holds before it passes them on
HELD_GROUPS = 10_000


def score_steps(df: DataFrame, y: str, p: str, by: Sequence[str], metrics: dict[str, Steps]) -> DataFrame:
    """User metrics in steps: partial results per batch and task, merged per group. No task holds a group's rows."""
    steps, keys = list(metrics.values()), df.select(*by).schema
    kinds = to_arrow_schema(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def rows():
            columns = [pa.array([k[i] for k in held], kinds.field(i).type) for i in range(len(by))]
            columns += [pa.array([s[i] for s in held.values()], pa.list_(pa.float64())) for i in range(len(steps))]
            return pa.RecordBatch.from_arrays(columns, [*by, *[f"_s{i}" for i in range(len(steps))]])

        for batch in batches:
            places: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*[c.to_pylist() for c in batch.columns[:-2]], strict=True) if by else [()] * batch.num_rows):
                places.setdefault(key, []).append(i)
            true, guess = (pd.Series(c.to_numpy(zero_copy_only=False), dtype="float64") for c in batch.columns[-2:])
            for key, at in places.items():
                a, b = true.iloc[at].reset_index(drop=True), guess.iloc[at].reset_index(drop=True)
                now = [[float(x) for x in s.partial(a, b)] for s in steps]
                held[key] = [s.merge(x, z) for s, x, z in zip(steps, held[key], now, strict=True)] if key in held else now
            if len(held) > HELD_GROUPS:
                yield rows()
                held = {}
        if held:
            yield rows()

    def merged(step: Steps, name: str):
        @F.pandas_udf("double")
        def finish(states: pd.Series) -> float:
            return float(step.finish(reduce(step.merge, states))) if len(states) else float("nan")

        return finish(F.col(name))

    schema = StructType([*keys.fields, *[StructField(f"_s{i}", ArrayType(DoubleType())) for i in range(len(steps))]])
    parts = df.select(*by, F.col(y).cast("double").alias("_y"), F.col(p).cast("double").alias("_p")).mapInArrow(run, schema)
    return parts.groupBy(*by).agg(*[merged(s, f"_s{i}").alias(n) for i, (n, s) in enumerate(metrics.items())])


def score_python(
    df: DataFrame, y: str, p: str, by: Sequence[str], metrics: dict[str, Callable[[pd.Series, pd.Series], float] | Steps], max_rows: int = 1_000_000
) -> DataFrame:
    """User metrics in Python: as ``Steps`` for groups of any size, or as plain (y_true, y_pred) -> float functions.

    A plain function needs its whole group in memory in one call, so the group sizes are checked first;
    larger groups need ``Steps`` or a column expression (medians: ``operators.quantiles``).
    """
    plain = {n: m for n, m in metrics.items() if not isinstance(m, Steps)}
    steps = {n: m for n, m in metrics.items() if isinstance(m, Steps)}
    if steps and not plain:
        return score_steps(df, y, p, by, steps)
    largest = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest > max_rows:
        raise ValueError(f"a group has {largest} rows, more than {max_rows}: write the metric as Steps or as a column expression")

    def wrap(fn):
        @F.pandas_udf("double")
        def run(a: pd.Series, b: pd.Series) -> float:
            return float(fn(a, b))

        return run(F.col(y).cast("double"), F.col(p).cast("double"))

    out = df.groupBy(*by).agg(*[wrap(fn).alias(name) for name, fn in plain.items()])
    if not steps:
        return out
    other = score_steps(df, y, p, by, steps).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], *steps)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)], F.lit(True))
    return out.join(other, same).select(*by, *metrics)


def directional_accuracy(
    df: DataFrame, y: str, p: str, series: Sequence[str], order_by: Sequence[str], by: Sequence[str] | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """Percent of steps whose direction was forecast right; null for fewer than two rows."""
    steps = with_windows(
        df.select(*dict.fromkeys([*series, *(by or ()), *order_by, y, p])),
        series,
        order_by,
        lambda w: {"_dy": lagged_sum(y, {0: 1.0, 1: -1.0}, w), "_dp": lagged_sum(p, {0: 1.0, 1: -1.0}, w)},
        1,
        layout,
    )
    hit = F.when(F.col("_dy").isNotNull() & F.col("_dp").isNotNull(), ((F.col("_dy") > 0) == (F.col("_dp") > 0)).cast("int"))
    column = (100 * F.avg(hit)).alias("directional_accuracy")
    groups = series if by is None else by
    return steps.groupBy(*groups).agg(column) if groups else steps.agg(column)


def mase(
    test: DataFrame,
    train: DataFrame,
    y: str,
    p: str,
    series: Sequence[str],
    order_by: Sequence[str],
    season: int = 1,
    variant: str = "nth_diff",
    layout: Layout | None = None,
) -> DataFrame:
    """Mean absolute error over the mean absolute naive step of the training part.

    ``nth_diff`` differences the training series ``season`` times, ``seasonal`` takes the lag-season
    difference. A zero denominator gives null.
    """
    if variant not in ("nth_diff", "seasonal"):
        raise ValueError(f"unknown variant {variant!r}")
    if variant == "nth_diff":
        step = lambda w: {"_d": nth_difference(y, season, w)}
    else:
        step = lambda w: {"_d": lagged_sum(y, {0: 1.0, season: -1.0}, w)}
    moved = with_windows(train.select(*dict.fromkeys([*series, *order_by, y])), series, order_by, step, season, layout)
    naive = F.avg(F.abs("_d")).alias("_naive")
    error = M.mae(y, p).alias("_mae")
    if not series:
        return test.agg(error).withColumn("_naive", moved.agg(naive).scalar()).select(
            F.try_divide("_mae", "_naive").alias("mase")
        )
    scale = moved.groupBy(*series).agg(naive)
    return join_same(test.groupBy(*series).agg(error), scale, series).select(*series, F.try_divide("_mae", "_naive").alias("mase"))
