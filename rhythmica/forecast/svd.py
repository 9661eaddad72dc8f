"""Truncated singular value decomposition of a panel: few time courses that many series share.

Per group, the matrix of series by periods is reduced to its ``rank`` strongest components. Tasks add the
products of their series' rows to a matrix of periods by periods; the sums of a group are decomposed in one
task, whose size is the calendar's, not the data's: periods squared. A group of many series is spread over
tasks by a hash of the series; nothing comes to the driver. The components are forecast by exponential
smoothing and projected back, or the rebuilt rows - the panel without what the components do not explain -
are handed to any other forecaster.

Defined results: rows without a target or a period are left out; repeated (series, period) rows count with
their mean; a missing cell counts as the mean of its series (``center``) or as zero; a null series or group key is
a key of its own; components have their largest entry positive; the rank is cut to the number of periods,
and components of no weight are zero. An empty table gives empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rhythmica.forecast.ets import EtsSpec, fit_ets
from rhythmica.operators.joins import join_per_group, join_same
from rhythmica.operators.layout import Layout
from rhythmica.session import settled

#: Series whose products one task adds up.
SERIES_PER_TASK = 4096
#: Components lighter than this share of the strongest one are rounding.
NOISE = 1e-10
DOUBLES = T.ArrayType(T.DoubleType())


@dataclass(frozen=True)
class SvdFit:
    groups: tuple[str, ...]
    series: tuple[str, ...]
    period: str
    rank: int
    calendar: DataFrame  # groups, period, _i, _n
    vectors: DataFrame  # groups, series, mean, n_obs, x
    components: DataFrame  # groups, weights (singular values), v: rank courses one after the other

    def scores(self) -> DataFrame:
        """One row per series: mean, observed periods, its score on each component, and the courses."""
        joined = join_per_group(self.vectors, self.components, self.groups, "inner")
        schema = T.StructType([*[joined.schema[c] for c in (*self.groups, *self.series, "mean", "n_obs", "v")], T.StructField("score", DOUBLES)])
        rank = self.rank

        def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                pdf["score"] = [np.asarray(v).reshape(rank, -1) @ np.asarray(x) for x, v in zip(pdf["x"], pdf["v"], strict=True)]
                yield pdf[schema.names]

        return joined.mapInPandas(project, schema)

    def rebuild(self) -> DataFrame:
        """The panel from its components, a row for every series and period of its group: (groups, series, period, fitted)."""
        scores, rank = self.scores(), self.rank
        schema = T.StructType([*[scores.schema[c] for c in (*self.groups, *self.series)], T.StructField("x", DOUBLES)])

        def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                pdf["x"] = [m + np.asarray(s) @ np.asarray(v).reshape(rank, -1) for m, s, v in zip(pdf["mean"], pdf["score"], pdf["v"], strict=True)]
                yield pdf[schema.names]

        cells = scores.mapInPandas(multiply, schema).select(*self.groups, *self.series, F.posexplode("x").alias("_i", "fitted"))
        return join_same(cells, self.calendar.drop("_n"), [*self.groups, "_i"]).select(*self.groups, *self.series, self.period, "fitted")

    def forecast(self, horizon: int, spec: EtsSpec = EtsSpec()) -> DataFrame:
        """(groups, series, step, yhat): the components' own forecasts, weighted by each series' scores."""
        count, rank = F.size("v") / F.lit(self.rank), self.rank
        courses = self.components.select(*self.groups, count.cast("int").alias("_t"), F.posexplode("v").alias("_at", "y"))
        courses = courses.select(*self.groups, F.expr("_at div _t").alias("_c"), F.expr("_at % _t").alias("_i"), "y")
        key = (*self.groups, "_c")
        ahead = fit_ets(courses, key, ["_i"], "y", spec, Layout(key, ("_i",))).forecast(horizon)  # as long as the calendar
        steps = ahead.groupBy(*self.groups, "step").agg(F.array_sort(F.collect_list(F.struct("_c", "yhat"))).alias("a"))
        future = steps.groupBy(*self.groups).agg(F.collect_list(F.struct("step", F.transform("a", lambda p: p["yhat"]).alias("yhat"))).alias("_f"))
        scores = self.scores().drop("v")
        rows = join_per_group(scores, future, self.groups, "inner").withColumn("_s", F.explode("_f"))
        yhat = reduce(lambda a, c: a + F.col("score")[c] * F.col("_s.yhat")[c], range(rank), F.col("mean"))
        return rows.select(*self.groups, *self.series, "_s.step", yhat.alias("yhat"))


def truncate(gram: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and time courses (rank, periods) of the strongest components."""
    values, vectors = np.linalg.eigh(gram)
    values, vectors = np.maximum(values[::-1][:rank], 0.0), vectors[:, ::-1][:, :rank]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    weights, courses = np.zeros(rank), np.zeros((rank, len(gram)))
    heavy = values > NOISE * values.max(initial=0.0)
    weights[: len(values)] = np.where(heavy, np.sqrt(values), 0.0)
    courses[: len(values)] = np.where(heavy[:, None], (vectors * sign).T, 0.0)
    return weights, courses


def fit_svd(df: DataFrame, groups: Sequence[str], series: Sequence[str], period: str, y: str, rank: int, center: bool = True) -> SvdFit:
    """Components of every group (``groups=[]``: of the whole table, under the key ``_all``)."""
    if not groups:
        df, groups = df.withColumn("_all", F.lit(0)), ["_all"]
    groups, series = tuple(groups), tuple(series)
    value = F.col(y).cast("double")
    present = df.where(F.col(period).isNotNull() & value.isNotNull() & ~F.isnan(value))
    cells = settled(present.groupBy(*groups, *series, period).agg(F.avg(value).alias("_y")), "cells")
    dates = Window.partitionBy(*groups)
    calendar = cells.select(*groups, period).distinct().select(
        *groups, period, (F.row_number().over(dates.orderBy(period)) - 1).alias("_i"), F.count(F.lit(1)).over(dates).alias("_n")
    )
    calendar = settled(calendar, "calendar")
    placed = join_same(cells, calendar, [*groups, period])
    listed = placed.groupBy(*groups, *series).agg(  # at most one entry per period
        F.avg("_y").alias("mean"), F.count(F.lit(1)).alias("n_obs"), F.max("_n").alias("_n"), F.collect_list("_i").alias("_at"), F.collect_list("_y").alias("_v")
    )
    keys = [cells.schema[c] for c in (*groups, *series)]
    vector_schema = T.StructType([*keys, T.StructField("mean", T.DoubleType()), T.StructField("n_obs", T.LongType()), T.StructField("x", DOUBLES)])

    def dense(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not center:
                pdf["mean"] = 0.0
            rows = []
            for n, at, v, mean in zip(pdf["_n"], pdf["_at"], pdf["_v"], pdf["mean"], strict=True):
                x = np.zeros(n)
                x[np.asarray(at, int)] = np.asarray(v, float) - mean
                rows.append(x)
            pdf["x"] = rows
            yield pdf[vector_schema.names]

    vectors = settled(listed.mapInPandas(dense, vector_schema), "vectors")
    tasks = vectors.groupBy(*groups).agg(F.ceil(F.count(F.lit(1)) / SERIES_PER_TASK).alias("_k"))
    dealt = join_per_group(vectors.select(*groups, "x", F.xxhash64(*series).alias("_h")), tasks, groups, "inner").withColumn("_h", F.pmod("_h", "_k"))
    spread = dealt.repartition(*groups, "_h").sortWithinPartitions(*groups, "_h").select(*groups, "x")
    gram_schema = T.StructType([*keys[: len(groups)], T.StructField("_row", T.IntegerType()), T.StructField("_g", DOUBLES)])

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, total = None, None
        for pdf in batches:
            for _, part in pdf.groupby(list(groups), sort=False, dropna=False):
                x = np.stack(part["x"].to_numpy())
                first = part.iloc[[0]][list(groups)].reset_index(drop=True)
                if head is not None and first.equals(head):
                    total += x.T @ x
                    continue
                if head is not None:
                    yield _rows(head, total)
                head, total = first, x.T @ x
        if head is not None:
            yield _rows(head, total)

    def _rows(head: pd.DataFrame, total: np.ndarray) -> pd.DataFrame:
        out = head.loc[np.zeros(len(total), int)].reset_index(drop=True)
        return out.assign(_row=np.arange(len(total)), _g=list(total))[gram_schema.names]

    partial = spread.mapInPandas(add, gram_schema)
    summed = partial.groupBy(*groups, "_row").applyInPandas(lambda pdf: pdf.iloc[[0]].assign(_g=[np.sum(np.stack(pdf["_g"].to_numpy()), axis=0)]), gram_schema)
    component_schema = T.StructType([*keys[: len(groups)], T.StructField("weights", DOUBLES), T.StructField("v", DOUBLES)])

    def decompose(pdf: pd.DataFrame) -> pd.DataFrame:
        weights, courses = truncate(np.stack(pdf.sort_values("_row")["_g"].to_numpy()), rank)
        return pdf.iloc[[0]][list(groups)].assign(weights=[weights], v=[courses.ravel()])

    components = settled(summed.groupBy(*groups).applyInPandas(decompose, component_schema), "components")
    return SvdFit(groups, series, period, rank, calendar, vectors, components)
