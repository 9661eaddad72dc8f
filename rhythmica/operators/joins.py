"""Joins of one small row per group onto many rows per group."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rhythmica.operators.layout import MAX_BLOCKS, rows_per_block


def join_per_group(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner", counted: DataFrame | None = None) -> DataFrame:
    """Equi-join of ``df`` with a table that has at most one row per key. ``counted``: the same rows before columns were
    added to them, where that is cheaper to count.

    The groups of ``df`` are counted first. Rows of groups longer than a block stay where they are and
    meet the broadcast rows of just those groups (at most ``MAX_BLOCKS`` of them); all other rows take
    the ordinary join, whose shuffle then has no large group.
    """
    keys = list(keys)
    n_groups = (df if counted is None else counted).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    size = rows_per_block(df)
    long_one = F.when(F.col("_n") > size, F.struct("_n", *keys))
    found = n_groups.agg(F.sum("_n").alias("rows"), F.collect_list(long_one).alias("long")).first()  # at most rows / size entries
    size = max(size, math.ceil((found["rows"] or 0) / MAX_BLOCKS))
    large = [tuple(r[k] for k in keys) for r in found["long"] if r["_n"] > size]
    if not large:
        return join_same(df, table, keys, how)
    named = F.broadcast(df.sparkSession.createDataFrame(large, T.StructType([df.schema[k] for k in keys])))
    few = F.broadcast(join_same(table, named, keys, "left_semi"))
    in_place = join_same(join_same(df, named, keys, "left_semi"), few, keys, how)
    return in_place.unionByName(join_same(join_same(df, named, keys, "left_anti"), table, keys, how))


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of the same name in which nulls are equal; the key columns are the left ones."""
    names = {k: f"_same_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[n]) for k, n in names.items()])
    return left.join(right, on, how).drop(*names.values())
