"""Exact interpolated percentiles without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rhythmica.operators.joins import join_per_group
from rhythmica.operators.layout import BEFORE, TOTAL, plan_layout, rows_per_block
from rhythmica.session import settled

# tables whose groups all have at most this many rows use Spark's own percentile
SMALL_GROUP = 100_000
# rank error of the sketch that brackets the wanted ranks, and the width of a bracket: four times that
ACCURACY = 2000
MARGIN = 4 / ACCURACY
# below this size a bracket would be a few rows wide, so the whole group is kept
BRACKET_FROM = 10_000


def exact_quantiles(df: DataFrame, by: Sequence[str], column: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """One row per group with the linearly interpolated percentiles of ``column``.

    Small groups (counted first) use the built-in percentile. Otherwise a mergeable sketch brackets
    each wanted rank; rows inside a bracket are tallied by value, rows between brackets only counted.
    The tally - a few thousandths of the rows - is laid out in order and the values at the ranks are
    picked by cumulative count. A rank outside its bracket would be an error, not a wrong value.
    """
    present = df.filter(F.col(column).isNotNull()).select(*by, F.col(column).alias("_v"))
    largest = present.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    if largest <= min(SMALL_GROUP, rows_per_block(df)):
        cuts = present.groupBy(*by).agg(F.percentile("_v", F.array(*[F.lit(float(q)) for q in probs])).alias("_q"))
        return cuts.select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])

    return _pick(present, by, probs, names, present.groupBy(*by).agg(_bracket("_v", probs).alias("_ends")))


def _pick(present: DataFrame, by: Sequence[str], probs: Sequence[float], names: Sequence[str], brackets: DataFrame, few_groups: bool = False) -> DataFrame:
    tally = settled(_bracketed_tally(present, by, probs, brackets, few_groups), "tally")
    order = ("_region", "_v")
    layout = plan_layout(tally, by, order, weight="_w")
    below = layout.window().rowsBetween(Window.unboundedPreceding, -1)
    whole = layout.window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = layout.spread(tally).select(
        *by,
        "_v",
        "_w",
        (F.col(BEFORE) + F.coalesce(F.sum("_w").over(below), F.lit(0))).alias("_lo"),
        F.coalesce(F.col(TOTAL), F.sum("_w").over(whole)).alias("_all"),
    )

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("_lo") <= rank) & (rank < F.col("_lo") + F.col("_w")), F.col("_v")))

    picks = []
    for i, q in enumerate(probs):
        rank = F.lit(float(q)) * (F.col("_all") - 1)
        picks += [value_at(F.floor(rank)).alias(f"_a{i}"), value_at(F.ceil(rank)).alias(f"_b{i}")]
    found = ranked.groupBy(*by).agg(*picks, F.max("_all").alias("_all"))
    outside = F.raise_error(F.lit("a percentile fell outside its bracket"))
    out = [F.col(c) for c in by]
    for i, (q, name) in enumerate(zip(probs, names, strict=True)):
        rank = F.lit(float(q)) * (F.col("_all") - 1)
        low = F.coalesce(F.col(f"_a{i}"), outside.cast("double"))
        high = F.coalesce(F.col(f"_b{i}"), outside.cast("double"))
        out.append((low + (high - low) * (rank - F.floor(rank))).alias(name))
    return found.select(*out)


def _bracket_ends(probs: Sequence[float]) -> list[float]:
    return [float(p) for q in probs for p in (max(0.0, q - MARGIN), min(1.0, q + MARGIN))]


def _bracket(column: str, probs: Sequence[float]) -> Column:
    """Sketched values at both ends of each bracket; null for groups that are kept whole."""
    return F.when(F.count(column) >= BRACKET_FROM, F.percentile_approx(column, _bracket_ends(probs), ACCURACY))


def _bracketed_tally(present: DataFrame, by: Sequence[str], probs: Sequence[float], brackets: DataFrame, few_groups: bool) -> DataFrame:
    """Counts per (group, region, value); rows between brackets have no value and one count per gap.

    ``_region`` numbers the intervals between the sorted bracket ends, so (region, value) is the value
    order.
    """
    ends = _bracket_ends(probs)
    brackets = settled(brackets, "brackets")  # written once, so that every job sees the same brackets
    if not by:
        rows = present.withColumn("_ends", brackets.scalar())
    elif few_groups:
        rows = present.join(F.broadcast(brackets), list(by), "left")  # one row per named column
    else:
        rows = join_per_group(present, brackets, by, "left")
    region, kept = F.lit(0), F.col("_ends").isNull()
    for i in range(len(ends)):
        region = region + F.coalesce((F.col("_ends")[i] < F.col("_v")).cast("int"), F.lit(0))
    for i in range(0, len(ends), 2):
        kept = kept | ((F.col("_v") >= F.col("_ends")[i]) & (F.col("_v") <= F.col("_ends")[i + 1]))
    return rows.groupBy(*by, region.alias("_region"), F.when(kept, F.col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("_w"))


def long_form(df: DataFrame, columns: Sequence[str], name: str = "column", value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, column), values as double."""
    return df.select(
        *keep,
        F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in columns])).alias("_e"),
    ).select(*keep, f"_e.{name}", f"_e.{value}")


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Percentiles of several columns, one row per column."""
    if df.count() <= min(SMALL_GROUP, rows_per_block(df)):
        return exact_quantiles(long_form(df, columns), ["column"], "value", probs, names)
    # all sketches in one pass over the columns as they are
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    wide = numbers.agg(*[_bracket(c, probs).alias(c) for c in columns])
    brackets = _one_row_per_column(wide, columns)
    present = long_form(df, columns).select("column", F.col("value").alias("_v")).filter(F.col("_v").isNotNull())
    return _pick(present, ["column"], probs, names, brackets, few_groups=True)


def _one_row_per_column(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    return wide.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("_ends")) for c in columns])).alias("_e")
    ).select("_e.column", "_e._ends")
