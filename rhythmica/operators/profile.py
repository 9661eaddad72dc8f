"""Table profiles and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rhythmica.operators.joins import join_same
from rhythmica.operators.quantiles import column_quantiles, exact_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def infer_feature_columns(df: DataFrame, target: str, feature_columns: Sequence[str] | None = None) -> list[str]:
    """The named columns, or all numeric columns but the target."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    if feature_columns:
        missing = [c for c in feature_columns if c not in df.columns]
        if missing:
            raise ValueError(f"feature columns not found: {missing}")
        return list(feature_columns)
    return [c for c in numeric_columns(df) if c != target]


def series_summary(df: DataFrame, by: Sequence[str], y: str) -> DataFrame:
    """Mean, median, sample deviation and maximum per group; highest mean first."""
    moments = df.groupBy(*by).agg(F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"), F.max(y).alias("max"))
    medians = exact_quantiles(df, by, y, [0.5], ["median"])
    return join_same(moments, medians, by, "left").orderBy(F.col("mean").desc(), *by)


def grouped_mean(df: DataFrame, by: Sequence[str], y: str, name: str = "mean") -> DataFrame:
    return df.groupBy(*by).agg(F.avg(y).alias(name))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: count, mean, std, min, quartiles, max; distinct count, most frequent value
    and its frequency for text columns."""
    wanted = list(columns or df.columns)
    numbers = [c for c in wanted if c in numeric_columns(df)]
    texts = [f.name for f in df.schema if f.name in wanted and isinstance(f.dataType, T.StringType)]
    out = None
    if numbers:
        stats = df.agg(
            *[
                f(F.col(c).cast("double")).alias(f"{k}|{c}")
                for c in numbers
                for k, f in (("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
            ]
        )
        flat = stats.select(
            F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("column"),
                            F.col(f"n|{c}").alias("n"),
                            *[F.col(f"{k}|{c}").alias(k) for k in ("mean", "std", "min", "max")],
                        )
                        for c in numbers
                    ]
                )
            ).alias("e")
        ).select("e.*")
        quartiles = column_quantiles(df, numbers, [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
        out = flat.join(quartiles, "column", "left").withColumns(
            {"n_distinct": F.lit(None).cast("bigint"), "top": F.lit(None).cast("string"), "freq": F.lit(None).cast("bigint")}
        )
    if texts:
        values = df.select(
            F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in texts])).alias("e")
        ).select("e.*")
        tally = values.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("k"))
        first = F.min_by(
            F.struct("value", "k"), F.struct(-F.col("k"), F.col("value"))
        )
        named = tally.groupBy("column").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("n_distinct"), first.alias("t"))
        none = {k: F.lit(None).cast("double") for k in ("mean", "std", "min", "max", "p25", "p50", "p75")}
        text_rows = named.select("column", "n", "n_distinct", F.col("t.value").alias("top"), F.col("t.k").alias("freq")).withColumns(none)
        out = text_rows if out is None else out.unionByName(text_rows)
    return out


def missing_summary(df: DataFrame) -> DataFrame:
    """Null (or NaN) count and percent per column, most first; one pass."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def gone(c: str):
        return (F.col(c).isNull() | F.isnan(c)) if c in floats else F.col(c).isNull()

    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(gone(c)).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in df.columns])
    return (
        counts.select("_rows", F.explode(cells).alias("e"))
        .select("e.column", "e.n_missing", (100 * F.try_divide("e.n_missing", "_rows")).alias("percent"))
        .orderBy(F.col("n_missing").desc(), "column")
    )


def duplicates(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Number of rows beyond the first per key (default: the full row); nulls are equal."""
    counts = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column; ``approximate`` uses a sketch for very large keys."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(*[count(c).alias(f"n_{c}") for c in columns])


def extent(df: DataFrame, ts: str, series: Sequence[str] = ()) -> DataFrame:
    """Row count, first and last time, number of series."""
    n_series = F.countDistinct(F.struct(*series)) if series else F.lit(1).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), n_series.alias("n_series"))


def category_report(df: DataFrame, by: Sequence[str], y: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(y).alias("mean_target"))


def hierarchy_totals(df: DataFrame, levels: Sequence[str], y: str) -> DataFrame:
    """Totals at every level of a hierarchy and the grand total."""
    return df.rollup(*levels).agg(F.grouping_id().cast("bigint").alias("level"), F.sum(y).alias("total"))


def resample(df: DataFrame, ts: str, period: str, by: Sequence[str], y: str, name: str = "y") -> DataFrame:
    """Sum of the target per group and calendar period."""
    return df.groupBy(*by, F.date_trunc(period, ts).cast("date").alias("period")).agg(F.sum(y).alias(name))


def top_groups(df: DataFrame, by: Sequence[str], y: str, k: int) -> DataFrame:
    """The k groups with the highest mean."""
    return grouped_mean(df, by, y).orderBy(F.col("mean").desc(), *by).limit(k)
