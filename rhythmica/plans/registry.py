"""Registry of named queries and the tables they share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rhythmica.operators.layout import Layout, short_series
from rhythmica.session import settled, utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, dates: Sequence[str] = ()):
    """Register a query. Date columns, named in ``dates`` for the SQL, are returned as ISO text, which
    both engines print alike."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(utc(spark), sf_dir)
            return out.withColumns({f.name: F.col(f.name).cast("string") for f in out.schema if isinstance(f.dataType, T.DateType)})

        QUERIES[name] = run
        if sql:
            replaced = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in dates)
            ORACLES[name] = f"SELECT * REPLACE ({replaced}) FROM ({sql})" if dates else sql
        return fn

    return add


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def r(col: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, digits)


def R(expr: str, digits: int = 6) -> str:
    """The same rounding in SQL; adding zero removes a negative zero."""
    return f"(round({expr}, {digits}) + 0.0)"


# weekly panel: one row per nation and week, y in whole currency units so that sums are exact
PANEL_ORDER = ("week",)
PANEL_SERIES = ("series",)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("series"), F.date_trunc("week", "o_orderdate").cast("date").alias("week"))
        .agg(
            F.sum(F.round("o_totalprice").cast("bigint")).cast("double").alias("y"),
            F.max(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("holiday"),
            F.min("n_regionkey").alias("region"),
            F.count(F.lit(1)).alias("n_orders"),
        )
    )


def stored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel written once, for queries whose jobs read it several times."""
    return settled(panel(spark, sf_dir), "panel")


def panel_layout() -> Layout:
    """A nation has one row per calendar week, so its length is bounded by the calendar."""
    return short_series(PANEL_SERIES, PANEL_ORDER)


PANEL_SQL = """panel AS (
  SELECT n_name AS series, CAST(date_trunc('week', o_orderdate) AS DATE) AS week,
         CAST(SUM(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) AS y,
         MAX(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS holiday,
         MIN(n_regionkey) AS region, COUNT(*) AS n_orders
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event type and day, y in hundredths so that sums are exact."""
    return (
        load(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("day"))
        .agg(F.sum(F.round(F.col("value") * 100).cast("bigint")).cast("double").alias("y"))
    )


def daily_layout() -> Layout:
    return short_series(("series",), ("day",))


DAILY_SQL = """daily AS (
  SELECT event_type AS series, CAST(ts AS DATE) AS day, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS y
  FROM events GROUP BY 1, 2)"""

# Forecast table: three simple forecasts per panel row
FORECAST_SQL = f"""{PANEL_SQL}, forecasts AS (
  SELECT * FROM (
    SELECT series, week, holiday, y, lag(y, 1) OVER w AS naive, lag(y, 4) OVER w AS seasonal,
           avg(y) OVER (PARTITION BY series ORDER BY week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS rolling
    FROM panel WINDOW w AS (PARTITION BY series ORDER BY week))
  WHERE naive IS NOT NULL AND seasonal IS NOT NULL AND rolling IS NOT NULL)"""

MODELS = ("naive", "seasonal", "rolling")


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rhythmica.operators.layout import with_windows

    table = with_windows(
        panel(spark, sf_dir).select("series", "week", "holiday", "y"),
        PANEL_SERIES,
        PANEL_ORDER,
        lambda w: {"naive": F.lag("y", 1).over(w), "seasonal": F.lag("y", 4).over(w), "rolling": F.avg("y").over(w.rowsBetween(-4, -1))},
        4,
        panel_layout(),
    )
    return table.na.drop(subset=["naive", "seasonal", "rolling"])


def stored_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(forecasts(spark, sf_dir), "forecasts")


LONG_SQL = FORECAST_SQL + """, long AS (
  SELECT series, week, y, 'naive' AS model, naive AS p FROM forecasts UNION ALL
  SELECT series, week, y, 'seasonal', seasonal FROM forecasts UNION ALL
  SELECT series, week, y, 'rolling', rolling FROM forecasts)"""


def long_forecasts(spark: SparkSession, sf_dir: str, models: Sequence[str] = MODELS) -> DataFrame:
    """One row per (series, week, model); the wide table is read once."""
    return forecasts(spark, sf_dir).select(
        "series", "week", "y", F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("p")) for m in models])).alias("e")
    ).select("series", "week", "y", "e.model", "e.p")


# Benchmark results: the three forecasts scored per nation
RESULTS_SQL = LONG_SQL + """, results AS (
  SELECT model AS model_name, series AS dataset_name,
         100 * avg(abs(y - p) / greatest(abs(y), 1e-8)) AS mape, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
         COUNT(*) AS n_samples
  FROM long GROUP BY 1, 2)"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rhythmica.functions import metrics as M

    return (
        long_forecasts(spark, sf_dir)
        .groupBy(F.col("model").alias("model_name"), F.col("series").alias("dataset_name"))
        .agg(M.mape("y", "p").alias("mape"), M.rmse("y", "p").alias("rmse"), M.mae("y", "p").alias("mae"), F.count(F.lit(1)).alias("n_samples"))
    )
