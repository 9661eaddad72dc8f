"""Sources, sinks, caches, stored models and streaming jobs. Each query writes to a folder of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from rhythmica.forecast import trees
from rhythmica.functions import metrics as M
from rhythmica.functions.calendar import literal
from rhythmica.operators import features, leaderboard, profile, split, validate
from rhythmica.plans.registry import (
    FORECAST_SQL,
    PANEL_ORDER,
    PANEL_SERIES,
    PANEL_SQL,
    R,
    RESULTS_SQL,
    forecasts,
    load,
    panel,
    panel_layout,
    query,
    r,
    results,
)
from rhythmica.session import shared_dir
from rhythmica.sources import files, tables
from rhythmica.streaming import jobs


@query("csv_roundtrip", "SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS date FROM orders", dates=["date"])
def _(spark, sf):
    path = f"{shared_dir(spark, 'csv')}.csv"
    df = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "dd-MM-yyyy").alias("o_orderdate"))
    tables.write_csv(df, path)
    back = tables.read_csv(spark, path, "o_orderkey bigint, o_totalprice double, o_orderdate string", "o_orderdate", "dd-MM-yyyy")
    return back.withColumn("date", F.col("date").cast("date"))


@query("parquet_roundtrip", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem")
def _(spark, sf):
    path = f"{shared_dir(spark, 'pq')}.parquet"
    df = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    tables.write_parquet(df, path, ["l_returnflag"])
    return tables.read_table(spark, path).select(*df.columns)


@query(
    "json_results_roundtrip",
    f"""WITH {RESULTS_SQL} SELECT model_name, dataset_name, {R("mape")} AS mape, {R("rmse", 4)} AS rmse, {R("mae", 4)} AS mae, n_samples FROM results""",
)
def _(spark, sf):
    path = shared_dir(spark, "results")
    leaderboard.save_results(results(spark, sf), path)
    back = leaderboard.load_results(spark, path)
    return back.select("model_name", "dataset_name", r("mape").alias("mape"), r("rmse", 4).alias("rmse"), r("mae", 4).alias("mae"), "n_samples")


@query("file_listing")
def _(spark, sf):
    return files.list_data_files(spark, sf, ".parquet")


@query("file_digests")
def _(spark, sf):
    return files.file_digests(spark, sf, ".parquet")


_CELLS = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-1:')" for c in ("event_id", "user_id", "event_type", "props"))
_PARTS = ", ".join(f"CAST('0x' || substr(m, {8 * k + 1}, 8) AS BIGINT) AS h{k}" for k in range(4))


def _joined(value: str) -> str:
    return " || '-' || ".join(f"CAST(coalesce({value.format(k=k)}, 0) AS VARCHAR)" for k in range(4))


@query(
    "table_fingerprint",
    f"SELECT COUNT(*) AS n_rows, {_joined('bit_xor(h{k})')} AS xor_hash, {_joined('SUM(h{k})')} AS sum_hash FROM (SELECT {_PARTS} FROM (SELECT md5({_CELLS}) AS m FROM events))",
)
def _(spark, sf):
    return files.table_fingerprint(load(spark, sf, "events").select("event_id", "user_id", "event_type", "props"))


@query("feature_cache", f"WITH {PANEL_SQL} SELECT series, week, lag(y, 1) OVER (PARTITION BY series ORDER BY week) AS y_lag_1 FROM panel", dates=["week"])
def _(spark, sf):
    folder = shared_dir(spark, "features")
    source = panel(spark, sf).select("series", "week", "y")

    def build(df):
        return features.add_history(df, "y", PANEL_ORDER, PANEL_SERIES, lags=[1], windows=[], mode="composite", layout=panel_layout())

    files.cached_features(source, build, folder, "panel")
    return files.cached_features(source, build, folder, "panel").select("series", "week", "y_lag_1")


@query(
    "predictions_sink",
    f"""WITH {FORECAST_SQL} SELECT series, week, CASE WHEN pos < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train' WHEN pos < floor(n * CAST(0.85 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split,
         'naive' AS model, y AS y_true, naive AS y_pred, y - naive AS residual
       FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY week) - 1 AS pos, COUNT(*) OVER (PARTITION BY series) AS n FROM forecasts)""",
    dates=["week"],
)
def _(spark, sf):
    path = shared_dir(spark, "predictions")
    tagged = split.series_split(forecasts(spark, sf), PANEL_SERIES, PANEL_ORDER, layout=panel_layout())
    rows = tagged.select("series", "week", "split", F.lit("naive").alias("model"), F.col("y").alias("y_true"), F.col("naive").alias("y_pred"))
    tables.write_predictions(rows, path)
    return spark.read.parquet(path)


@query(
    "infer_features",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem",
)
def _(spark, sf):
    df = load(spark, sf, "lineitem")
    return df.select(*profile.infer_feature_columns(df, "l_extendedprice"))


@query("model_roundtrip")
def _(spark, sf):
    df = load(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_returnflag")
    path = shared_dir(spark, "model")
    trees.random_forest(["l_quantity", "l_discount", "l_tax"], "l_extendedprice", trees=4, depth=4).fit(df).save(path)
    scored = trees.load_model(path).transform(df)
    return scored.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), M.mae("l_extendedprice", "prediction").alias("mae"))


# --- streaming ----------------------------------------------------------------------------------
@query(
    "stream_score_quality",
    """SELECT 'good' AS side, o_orderkey, round(o_totalprice * 1.1, 4) + 0.0 AS prediction FROM orders WHERE o_totalprice <= 400000 AND o_orderstatus IN ('F', 'O')
       UNION ALL SELECT 'bad', o_orderkey, 0.0 FROM orders WHERE NOT (o_totalprice <= 400000 AND o_orderstatus IN ('F', 'O'))""",
)
def _(spark, sf):
    base = shared_dir(spark, "score")
    rules = [*validate.not_null("o_orderkey"), validate.between("o_totalprice", 0, 400000), validate.in_set("o_orderstatus", ("F", "O"))]
    stream = jobs.file_stream(spark, f"{sf}/orders.parquet", load(spark, sf, "orders"))
    jobs.run_to_end(
        jobs.validate_and_score(
            stream, rules, lambda df: df.withColumn("prediction", F.col("o_totalprice") * 1.1), f"{base}/good", f"{base}/bad", f"{base}/checkpoint"
        )
    )
    good = spark.read.parquet(f"{base}/good").select(F.lit("good").alias("side"), "o_orderkey", r("prediction", 4).alias("prediction"))
    bad = spark.read.parquet(f"{base}/bad").select(F.lit("bad").alias("side"), "o_orderkey", F.lit(0.0).alias("prediction"))
    return good.unionByName(bad)




@query(
    "stream_accuracy_windows",
    f"""SELECT strftime(w, '%Y-%m-%d') AS window_start, event_type, COUNT(*) AS n, {R("100 * avg(abs(value - 10) / greatest(abs(value), 1e-8))")} AS mape,
         {R("sqrt(avg((value - 10) * (value - 10)))")} AS rmse, CAST(100 * avg(abs(value - 10) / greatest(abs(value), 1e-8)) > 200 AS INT) AS alert
       FROM (SELECT *, date_trunc('day', ts) AS w FROM events) GROUP BY 1, 2""",
)
def _(spark, sf):
    base = shared_dir(spark, "accuracy")
    like = load(spark, sf, "events")
    stream = jobs.file_stream(spark, f"{sf}/events.parquet", like).withColumn("p", F.lit(10.0))
    windows = jobs.accuracy_windows(stream, "ts", "value", "p", ["event_type"], "1 day", late="1 hour", alert_over=200.0)
    jobs.run_to_end(jobs.emit_to(windows, f"{base}/out", f"{base}/checkpoint"))
    out = jobs.last_values(spark, f"{base}/out", windows.schema, ["window_start", "event_type"])
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "event_type", "n", r("mape").alias("mape"), r("rmse").alias("rmse"), "alert")


@query(
    "stream_sliding_windows",
    f"""SELECT strftime(w, '%Y-%m-%d %H') AS window_start, COUNT(*) AS n, {R("sqrt(avg((value - 10) * (value - 10)))")} AS rmse
       FROM (SELECT value, unnest([half, half - INTERVAL 12 HOUR]) AS w
             FROM (SELECT value, date_trunc('day', ts) + INTERVAL 12 HOUR * CAST(hour(ts) >= 12 AS INT) AS half FROM events)) GROUP BY 1""",
)
def _(spark, sf):
    base = shared_dir(spark, "sliding")
    stream = jobs.file_stream(spark, f"{sf}/events.parquet", load(spark, sf, "events")).withColumn("p", F.lit(10.0))
    windows = jobs.accuracy_windows(stream, "ts", "value", "p", [], "1 day", "12 hours", late="1 hour")
    jobs.run_to_end(jobs.emit_to(windows, f"{base}/out", f"{base}/checkpoint"))
    out = jobs.last_values(spark, f"{base}/out", windows.schema, ["window_start"])
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH").alias("window_start"), "n", r("rmse").alias("rmse"))


@query(
    "stream_online_lags",
    """SELECT event_id, lag(value, 1) OVER w AS value_lag_1, lag(value, 3) OVER w AS value_lag_3 FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def _(spark, sf):
    base = shared_dir(spark, "lags")
    # the table arrives as four deliveries in time order, one micro-batch each
    ev = load(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    span = ev.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    edges = [span["a"] + (span["b"] - span["a"]) * k / 4 for k in range(4)]
    for k, start in enumerate(edges):
        part = ev.filter(F.col("ts") >= literal(start, ev.schema["ts"].dataType))
        part = part.filter(F.col("ts") < literal(edges[k + 1], ev.schema["ts"].dataType)) if k < 3 else part
        part.write.mode("append").parquet(f"{base}/in")
        stream = jobs.file_stream(spark, f"{base}/in", ev, "*.parquet")
        jobs.run_to_end(jobs.online_lags(stream, ["user_id"], ["ts", "event_id"], "value", [1, 3], f"{base}/out", f"{base}/state", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/out").select("event_id", "value_lag_1", "value_lag_3")
