"""Calendar, cleaning, ordering, window and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rhythmica.functions import calendar, cleaning
from rhythmica.operators import features, fill, leaderboard, profile, split, target_stats
from rhythmica.operators.layout import with_windows
from rhythmica.plans.registry import (
    FORECAST_SQL,
    PANEL_ORDER,
    PANEL_SERIES,
    PANEL_SQL,
    R,
    forecasts,
    load,
    panel,
    panel_layout,
    query,
    r,
    stored_panel,
)

EVENT_ORDER = ("ts", "event_id")


@query(
    "date_features_orders",
    """SELECT o_orderkey, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day,
         CAST(isodow(d) - 1 AS INT) AS dayofweek, CAST(quarter(d) AS INT) AS quarter, CAST(week(d) AS INT) AS week,
         CAST(isodow(d) >= 6 AS INT) AS is_weekend, CAST(day(d) = 1 AS INT) AS is_month_start, CAST(d = last_day(d) AS INT) AS is_month_end,
         CAST(day(d) = 1 AND month(d) IN (1, 4, 7, 10) AS INT) AS is_quarter_start,
         CAST(d = last_day(d) AND month(d) IN (3, 6, 9, 12) AS INT) AS is_quarter_end
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def _(spark, sf):
    return calendar.add_date_features(load(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query(
    "clock_features_events",
    """SELECT event_id, CAST(dayofyear(ts) AS INT) AS dayofyear, CAST(hour(ts) AS INT) AS hour_of_day, CAST(isodow(ts) - 1 AS INT) AS weekday,
         CAST(week(ts) AS INT) AS week_of_year FROM events""",
)
def _(spark, sf):
    return load(spark, sf, "events").select("event_id", "ts").withColumns(calendar.clock_parts("ts")).drop("ts")


@query(
    "parse_mixed_dates",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed,
         CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%d-%m-%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
           WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y')
           ELSE CASE WHEN day(o_orderdate) > 12 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE strftime(o_orderdate, '%d/%m/%Y') END END AS raw
       FROM orders""",
    dates=["parsed"],
)
def _(spark, sf):
    d = F.col("o_orderdate")
    shape = F.col("o_orderkey") % 4
    raw = (
        F.when(shape == 0, F.date_format(d, "dd-MM-yyyy"))
        .when(shape == 1, F.date_format(d, "yyyy-MM-dd"))
        .when((shape == 3) & (F.dayofmonth(d) > 12), F.date_format(d, "MM/dd/yyyy"))
        .otherwise(F.date_format(d, "dd/MM/yyyy"))
    )
    texts = load(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return texts.select("o_orderkey", "raw", calendar.parse_date("raw").cast("date").alias("parsed"))


@query(
    "cyclical_max_orders",
    f"""SELECT o_orderkey, {R("sin(2 * pi() * m / max(m) OVER ())")} AS month_sin, {R("cos(2 * pi() * m / max(m) OVER ())")} AS month_cos,
         {R("sin(2 * pi() * w / max(w) OVER ())")} AS week_sin, {R("cos(2 * pi() * w / max(w) OVER ())")} AS week_cos
       FROM (SELECT o_orderkey, month(o_orderdate) AS m, week(o_orderdate) AS w FROM orders)""",
)
def _(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", F.month("o_orderdate").alias("month"), F.weekofyear("o_orderdate").alias("week"))
    out = calendar.add_cyclical(df, ["month", "week", "absent"])
    return out.select("o_orderkey", *[r(c).alias(c) for c in ("month_sin", "month_cos", "week_sin", "week_cos")])


@query(
    "cyclical_fixed_orders",
    f"""SELECT o_orderkey, {R("sin(2 * pi() * week(o_orderdate) / 52)")} AS week_sin, {R("cos(2 * pi() * week(o_orderdate) / 52)")} AS week_cos,
         {R("sin(2 * pi() * month(o_orderdate) / 12)")} AS month_sin, {R("cos(2 * pi() * month(o_orderdate) / 12)")} AS month_cos FROM orders""",
)
def _(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", F.month("o_orderdate").alias("month"), F.weekofyear("o_orderdate").alias("week"))
    out = calendar.add_cyclical(calendar.add_cyclical(df, ["week"], 52), ["month"], 12)
    return out.select("o_orderkey", *[r(c).alias(c) for c in ("month_sin", "month_cos", "week_sin", "week_cos")])


def _trailing(y: str, part: str, order: str, n: int) -> tuple[str, str]:
    frame = f"OVER ({part} ORDER BY {order} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"avg({y}) {frame}", f"stddev_samp({y}) {frame}"


@query(
    "lag_features_panel",
    f"""WITH {PANEL_SQL}
       SELECT series, week, y, lag(y, 1) OVER s AS y_lag_1_series, lag(y, 7) OVER s AS y_lag_7_series, lag(y, 14) OVER s AS y_lag_14_series,
         lag(y, 1) OVER g AS y_lag_1_region, lag(y, 7) OVER g AS y_lag_7_region, lag(y, 14) OVER g AS y_lag_14_region
       FROM panel WINDOW s AS (PARTITION BY series ORDER BY week, series), g AS (PARTITION BY region ORDER BY week, series)""",
    dates=["week"],
)
def _(spark, sf):
    df = stored_panel(spark, sf).select("series", "region", "week", "y")
    return features.add_history(df, "y", ["week", "series"], ["series", "region"], windows=[]).drop("region")


@query(
    "rolling_features_panel",
    f"""WITH {PANEL_SQL}
       SELECT series, week, {R(_trailing("y", "PARTITION BY series", "week", 7)[0], 4)} AS y_rolling_mean_7,
         {R(_trailing("y", "PARTITION BY series", "week", 7)[1], 3)} AS y_rolling_std_7,
         {R(_trailing("y", "PARTITION BY series", "week", 30)[0], 4)} AS y_rolling_mean_30,
         {R(_trailing("y", "PARTITION BY series", "week", 30)[1], 3)} AS y_rolling_std_30 FROM panel""",
    dates=["week"],
)
def _(spark, sf):
    df = panel(spark, sf).select("series", "week", "y")
    out = features.add_history(df, "y", PANEL_ORDER, PANEL_SERIES, lags=[], mode="composite", layout=panel_layout())
    return out.select("series", "week", *[r(f"y_rolling_{k}_{n}", d).alias(f"y_rolling_{k}_{n}") for n in (7, 30) for k, d in (("mean", 4), ("std", 3))])


@query(
    "static_features_panel",
    f"""WITH {PANEL_SQL}, f AS (
         SELECT series, week, y, CAST(month(week) AS INT) AS month, CAST(week(week) AS INT) AS wk, lag(y, 1) OVER s AS l1,
           {_trailing("y", "PARTITION BY series", "week", 7)[0]} AS m7, {_trailing("y", "PARTITION BY series", "week", 7)[1]} AS s7
         FROM panel WINDOW s AS (PARTITION BY series ORDER BY week))
       SELECT series, week, month, coalesce(l1, 0) AS y_lag_1, {R("coalesce(m7, 0)", 4)} AS y_rolling_mean_7, {R("coalesce(s7, 0)", 3)} AS y_rolling_std_7,
         {R("sin(2 * pi() * month / max(month) OVER ())")} AS month_sin, {R("cos(2 * pi() * month / max(month) OVER ())")} AS month_cos FROM f""",
    dates=["week"],
)
def _(spark, sf):
    df = panel(spark, sf).select("series", F.col("week").alias("day0"), "y")
    out = features.static_features(
        df, "day0", "y", ["day0"], ["series"], lags=[1], windows=[7], cyclical=["month"], mode="composite",
        layout=features.Layout(("series",), ("day0",)),
    )
    return out.select(
        "series", F.col("day0").alias("week"), "month", "y_lag_1", r("y_rolling_mean_7", 4).alias("y_rolling_mean_7"),
        r("y_rolling_std_7", 3).alias("y_rolling_std_7"), r("month_sin").alias("month_sin"), r("month_cos").alias("month_cos"),
    )


@query(
    "user_history_events",
    f"""SELECT event_id, lag(value, 1) OVER s AS value_lag_1, lag(value, 7) OVER s AS value_lag_7,
         {R(_trailing("value", "PARTITION BY user_id", "ts, event_id", 7)[0])} AS value_rolling_mean_7,
         {R(_trailing("value", "PARTITION BY user_id", "ts, event_id", 7)[1])} AS value_rolling_std_7
       FROM events WINDOW s AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def _(spark, sf):
    df = load(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    out = features.add_history(df, "value", EVENT_ORDER, ["user_id"], lags=[1, 7], windows=[7], mode="composite")
    return out.select(
        "event_id", "value_lag_1", "value_lag_7", r("value_rolling_mean_7").alias("value_rolling_mean_7"), r("value_rolling_std_7").alias("value_rolling_std_7")
    )


@query(
    "global_lag_events",
    "SELECT event_id, lag(value, 1) OVER w AS value_lag_1, lag(value, 7) OVER w AS value_lag_7 FROM events WINDOW w AS (ORDER BY ts, event_id)",
)
def _(spark, sf):
    df = load(spark, sf, "events").select("event_id", "ts", "value")
    return features.add_history(df, "value", EVENT_ORDER, lags=[1, 7], windows=[]).select("event_id", "value_lag_1", "value_lag_7")


@query(
    "global_rolling_events",
    f"""SELECT event_id, {R(_trailing("value", "", "ts, event_id", 7)[0])} AS value_rolling_mean_7,
         {R(_trailing("value", "", "ts, event_id", 7)[1])} AS value_rolling_std_7 FROM events""",
)
def _(spark, sf):
    df = load(spark, sf, "events").select("event_id", "ts", "value")
    out = features.add_history(df, "value", EVENT_ORDER, lags=[], windows=[7])
    return out.select("event_id", *[r(f"value_rolling_{k}_7").alias(f"value_rolling_{k}_7") for k in ("mean", "std")])


@query(
    "temporal_split_events",
    """SELECT event_id, CASE WHEN pos < trunc(n * 0.7) THEN 'train' WHEN pos < trunc(n * 0.85) THEN 'val' ELSE 'test' END AS split
       FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, COUNT(*) OVER () AS n FROM events)""",
)
def _(spark, sf):
    return split.temporal_split(load(spark, sf, "events").select("event_id", "ts"), EVENT_ORDER).select("event_id", "split")


@query(
    "series_split_events",
    """SELECT event_id, CASE WHEN pos < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train' WHEN pos < floor(n * CAST(0.85 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split
       FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, COUNT(*) OVER (PARTITION BY user_id) AS n FROM events)""",
)
def _(spark, sf):
    df = load(spark, sf, "events").select("event_id", "ts", "user_id")
    return split.series_split(df, ["user_id"], EVENT_ORDER).select("event_id", "split")


@query(
    "horizon_split_panel",
    f"""WITH {PANEL_SQL}
       SELECT series, week, CASE WHEN left_rows <= 52 THEN 'test' WHEN left_rows <= 104 THEN 'val' ELSE 'train' END AS split
       FROM (SELECT series, week, row_number() OVER (PARTITION BY series ORDER BY week DESC) AS left_rows, COUNT(*) OVER (PARTITION BY series) AS n FROM panel)
       WHERE n - 104 >= 104""",
    dates=["week"],
)
def _(spark, sf):
    df = panel(spark, sf).select("series", "week")
    return split.horizon_split(df, PANEL_SERIES, PANEL_ORDER, 52, 52, 104, layout=panel_layout())


@query(
    "ffill_bfill_panel",
    f"""WITH {PANEL_SQL}, g AS (SELECT series, week, CASE WHEN holiday = 0 THEN y END AS y FROM panel)
       SELECT series, week, coalesce(last_value(y IGNORE NULLS) OVER (PARTITION BY series ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         first_value(y IGNORE NULLS) OVER (PARTITION BY series ORDER BY week ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS y FROM g""",
    dates=["week"],
)
def _(spark, sf):
    df = panel(spark, sf).select("series", "week", F.when(F.col("holiday") == 0, F.col("y")).alias("y"))
    return fill.fill_gaps(df, ["y"], PANEL_SERIES, PANEL_ORDER, 0.0, panel_layout())


@query(
    "ffill_users_events",
    """WITH g AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'click' THEN value END AS v FROM events)
       SELECT event_id, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS v FROM g""",
)
def _(spark, sf):
    df = load(spark, sf, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") == "click", F.col("value")).alias("v"))
    return fill.fill_gaps(df, ["v"], ["user_id"], EVENT_ORDER).select("event_id", "v")


@query(
    "drop_warmup_panel",
    f"""WITH {PANEL_SQL} SELECT * FROM (SELECT series, week, lag(y, 1) OVER s AS y_lag_1, lag(y, 4) OVER s AS y_lag_4
         FROM panel WINDOW s AS (PARTITION BY series ORDER BY week)) WHERE y_lag_1 IS NOT NULL AND y_lag_4 IS NOT NULL""",
    dates=["week"],
)
def _(spark, sf):
    df = panel(spark, sf).select("series", "week", "y")
    out = features.add_history(df, "y", PANEL_ORDER, PANEL_SERIES, lags=[1, 4], windows=[], mode="composite", layout=panel_layout())
    return cleaning.drop_null_rows(out).drop("y")


@query(
    "ordinal_map_orders",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 END::DOUBLE AS priority_rank,
         CAST(o_orderstatus = 'O' AS INT) AS is_open FROM orders""",
)
def _(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey",
        cleaning.map_values("o_orderpriority", {"1-URGENT": 3, "2-HIGH": 2, "3-MEDIUM": 1}).cast("double").alias("priority_rank"),
        cleaning.bool_to_int(F.col("o_orderstatus") == "O").alias("is_open"),
    )


@query(
    "event_uplift_panel",
    f"""WITH {PANEL_SQL}
       SELECT series, week, CASE WHEN week IN (DATE '1996-10-21', DATE '1997-11-10') THEN CAST(trunc(y * CAST(1.4 AS DOUBLE)) AS DOUBLE) ELSE y END AS festival,
         CASE WHEN month(week) BETWEEN 6 AND 9 AND holiday = 1 THEN CAST(trunc(y * CAST(0.6 AS DOUBLE)) AS DOUBLE) ELSE y END AS monsoon,
         {R("CASE WHEN week BETWEEN DATE '1998-03-01' AND DATE '1998-12-01' THEN y * CAST(0.85 AS DOUBLE) ELSE y END", 4)} AS recession_overall,
         {R("CASE WHEN week BETWEEN DATE '1998-03-01' AND DATE '1998-12-01' THEN y * CAST(0.80 AS DOUBLE) ELSE y END", 4)} AS recession_freight,
         {R("CASE WHEN week BETWEEN DATE '1998-03-01' AND DATE '1998-12-01' THEN y * CAST(0.60 AS DOUBLE) ELSE y END", 4)} AS recession_passenger
       FROM panel""",
    dates=["week"],
)
def _(spark, sf):
    df = panel(spark, sf)
    festival = F.col("week").isin([F.lit("1996-10-21").cast("date"), F.lit("1997-11-10").cast("date")])
    monsoon = F.month("week").between(6, 9) & (F.col("holiday") == 1)
    slump = F.col("week").between(F.lit("1998-03-01").cast("date"), F.lit("1998-12-01").cast("date"))
    return df.select(
        "series",
        "week",
        cleaning.uplift("y", festival, 1.4).alias("festival"),
        cleaning.uplift("y", monsoon, 0.6).alias("monsoon"),
        *[r(cleaning.scale_where("y", slump, f), 4).alias(f"recession_{n}") for n, f in (("overall", 0.85), ("freight", 0.80), ("passenger", 0.60))],
    )


TIERS = {"click": 25.0, "view": 22.0, "purch": 20.0}
SEASONS = {"click": ((1, 2), 1.5), "view": ((3, 4, 9, 10), 1.3)}


@query(
    "demand_drivers_events",
    f"""WITH top AS (SELECT max(value) AS m FROM events)
       SELECT event_id, CASE WHEN hour(ts) BETWEEN 18 AND 20 THEN 1.8 WHEN hour(ts) BETWEEN 8 AND 10 THEN 1.5 ELSE 1.0 END::DOUBLE AS peak,
         CASE WHEN isodow(ts) >= 6 THEN 0.7 ELSE 1.0 END::DOUBLE AS weekend,
         CASE WHEN contains(event_type, 'click') THEN 25 WHEN contains(event_type, 'view') THEN 22 WHEN contains(event_type, 'purch') THEN 20 ELSE 15 END::DOUBLE AS base,
         CASE WHEN event_type = 'click' AND month(ts) IN (1, 2) THEN 1.5 WHEN event_type = 'view' AND month(ts) IN (3, 4, 9, 10) THEN 1.3 ELSE 1.0 END::DOUBLE AS season,
         CASE WHEN event_type = 'purchase' THEN 1.3 ELSE 1.0 END::DOUBLE AS promotion,
         {R("greatest(0.5::DOUBLE, 1.5::DOUBLE - value / m)")} AS price
       FROM events, top""",
)
def _(spark, sf):
    df = load(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    top = df.agg(F.max("value")).scalar()
    return df.select(
        "event_id",
        cleaning.peak_factor(F.hour("ts")).alias("peak"),
        cleaning.weekend_factor(F.weekday("ts")).alias("weekend"),
        cleaning.tier(F.col("event_type"), TIERS, 15.0).alias("base"),
        cleaning.season_factor(F.col("event_type"), F.month("ts"), SEASONS).alias("season"),
        cleaning.promotion_factor((F.col("event_type") == "purchase").cast("int")).alias("promotion"),
        r(cleaning.price_factor(F.col("value"), top)).alias("price"),
    )


@query(
    "clip_residual_panel",
    f"""WITH {PANEL_SQL}, d AS (SELECT series, week, y, 2 * lag(y, 1) OVER s - lag(y, 2) OVER s AS drift FROM panel WINDOW s AS (PARTITION BY series ORDER BY week))
       SELECT series, week, greatest(drift, 0) AS y_pred, y - greatest(drift, 0) AS residual FROM d WHERE drift IS NOT NULL""",
    dates=["week"],
)
def _(spark, sf):
    df = panel(spark, sf).select("series", "week", "y")
    out = with_windows(
        df, PANEL_SERIES, PANEL_ORDER, lambda w: {"drift": features.lagged_sum("y", {1: 2.0, 2: -1.0}, w)}, 2, panel_layout()
    ).filter(F.col("drift").isNotNull())
    out = out.withColumn("y_pred", cleaning.clip_negative("drift"))
    return out.select("series", "week", "y_pred", cleaning.residual("y", "y_pred").alias("residual"))


@query(
    "log_target_roundtrip",
    f"SELECT o_orderkey, {R('ln(1 + o_totalprice)')} AS log_y, {R('o_totalprice', 2)} AS y FROM orders",
)
def _(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", cleaning.log_target("o_totalprice").alias("log_y"))
    return df.select("o_orderkey", r("log_y").alias("log_y"), r(cleaning.unlog_target("log_y"), 2).alias("y"))


@query(
    "filter_series_isin",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O')""",
)
def _(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return cleaning.filter_values(df, o_orderpriority=["1-URGENT", "2-HIGH"], o_orderstatus=["F", "O"])


@query(
    "seasonal_diff_panel",
    f"""WITH {PANEL_SQL}, k AS (SELECT series FROM panel GROUP BY series HAVING COUNT(*) >= 104)
       SELECT series, week, y - lag(y, 1) OVER s - lag(y, 4) OVER s + lag(y, 5) OVER s AS y_diff
       FROM panel WHERE series IN (SELECT series FROM k) WINDOW s AS (PARTITION BY series ORDER BY week)""",
    dates=["week"],
)
def _(spark, sf):
    df = features.series_with_history(panel(spark, sf).select("series", "week", "y"), PANEL_SERIES, 104)
    return features.add_difference(df, "y", PANEL_SERIES, PANEL_ORDER, 1, 1, 4, layout=panel_layout()).drop("y")


@query(
    "topk_series",
    f"WITH {PANEL_SQL} SELECT series, {R('avg(y)', 4)} AS mean FROM panel GROUP BY series ORDER BY avg(y) DESC, series LIMIT 10",
)
def _(spark, sf):
    return profile.top_groups(panel(spark, sf), ["series"], "y", 10).select("series", r("mean", 4).alias("mean"))


@query("newest_events", "SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 200")
def _(spark, sf):
    return leaderboard.newest(load(spark, sf, "events").select("event_id", "ts", "event_type", "value"), "ts", "event_id", 200)


@query("sorted_panel", f"WITH {PANEL_SQL} SELECT series, week, y FROM panel ORDER BY series, week", dates=["week"])
def _(spark, sf):
    return panel(spark, sf).select("series", "week", "y").orderBy("series", "week")


@query("seeded_shuffle")
def _(spark, sf):
    return load(spark, sf, "events").select("event_id", "value").orderBy(F.xxhash64("event_id", F.lit(42)), "event_id")


@query(
    "union_train_val",
    """SELECT event_id, split FROM (
         SELECT event_id, CASE WHEN pos < trunc(n * 0.7) THEN 'train' WHEN pos < trunc(n * 0.85) THEN 'val' ELSE 'test' END AS split
         FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, COUNT(*) OVER () AS n FROM events)) WHERE split <> 'test'""",
)
def _(spark, sf):
    tagged = split.temporal_split(load(spark, sf, "events").select("event_id", "ts"), EVENT_ORDER).select("event_id", "split")
    return tagged.filter(F.col("split").isin("train", "val"))


@query(
    "sales_star_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate, n_name, p_brand, l_extendedprice
       FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON l_partkey = p_partkey""",
)
def _(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    orders = load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    customers = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nations = load(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    parts = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    # customers meet the orders, which are fewer than the lines; the lines move while they have few columns
    placed = cleaning.lookup(orders, customers, "o_custkey")
    out = cleaning.lookup(cleaning.lookup(lines, parts, "l_partkey"), placed, "l_orderkey")
    out = cleaning.lookup(out, nations, "c_nationkey")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "n_name", "p_brand", "l_extendedprice")


@query(
    "aligned_forecasts_panel",
    f"""WITH {FORECAST_SQL} SELECT series, week, y, naive, seasonal, {R("rolling", 4)} AS rolling FROM forecasts""",
    dates=["week"],
)
def _(spark, sf):
    return forecasts(spark, sf).select("series", "week", "y", "naive", "seasonal", r("rolling", 4).alias("rolling"))


_PRICED = "SELECT o_orderkey, o_orderdate, o_orderpriority, o_custkey % 100 AS band, CASE WHEN o_orderkey % 7 <> 3 THEN round(o_totalprice) END AS y FROM orders"


def _ordered_sql(category: str) -> str:
    past = f"OVER (PARTITION BY {category} ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return R(f"(coalesce(SUM(y) {past}, 0) + 10 * m) / (COUNT(y) {past} + 10)", 4)


@query(
    "ordered_target_statistic",
    f"""WITH t AS ({_PRICED}), p AS (SELECT avg(y) AS m FROM t)
       SELECT o_orderkey, {_ordered_sql("o_orderpriority")} AS priority_target, {_ordered_sql("band")} AS band_target FROM t, p""",
)
def _(spark, sf):
    order = ["o_orderdate", "o_orderkey"]
    known = F.when(F.col("o_orderkey") % 7 != 3, F.round("o_totalprice"))  # rows without a target are encoded too
    df = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.col("o_orderpriority").alias("priority"), (F.col("o_custkey") % 100).alias("band"), known.alias("y"))
    out = target_stats.OrderedTargetEncoder(["priority", "band"], "y", order, weight=10.0, prior=target_stats.mean_target(df, "y")).encode_training(df)
    return out.select("o_orderkey", r("priority_target", 4).alias("priority_target"), r("band_target", 4).alias("band_target"))
