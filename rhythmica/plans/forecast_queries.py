"""Ensembles, intervals, per-series models and tree learners."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rhythmica.forecast import additive, arima, base, ensemble, ets, fourier, intervals, sarima, smoothing, stl, svd, trees
from rhythmica.forecast.regression import LinearForecaster, fit_linear
from rhythmica.functions import metrics as M

from rhythmica.operators.layout import with_windows
from rhythmica.plans.registry import (
    FORECAST_SQL,
    MODELS,
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
    stored_forecasts,
    stored_panel,
)
from rhythmica.session import settled, shared_dir


@query(
    "voting_mean_weighted_median",
    f"""WITH {FORECAST_SQL} SELECT series, week, naive, seasonal, {R("(naive + seasonal + rolling) / 3", 3)} AS mean,
         {R("naive * 0.5::DOUBLE + seasonal * 0.2::DOUBLE + rolling * 0.3::DOUBLE", 3)} AS weighted,
         {R("list_sort([naive, seasonal, rolling])[2]", 3)} AS middle, {R("(list_sort([naive, seasonal, rolling, y])[2] + list_sort([naive, seasonal, rolling, y])[3]) / 2", 3)} AS middle_even
       FROM forecasts""",
    dates=["week"],
)
def _(spark, sf):
    return forecasts(spark, sf).select(
        "series", "week", "naive", "seasonal",
        r(ensemble.vote(MODELS), 3).alias("mean"),
        r(ensemble.vote(MODELS, [0.5, 0.2, 0.3]), 3).alias("weighted"),
        r(ensemble.vote(MODELS, kind="median"), 3).alias("middle"),
        r(ensemble.vote([*MODELS, "y"], kind="median"), 3).alias("middle_even"),
    )


@query(
    "prediction_interval",
    f"""WITH {FORECAST_SQL}, q AS (SELECT series, quantile_cont(y - rolling, 0.05) AS lo, quantile_cont(y - rolling, 0.95) AS hi FROM forecasts GROUP BY series),
       s AS (SELECT series, stddev_pop(rolling) AS sd FROM forecasts GROUP BY series), g AS (SELECT stddev_pop(rolling) AS sd FROM forecasts)
       SELECT f.series, week, {R("rolling - 1.96 * s.sd", 4)} AS series_lower, {R("rolling + 1.96 * s.sd", 4)} AS series_upper,
         {R("rolling - 1.96 * g.sd", 4)} AS lower, {R("rolling + lo", 4)} AS residual_lower, {R("rolling + hi", 4)} AS residual_upper
       FROM forecasts f JOIN q ON f.series = q.series JOIN s ON f.series = s.series, g""",
    dates=["week"],
)
def _(spark, sf):
    df = stored_forecasts(spark, sf).select("series", "week", "y", "rolling")
    out = intervals.spread_interval(df, "rolling", ["series"]).withColumnsRenamed({"lower": "series_lower", "upper": "series_upper"})
    out = intervals.spread_interval(out, "rolling").withColumnsRenamed({"lower": "all_lower"}).drop("upper")
    out = intervals.residual_interval(out, df, "y", "rolling", ["series"], 0.9)
    return out.select(
        "series", "week", r("series_lower", 4).alias("series_lower"), r("series_upper", 4).alias("series_upper"), r("all_lower", 4).alias("lower"),
        r("lower", 4).alias("residual_lower"), r("upper", 4).alias("residual_upper"),
    )


@query(
    "seasonal_naive_panel",
    f"WITH {PANEL_SQL} SELECT series, week, y, lag(y, 52) OVER (PARTITION BY series ORDER BY week) AS yhat FROM panel",
    dates=["week"],
)
def _(spark, sf):
    return smoothing.seasonal_naive(panel(spark, sf).select("series", "week", "y"), PANEL_SERIES, PANEL_ORDER, "y", 52, layout=panel_layout())


@query(
    "ses_panel",
    f"""WITH RECURSIVE {PANEL_SQL}, n AS (SELECT series, y, row_number() OVER (PARTITION BY series ORDER BY week) AS i, COUNT(*) OVER (PARTITION BY series) AS n FROM panel),
       s AS (SELECT series, i, n, y AS level FROM n WHERE i = 1
             UNION ALL SELECT n.series, n.i, n.n, 0.3::DOUBLE * n.y + 0.7::DOUBLE * s.level FROM s JOIN n ON n.series = s.series AND n.i = s.i + 1)
       SELECT series, {R("level", 3)} AS level, n FROM s WHERE i = n""",
)
def _(spark, sf):
    out = smoothing.exponential_level(panel(spark, sf).select("series", "week", "y"), PANEL_SERIES, PANEL_ORDER, "y", 0.3, layout=panel_layout())
    return out.select("series", r("level", 3).alias("level"), "n")


_ETS = ets.EtsSpec(season=4, alphas=(0.1, 0.3, 0.6), betas=(0.02, 0.1), gammas=(0.1, 0.3), phis=(0.9, 1.0))


def _values(name: str, numbers) -> str:
    return f"(VALUES {', '.join(f'({x}::DOUBLE)' for x in numbers)}) {name}_({name})"


@query(
    "ets_panel",
    f"""WITH RECURSIVE {PANEL_SQL}, n AS (SELECT series, y, row_number() OVER (PARTITION BY series ORDER BY week) - 1 AS i, COUNT(*) OVER (PARTITION BY series) AS n FROM panel),
       h AS (SELECT series, any_value(n) AS n, list(y ORDER BY i) FILTER (i < 4) AS a, list(y ORDER BY i) FILTER (i BETWEEN 4 AND 7) AS b FROM n GROUP BY series),
       grid AS (SELECT * FROM {_values("alpha", _ETS.alphas)}, {_values("beta", _ETS.betas)}, {_values("gamma", _ETS.gammas)}, {_values("phi", _ETS.phis)} WHERE beta <= alpha AND gamma <= 1 - alpha),
       s AS (SELECT series, n, alpha, beta, gamma, phi, 3 AS i, list_avg(a) AS level, (list_avg(b) - list_avg(a)) / 4 AS slope, list_transform(a, lambda x: x - list_avg(a)) AS season, 0::DOUBLE AS sse FROM h, grid
             UNION ALL
             SELECT series, n, alpha, beta, gamma, phi, j, level + phi * slope + alpha * e, phi * slope + beta * e, list_append(season[2:], season[1] + gamma * e), sse + e * e
             FROM (SELECT s.*, p.i AS j, p.y - (level + phi * slope + season[1]) AS e FROM s JOIN n p ON p.series = s.series AND p.i = s.i + 1)),
       best AS (SELECT * FROM s WHERE i = n - 1 QUALIFY row_number() OVER (PARTITION BY series ORDER BY sse) = 1)
       SELECT series, n, alpha, beta, gamma, phi, {R("level", 3)} AS level, {R("slope", 3)} AS slope, {R("sqrt(sse / (n - 4))", 3)} AS rmse,
         {R("level + phi * slope + season[1]", 2)} AS step_1, {R("level + (phi + phi * phi) * slope + season[2]", 2)} AS step_2,
         {R("sqrt(sse / (n - 4) * (1 + (alpha + beta * phi) * (alpha + beta * phi)))", 3)} AS std_2 FROM best""",
)
def _(spark, sf):
    fit = ets.fit_ets(panel(spark, sf).select("series", "week", "y"), PANEL_SERIES, PANEL_ORDER, "y", _ETS, panel_layout())
    at = lambda k, c: F.max(F.when(F.col("step") == k, F.col(c)))
    steps = fit.forecast(2).groupBy("series").agg(at(1, "yhat").alias("step_1"), at(2, "yhat").alias("step_2"), at(2, "std").alias("std_2"))
    return fit.models.join(steps, "series").select(
        "series", "n", "alpha", "beta", "gamma", "phi", r("level", 3).alias("level"), r("slope", 3).alias("slope"), r(F.sqrt(F.col("sse") / (F.col("n") - 4)), 3).alias("rmse"),
        r("step_1", 2).alias("step_1"), r("step_2", 2).alias("step_2"), r("std_2", 3).alias("std_2"),
    )


def _two_regressors(y: str, a: str, b: str) -> str:
    """SQL of both slopes and the intercept of y on a and b."""
    det = f"(var_pop({a}) * var_pop({b}) - covar_pop({a}, {b}) ** 2)"
    one = f"((covar_pop({y}, {a}) * var_pop({b}) - covar_pop({y}, {b}) * covar_pop({a}, {b})) / {det})"
    two = f"((covar_pop({y}, {b}) * var_pop({a}) - covar_pop({y}, {a}) * covar_pop({a}, {b})) / {det})"
    return f"{one} AS b1, {two} AS b2, avg({y}) - {one} * avg({a}) - {two} * avg({b}) AS b0"


@query(
    "fourier_ar_panel",
    f"""WITH {PANEL_SQL}, n AS (SELECT series, y, row_number() OVER (PARTITION BY series ORDER BY week) - 1 AS t FROM panel),
       w AS (SELECT series, t, y, cos(2 * pi() * (t % 52) / 52) AS c, sin(2 * pi() * (t % 52) / 52) AS s FROM n),
       l AS (SELECT *, lag(y) OVER w AS y1, lag(c) OVER w AS c1, lag(s) OVER w AS s1 FROM w WINDOW w AS (PARTITION BY series ORDER BY t)),
       first AS (SELECT series, {_two_regressors("y", "c", "s")} FROM l WHERE t > 0 GROUP BY series),
       ar AS (SELECT series, regr_slope(y - b1 * c - b2 * s, y1 - b1 * c1 - b2 * s1) AS phi FROM l JOIN first USING (series) WHERE t > 0 GROUP BY series),
       f AS (SELECT series, t, phi, y - phi * y1 AS fy, c - phi * c1 AS fc, s - phi * s1 AS fs FROM l JOIN ar USING (series) WHERE t > 0),
       second AS (SELECT series, COUNT(*) AS n, any_value(phi) AS phi, {_two_regressors("fy", "fc", "fs")} FROM f GROUP BY series),
       e AS (SELECT series, sqrt(SUM((fy - b0 - b1 * fc - b2 * fs) ** 2) / any_value(n - 4)) AS sigma FROM f JOIN second USING (series) GROUP BY series),
       z AS (SELECT series, max(t) + 1 AS t, arg_max(y, t) AS y, arg_max(c, t) AS c, arg_max(s, t) AS s FROM w GROUP BY series)
       SELECT series, n, {R("b1", 2)} AS cosine, {R("b2", 2)} AS sine, {R("m.phi", 6)} AS phi, {R("b0", 2)} AS intercept, {R("sigma", 2)} AS sigma,
         {R("b0 + b1 * cos(2 * pi() * (t % 52) / 52) + b2 * sin(2 * pi() * (t % 52) / 52) + m.phi * (y - b1 * c - b2 * s)", 2)} AS step_1,
         {R("sigma * sqrt(1 + m.phi * m.phi)", 2)} AS std_2
       FROM second m JOIN e USING (series) JOIN z USING (series)""",
)
def _(spark, sf):
    spec = fourier.FourierSpec(period=52, harmonics=1, order=1, rounds=1)  # the SQL states one round
    fit = fourier.fit_fourier(panel(spark, sf).select("series", "week", "y"), PANEL_SERIES, PANEL_ORDER, "y", spec, panel_layout())
    at = lambda k, c: F.max(F.when(F.col("step") == k, F.col(c)))
    steps = fit.forecast(2).groupBy("series").agg(at(1, "yhat").alias("step_1"), at(2, "std").alias("std_2"))
    return fit.models.where("ok").join(steps, "series").select(
        "series", "n", r(F.col("beta")[0], 2).alias("cosine"), r(F.col("beta")[1], 2).alias("sine"), r(F.col("phi")[0], 6).alias("phi"),
        r("intercept", 2).alias("intercept"), r("sigma", 2).alias("sigma"), r("step_1", 2).alias("step_1"), r("std_2", 2).alias("std_2"),
    )


@query("fourier_ar_forecast_panel")
def _(spark, sf):
    spec = fourier.FourierSpec(period=365.25 / 7, harmonics=3, order=4)
    return fourier.fit_fourier(panel(spark, sf).select("series", "week", "y"), PANEL_SERIES, PANEL_ORDER, "y", spec, panel_layout()).forecast(26)


@query(
    "svd_rebuild_panel",
    f"""WITH RECURSIVE {PANEL_SQL}, g AS (SELECT a.region, a.series AS s, b.series AS t, SUM(a.y / 1000 * (b.y / 1000)) AS g FROM panel a JOIN panel b USING (region, week) GROUP BY ALL),
       u AS (SELECT DISTINCT region, s, 1::DOUBLE AS u, 0 AS i FROM g
             UNION ALL
             SELECT region, s, x / sqrt(SUM(x * x) OVER (PARTITION BY region)), i + 1
             FROM (SELECT region, g.s, i, SUM(g.g * u.u) AS x FROM u JOIN g USING (region) WHERE g.t = u.s AND i < 200 GROUP BY region, g.s, i)),
       one AS (SELECT region, s AS series, u FROM u WHERE i = 200),
       course AS (SELECT region, week, SUM(u * y) AS v FROM panel JOIN one USING (region, series) GROUP BY region, week)
       SELECT region, series, week, {R("u * v", 1)} AS fitted, {R("sqrt(SUM(v * v) OVER (PARTITION BY region, series))", 1)} AS weight
       FROM one JOIN course USING (region)""",
    dates=["week"],
)
def _(spark, sf):
    fit = svd.fit_svd(panel(spark, sf).select("region", "series", "week", "y"), ["region"], ["series"], "week", "y", 1, center=False)
    weight = fit.components.select("region", r(F.col("weights")[0], 1).alias("weight"))
    return fit.rebuild().join(weight, "region").select("region", "series", "week", r("fitted", 1).alias("fitted"), "weight")


@query("svd_forecast_panel")
def _(spark, sf):
    fit = svd.fit_svd(panel(spark, sf).select("region", "series", "week", "y"), ["region"], ["series"], "week", "y", 2)
    return fit.forecast(8, ets.EtsSpec(season=4)).select("region", "series", "step", r("yhat", 2).alias("yhat"))


@query("stl_panel")
def _(spark, sf):
    spec = stl.StlSpec(period=52, seasonal=7, outer=1)
    return stl.decompose(panel(spark, sf).select("series", "week", "y"), PANEL_SERIES, PANEL_ORDER, "y", spec, panel_layout()).drop("_pos", "_n")


@query("stl_forecast_panel")
def _(spark, sf):
    spec = stl.StlSpec(period=13, seasonal=9)
    return stl.forecast_stl(panel(spark, sf).select("series", "week", "y"), PANEL_SERIES, PANEL_ORDER, "y", spec, 26, layout=panel_layout())


_AR1_SQL = f"""{PANEL_SQL}, d AS (SELECT series, week, y, y - lag(y, 1) OVER w AS d0, lag(y, 1) OVER w - lag(y, 2) OVER w AS d1 FROM panel WINDOW w AS (PARTITION BY series ORDER BY week)),
  fit AS (SELECT series, regr_slope(d0, d1) AS slope, regr_intercept(d0, d1) AS intercept, regr_count(d0, d1) AS n FROM d GROUP BY series),
  last AS (SELECT series, arg_max(y, week) AS y, arg_max(d0, week) AS d0 FROM d GROUP BY series)"""


@query(
    "ar1_per_series",
    f"""WITH {_AR1_SQL} SELECT series, CAST(n AS BIGINT) AS n, {R("slope")} AS slope, {R("intercept", 3)} AS intercept,
         {R("y + intercept + slope * d0", 2)} AS step_1, {R("y + intercept + slope * d0 + intercept + slope * (intercept + slope * d0)", 2)} AS step_2
       FROM fit JOIN last USING (series)""",
)
def _(spark, sf):
    fit = arima.fit_arima(stored_panel(spark, sf).select("series", "week", "y"), PANEL_SERIES, PANEL_ORDER, "y", arima.ArimaOrder(1, 1, 0, trend=True), panel_layout())
    steps = fit.forecast(2).groupBy("series").agg(*[F.max(F.when(F.col("step") == k, F.col("yhat"))).alias(f"step_{k}") for k in (1, 2)])
    return fit.coefs.join(steps, "series").select(
        "series", "n", r(F.col("coef")[0]).alias("slope"), r("intercept", 3).alias("intercept"), r("step_1", 2).alias("step_1"), r("step_2", 2).alias("step_2")
    )


@query("arima_ma_panel")
def _(spark, sf):
    fit = arima.fit_arima(stored_panel(spark, sf).select("series", "week", "y"), PANEL_SERIES, PANEL_ORDER, "y", arima.ArimaOrder(1, 1, 1), panel_layout())
    return fit.forecast(8).join(fit.info().select("series", "aic", "bic", "ok"), "series")


@query("seasonal_arima_panel")
def _(spark, sf):
    order = arima.ArimaOrder(1, 0, 1, seasonal_p=1, seasonal_d=1, season=13)
    fit = arima.fit_arima(stored_panel(spark, sf).select("series", "week", "y"), PANEL_SERIES, PANEL_ORDER, "y", order, panel_layout())
    return fit.forecast(13)


def _moving_average_sql(rounds: int) -> str:
    """Gauss-Newton rounds for a level and one moving-average term, each a recursion over the rows."""
    parts = ["f0 AS (SELECT DISTINCT series, 0::DOUBLE AS c, 0::DOUBLE AS q FROM n)"]
    for k in range(rounds):
        parts.append(
            f"""r{k} AS (SELECT n.series, i, y - c AS e, -1::DOUBLE AS gc, 0::DOUBLE AS gq, c, q FROM n JOIN f{k} USING (series) WHERE i = 1
                UNION ALL SELECT n.series, n.i, n.y - c - q * e, -1 - q * gc, -e - q * gq, c, q FROM r{k} r JOIN n ON n.series = r.series AND n.i = r.i + 1),
               g{k} AS (SELECT series, any_value(c) AS c, any_value(q) AS q, SUM(gc * gc) AS cc, SUM(gq * gq) AS qq, SUM(gc * gq) AS cq, SUM(gc * e) AS ce, SUM(gq * e) AS qe, SUM(e * e) AS sse,
                   arg_max(e, i) AS last, COUNT(*) AS n FROM r{k} GROUP BY series),
               f{k + 1} AS (SELECT series, c - (ce * qq - qe * cq) / (cc * qq - cq * cq) AS c, q - (qe * cc - ce * cq) / (cc * qq - cq * cq) AS q FROM g{k})"""
        )
    return ", ".join(parts)


@query(
    "sarima_css_panel",
    f"""WITH RECURSIVE {PANEL_SQL}, n AS (SELECT series, y, row_number() OVER (PARTITION BY series ORDER BY week) AS i FROM panel), {_moving_average_sql(7)}
       SELECT series, n, {R("q", 4)} AS ma_1, {R("c", 0)} AS level, {R("sqrt(sse / n)", 2)} AS sigma, {R("c + q * last", 0)} AS step_1, {R("sqrt(sse / n * (1 + q * q))", 2)} AS std_2 FROM g6""",
)
def _(spark, sf):
    df, spec = panel(spark, sf).select("series", "week", "y"), sarima.SarimaSpec(0, 0, 1, trend="c")
    # the SQL states six undamped rounds, converged or not
    fit = sarima.fit_sarima(df, PANEL_SERIES, PANEL_ORDER, "y", spec, rounds=6, tolerance=0.0, damping=0.0, layout=panel_layout())
    at = lambda k, c: F.max(F.when(F.col("step") == k, F.col(c)))
    steps = fit.forecast(2).groupBy("series").agg(at(1, "yhat").alias("step_1"), at(2, "std").alias("std_2"))
    return fit.parameters().join(steps, "series").select(
        "series", "n", r("ma_1", 4).alias("ma_1"), r("level", 0).alias("level"), r("sigma", 2).alias("sigma"), r("step_1", 0).alias("step_1"), r("std_2", 2).alias("std_2")
    )


@query("sarima_season_panel")
def _(spark, sf):
    spec = sarima.SarimaSpec(1, 0, 1, 1, 0, 1, 13, "ct")
    return sarima.fit_sarima(panel(spark, sf).select("series", "week", "y"), PANEL_SERIES, PANEL_ORDER, "y", spec, layout=panel_layout()).forecast(13)


@query("arima_users_events")
def _(spark, sf):
    df = load(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    return arima.fit_arima(df, ["user_id"], ["ts", "event_id"], "value", arima.ArimaOrder(1, 1, 1)).forecast(3)


@query(
    "batch_score_panel",
    f"""WITH {PANEL_SQL}, l AS (SELECT series, week, y, lag(y, 1) OVER w AS l1, lag(y, 4) OVER w AS l4 FROM panel WINDOW w AS (PARTITION BY series ORDER BY week)),
       fit AS (SELECT series, regr_slope(y, l1) AS slope, regr_intercept(y, l1) AS intercept FROM l GROUP BY series)
       SELECT l.series, week, y, {R("intercept + slope * l1", 2)} AS prediction FROM l JOIN fit USING (series) WHERE l1 IS NOT NULL""",
    dates=["week"],
)
def _(spark, sf):
    lagged = with_windows(panel(spark, sf).select("series", "week", "y"), PANEL_SERIES, PANEL_ORDER, lambda w: {"l1": F.lag("y", 1).over(w)}, 1, panel_layout())
    path = shared_dir(spark, "models")
    fit_linear(lagged, PANEL_SERIES, "y", ["l1"]).write.parquet(path)
    rows = base.score_with_table(lagged.filter(F.col("l1").isNotNull()), spark.read.parquet(path), PANEL_SERIES, ["l1"])
    return rows.select("series", "week", "y", r("prediction", 2).alias("prediction"))


@query(
    "horizon_frame_panel",
    f"""WITH {PANEL_SQL}, l AS (SELECT series, max(week) AS last FROM panel GROUP BY series)
       SELECT series, CAST(i AS INT) AS step, CAST(last + CAST(7 * i AS INT) AS DATE) AS week, 3.2::DOUBLE AS fuel_price FROM l, range(1, 9) t(i)""",
    dates=["week"],
)
def _(spark, sf):
    out = base.future_rows(panel(spark, sf), ["series"], "week", 8, "7 days", {"fuel_price": 3.2})
    return out.withColumn("week", F.col("week").cast("date"))


def _ridge_sql(alpha: float) -> str:
    return f"""WITH {FORECAST_SQL}, m AS (SELECT COUNT(*) AS n, avg(y) AS my, avg(naive) AS ma, avg(rolling) AS mb,
         covar_pop(naive, naive) AS aa, covar_pop(rolling, rolling) AS bb, covar_pop(naive, rolling) AS ab, covar_pop(naive, y) AS ay, covar_pop(rolling, y) AS by_ FROM forecasts),
       e AS (SELECT *, aa + {alpha} / n AS a2, bb + {alpha} / n AS b2 FROM m),
       c AS (SELECT *, (ay * b2 - by_ * ab) / (a2 * b2 - ab * ab) AS ca, (by_ * a2 - ay * ab) / (a2 * b2 - ab * ab) AS cb FROM e)
       SELECT series, week, {R("my - ca * ma - cb * mb + ca * naive + cb * rolling", 2)} AS prediction FROM forecasts, c"""


@query("ridge_stacking", _ridge_sql(1000.0), dates=["week"])
def _(spark, sf):
    df = stored_forecasts(spark, sf).select("series", "week", "y", "naive", "rolling")
    model = ensemble.Stacking(["naive", "rolling"], alpha=1000.0).fit(df, "y")
    return model.predict(df).select("series", "week", r("prediction", 2).alias("prediction"))


def _fold_sql(column: str, feature: str) -> str:
    fits = ", ".join(f"regr_slope(y, {feature}) FILTER (fold < {k}) AS s{k}, regr_intercept(y, {feature}) FILTER (fold < {k}) AS i{k}" for k in (1, 2))
    return f"{column}_fit AS (SELECT {fits} FROM folded)"


_OOF_BASES = {"by_naive": ["naive"], "by_rolling": ["rolling"]}


@query(
    "expanding_stacking",
    f"""WITH {FORECAST_SQL}, placed AS (SELECT series, week, y, naive, rolling, row_number() OVER (ORDER BY week, series) - 1 AS pos, COUNT(*) OVER () AS n FROM forecasts),
       cuts AS (SELECT max(week) FILTER (pos = n * 1 // 3 - 1) AS c1, max(week) FILTER (pos = n * 2 // 3 - 1) AS c2 FROM placed),
       folded AS (SELECT series, week, y, naive, rolling, CAST(week > c1 AS INT) + CAST(week > c2 AS INT) AS fold FROM placed, cuts),
       {_fold_sql("naive", "naive")}, {_fold_sql("rolling", "rolling")},
       based AS (SELECT series, week, y, fold, CASE fold WHEN 1 THEN a.i1 + a.s1 * naive WHEN 2 THEN a.i2 + a.s2 * naive END AS by_naive,
                        CASE fold WHEN 1 THEN b.i1 + b.s1 * rolling WHEN 2 THEN b.i2 + b.s2 * rolling END AS by_rolling FROM folded, naive_fit a, rolling_fit b),
       m AS (SELECT COUNT(*) AS n, avg(y) AS my, avg(by_naive) AS ma, avg(by_rolling) AS mb, var_pop(by_naive) + 1000.0 / COUNT(*) AS aa, var_pop(by_rolling) + 1000.0 / COUNT(*) AS bb,
                    covar_pop(by_naive, by_rolling) AS ab, covar_pop(by_naive, y) AS ay, covar_pop(by_rolling, y) AS yb FROM based WHERE fold > 0),
       c AS (SELECT *, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS ca, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS cb FROM m)
       SELECT series, week, fold, {R("by_naive", 2)} AS by_naive, {R("by_rolling", 2)} AS by_rolling,
              {R("my - ca * ma - cb * mb + ca * by_naive + cb * by_rolling", 2)} AS prediction FROM based, c WHERE fold > 0""",
    dates=["week"],
)
def _(spark, sf):
    df = stored_forecasts(spark, sf).select("series", "week", "y", "naive", "rolling")
    based = settled(ensemble.expanding_out_of_fold(df, "y", _OOF_BASES, ["week", "series"]).where("fold > 0"), "based")
    stacked = ensemble.Stacking(list(_OOF_BASES), alpha=1000.0).fit(based, "y").predict(based)
    return stacked.select("series", "week", "fold", *[r(c, 2).alias(c) for c in (*_OOF_BASES, "prediction")])


def _value_features(spark, sf):
    """Event-level supervised table with signal: price from quantity, size and discount."""
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    parts = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", F.col("p_size").cast("double").alias("p_size"))
    df = lines.join(parts, "l_partkey")
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    return df.withColumn("is_validation", F.col("l_shipdate") >= cut)


_X = ["l_quantity", "p_retailprice", "l_discount", "p_size"]


@query("random_forest_lineitem")
def _(spark, sf):
    df = settled(_value_features(spark, sf), "trees")
    model = trees.random_forest(_X, "l_extendedprice", trees=10, depth=5).fit(df.filter("not is_validation"))
    scored = model.predict(df.filter("is_validation"))
    return scored.agg(F.count(F.lit(1)).alias("n"), M.r2("l_extendedprice", "prediction").alias("r2"), M.mae("l_extendedprice", "prediction").alias("mae"))


@query("gbt_lineitem")
def _(spark, sf):
    df = settled(_value_features(spark, sf), "trees")
    model = trees.boosted_trees(_X, "l_extendedprice", rounds=8, depth=4, validation="is_validation").fit(df)
    scored = model.predict(df.filter("is_validation"))
    return scored.agg(F.count(F.lit(1)).alias("n"), M.r2("l_extendedprice", "prediction").alias("r2"), M.mae("l_extendedprice", "prediction").alias("mae"))


@query("feature_importance")
def _(spark, sf):
    df = _value_features(spark, sf).filter("not is_validation")
    return trees.random_forest(_X, "l_extendedprice", trees=8, depth=5).fit(df).importance(spark)


@query("param_search")
def _(spark, sf):
    df = settled(_value_features(spark, sf), "search")
    trials = trees.sampled({"trees": [4, 8], "depth": [3, 5, 7], "min_leaf": [1, 5]}, 4)
    return trees.search(
        lambda **p: trees.random_forest(_X, "l_extendedprice", **p), trials, df.filter("not is_validation"), df.filter("is_validation"), "l_extendedprice"
    )


_RUNG_TRIALS = [{"feature": c} for c in ("l_tax", "l_quantity", "l_discount", "p_size", "p_retailprice")]


def _rung_sql(rung: int, share: int) -> str:
    """Scores of the trials that are alive in a rung, by regressions on one feature."""
    window = "l_shipdate < TIMESTAMP '2000-01-01'" + ("" if share == 1 else f" AND l_shipdate >= (SELECT min(l_shipdate) FILTER (i = n - greatest(n // {share}, 1)) FROM placed)")
    scores = " UNION ALL ".join(
        f"""SELECT {i} AS trial, sqrt(avg((y - b - a * x) ** 2)) AS score FROM (SELECT l_extendedprice AS y, {t["feature"]} AS x FROM rows WHERE l_shipdate >= TIMESTAMP '2000-01-01'),
            (SELECT regr_slope(l_extendedprice, {t["feature"]}) AS a, regr_intercept(l_extendedprice, {t["feature"]}) AS b FROM rows WHERE {window})"""
        for i, t in enumerate(_RUNG_TRIALS)
    )
    alive = f"trial IN (SELECT trial FROM rung{rung - 1} WHERE kept)" if rung else "TRUE"
    keep = "1" if share == 1 else "ceil(COUNT(*) OVER () / 2)"
    return f"rung{rung} AS (SELECT {rung}::INT AS rung, trial::INT AS trial, {share}::INT AS share_of_rows, score, row_number() OVER (ORDER BY score, trial) <= {keep} AS kept FROM ({scores}) WHERE {alive})"


@query(
    "successive_halving_lineitem",
    f"""WITH rows AS (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax, p_retailprice, CAST(p_size AS DOUBLE) AS p_size FROM lineitem JOIN part ON l_partkey = p_partkey),
       placed AS (SELECT l_shipdate, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) - 1 AS i, COUNT(*) OVER () AS n FROM rows WHERE l_shipdate < TIMESTAMP '2000-01-01'),
       {_rung_sql(0, 4)}, {_rung_sql(1, 2)}, {_rung_sql(2, 1)}
       SELECT rung, trial, share_of_rows, {R("score", 3)} AS score, kept FROM (SELECT * FROM rung0 UNION ALL SELECT * FROM rung1 UNION ALL SELECT * FROM rung2)""",
)
def _(spark, sf):
    df = settled(_value_features(spark, sf), "rungs")
    out = trees.successive_halving(
        lambda feature: LinearForecaster([feature], "l_extendedprice"), _RUNG_TRIALS, df.filter("not is_validation"), df.filter("is_validation"), "l_extendedprice",
        ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"],
    )
    return out.select("rung", "trial", "share_of_rows", r("score", 3).alias("score"), "kept")


@query("categorical_boosting_lineitem")
def _(spark, sf):
    brands = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    used = [*order, "l_quantity", "l_discount", "l_extendedprice", "p_brand", "p_type", "is_validation"]
    df = settled(_value_features(spark, sf).join(brands, "l_partkey").select(*used), "trees")
    model = trees.categorical_boosted_trees(["l_quantity", "l_discount"], ["l_partkey", "p_brand", "p_type"], "l_extendedprice", order, weight=5.0, rounds=8, depth=4)
    scored = model.fit(df.filter("not is_validation")).predict(df.filter("is_validation"))
    return scored.agg(F.count(F.lit(1)).alias("n"), M.r2("l_extendedprice", "prediction").alias("r2"), M.mae("l_extendedprice", "prediction").alias("mae"))


@query("additive_forecast")
def _(spark, sf):
    df = stored_panel(spark, sf).select("series", "week", "y", "holiday")
    spec = additive.AdditiveSpec(changepoints=10, yearly_order=4, weekly_order=0, regressors=("holiday",))
    model = additive.AdditiveModel(PANEL_SERIES, PANEL_ORDER, "week", "y", spec).fit(df.filter(F.col("week") < F.lit(dt.date(2000, 1, 3))), panel_layout())
    return model.predict(df.filter(F.col("week") >= F.lit(dt.date(2000, 1, 3))))


@query("fallback_ensemble_panel", f"""WITH {FORECAST_SQL} SELECT series, week, {R("coalesce((y52 + rolling) / 2, rolling)", 3)} AS prediction
       FROM (SELECT f.*, lag(y, 52) OVER (PARTITION BY series ORDER BY week) AS y52 FROM forecasts f)""", dates=["week"])
def _(spark, sf):
    df = smoothing.seasonal_naive(forecasts(spark, sf), PANEL_SERIES, PANEL_ORDER, "y", 52, "y52", panel_layout())
    return df.select("series", "week", r(F.coalesce(ensemble.vote(["y52", "rolling"]), F.col("rolling")), 3).alias("prediction"))


