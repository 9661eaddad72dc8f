import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from rhythmica.forecast import additive, arima, base, ensemble, intervals, regression, smoothing, trees


def table(spark, series):
    rows = [(name, i, float(v)) for name, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series string, t int, y double").repartition(4)


def ar_series(n, phi, theta=0.0, c=0.0, seed=0):
    rng = np.random.default_rng(seed)
    e, w = rng.normal(0, 1, n), np.zeros(n)
    for i in range(1, n):
        w[i] = c + phi * w[i - 1] + e[i] + theta * e[i - 1]
    return w


@pytest.mark.parametrize("block", [None, "150"])
def test_ar_on_differences(spark, block):
    if block:
        spark.conf.set("spark.rhythmica.rowsPerBlock", block)
    try:
        w = {"a": ar_series(1200, 0.6), "b": ar_series(300, -0.3, seed=1)}
        df = table(spark, {k: np.cumsum(v) for k, v in w.items()})
        fit = arima.fit_arima(df, ["series"], ["t"], "y", arima.ArimaOrder(1, 1, 0, trend=True))
        coefs = {r["series"]: r for r in fit.coefs.collect()}
        steps = {(r["series"], r["step"]): r for r in fit.forecast(3).collect()}
        for k, v in w.items():
            d = np.diff(np.cumsum(v))
            x = np.c_[np.ones(len(d) - 1), d[:-1]]
            want = np.linalg.lstsq(x, d[1:], rcond=None)[0]
            assert coefs[k]["coef"][0] == pytest.approx(want[1], abs=1e-9)
            assert coefs[k]["intercept"] == pytest.approx(want[0], abs=1e-9)
            y, step = np.cumsum(v), d[-1]
            level = y[-1]
            for h in (1, 2, 3):
                step = want[0] + want[1] * step
                level += step
                assert steps[(k, h)]["yhat"] == pytest.approx(level, rel=1e-9)
                assert steps[(k, h)]["lower"] < steps[(k, h)]["yhat"] < steps[(k, h)]["upper"]
            assert steps[(k, 1)]["std"] < steps[(k, 3)]["std"]
    finally:
        spark.conf.unset("spark.rhythmica.rowsPerBlock")


def test_ma_terms_are_recovered_and_survive_cuts(spark):
    df = table(spark, {"a": ar_series(4000, 0.5, theta=0.4)})
    order = arima.ArimaOrder(1, 0, 1, long_ar=12)
    whole = arima.fit_arima(df, ["series"], ["t"], "y", order)
    spark.conf.set("spark.rhythmica.rowsPerBlock", "500")
    try:
        cut = arima.fit_arima(df, ["series"], ["t"], "y", order)
        np.testing.assert_allclose(cut.coefs.first()["coef"], whole.coefs.first()["coef"], rtol=1e-8)
        a = [r["yhat"] for r in whole.forecast(4).orderBy("step").collect()]
        b = [r["yhat"] for r in cut.forecast(4).orderBy("step").collect()]
        np.testing.assert_allclose(a, b, rtol=1e-8)
    finally:
        spark.conf.unset("spark.rhythmica.rowsPerBlock")
    phi, theta = whole.coefs.first()["coef"]
    assert phi == pytest.approx(0.5, abs=0.08) and theta == pytest.approx(0.4, abs=0.08)
    info = whole.info().first()
    assert info["aic"] < info["bic"]


def test_seasonal_difference_forecast(spark):
    season = np.tile([10.0, 20.0, 30.0, 40.0], 40)
    y = season + ar_series(160, 0.0) * 0.01
    fit = arima.fit_arima(table(spark, {"a": y}), ["series"], ["t"], "y", arima.ArimaOrder(1, 0, 0, seasonal_d=1, season=4))
    got = [r["yhat"] for r in fit.forecast(4).orderBy("step").collect()]
    np.testing.assert_allclose(got, [10, 20, 30, 40], atol=0.2)


def test_exogenous_regressor(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, 400)
    y = 3 * x + ar_series(400, 0.5, seed=4) * 0.1
    rows = [("a", i, float(y[i]), float(x[i])) for i in range(390)]
    df = spark.createDataFrame(rows, "series string, t int, y double, x double")
    ahead = spark.createDataFrame([("a", i + 1, float(x[390 + i])) for i in range(10)], "series string, step int, x double")
    fit = arima.fit_arima(df, ["series"], ["t"], "y", arima.ArimaOrder(0, 0, 0), exog=["x"])
    assert fit.coefs.first()["coef"][0] == pytest.approx(3, abs=0.05)
    got = [r["yhat"] for r in fit.forecast(10, future=ahead).orderBy("step").collect()]
    np.testing.assert_allclose(got, y[390:], atol=0.6)
    mixed = arima.fit_arima(df, ["series"], ["t"], "y", arima.ArimaOrder(1, 1, 1), exog=["x"])
    got = [r["yhat"] for r in mixed.forecast(5, future=ahead).orderBy("step").collect()]
    np.testing.assert_allclose(got, y[390:395], atol=0.8)
    with pytest.raises(ValueError):
        fit.forecast(3)


def test_hopeless_series_fall_back(spark):
    df = table(spark, {"flat": [5.0] * 50, "short": [1.0, 2.0], "one": [7.0], "good": np.cumsum(ar_series(200, 0.5))})
    fit = arima.fit_arima(df, ["series"], ["t"], "y", arima.ArimaOrder(1, 1, 1))
    got = {(r["series"], r["step"]): r["yhat"] for r in fit.forecast(2).collect()}
    assert len(got) == 8 and all(np.isfinite(v) for v in got.values())
    assert got[("flat", 2)] == pytest.approx(5.0) and got[("one", 1)] == pytest.approx(7.0)


@pytest.mark.parametrize("block", [None, "30"])
def test_exponential_level(spark, block):
    if block:
        spark.conf.set("spark.rhythmica.rowsPerBlock", block)
    try:
        y = np.random.default_rng(2).normal(50, 10, 400)
        level = y[0]
        for v in y[1:]:
            level = 0.3 * v + 0.7 * level
        got = smoothing.exponential_level(table(spark, {"a": y}), ["series"], ["t"], "y", 0.3).first()
        assert got["level"] == pytest.approx(level, rel=1e-12) and got["n"] == 400
    finally:
        spark.conf.unset("spark.rhythmica.rowsPerBlock")


def test_seasonal_naive(spark):
    got = smoothing.seasonal_naive(table(spark, {"a": range(6)}), ["series"], ["t"], "y", 4).orderBy("t").collect()
    assert [r["yhat"] for r in got] == [None] * 4 + [0.0, 1.0]


@pytest.mark.parametrize("block", [None, "100"])
def test_additive_model(spark, block):
    days = [dt.datetime(2020, 1, 1) + dt.timedelta(days=i) for i in range(900)]
    truth = lambda i, d: 50 + 0.1 * i + 10 * np.sin(2 * np.pi * i / 365.25) + (5 if d.weekday() >= 5 else 0)
    rng = np.random.default_rng(1)
    rows = [("a", d, float(truth(i, d) + rng.normal(0, 0.5)), 1.0) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, y double, z double").repartition(4)
    cut = F.lit(days[800])
    if block:
        spark.conf.set("spark.rhythmica.rowsPerBlock", block)
    try:
        spec = additive.AdditiveSpec(changepoints=5, yearly_order=3)
        model = additive.AdditiveModel(["series"], ["ts"], "ts", "y", spec).fit(df.filter(F.col("ts") < cut))
        out = model.predict(df.filter(F.col("ts") >= cut)).toPandas()
        assert (out["yhat"] - out["y"]).abs().mean() < 2.0
        assert (out["yhat_lower"] < out["yhat_upper"]).all()
        assert model.coefs.first()["n"] == 800
    finally:
        spark.conf.unset("spark.rhythmica.rowsPerBlock")


def test_voting(spark):
    df = spark.createDataFrame([(1.0, 2.0, 6.0)], "a double, b double, c double")
    pick = lambda **k: df.select(ensemble.vote(["a", "b", "c"], **k)).first()[0]
    assert pick() == 3.0 and pick(kind="median") == 2.0 and pick(weights=[0.5, 0.25, 0.25]) == 2.5
    assert df.select(ensemble.vote(["a", "c"], kind="median")).first()[0] == 3.5
    for bad in ({"weights": [0.5, 0.5]}, {"weights": [0.5, 0.5, 0.5]}, {"kind": "max"}):
        with pytest.raises(ValueError):
            pick(**bad)


def test_ridge_stacking_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (300, 2))
    y = x @ [2.0, -1.0] + 3 + rng.normal(0, 0.1, 300)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, y double")
    got = ensemble.Stacking(["a", "b"], alpha=10.0).fit(df, "y")
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 10 * np.eye(2), xc.T @ yc)
    np.testing.assert_allclose(got.coef, want, rtol=1e-9)
    assert got.intercept == pytest.approx(y.mean() - x.mean(0) @ want)
    assert got.predict(df).columns == ["a", "b", "y", "prediction"]


def test_out_of_fold_covers_every_row_once(spark):
    df = spark.range(60).select("id", F.col("id").cast("double").alias("x"), (2.0 * F.col("id") + 1).alias("y"))
    out = ensemble.out_of_fold(df, {"line": regression.LinearForecaster(["x"], "y")}, 3, ["id"]).toPandas()
    assert sorted(out["id"]) == list(range(60))
    np.testing.assert_allclose(out["line"], out["y"], rtol=1e-9)


def test_intervals(spark):
    df = spark.createDataFrame([("a", float(v), float(v + e)) for v, e in zip(range(100), np.linspace(-1, 1, 100))], "s string, p double, y double")
    out = intervals.spread_interval(df, "p", ["s"]).first()
    sd = np.arange(100).std()
    assert out["upper"] - out["p"] == pytest.approx(1.96 * sd)
    band = intervals.residual_interval(df, df, "y", "p", ["s"], 0.8).orderBy("p").first()
    assert band["lower"] == pytest.approx(-0.8) and band["upper"] == pytest.approx(0.8)


@pytest.fixture(scope="module")
def uniform(spark):
    x = np.random.default_rng(42).uniform(0, 1, (400, 5))
    y = 2 * x[:, 0] + 3 * x[:, 1] + 0.1 * np.random.default_rng(1).normal(size=400)
    rows = [(*map(float, r), float(v), i >= 300) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "x0 double, x1 double, x2 double, x3 double, x4 double, y double, late boolean").coalesce(2).cache()


FEATURES = [f"x{i}" for i in range(5)]


def test_trees_importance_and_reproducibility(spark, uniform, tmp_path):
    train, test = uniform.filter("not late"), uniform.filter("late")
    model = trees.random_forest(FEATURES, "y", trees=10, depth=5).fit(train)
    names = [r["feature"] for r in model.importance(spark).collect()]
    assert set(names[:2]) == {"x0", "x1"}
    again = trees.random_forest(FEATURES, "y", trees=10, depth=5).fit(train)
    a, b = ([r["prediction"] for r in m.predict(test).collect()] for m in (model, again))
    assert a == b and len(a) == 100
    model.save(str(tmp_path / "forest"))
    c = [r["prediction"] for r in trees.load_model(str(tmp_path / "forest")).transform(test).collect()]
    assert c == a


def test_boosting_stops_early(uniform):
    model = trees.boosted_trees(FEATURES, "y", rounds=20, depth=3, validation="late", tolerance=0.05).fit(uniform)
    assert 1 <= model.model.stages[-1].getNumTrees < 20


def test_search_orders_trials_and_survives_failures(uniform):
    def build(depth):
        if depth == 99:
            raise RuntimeError("no")
        return trees.random_forest(FEATURES, "y", trees=5, depth=depth)

    out = trees.search(build, trees.grid({"depth": [1, 5, 99]}), uniform.filter("not late"), uniform.filter("late"), "y").collect()
    assert out[0]["params"] == {"depth": "5"} and out[-1]["score"] == float("inf") and out[-1]["status"].startswith("failed")
    assert len(trees.sampled({"a": [1, 2, 3], "b": [1, 2]}, 4, seed=1)) == 4


def test_future_rows(spark):
    df = spark.createDataFrame([("a", dt.datetime(2020, 1, 1)), ("a", dt.datetime(2020, 1, 5)), ("b", dt.datetime(2020, 2, 1))], "s string, ts timestamp_ntz")
    out = base.future_rows(df, ["s"], "ts", 3, "1 day", {"fuel": 3.2}).orderBy("s", "step").collect()
    assert [(r["s"], r["step"], r["ts"].day) for r in out] == [("a", 1, 6), ("a", 2, 7), ("a", 3, 8), ("b", 1, 2), ("b", 2, 3), ("b", 3, 4)]
    assert out[0]["fuel"] == 3.2


def test_tails_are_limited_before_the_shuffle(spark):
    fit = arima.fit_arima(table(spark, {"a": ar_series(100, 0.5)}), ["series"], ["t"], "y", arima.ArimaOrder(1, 1, 0))
    plan = fit.tails()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # partial in every task, then final
    assert [len(r["tail"]) for r in fit.tails().collect()] == [fit.order.reach]


def test_missing_targets_are_left_out(spark):
    y = np.cumsum(ar_series(200, 0.5))
    df = table(spark, {"a": y})
    holes = df.unionByName(spark.createDataFrame([("a", 1000, None), ("a", 1001, float("nan"))], df.schema))
    want, got = (arima.fit_arima(d, ["series"], ["t"], "y").forecast(3).orderBy("step").collect() for d in (df, holes))
    assert [r["yhat"] for r in got] == pytest.approx([r["yhat"] for r in want])


@pytest.mark.parametrize("block", [None, "40"])
def test_expanding_folds_learn_from_earlier_rows_only(spark, block):
    rng = np.random.default_rng(11)
    n = 200
    t = np.sort(rng.integers(0, 90, n))  # times repeat
    a, b = rng.normal(5, 2, n), rng.normal(-3, 1, n)
    y = np.where(np.arange(n) < 100, 2 * a - b, 5 * a + b) + rng.normal(0, 0.1, n)
    rows = [(int(t[i]), i, float(a[i]), float(b[i]), float(y[i])) for i in range(n)]
    rows[7] = (rows[7][0], 7, None, 1.0, 2.0)  # teaches nothing about a
    df = spark.createDataFrame([*rows, (None, 999, 1.0, 1.0, 1.0)], "t int, id int, a double, b double, y double").repartition(4)
    if block:
        spark.conf.set("spark.rhythmica.rowsPerBlock", block)
    try:
        got = {r.id: r for r in ensemble.expanding_out_of_fold(df, "y", {"both": ["a", "b"], "one": ["b"]}, ["t", "id"], folds=4).collect()}
    finally:
        spark.conf.unset("spark.rhythmica.rowsPerBlock")
    assert len(got) == n + 1 and got[999].fold == 0 and got[0].both is None
    ends = [t[n * k // 4 - 1] for k in (1, 2, 3)]
    fold = np.array([sum(x > e for e in ends) for x in t])
    for i in range(n):
        assert got[i].fold == fold[i]
        past = [j for j in range(n) if fold[j] < fold[i]]
        assert all(t[j] < t[i] for j in past)
        for name, xs in (("both", (a, b)), ("one", (b,))):
            if not past or (i == 7 and name == "both"):
                assert got[i][name] is None
                continue
            # the undated row is in fold 0; row 7 has no a, and its b and y are 1 and 2
            used = [j for j in past if not (j == 7 and name == "both")]
            x = np.array([[1.0, *(1.0 if j == 7 else v[j] for v in xs)] for j in used] + [[1.0] * (1 + len(xs))])
            z = np.array([2.0 if j == 7 else y[j] for j in used] + [1.0])
            want = np.linalg.lstsq(x, z, rcond=None)[0] @ np.array([1.0, *(1.0 if i == 7 else v[i] for v in xs)])
            assert got[i][name] == pytest.approx(want, rel=1e-8)
    with pytest.raises(ValueError):
        ensemble.expanding_folds(df, ["t", "id"], 1)
