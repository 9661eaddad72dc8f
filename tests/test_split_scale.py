import numpy as np
import pytest
from conftest import ORDER
from pyspark.sql import functions as F

from rhythmica.operators import scale, split
from rhythmica.operators.quantiles import column_quantiles, exact_quantiles


def counts(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


@pytest.fixture(scope="module")
def hundred(spark):
    return spark.range(100).select("id", F.expr("timestamp_seconds(id * 86400)").alias("ts"), F.col("id").cast("double").alias("y")).repartition(4)


def test_default_and_custom_ratios(hundred):
    assert counts(split.temporal_split(hundred, ["ts", "id"])) == {"train": 70, "val": 15, "test": 15}
    assert counts(split.temporal_split(hundred, ["ts", "id"], 0.8, 0.1)) == {"train": 80, "val": 10, "test": 10}
    assert counts(split.temporal_split(hundred, ["ts", "id"], 1.0, 0.0)) == {"train": 100}


def test_split_is_in_time_order(hundred):
    out = split.temporal_split(hundred, ["ts", "id"]).groupBy("split").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).collect()
    r = {x["split"]: x for x in out}
    assert r["train"]["b"] < r["val"]["a"] and r["val"]["b"] < r["test"]["a"]


def test_split_needs_no_shuffle_of_rows(hundred):
    plan = split.temporal_split(hundred, ["ts", "id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan


def test_cut_table_splits_alike(panel, panel_pdf, small_blocks):
    got = counts(split.temporal_split(panel, ORDER))
    n = len(panel_pdf)
    assert got == {"train": int(n * 0.7), "val": int(n * 0.85) - int(n * 0.7), "test": n - int(n * 0.85)}


def test_series_and_horizon_split(panel, small_blocks):
    got = split.series_split(panel, ["series"], ORDER).groupBy("series", "split").count().collect()
    by = {(r["series"], r["split"]): r["count"] for r in got}
    assert by[("hot", "train")] == 420 and by[("hot", "val")] == 90 and by[("hot", "test")] == 90
    h = split.horizon_split(panel, ["series"], ORDER, 10, 20, 50).groupBy("series", "split").count().collect()
    by = {(r["series"], r["split"]): r["count"] for r in h}
    assert by[("mid", "test")] == 10 and by[("mid", "val")] == 20 and ("tiny", "train") not in by


@pytest.mark.parametrize("block", ["40", "1000000"])
def test_exact_quantiles(spark, panel, panel_pdf, block):
    spark.conf.set("spark.rhythmica.rowsPerBlock", block)
    try:
        probs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
        names = [f"q{i}" for i in range(len(probs))]
        got = {r["series"]: r for r in exact_quantiles(panel, ["series"], "y", probs, names).collect()}
        for s, g in panel_pdf.dropna().groupby("series"):
            np.testing.assert_allclose([got[s][n] for n in names], np.quantile(g["y"], probs), rtol=1e-12)
        whole = exact_quantiles(panel, [], "y", [0.5], ["m"]).first()["m"]
        assert whole == pytest.approx(panel_pdf["y"].median())
    finally:
        spark.conf.unset("spark.rhythmica.rowsPerBlock")


def test_column_quantiles_with_many_equal_values(spark, small_blocks):
    df = spark.range(1000).select((F.col("id") % 3).cast("double").alias("a"), F.lit(5.0).alias("b"))
    got = {r["column"]: r for r in column_quantiles(df, ["a", "b"], [0.25, 0.5, 0.75], ["x", "y", "z"]).collect()}
    assert tuple(got["a"])[1:] == (0.0, 1.0, 2.0) and tuple(got["b"])[1:] == (5.0, 5.0, 5.0)


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), 7.0) for a, b in zip(rng.normal(5, 3, 200), rng.exponential(10, 200))]
    return spark.createDataFrame(rows, "a double, b double, c double"), np.array(rows)


def test_scalers_match_formulas(numbers):
    df, x = numbers
    cases = [
        (scale.StandardScaler(["a", "b", "c"]), (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)),
        (scale.RobustScaler(["a", "b", "c"]), (x - np.median(x, 0)) / np.where((i := np.quantile(x, 0.75, 0) - np.quantile(x, 0.25, 0)) > 0, i, 1)),
        (scale.MinMaxScaler(["a", "b", "c"]), (x - x.min(0)) / np.where((w := np.ptp(x, 0)) > 0, w, 1)),
    ]
    for scaler, want in cases:
        got = scaler.fit(df).transform(df).toPandas().to_numpy()
        np.testing.assert_allclose(np.sort(got, 0), np.sort(want, 0), rtol=1e-9, atol=1e-12)
        back = scaler.inverse(scaler.transform(df)).toPandas().to_numpy()
        np.testing.assert_allclose(np.sort(back, 0), np.sort(x, 0), atol=1e-9)


def test_chain_modes_and_target_inverse(numbers):
    df, x = numbers
    steps = lambda: [("robust", scale.RobustScaler(["a"])), ("standard", scale.StandardScaler(["a"])), ("target_s", scale.StandardScaler(["b"]))]
    raw, chained = scale.ScalerChain(steps()).fit(df), scale.ScalerChain(steps(), fit="chained").fit(df)
    r = (x[:, 0] - np.median(x[:, 0])) / (np.quantile(x[:, 0], 0.75) - np.quantile(x[:, 0], 0.25))
    got_raw = raw.transform(df).toPandas()["a"].to_numpy()
    np.testing.assert_allclose(np.sort(got_raw), np.sort((r - x[:, 0].mean()) / x[:, 0].std()), rtol=1e-9)
    got = chained.transform(df).toPandas()["a"].to_numpy()
    np.testing.assert_allclose(np.sort(got), np.sort((r - r.mean()) / r.std()), rtol=1e-9, atol=1e-9)
    back = raw.inverse_target(raw.transform(df), ["b"], "b").toPandas()["b"]
    np.testing.assert_allclose(np.sort(back), np.sort(x[:, 1]), atol=1e-9)
    back = chained.inverse_features(chained.transform(df)).toPandas()["a"]
    np.testing.assert_allclose(np.sort(back), np.sort(x[:, 0]), atol=1e-9)
    with pytest.raises(RuntimeError):
        scale.ScalerChain(steps()).transform(df)


def test_sketched_robust_scaler_is_close(numbers):
    df, x = numbers
    rough = scale.RobustScaler(["b"], exact=False).fit(df).params["b"]
    exact = scale.RobustScaler(["b"]).fit(df).params["b"]
    np.testing.assert_allclose(rough, exact, rtol=0.1)


def test_brackets_hold_every_rank_of_large_groups(spark, small_blocks):
    # above the size from which groups are bracketed; one group holds most rows, values repeat
    df = spark.range(60_000).select(
        F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("s"), (F.floor(F.pow(F.rand(5), 3) * 5000) / 7).alias("y")
    )
    rows = df.toPandas()
    frozen = spark.createDataFrame(rows)
    spark.conf.set("spark.rhythmica.rowsPerBlock", "2000")
    probs, names = [0.0, 0.01, 0.25, 0.5, 0.975, 1.0], list("uvwxyz")
    for by in (["s"], []):
        got = exact_quantiles(frozen, by, "y", probs, names).collect()
        for r in got:
            part = rows[rows.s == r["s"]] if by else rows
            np.testing.assert_allclose([r[n] for n in names], np.quantile(part["y"], probs), rtol=1e-12)
