import numpy as np
import pandas as pd
import pytest
from conftest import ORDER, by_id
from pyspark.sql import functions as F

from rhythmica.operators import features, fill
from rhythmica.operators.joins import join_per_group
from rhythmica.operators.layout import keys_at, plan_layout, with_position, with_windows


def expected_history(pdf, lags, windows):
    out = pdf.sort_values(["series", "ts", "id"]).copy()
    g = out.groupby("series")["y"]
    for k in lags:
        out[f"y_lag_{k}"] = g.shift(k)
    for n in windows:
        out[f"y_rolling_mean_{n}"] = g.transform(lambda x, n=n: x.shift(1).rolling(n, min_periods=1).mean())
        out[f"y_rolling_std_{n}"] = g.transform(lambda x, n=n: x.shift(1).rolling(n, min_periods=1).std())
    return out.sort_values("id").reset_index(drop=True)


def same(got, want, columns):
    for c in columns:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_long_series_is_cut(panel, small_blocks):
    layout = plan_layout(panel, ["series"], ORDER, reach=7)
    assert layout.cuts is not None and layout.rows == panel.count()
    sizes = layout.spread(panel).groupBy("series", "_blk").count().toPandas()
    assert sizes[sizes.series == "hot"]["count"].max() < 300
    assert (sizes[sizes.series == "hot"]._blk.nunique()) > 5
    assert sizes[sizes.series == "tiny"]._blk.nunique() == 1


def test_short_series_stay_whole(panel):
    assert plan_layout(panel, ["series"], ORDER).cuts is None


def test_history_across_cuts(panel, panel_pdf, small_blocks):
    got = by_id(
        features.add_history(panel, "y", ORDER, ["series"], [1, 7, 14], [7, 30], "composite"),
        "y_lag_1", "y_lag_7", "y_lag_14", "y_rolling_mean_7", "y_rolling_std_7", "y_rolling_mean_30", "y_rolling_std_30",
    )
    assert len(got) == len(panel_pdf)
    same(got, expected_history(panel_pdf, [1, 7, 14], [7, 30]), got.columns[1:])


def test_history_without_cuts(panel, panel_pdf):
    got = by_id(features.add_history(panel, "y", ORDER, ["series"], [1], [7], "composite"), "y_lag_1", "y_rolling_mean_7", "y_rolling_std_7")
    same(got, expected_history(panel_pdf, [1], [7]), got.columns[1:])


def test_ungrouped_history(panel, panel_pdf, small_blocks):
    got = by_id(features.add_history(panel, "y", ORDER, lags=[1, 5], windows=[9]), "y_lag_1", "y_lag_5", "y_rolling_mean_9", "y_rolling_std_9")
    one = panel_pdf.assign(series="all")
    same(got, expected_history(one, [1, 5], [9]), got.columns[1:])


def test_position_equals_row_number(panel, panel_pdf, small_blocks):
    got = by_id(with_position(panel, ["series"], ORDER, "pos", "n"), "pos", "n")
    want = panel_pdf.sort_values(ORDER)
    want["pos"] = want.groupby("series").cumcount()
    want["n"] = want.groupby("series")["id"].transform("size")
    same(got, want.sort_values("id").reset_index(drop=True), ["pos", "n"])


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_partitioning_does_not_matter(panel, small_blocks, parts):
    got = by_id(with_position(panel.repartition(parts), [], ORDER, "pos"), "pos")
    want = panel.toPandas().sort_values(ORDER).reset_index(drop=True).reset_index(names="pos").sort_values("id")
    assert got["pos"].tolist() == want["pos"].tolist()


def test_all_rows_at_one_time(spark, small_blocks):
    df = spark.range(500).select("id", F.lit("a").alias("series"), F.lit("2020-01-01").cast("timestamp").alias("ts"), F.col("id").cast("double").alias("y"))
    got = by_id(features.add_history(df, "y", ORDER, ["series"], [3], [], "composite"), "y_lag_3")
    assert got["y_lag_3"].isna().sum() == 3
    assert (got["y_lag_3"].dropna().to_numpy() == np.arange(497)).all()


def test_null_series_key(spark, small_blocks):
    df = spark.range(200).select("id", F.lit(None).cast("string").alias("series"), F.col("id").alias("ts"), F.col("id").cast("double").alias("y"))
    got = by_id(with_position(df, ["series"], ORDER, "pos", "n"), "pos", "n")
    assert got["pos"].tolist() == list(range(200)) and set(got["n"]) == {200}


def test_keys_at(panel, panel_pdf, small_blocks):
    want = panel_pdf.sort_values(ORDER).reset_index(drop=True)
    got = keys_at(panel, ORDER, lambda n: [0, 100, n - 1, n])
    assert [g and g["id"] for g in got] == [want.id[0], want.id[100], want.id.iloc[-1], None]


def test_fill_across_cuts(panel, panel_pdf, small_blocks):
    sparse = panel.withColumn("y", F.when(F.col("id") % 97 == 0, F.col("y")))
    got = by_id(fill.fill_gaps(sparse, ["y"], ["series"], ORDER), "y")
    want = panel_pdf.sort_values(ORDER).copy()
    want["y"] = want["y"].where(want["id"] % 97 == 0)
    want["y"] = want.groupby("series")["y"].transform(lambda s: s.ffill().bfill()).fillna(0.0)
    same(got, want.sort_values("id").reset_index(drop=True), ["y"])


def test_no_leakage(spark, panel, panel_pdf):
    cut = pd.Timestamp("2020-06-01").to_pydatetime()
    later = panel.withColumn("y", F.when(F.col("ts") >= F.lit(cut), F.col("y") + 1000).otherwise(F.col("y")))
    build = lambda df: by_id(
        features.add_history(df, "y", ORDER, ["series"], [1], [7], "composite").filter(F.col("ts") < F.lit(cut)), "y_lag_1", "y_rolling_mean_7"
    )
    pd.testing.assert_frame_equal(build(panel), build(later))


def test_defaults_and_empty_lists(panel):
    full = features.add_history(panel, "y", ORDER, ["series"])
    assert {"y_lag_1_series", "y_lag_7_series", "y_lag_14_series", "y_rolling_mean_30_series"} <= set(full.columns)
    assert features.add_history(panel, "y", ORDER, ["series"], [], []).columns == panel.columns


def test_one_shuffle_for_all_columns(panel):
    df = features.add_history(panel, "y", ORDER, ["series"], [1, 7], [7, 30], "composite")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window ") == 1 or plan.count("Window [") == 1


def test_nth_difference(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 4, 9, 16, 25])], "t int, y double")
    got = [r["d"] for r in with_windows(df, [], ["t"], lambda w: {"d": features.nth_difference("y", 2, w)}, 2).orderBy("t").collect()]
    assert got == [None, None, 2.0, 2.0, 2.0]
    assert features.difference_weights(1, 1, 4) == {0: 1.0, 1: -1.0, 4: -1.0, 5: 1.0}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_per_group_splits_large_groups(spark, panel, panel_pdf, small_blocks, how):
    table = spark.createDataFrame([("hot", 1.0), ("tiny", 2.0), ("nowhere", 3.0)], "series string, x double")
    got = join_per_group(panel, table, ["series"], how).groupBy("series", "x").count().collect()
    sizes = panel_pdf.groupby("series").size()
    want = {("hot", 1.0, sizes["hot"]), ("tiny", 2.0, sizes["tiny"])} | ({("mid", None, sizes["mid"])} if how == "left" else set())
    assert {tuple(r) for r in got} == want
