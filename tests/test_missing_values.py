"""Nulls, NaN and ill-typed text in checks, rankings, summaries, searches and predictions."""

import pytest
from pyspark.sql import functions as F

from rhythmica.forecast import intervals, trees
from rhythmica.operators import joins, leaderboard, profile, validate



def bad_rows(df, rules):
    return [r for r in validate.run_rules(df, rules).collect() if r.asDict().get("success") == 0]


def test_nan_predictions_fail(spark):
    good = spark.createDataFrame([(1000.0,), (3000.0,)], "predictions double")
    assert not bad_rows(good, validate.PREDICTION_RULES)
    assert bad_rows(good.union(spark.createDataFrame([(float("nan"),)], "predictions double")), validate.PREDICTION_RULES)


def test_ill_typed_text_fails(spark):
    df = spark.createDataFrame([("1", "not a date", "abc", "70", "3", "0")], ", ".join(f"{c} string" for c in validate.SALES_COLUMNS))
    assert len(bad_rows(df, validate.SALES_RULES)) == 2


def test_words_that_look_like_nan_are_not_missing(spark):
    assert not bad_rows(spark.createDataFrame([("Nancy",), ("x",)], "Store string"), validate.not_null("Store"))


def test_models_without_metric_come_last(spark):
    rows = [("broken", None), ("a", 2.0), ("b", 1.0), ("odd", float("nan"))]
    ranked = leaderboard.rank_models(spark.createDataFrame(rows, "model_name string, mape double"))
    assert [(r["rank"], r["model_name"]) for r in ranked.orderBy("rank").collect()] == [(1, "b"), (2, "a"), (3, "broken"), (4, "odd")]


def test_null_loss_is_never_best(spark):
    steps = spark.createDataFrame([("r", 1, None), ("r", 2, 0.5), ("r", 3, 0.7)], "run string, step int, loss double")
    row = leaderboard.training_summary(steps, ["run"], "step", "loss", ["loss"]).first()
    assert (row["best_step"], row["best_loss"], row["last_step"]) == (2, 0.5, 3)


def test_predictions_keep_rows_with_gaps(spark):
    rows = [(float(i), float(i % 3), 2.0 * i) for i in range(30)]
    train = spark.createDataFrame(rows, "a double, b double, y double")
    model = trees.random_forest(["a", "b"], "y", trees=2).fit(train)
    gaps = spark.createDataFrame([(1.0, 1.0, 0.0), (None, 1.0, 0.0), (2.0, float("nan"), 0.0)], "a double, b double, y double")
    got = [r["prediction"] for r in model.predict(gaps).collect()]
    assert len(got) == 3 and sum(p is None for p in got) == 2


def test_search_survives_a_missing_score(spark):
    train = spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)], "a double, y double")
    nothing = spark.createDataFrame([(None, 1.0)], "a double, y double")
    found = trees.search(lambda depth: trees.random_forest(["a"], "y", trees=1, depth=depth), [{"depth": 1}], train, nothing, "y")
    assert found.first()["status"] == "no score"


def test_null_group_keys_are_a_group(spark):
    rows = [("a", 1.0, 2.0), ("a", 3.0, 4.0), (None, 5.0, 6.0), (None, 7.0, 9.0)]
    df = spark.createDataFrame(rows, "k string, y double, p double")
    summary = {r["k"]: (r["mean"], r["median"]) for r in profile.series_summary(df, ["k"], "y").collect()}
    assert summary == {"a": (2.0, 2.0), None: (6.0, 6.0)}
    assert intervals.spread_interval(df, "p", ["k"]).where("lower IS NOT NULL").count() == 4
    for per_block in ("1", "2000000"):  # the null group as a long and as a short one
        spark.conf.set("spark.rhythmica.rowsPerBlock", per_block)
        try:
            per_key = df.groupBy("k").agg(F.max("y").alias("top"))
            got = joins.join_per_group(df, per_key, ["k"]).select("k", "y", "top").collect()
        finally:
            spark.conf.unset("spark.rhythmica.rowsPerBlock")
        assert sorted((r["y"], r["top"]) for r in got) == [(1.0, 3.0), (3.0, 3.0), (5.0, 7.0), (7.0, 7.0)]


def test_fingerprints_tell_cells_and_nulls_apart(spark):
    from rhythmica.sources.files import fingerprint_key

    tables = [[("a|b", "c")], [("a", "b|c")], [("a1:", "c")], [("a", "1:c")], [("<null>", "c")], [(None, "c")], [("-1:", "c")], [("", "c")], [(None, "c"), (None, "c")]]
    keys = {fingerprint_key(spark.createDataFrame(rows, "x string, y string")) for rows in tables}
    assert len(keys) == len(tables)
    assert fingerprint_key(spark.createDataFrame([], "x string")) == "0-0-0-0-0-0-0-0-0"


@pytest.mark.parametrize("block", [None, "2"])
def test_guard_keeps_null_keys_and_long_series(spark, block):
    from rhythmica.operators.features import series_with_history

    df = spark.createDataFrame([("a", i) for i in range(9)] + [(None, 1), (None, 2), ("b", 1)], "s string, t int")
    if block:
        spark.conf.set("spark.rhythmica.rowsPerBlock", block)
    try:
        kept = series_with_history(df, ["s"], 2)
        assert kept.columns == ["s", "t"] and sorted((r.s or "", r.t) for r in kept.collect()) == [("", 1), ("", 2), *[("a", i) for i in range(9)]]
    finally:
        spark.conf.unset("spark.rhythmica.rowsPerBlock")


def test_smoothing_leaves_nulls_out(spark):
    from rhythmica.forecast.smoothing import exponential_level

    df = spark.createDataFrame([("a", 0, 10.0), ("a", 1, None), ("a", 2, 10.0), ("a", 3, float("nan")), ("b", 0, None)], "s string, t int, y double")
    assert [(r.s, r.level, r.n) for r in exponential_level(df, ["s"], ["t"], "y", 0.5).collect()] == [("a", 10.0, 2)]
