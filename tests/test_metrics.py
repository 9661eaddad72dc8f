import math

import pytest
from pyspark.sql import functions as F

from rhythmica.functions import metrics as M
from rhythmica.operators import evaluate


def frame(spark, y, p):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, p))], "t int, y double, p double")


def value(spark, metric, y, p, **kw):
    return frame(spark, y, p).agg(metric("y", "p", **kw)).first()[0]


@pytest.mark.parametrize(
    "metric, y, p, want",
    [
        (M.mae, [100, 200, 300, 400, 500], [110, 190, 310, 390, 510], 10),
        (M.rmse, [100, 200, 300, 400, 500], [110, 190, 310, 390, 510], 10),
        (M.rmse, [1, 2, 3], [2, 3, 4], 1),
        (M.mae, [10, 20, 30], [15, 25, 35], 5),
        (M.mae, [1, 2, 3, 4], [1.5, 2.5, 3.5, 4.5], 0.5),
        (M.mse, [1, 2, 3], [3, 4, 5], 4),
        (M.mape, [100, 200], [110, 180], 10),
        (M.mape, [0, 0, 0], [1, 1, 1], 100 / 1e-8),
        (M.mape_signed, [100, -100], [110, -110], 10),
        (M.mape_signed, [0], [1], 100 / 2.220446049250313e-16),
        (M.smape, [100, 0], [110, 0], 100 * 10 / 105),
        (M.smape_loss, [100], [110], 100 * 10 / (105 + 1e-8)),
        (M.pinball, [10, 10], [8, 14], 1.5),
        (M.huber, [1, 2, 3, 4], [1, 2, 3, 6], (2 - 0.5) / 4),
        (M.r2, [1, 2, 3], [1, 2, 3], 1),
    ],
)
def test_closed_forms(spark, metric, y, p, want):
    assert value(spark, metric, y, p) == pytest.approx(want)


def test_invariants(spark):
    y, p = [100, 200, 300, 500], [120, 180, 330, 400]
    assert value(spark, M.mae, y, p) <= value(spark, M.rmse, y, p)
    assert value(spark, M.mape, [10 * v for v in y], [10 * v for v in p]) == pytest.approx(value(spark, M.mape, y, p))
    assert value(spark, M.smape, y, p) == pytest.approx(value(spark, M.smape, p, y))
    assert 0 <= value(spark, M.smape, y, [0] * 4) <= 200 + 1e-9
    assert value(spark, M.huber, [1, 2, 3, 100], [1, 2, 3, 4]) < value(spark, M.mse, [1, 2, 3, 100], [1, 2, 3, 4])
    assert value(spark, M.smape, [0], [0]) is None


def test_pinball_is_asymmetric(spark):
    assert value(spark, M.pinball, [10], [5], q=0.9) == pytest.approx(4.5)
    assert value(spark, M.pinball, [10], [15], q=0.9) == pytest.approx(0.5)


def test_weighted_and_multi_quantile(spark):
    df = spark.createDataFrame([(10.0, 8.0, 5.0), (10.0, 12.0, 1.0)], "y double, p double, w double")
    assert df.agg(M.wmae("y", "p", "w")).first()[0] == pytest.approx(2)
    assert df.agg(M.multi_quantile("y", {0.1: "p", 0.9: "p"})).first()[0] == pytest.approx(1.0)


def test_directional_accuracy(spark):
    df = frame(spark, [1, 2, 1, 3], [1, 3, 4, 5])
    got = evaluate.directional_accuracy(df, "y", "p", [], ["t"]).first()[0]
    assert got == pytest.approx(200 / 3)
    assert evaluate.directional_accuracy(df.filter("t = 0"), "y", "p", [], ["t"]).first()[0] is None


def test_mase_variants(spark):
    train = frame(spark, [1, 4, 9, 16, 25], [0] * 5)
    test = frame(spark, [30, 40], [28, 44])
    nth = evaluate.mase(test, train, "y", "p", [], ["t"], 2, "nth_diff").first()[0]
    seasonal = evaluate.mase(test, train, "y", "p", [], ["t"], 2, "seasonal").first()[0]
    assert nth == pytest.approx(3 / 2)
    assert seasonal == pytest.approx(3 / 12)
    flat = frame(spark, [5, 5, 5], [0] * 3)
    assert evaluate.mase(test, flat, "y", "p", [], ["t"], 1).first()[0] is None


def test_collection_keeps_going(spark):
    df = frame(spark, [1, 2], [1, 3])
    got = evaluate.score_or_null(df, "y", "p", {"mae": M.mae, "broken": lambda y, p: F.avg(F.col("nowhere")), "zero": lambda y, p: F.sum(y - y)})
    assert got == {"mae": 0.5, "broken": None, "zero": 0.0}


def test_empty_table(spark):
    empty = frame(spark, [], [])
    with pytest.raises(ValueError):
        evaluate.score(empty, "y", "p")
    assert evaluate.score(empty, "y", "p", ["t"]).count() == 0


def test_python_metric_checks_group_size(spark):
    df = frame(spark, [1, 2, 3], [1, 1, 1])
    got = evaluate.score_python(df, "y", "p", [], {"worst": lambda y, p: float((y - p).abs().max())}).first()[0]
    assert math.isclose(got, 2.0)
    with pytest.raises(ValueError):
        evaluate.score_python(df, "y", "p", [], {"worst": lambda y, p: 0.0}, max_rows=2)


def test_python_metric_in_steps_has_no_row_limit(spark, panel, panel_pdf, monkeypatch):
    mean = evaluate.Steps(lambda y, p: [(y - p).abs().sum(), (y - p).notna().sum()], lambda a, b: [a[0] + b[0], a[1] + b[1]], lambda s: s[0] / s[1])
    df = panel.withColumn("p", F.lit(90.0)).withColumn("series", F.when(F.col("series") != "tiny", F.col("series")))
    monkeypatch.setattr(evaluate, "HELD_GROUPS", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = {r.series: r.mean for r in evaluate.score_python(df, "y", "p", ["series"], {"mean": mean}, max_rows=2).collect()}
        every = evaluate.score_python(df, "y", "p", [], {"mean": mean}, max_rows=2).first().mean
        both = evaluate.score_python(df, "y", "p", ["series"], {"n": lambda y, p: len(y), "mean": mean}).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    error = (panel_pdf.y - 90).abs()
    want = {None if s == "tiny" else s: part.mean() for s, part in error.groupby(panel_pdf.series)}
    assert got == pytest.approx(want) and every == pytest.approx(error.mean())
    assert {r.series: (r.n, r.mean) for r in both} == {s: (n, pytest.approx(want[s])) for s, n in (("hot", 600), ("mid", 250), (None, 3))}


def test_custom_metric_query_has_no_row_limit(spark, monkeypatch):
    from rhythmica.plans import catalog

    monkeypatch.setattr(evaluate.score_python, "__defaults__", (2,))
    assert catalog.QUERIES["custom_metric_and_transform"](spark, "/root/testdata/sf0.001").where("median_error IS NOT NULL").count() > 0
