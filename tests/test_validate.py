import pytest

from rhythmica.operators import profile, validate

COLUMNS = "Store int, Date string, Weekly_Sales double, Temperature double, Fuel_Price double, Holiday_Flag int"
GOOD = (1, "2010-02-05", 1643690.9, 42.31, 2.572, 0)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def failed(spark, *rows):
    out = validate.run_rules(table(spark, *rows), validate.SALES_RULES).filter("success = 0").collect()
    return {r["rule"] for r in out}


def change(**kw):
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return tuple(kw.get(n, v) for n, v in zip(names, GOOD))


@pytest.mark.parametrize(
    "bad, rule",
    [
        ({"Store": 99}, "Store:between"),
        ({"Store": 0}, "Store:between"),
        ({"Store": None}, "Store:not_null"),
        ({"Weekly_Sales": -5.0}, "Weekly_Sales:between"),
        ({"Temperature": 200.0}, "Temperature:between"),
        ({"Fuel_Price": 0.0}, "Fuel_Price:between"),
        ({"Fuel_Price": 10.5}, "Fuel_Price:between"),
        ({"Holiday_Flag": 2}, "Holiday_Flag:in_set"),
    ],
)
def test_each_rule(spark, bad, rule):
    assert failed(spark, GOOD, change(**bad)) == {rule}


def test_good_table_passes(spark):
    assert failed(spark, GOOD) == set()
    assert validate.check(table(spark, GOOD), validate.SALES_RULES, validate.SALES_COLUMNS).count() == len(validate.SALES_RULES)


def test_gate_raises_with_all_failures(spark):
    bad = table(spark, change(Store=99, Weekly_Sales=-5.0, Holiday_Flag=2))
    with pytest.raises(validate.ValidationError) as e:
        validate.check(bad, validate.EXPECTATIONS)
    assert all(n in str(e.value) for n in ("Store:between", "Weekly_Sales:between", "Holiday_Flag:in_set"))
    assert validate.check(bad, validate.EXPECTATIONS, raise_on_failure=False).count() == 4
    with pytest.raises(validate.ValidationError):
        validate.check(bad.drop("Store"), [], validate.SALES_COLUMNS)


def test_suite_statistics(spark):
    bad = table(spark, change(Store=99, Weekly_Sales=-5.0, Holiday_Flag=2))
    assert tuple(validate.summarise(validate.run_rules(bad, validate.EXPECTATIONS)).first()) == (4, 1, 3, 25.0)


def test_failing_rows_and_filter(spark):
    df = table(spark, GOOD, change(Store=50, Temperature=200.0))
    row = validate.failing_rows(df, validate.SALES_RULES).first()
    assert row["broken_rules"] == ["Store:between", "Temperature:between"]
    assert df.filter(validate.passing(validate.SALES_RULES)).count() == 1


def test_predictions_requests_features(spark):
    p = spark.createDataFrame([(1.0,), (-500.0,), (None,)], "predictions double")
    assert {r["rule"]: r["n_failed"] for r in validate.run_rules(p, validate.PREDICTION_RULES).collect()} == {"predictions:not_null": 1, "predictions:between": 1}
    q = spark.createDataFrame([(1, "2020-01-01"), (60, "junk")], "Store int, Date string")
    assert {r["rule"] for r in validate.run_rules(q, validate.REQUEST_RULES).filter("success=0").collect()} == {"Store:between", "Date:type"}
    f = spark.createDataFrame([(1, 5.0, None, None, 2020, 13, 7)], "Store int, Weekly_Sales double, Weekly_Sales_lag_1 double, Weekly_Sales_lag_7 double, year int, month int, dayofweek int")
    assert {r["rule"] for r in validate.run_rules(f, validate.FEATURE_RULES).filter("success=0").collect()} == {"month:between", "dayofweek:between"}


def test_model_input(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("inf"), None)], "a double, b double")
    out = {r["rule"]: r["n_failed"] for r in validate.check_model_input(df, 2, ["a"], raise_on_failure=False).collect()}
    assert out == {"a:not_null": 0, "b:not_null": 1, "a:finite": 1, "b:finite": 0}
    with pytest.raises(validate.ValidationError):
        validate.check_model_input(df, 3)
    with pytest.raises(validate.ValidationError):
        validate.check_model_input(df, 2, ["c"])


def test_quality_report(spark):
    df = table(spark, GOOD, GOOD, change(Store=None), change(Store=99))
    row = validate.quality_report(df, validate.SALES_RULES, validate.SALES_COLUMNS).first()
    assert (row["is_valid"], row["n_rows"], row["n_columns"], row["duplicate_rows"]) == (0, 4, 6, 1)
    assert row["null_counts"]["Store"] == 1 and {f["rule"] for f in row["failures"]} == {"Store:not_null", "Store:between"}
    good = validate.quality_report(table(spark, GOOD), validate.SALES_RULES, validate.SALES_COLUMNS).first()
    assert good["is_valid"] == 1 and good["failures"] == []
    partial = validate.quality_report(table(spark, GOOD).drop("Date"), validate.SALES_RULES, validate.SALES_COLUMNS).first()
    assert partial["is_valid"] == 0 and partial["missing_columns"] == ["Date"]


def test_profile_helpers(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (1, float("nan"), None), (2, None, "a"), (2, None, "a")], "k int, x double, s string")
    miss = [(r["column"], r["n_missing"], r["percent"]) for r in profile.missing_summary(df).collect()]
    assert miss == [("x", 3, 75.0), ("s", 1, 25.0), ("k", 0, 0.0)]
    assert profile.duplicates(df).first()[0] == 1 and profile.duplicates(df, ["k"]).first()[0] == 2
    d = {r["column"]: r for r in profile.describe(df.filter("not isnan(x) or x is null")).collect()}
    assert d["s"]["top"] == "a" and d["s"]["freq"] == 3 and d["s"]["n_distinct"] == 1
    assert d["k"]["p50"] == 2.0 and d["k"]["n"] == 3
    assert profile.infer_feature_columns(df, "x") == ["k"]
    for bad in (lambda: profile.infer_feature_columns(df, "nope"), lambda: profile.infer_feature_columns(df, "x", ["k", "zzz"])):
        with pytest.raises(ValueError):
            bad()
