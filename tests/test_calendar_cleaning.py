import math

import pandas as pd
from pyspark.sql import functions as F

from rhythmica.functions import calendar, cleaning


def test_parse_mixed_dates(spark):
    texts = ["05-02-2010", "2010-02-05", "05/02/2010", "12/31/2010", "junk", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["d"] for r in df.select("i", calendar.parse_date("t").cast("date").cast("string").alias("d")).orderBy("i").collect()]
    assert got == ["2010-02-05", "2010-02-05", "2010-02-05", "2010-12-31", None, None]


def test_date_parts_equal_pandas(spark):
    days = pd.date_range("2009-12-01", "2012-03-31", freq="D")
    df = spark.createDataFrame([(d.to_pydatetime(),) for d in days], "d timestamp_ntz")
    got = calendar.add_date_features(df, "d").toPandas().sort_values("d").reset_index(drop=True)
    s = pd.Series(days)
    want = {
        "year": s.dt.year, "month": s.dt.month, "day": s.dt.day, "dayofweek": s.dt.dayofweek, "quarter": s.dt.quarter,
        "week": s.dt.isocalendar().week, "is_weekend": s.dt.dayofweek >= 5, "is_month_start": s.dt.is_month_start,
        "is_month_end": s.dt.is_month_end, "is_quarter_start": s.dt.is_quarter_start, "is_quarter_end": s.dt.is_quarter_end,
    }
    for c, w in want.items():
        assert got[c].astype(int).tolist() == w.astype(int).tolist(), c


def test_cyclical(spark):
    df = spark.createDataFrame([(3,), (6,), (12,)], "m int")
    rows = calendar.add_cyclical(df, ["m", "absent"]).orderBy("m").collect()
    assert math.isclose(rows[0]["m_sin"], 1.0) and math.isclose(rows[1]["m_cos"], -1.0)
    fixed = calendar.add_cyclical(df, ["m"], 24).orderBy("m").collect()
    assert math.isclose(fixed[1]["m_sin"], 1.0)


def test_cleaning(spark):
    df = spark.createDataFrame(
        [(1, 10.0, "A", "3.5", {"val_MAPEMetric": "0.0"}, {"model.b": "2", "model.a": "1", "x": "9"}), (2, float("nan"), "Z", "abc", {"val_MAPE": "7"}, {})],
        "id int, y double, kind string, text string, m map<string,string>, p map<string,string>",
    )
    out = cleaning.nan_to_null(df).select(
        "id", "y",
        cleaning.map_values("kind", {"A": 3, "B": 2, "C": 1}).alias("rank"),
        cleaning.to_numeric("text").alias("num"),
        cleaning.first_present("m", "val_MAPE", "val_MAPEMetric").alias("mape"),
        cleaning.first_present("m", "nothing", default="unknown").alias("dflt"),
        cleaning.params_with_prefix("p", "model.").alias("params"),
        cleaning.clip_negative(-F.col("id")).alias("clipped"),
        cleaning.uplift(F.lit(13.0), F.col("id") == 1, 1.4).alias("up"),
    ).orderBy("id").collect()
    assert (out[0]["rank"], out[1]["rank"]) == (3, None)
    assert (out[0]["num"], out[1]["num"]) == (3.5, None)
    assert out[1]["y"] is None
    assert (out[0]["mape"], out[1]["mape"]) == ("0.0", "7")  # a stored zero counts
    assert out[0]["dflt"] == "unknown"
    assert [(e["key"], e["value"]) for e in out[0]["params"]] == [("a", "1"), ("b", "2")]
    assert [r["clipped"] for r in out] == [0, 0]
    assert [r["up"] for r in out] == [18.0, 13.0]


def test_fill_flatten_filter(spark):
    df = spark.createDataFrame([(1, None, None, ("x" * 600, (5,)))], "id int, a double, s string, n struct<t:string,u:struct<k:int>>")
    assert cleaning.fill_constant(df.select("id", "a", "s")).first() == (1, 0.0, None)
    flat = cleaning.flatten(df.select("id", "n"), max_chars=500)
    assert flat.columns == ["id", "n.t", "n.u.k"] and len(flat.first()["n.t"]) == 500
    assert len(cleaning.flatten(df.select("id", "n")).first()["n.t"]) == 600
    assert cleaning.filter_values(df, id=[1, 2]).count() == 1 and cleaning.filter_values(df, id=3).count() == 0


def test_factors(spark):
    hours = spark.range(24).select("id", cleaning.peak_factor(F.col("id")).alias("f")).orderBy("id").collect()
    assert [r["id"] for r in hours if r["f"] == 1.5] == [8, 9, 10] and [r["id"] for r in hours if r["f"] == 1.8] == [18, 19, 20]
    names = spark.createDataFrame([("North Zone",), ("Elsewhere",)], "z string").select(cleaning.tier(F.col("z"), {"North": 25, "South": 22}, 15)).collect()
    assert [r[0] for r in names] == [25.0, 15.0]
    prices = spark.createDataFrame([(0.0,), (50.0,), (100.0,)], "p double").select(cleaning.price_factor(F.col("p"), F.lit(100.0))).collect()
    assert [r[0] for r in prices] == [1.5, 1.0, 0.5]
