import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from rhythmica.operators import validate
from rhythmica.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def deliver(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)


SCHEMA = "id bigint, ts timestamp_ntz, user bigint, value double"


def lag_rows(batches):
    return [[(i, T0 + dt.timedelta(hours=h), u, float(i)) for i, h, u in b] for b in batches]


def run_lags(spark, tmp_path, batches, lags, **kw):
    src = str(tmp_path / "in")
    like = spark.createDataFrame([], SCHEMA)
    for b in lag_rows(batches):
        deliver(spark, src, b, SCHEMA)
    stream = jobs.file_stream(spark, src, like, "*.parquet", max_files=1)
    q = jobs.online_lags(stream, ["user"], ["ts", "id"], "value", lags, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "cp"), **kw)
    jobs.run_to_end(q)
    return {r["id"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}


def test_lags_across_batches_and_compaction(spark, tmp_path):
    batches = [[(10 * k + j, 10 * k + j, j % 2) for j in range(6)] for k in range(7)]
    got = run_lags(spark, tmp_path, batches, [1, 4], compact_every=3)
    flat = [r for b in batches for r in b]
    for u in (0, 1):
        ids = [i for i, _, who in flat if who == u]
        for n, i in enumerate(ids):
            assert got[i]["value_lag_1"] == (ids[n - 1] if n >= 1 else None)
            assert got[i]["value_lag_4"] == (ids[n - 4] if n >= 4 else None)
    assert (tmp_path / "state" / "snapshot-6").exists()


def test_late_rows_are_left_out(spark, tmp_path):
    got = run_lags(spark, tmp_path, [[(1, 0, 1), (2, 100, 1)], [(3, 10, 1), (4, 99, 1), (5, 101, 1)]], [1], late_after="2 hours")
    assert sorted(got) == [1, 2, 4, 5]
    assert got[5]["value_lag_1"] == 2.0


def test_validate_and_score(spark, tmp_path):
    src = str(tmp_path / "in")
    schema = "Store int, Date string, x double"
    deliver(spark, src, [(1, "2020-01-01", 2.0), (99, "2020-01-01", 3.0), (4, "junk", 1.0)], schema)
    stream = jobs.file_stream(spark, src, spark.createDataFrame([], schema), "*.parquet")
    q = jobs.validate_and_score(
        stream, validate.REQUEST_RULES, lambda d: d.withColumn("prediction", F.col("x") * 2), str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "cp")
    )
    jobs.run_to_end(q)
    assert [r["prediction"] for r in spark.read.parquet(str(tmp_path / "good")).collect()] == [4.0]
    bad = {r["Store"]: r["broken_rules"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert bad == {99: ["Store:between"], 4: ["Date:type"]}


def test_accuracy_windows_drop_late_rows(spark, tmp_path):
    src, schema = str(tmp_path / "in"), "ts timestamp_ntz, y double, p double"
    day = lambda d, h=0: T0 + dt.timedelta(days=d, hours=h)
    deliver(spark, src, [(day(0, 1), 100.0, 110.0), (day(0, 2), 100.0, 90.0), (day(3), 100.0, 200.0)], schema)
    # Spark compares late rows with the watermark of the batch before, so this delivery moves it on
    deliver(spark, src, [(day(6), 100.0, 100.0)], schema)
    deliver(spark, src, [(day(0, 3), 100.0, 900.0), (day(9), 100.0, 100.0)], schema)  # first row is too late
    stream = jobs.file_stream(spark, src, spark.createDataFrame([], schema), "*.parquet", max_files=1)
    windows = jobs.accuracy_windows(stream, "ts", "y", "p", size="1 day", late="1 hour", alert_over=50.0)
    jobs.run_to_end(jobs.append_to(windows, str(tmp_path / "out"), str(tmp_path / "cp")))
    rows = spark.read.schema(windows.schema).parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r["window_start"], r["n"], round(r["mape"], 6), r["alert"]) for r in rows] == [
        (day(0), 2, 10.0, 0),
        (day(3), 1, 100.0, 1),
        (day(6), 1, 0.0, 0),
    ]


@pytest.mark.parametrize("mode", ["update", "complete"])
@pytest.mark.parametrize("slide", [None, "12 hours"])
def test_open_windows_are_emitted(spark, tmp_path, mode, slide):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    keys = ["window_start", "event_type"]
    # three deliveries in time order, so that a window is emitted more than once
    ends = [r.ts for r in events.orderBy("ts", "event_id").select("ts").collect()]
    ends = [ends[len(ends) // 3], ends[2 * len(ends) // 3]]
    third = F.when(F.col("ts") < F.lit(ends[0]), 0).when(F.col("ts") < F.lit(ends[1]), 1).otherwise(2)
    for k in range(3):
        events.where(third == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = jobs.file_stream(spark, f"{tmp_path}/in", events, "*.parquet").withColumn("p", F.lit(10.0))
        windows = jobs.accuracy_windows(stream, "ts", "value", "p", ["event_type"], "1 day", slide, late="1 hour")
        jobs.run_to_end(jobs.emit_to(windows, f"{tmp_path}/out", f"{tmp_path}/checkpoint", mode))
    got = jobs.last_values(spark, f"{tmp_path}/out", windows.schema, keys)
    want = jobs.accuracy_windows(events.withColumn("p", F.lit(10.0)), "ts", "value", "p", ["event_type"], "1 day", slide)
    sizes = {(r.window_start, r.event_type): (r.n, pytest.approx(r.rmse)) for r in want.collect()}
    assert {(r.window_start, r.event_type): (r.n, r.rmse) for r in got.collect()} == sizes and got.count() == len(sizes)
