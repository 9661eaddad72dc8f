import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rhythmica.forecast.regression import LinearForecaster
from rhythmica.operators import backtest, leaderboard
from rhythmica.sources import files, tables


def runs(spark, rows):
    return spark.createDataFrame(rows, "run_id string, model string, test_MAPE double, val_MAPE double")


def test_best_run_prefers_test_metrics(spark):
    df = runs(spark, [("1", "a", 5.0, 1.0), ("2", "a", 3.0, 9.0), ("0", "a", 3.0, 9.0), ("3", "b", None, 1.0)])
    assert [(r["model"], r["run_id"]) for r in leaderboard.best_run_per_model(df).collect()] == [("a", "0")]


def test_best_run_falls_back_to_validation(spark):
    df = runs(spark, [("1", "a", None, 4.0), ("2", "a", None, 2.0), ("3", "b", None, None)])
    assert [(r["model"], r["run_id"]) for r in leaderboard.best_run_per_model(df).collect()] == [("a", "2")]


def test_run_table_defaults_and_zero_metric(spark):
    stored = spark.createDataFrame(
        [("abcdefghijkl", None, "FINISHED", {"val_MAPE": "0.0", "val_MAPEMetric": "5"}, {}, {}, 1_600_000_000_000)],
        "run_id string, run_name string, status string, metrics map<string,string>, params map<string,string>, tags map<string,string>, start_ms bigint",
    )
    row = leaderboard.run_table(stored).first()
    assert (row["run_name"], row["model"], row["dataset"], row["val_MAPE"], row["test_MAPE"]) == ("abcdefgh", "unknown", "unknown", 0.0, None)
    assert row["start_time"] == dt.datetime(2020, 9, 13, 12, 26, 40)


def test_benchmark_skips_failures(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), (3.0 * F.col("id") + 2).alias("y"))

    class Broken:
        def fit(self, df):
            raise RuntimeError("no")

    out = leaderboard.run_benchmark({"line": LinearForecaster(["x"], "y"), "broken": Broken()}, df, df, "y", "demo", features=["x"])
    row = out.collect()
    assert len(row) == 1 and row[0]["model_name"] == "line" and row[0]["rmse"] < 1e-8 and row[0]["n_samples"] == 100 and row[0]["n_features"] == 1
    leaderboard.save_results(out, str(tmp_path / "r"))
    assert leaderboard.load_results(spark, str(tmp_path / "r")).select("model_name", "n_samples").collect() == [("line", 100)]


def test_load_single_document(spark, tmp_path):
    doc = {"results": [{"model_name": "m", "dataset_name": "d", "mape": 1.5, "rmse": 2.0, "mae": 1.0, "training_time": 0.1, "prediction_time": 0.2,
                        "n_samples": 7, "n_features": 3, "params": {"a": "1"}}], "timestamp": "2024-01-01", "n_models": 1, "n_datasets": 1}
    path = tmp_path / "benchmark_results.json"
    path.write_text(json.dumps(doc, indent=2))
    row = leaderboard.load_results(spark, str(path)).first()
    assert (row["model_name"], row["mape"], row["params"]) == ("m", 1.5, {"a": "1"})


def test_rank_is_stable_on_ties(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "model_name string, mape double")
    assert [(r["rank"], r["model_name"]) for r in leaderboard.rank_models(df).orderBy("rank").collect()] == [(1, "c"), (2, "a"), (3, "b")]


def test_training_summary(spark):
    df = spark.createDataFrame([("m", 1, 0.5, 9.0), ("m", 2, 0.2, 8.0), ("m", 3, 0.4, 7.0)], "m string, step int, loss double, rmse double")
    assert tuple(leaderboard.training_summary(df, ["m"], "step", "loss", ["rmse"]).first()) == ("m", 3, 7.0, 2, 0.2)


def test_backtest_uses_only_the_past(spark):
    rows = [("a", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "s string, d date, y double")
    folds = backtest.rolling_folds(dt.date(2020, 1, 11), 2, dt.timedelta(days=2))
    out = backtest.backtest(df, ["s"], ["d"], "d", "y", folds).orderBy("d").collect()
    assert [(r["fold"], r["y_true"], r["naive"], r["history_mean"]) for r in out] == [(0, 6.0, 5.0, 2.5), (0, 7.0, 5.0, 2.5), (1, 8.0, 7.0, 3.5), (1, 9.0, 7.0, 3.5)]


def test_read_table_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none.csv"))
    (tmp_path / "x.txt").write_text("a")
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "x.txt"))


def test_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Store,When,Sales\n1,05-02-2010,10.5\n2,junk,3\n")
    df = tables.read_csv(spark, str(tmp_path / "s.csv"), "Store int, When string, Sales double", "When", "dd-MM-yyyy")
    rows = df.orderBy("Store").collect()
    assert df.columns == ["Store", "date", "Sales"] and rows[0]["date"] == dt.datetime(2010, 2, 5) and rows[1]["date"] is None
    assert tables.read_table(spark, str(tmp_path / "s.csv")).count() == 2


def test_fingerprint_and_cache(spark, tmp_path):
    df = spark.range(50).withColumn("x", F.col("id") * 2)
    key = files.fingerprint_key(df)
    assert key == files.fingerprint_key(df.repartition(7)) != files.fingerprint_key(df.union(df.limit(2)))
    built = []

    def build(d):
        built.append(1)
        return d.withColumn("f", F.col("x") + 1)

    for _ in range(2):
        assert files.cached_features(df, build, str(tmp_path), "t").count() == 50
    assert len(built) == 1
    files.cached_features(df.filter("id > 3"), build, str(tmp_path), "t")
    files.cached_features(df, build, str(tmp_path), "t", force=True)
    assert len(built) == 3


def test_listing_key_changes_with_the_files(spark, tmp_path):
    folder = tmp_path / "t"
    spark.range(5).write.parquet(str(folder))
    before = files.listing_key(spark, str(folder))
    assert before == files.listing_key(spark, str(folder))
    spark.range(5).write.mode("append").parquet(str(folder))
    assert before != files.listing_key(spark, str(folder))


def test_listing_and_digests(spark, tmp_path):
    raw = tmp_path / "p" / "data" / "raw"
    raw.mkdir(parents=True)
    (raw / "a.csv").write_text("x\n1\n")
    (raw / "b.txt").write_text("no")
    assert [r["path"].endswith("a.csv") for r in files.list_tier(spark, str(tmp_path / "p"), "raw").collect()] == [True]
    import hashlib

    assert files.file_digests(spark, str(raw)).first()["digest"] == hashlib.md5(b"x\n1\n").hexdigest()
    with pytest.raises(ValueError):
        files.list_tier(spark, str(tmp_path / "p"), "bronze")


def test_digests_of_files_longer_than_a_range(spark, tmp_path, monkeypatch):
    import hashlib

    import pyarrow as pa

    contents = {f"a {n}%é.bin": bytes(i * i % 251 for i in range(n)) for n in (63, 100, 101, 1000, 1037)}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    made, rounds = files._next_range, []

    def watched(start, size):
        rounds.append((start, size))
        return made(start, size)

    monkeypatch.setattr(files, "RANGE", 100)
    monkeypatch.setattr(files, "_next_range", watched)
    rows = files.file_digests(spark, str(tmp_path), ".bin").collect()
    assert {r["path"].rsplit("/", 1)[1]: (r["length"], r["digest"]) for r in rows} == {k: (len(c), hashlib.md5(c).hexdigest()) for k, c in contents.items()}
    assert rounds == [(start, 100) for start in range(0, 1037 if files._openssl() else 1, 100)]

    monkeypatch.setattr(files, "_openssl", lambda: None)  # the state of a sum cannot be had
    row = {"path": f"file:{tmp_path}/a 1037%é.bin", "length": 1037, "state": None}
    (out,) = made(0, 100)(iter([pa.RecordBatch.from_pylist([row])]))
    assert out.to_pylist()[0]["digest"] == hashlib.md5(contents["a 1037%é.bin"]).hexdigest()


def test_predictions_sink(spark, tmp_path):
    df = spark.createDataFrame([(5.0, 3.0, "test", "m")], "y_true double, y_pred double, split string, model string")
    tables.write_predictions(df, str(tmp_path / "pred"))
    row = spark.read.parquet(str(tmp_path / "pred")).first()
    assert row["residual"] == 2.0 and row["split"] == "test" and row["model"] == "m"


def test_cache_rebuilds_for_other_parameters_and_schemas(spark, tmp_path):
    df, calls = spark.range(5).selectExpr("id", "id * 2 AS x"), []

    def build(d):
        calls.append(1)
        return d

    for source, lags in ((df, [1]), (df, [1]), (df, [1, 2]), (df.withColumnRenamed("x", "y"), [1])):
        files.cached_features(source, build, str(tmp_path), "t", params={"lags": lags})
    assert len(calls) == 3
