"""Ordered target statistics and successive halving against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rhythmica.forecast import trees
from rhythmica.forecast.regression import LinearForecaster
from rhythmica.operators.target_stats import OrderedTargetEncoder, mean_target, ordered_target_statistic

ORDER = ["t", "id"]


def table(n=900, seed=3):
    """Two thirds of the rows share one category; some targets and categories are missing; times repeat."""
    rng = np.random.default_rng(seed)
    kinds = rng.choice(["hot", "warm", None, "rare"], n, p=[0.66, 0.2, 0.13, 0.01])
    y = [None if i % 9 == 4 else (float("nan") if i % 50 == 7 else float(v)) for i, v in enumerate(rng.integers(-50, 100, n))]
    return [(int(t), i, k, v, int(i % 3)) for i, (t, k, v) in enumerate(zip(rng.integers(0, n // 3, n), kinds, y, strict=True))]


def plain(rows, prior, weight):
    sums, out = {}, {}
    for t, i, kind, y, _ in sorted(rows, key=lambda r: (r[0], r[1])):
        total, n = sums.get(kind, (0.0, 0))
        out[i] = (total + weight * prior) / (n + weight) if n + weight else None
        if y is not None and not math.isnan(y):
            sums[kind] = (total + y, n + 1)
    return out, sums


@pytest.mark.parametrize("weight", [0.0, 2.5])
def test_statistics_of_a_hot_category_equal_a_plain_loop(spark, small_blocks, weight):
    rows = table()
    df = spark.createDataFrame(rows, "t int, id int, kind string, y double, n int").repartition(5)
    out = ordered_target_statistic(df, "kind", "y", ORDER, 7.0, weight, "s")
    assert out.columns == [*df.columns, "s"]
    got, want = {r.id: r.s for r in out.collect()}, plain(rows, 7.0, weight)[0]
    assert len(got) == len(rows)
    for i, v in want.items():
        assert got[i] == pytest.approx(v, rel=1e-12) if v is not None else got[i] is None


def test_no_task_gathers_a_whole_category(spark, monkeypatch):
    from rhythmica.operators import target_stats

    monkeypatch.setattr(target_stats, "ROWS", 40)
    rows = table(4000)
    df = spark.createDataFrame(rows, "t int, id int, kind string, y double, n int").repartition(5)
    encoder = OrderedTargetEncoder(["n", "kind"], "y", ORDER, weight=2.5, prior=7.0)
    out = encoder.encode_training(df)
    got, want = {r.id: r.kind_target for r in out.collect()}, plain(rows, 7.0, 2.5)[0]
    assert len(got) == len(rows) and all(got[i] == pytest.approx(v, rel=1e-12) for i, v in want.items())
    most = max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
    assert most < 800  # of 4,000, of which the largest category has 2,600


@pytest.fixture
def large(monkeypatch):
    """More than 40 rows for each core are many, more than a tenth of them are a long category."""
    from rhythmica.operators import target_stats

    for name, value in (("ROWS", 40), ("CARRIES", 10), ("CHUNK", 32)):
        monkeypatch.setattr(target_stats, name, value)


def test_columns_of_a_large_table_are_encoded_together(spark, large):
    """Long and short categories in one column, only long ones, only short ones; some order keys are null."""
    rows = [(None if i < 5 else t, i, k, v, i % 3) for t, i, k, v, _ in table(3000)]
    df = spark.createDataFrame([(*r, f"s{r[1] % 700}") for r in rows], "t int, id int, kind string, y double, n int, s string").repartition(5)
    first = [(-1 if r[0] is None else r[0], *r[1:]) for r in rows]
    want = {}
    for c, at in (("kind", lambda r: r[2]), ("n", lambda r: r[4]), ("s", lambda r: f"s{r[1] % 700}")):
        want[c] = plain([(r[0], r[1], at(r), r[3], 0) for r in first], 7.0, 2.5)[0]
    for columns in (["kind", "n", "s"], ["n"], ["s"]):
        out = OrderedTargetEncoder(columns, "y", ORDER, weight=2.5, prior=7.0).encode_training(df)
        assert out.columns == [*df.columns, *[f"{c}_target" for c in columns]]
        got = {r.id: r for r in out.collect()}
        assert len(got) == len(rows) == out.count()
        assert all(got[i][f"{c}_target"] == pytest.approx(v, rel=1e-12) for c in columns for i, v in want[c].items())
        assert max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()) < 600
    few = OrderedTargetEncoder(["kind"], "y", ORDER, weight=2.5, prior=7.0).encode_training(df, ["id"])
    assert few.columns == ["id", "kind_target"] and {r.id: r.kind_target for r in few.collect()} == pytest.approx(want["kind"], rel=1e-12)


def test_an_ordered_sum_goes_on_from_chunk_to_chunk():
    from rhythmica.operators.target_stats import _earlier

    rng = np.random.default_rng(2)
    codes, values, known = rng.integers(0, 4, 500).astype(np.int16), rng.normal(size=500), rng.integers(0, 2, 500)
    total, count, sums, numbers = np.zeros(3), np.zeros(3, np.int64), [], []
    for a, b in ((0, 200), (200, 201), (201, 500)):
        s, n = _earlier(codes[a:b], values[a:b], known[a:b], total, count)
        sums, numbers = [*sums, *s], [*numbers, *n]
    for i, c in enumerate(codes):
        past = [j for j in range(i) if codes[j] == c] if c < 3 else []
        assert sums[i] == pytest.approx(values[past].sum()) and numbers[i] == known[past].sum()


def rows_of_features(n=6000):
    rng = np.random.default_rng(8)
    a, b, c = rng.integers(-6, 7, n), rng.gamma(2.0, 3.0, n), rng.normal(size=n)
    y = np.where(a > 1, 5.0, 0.0) + np.where(b > 4, 3.0, -1.0) * np.sign(c) + rng.normal(0, 0.5, n)
    rows = [(int(a[i]), float(b[i]) if i % 97 else None, float(c[i]) if i % 89 else float("nan"), float(y[i]) if i % 83 else None, 1.5, i) for i in range(n)]
    return rows, "a int, b double, c double, y double, one double, i int"


def test_trees_from_groups_are_the_trees_from_rows(spark, large, tmp_path):
    df = spark.createDataFrame(*rows_of_features()).cache()
    plain_trees = trees.boosted_trees(["a", "b", "c", "one"], "y", rounds=6, depth=4)
    rows, groups = plain_trees.fit(df), plain_trees.fit_groups(df)
    assert [t.numNodes for t in groups.model.stages[-1].trees] == [t.numNodes for t in rows.model.stages[-1].trees]
    assert groups.predict(df).columns == rows.predict(df).columns
    got, want = ({r.i: r.prediction for r in m.predict(df).collect()} for m in (groups, rows))
    assert len(got) == 6000 and sum(v is None for v in got.values()) == sum(v is None for v in want.values()) > 100
    assert all(got[i] == pytest.approx(v, rel=1e-9) if v is not None else got[i] is None for i, v in want.items())
    weights = {r.feature: r.importance for r in rows.importance(spark).collect()}
    assert {r.feature: r.importance for r in groups.importance(spark).collect()} == pytest.approx(weights, rel=1e-9)
    groups.save(str(tmp_path / "model"))
    again = trees.TreeForecaster(rows.features, "y", None, trees.load_model(str(tmp_path / "model")))
    assert {r.i: r.prediction for r in again.predict(df).collect()} == got


@pytest.mark.parametrize("settings", [{"subsample": 0.5}, {"validation": "held"}])
def test_learners_that_look_at_single_rows_get_them(spark, settings):
    df = spark.createDataFrame(*rows_of_features(600)).withColumn("held", F.col("i") % 5 == 0)
    learner = trees.boosted_trees(["a", "b"], "y", rounds=3, depth=2, **settings)
    got, want = ([r.prediction for r in m.predict(df).orderBy("i").collect()] for m in (learner.fit_groups(df), learner.fit(df)))
    assert got == want


def test_boosting_of_a_large_table_passes_over_groups(spark, large, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, int(k), float(k * 10 + rng.normal()), float(x)) for i, (k, x) in enumerate(zip(rng.integers(0, 3, 3000), rng.integers(0, 2, 3000), strict=True))]
    df, seen = spark.createDataFrame(rows, "t int, kind int, y double, x double"), []
    fit = trees.GBTRegressor.fit
    monkeypatch.setattr(trees.GBTRegressor, "fit", lambda self, data, *a: (seen.append(data), fit(self, data, *a))[1])
    model = trees.categorical_boosted_trees(["x"], ["kind"], "y", ["t"], rounds=10, depth=3).fit(df)
    assert seen[0].count() <= 2 * 32 and seen[0].agg(F.sum("_n")).first()[0] == 3000  # every row counts
    errors = np.array([r.y - r.prediction for r in model.predict(df).collect()])
    assert len(errors) == 3000 and (errors**2).mean() < 4


def test_later_rows_see_all_of_training_and_unknown_categories_the_prior(spark, small_blocks):
    rows = table()
    df = spark.createDataFrame(rows, "t int, id int, kind string, y double, n int")
    encoder = OrderedTargetEncoder(["kind", "n"], "y", ORDER, weight=4.0).fit(df)
    known = [r[3] for r in rows if r[3] is not None and not math.isnan(r[3])]
    assert encoder.prior == pytest.approx(np.mean(known))
    later = spark.createDataFrame([(1, "hot", 0), (2, None, 1), (3, "new", 9)], "id int, kind string, n int")
    got = {r.id: r for r in encoder.encode(later).collect()}
    sums = plain(rows, encoder.prior, 4.0)[1]
    for i, kind in ((1, "hot"), (2, None)):
        total, n = sums[kind]
        assert got[i].kind_target == pytest.approx((total + 4 * encoder.prior) / (n + 4))
    assert got[3].kind_target == got[3].n_target == pytest.approx(encoder.prior)
    assert encoder.encode_training(df).count() == len(rows)
    none = df.limit(0)
    assert mean_target(none, "y") == 0.0 and ordered_target_statistic(none, "kind", "y", ORDER, 0.0).count() == 0


def test_a_row_never_learns_from_itself_or_from_later_rows(spark):
    rows = table(120)
    df = spark.createDataFrame(rows, "t int, id int, kind string, y double, n int")
    cut = 20
    changed = [(t, i, k, (999.0 if t >= cut else y), n) for t, i, k, y, n in rows]
    early = lambda d: {r.id: r.s for r in ordered_target_statistic(d, "kind", "y", ORDER, 1.0, name="s").where(f"t < {cut}").collect()}
    assert early(df) == early(spark.createDataFrame(changed, df.schema))


def test_trees_use_categories(spark):
    rng = np.random.default_rng(5)
    level = {c: v for c, v in zip("abcdefgh", rng.permutation(8) * 10.0, strict=True)}
    rows = [(i, c, float(level[c] + rng.normal(0, 1)), float(rng.normal())) for i, c in enumerate(rng.choice(list("abcdefgh"), 600))]
    df = spark.createDataFrame(rows, "t int, kind string, y double, x double")
    model = trees.categorical_boosted_trees(["x"], ["kind"], "y", ["t"], rounds=10, depth=3).fit(df.where("t < 450"))
    held = model.predict(df.where("t >= 450"))
    assert held.columns == [*df.columns, "prediction"] and held.count() == 150
    errors = np.array([r.y - r.prediction for r in held.collect()])
    without = trees.boosted_trees(["x"], "y", rounds=10, depth=3).fit(df.where("t < 450")).predict(df.where("t >= 450"))
    blind = np.array([r.y - r.prediction for r in without.collect()])
    assert (errors**2).mean() < (blind**2).mean() / 16


def test_halving_keeps_what_an_exhaustive_loop_keeps(spark, small_blocks):
    rng = np.random.default_rng(11)
    x = rng.normal(0, 1, (400, 4))
    # feature a leads late in time, b on the whole, c and d are noise
    y = np.where(np.arange(400) >= 250, 1.0, -1.0) * 2.0 * x[:, 0] + 3.0 * x[:, 1] + rng.normal(0, 0.3, 400)
    rows = [(i // 2, i, *map(float, x[i]), float(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "t int, id int, a double, b double, c double, d double, y double").repartition(5)
    trials = [{"features": ("c",)}, {"features": ("a", "b")}, {"features": ("missing",)}, {"features": ("d",)}, {"features": ("b",)}, {"features": ("a",)}]
    train, held = df.where("t < 160"), df.where("t >= 160")
    got = trees.successive_halving(lambda features: LinearForecaster(list(features), "y"), trials, train, held, "y", ORDER, rungs=3)
    found = {(r.rung, r.trial): r for r in got.collect()}

    def score(features, first):
        use = [("a", "b", "c", "d").index(f) for f in features]
        rows_in = [i for i in range(320) if i // 2 >= first]
        design = np.column_stack([np.ones(len(rows_in)), x[np.ix_(rows_in, use)]])
        coef = np.linalg.lstsq(design, y[rows_in], rcond=None)[0]
        return float(np.sqrt(((y[320:] - coef[0] - x[320:][:, use] @ coef[1:]) ** 2).mean()))

    alive = list(range(6))
    for rung, share in enumerate((4, 2, 1)):
        first = (320 - 320 // share) // 2
        scores = {i: score(trials[i]["features"], first) for i in alive if i != 2}
        assert {t for r, t in found if r == rung} == set(alive)
        for i, s in scores.items():
            assert found[rung, i].score == pytest.approx(s, rel=1e-9) and found[rung, i].status == "ok"
        ranked = sorted(scores, key=lambda i: (scores[i], i))
        alive = sorted(ranked[: math.ceil(len(alive) / 2)] if rung < 2 else ranked[:1])
        assert {t for (r, t), row in found.items() if r == rung and row.kept} == set(alive)
    assert found[0, 2].status.startswith("failed") and not found[0, 2].kept
    again = trees.successive_halving(lambda features: LinearForecaster(list(features), "y"), trials, train, held, "y", ORDER, rungs=3, parallel=1)
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


def test_halving_of_nothing(spark):
    df = spark.createDataFrame([], "t int, id int, a double, y double")
    out = trees.successive_halving(lambda features: LinearForecaster(["a"], "y"), [{"features": 1}], df, df, "y", ORDER)
    assert [r.kept for r in out.collect()] == [False]
    with pytest.raises(ValueError):
        trees.successive_halving(lambda: None, [{}], df, df, "y", ORDER, rungs=0)
