"""Successive halving: trials that share their passes score as trials by themselves."""

import numpy as np
import pytest

from rhythmica.forecast import trees
from rhythmica.forecast.regression import LinearForecaster
from rhythmica.session import settled

ORDER = ["t", "id"]


class Alone:
    """A linear learner that shares no pass."""

    def __init__(self, features, model=None):
        self.model = model or LinearForecaster(list(features), "y")

    def fit(self, df):
        return Alone((), self.model.fit(df))

    def predict(self, df):
        return self.model.predict(df)


def halving_rows(out):
    return {(r.rung, r.trial): (r.share_of_rows, r.params, r.status, r.kept, r.score) for r in out.collect()}


def test_trials_of_a_rung_share_their_passes(spark):
    df = spark.createDataFrame([(i // 3, i, *[float((i * k) % 11) for k in (1, 2, 3, 5, 7)], float(i % 5)) for i in range(300)], "t int, id int, a double, b double, c double, d double, e double, y double")
    train, held = settled(df.where("t < 80"), "train"), settled(df.where("t >= 80"), "held")
    tracker = spark.sparkContext.statusTracker()

    def jobs(names):
        before = max(tracker.getJobIdsForGroup())
        trees.successive_halving(lambda feature: LinearForecaster([feature], "y"), [{"feature": c} for c in names], train, held, "y", ORDER)
        return max(tracker.getJobIdsForGroup()) - before

    assert jobs("abcde") == jobs("ab")


@pytest.mark.parametrize("together", [30, 12])
def test_halving_with_shared_passes_equals_single_trials_on_odd_rows(spark, monkeypatch, together):
    monkeypatch.setattr(trees, "SUMS_TOGETHER", together)
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (300, 4))
    y = 2 * x[:, 0] - x[:, 1] + rng.normal(0, 0.5, 300)
    odd = lambda i, n, v: None if i % n == 0 else float("nan") if v is not None and i == 5 and n == 19 else float(v)
    rows = [(None if i % 37 == 0 else i // 4, i // 2, odd(i, 7, x[i, 0]), odd(i, 9, x[i, 1]), odd(i, 300, x[i, 2]), odd(i, 19, x[i, 3]), odd(i, 23, y[i])) for i in range(300)]
    df = spark.createDataFrame([*rows, *rows[40:80]], "t int, id int, a double, b double, prediction double, d double, y double")
    sets = [("a",), ("missing",), ("a", "b"), ("d",), (), ("b", "d"), ("y",)]
    for held in (df.where("id >= 110").drop("prediction"), df.where("id >= 110"), df.limit(0)):
        trials = [{"features": f} for f in (sets if "prediction" not in held.columns else [*sets, ("prediction",), ("prediction", "a")])]
        for train in (df.where("id < 110"), df.limit(0))[: 2 if together == 12 else 1]:
            shared = halving_rows(trees.successive_halving(lambda features: LinearForecaster(list(features), "y"), trials, train, held, "y", ORDER))
            alone = halving_rows(trees.successive_halving(Alone, trials, train, held, "y", ORDER))
            assert {k: v[:4] for k, v in shared.items()} == {k: v[:4] for k, v in alone.items()}
            assert [v[4] for v in shared.values()] == pytest.approx([alone[k][4] for k in shared], rel=1e-12)
    assert shared[0, 1][2] == "failed: AnalysisException"


def test_a_trial_that_cannot_be_built_fails_by_itself(spark):
    df = spark.createDataFrame([(i, i, float(i), float(2 * i)) for i in range(40)], "t int, id int, a double, y double")

    def build(kind):
        if kind == "refused":
            raise KeyError(kind)
        return LinearForecaster(["a"], "y") if kind == "linear" else Alone(["a"])

    got = halving_rows(trees.successive_halving(build, [{"kind": k} for k in ("refused", "linear", "alone")], df.where("t < 30"), df.where("t >= 30"), "y", ORDER, rungs=1))
    assert [got[0, i][2] for i in range(3)] == ["failed: KeyError", "ok", "ok"]
    assert got[0, 1][4] == pytest.approx(got[0, 2][4]) and got[0, 1][3]
