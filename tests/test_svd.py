"""Truncated decomposition of a panel against NumPy on the whole matrix."""

import numpy as np
import pytest

from rhythmica.forecast import svd
from rhythmica.forecast.ets import EtsSpec

from test_ets import ahead, plain


def panel_rows(seed, series, periods, group):
    rng = np.random.default_rng(seed)
    y = rng.normal(50, 5, (series, 1)) + rng.normal(0, 4, (series, 2)) @ rng.normal(0, 3, (2, periods)) + rng.normal(0, 0.5, (series, periods))
    return y, [(group, f"s{i}", t, float(y[i, t])) for i in range(series) for t in range(periods)]


def filled(rows, center):
    """(series names, matrix, means) with gaps by the stated rule."""
    names, times = sorted({r[1] for r in rows}, key=str), sorted({r[2] for r in rows})
    x, seen = np.zeros((len(names), len(times))), np.zeros((len(names), len(times)))
    for _, s, t, v in rows:
        x[names.index(s), times.index(t)] += v
        seen[names.index(s), times.index(t)] += 1
    x = np.where(seen > 0, x / np.maximum(seen, 1), 0)
    means = x.sum(1) / (seen > 0).sum(1) if center else np.zeros(len(names))
    return names, times, np.where(seen > 0, x - means[:, None], 0), means


@pytest.mark.parametrize("center", [True, False])
@pytest.mark.parametrize("per_task", [None, 3])
def test_rebuild_and_forecast_equal_numpy(spark, monkeypatch, center, per_task):
    if per_task:
        monkeypatch.setattr(svd, "SERIES_PER_TASK", per_task)
    _, a = panel_rows(1, 12, 40, "a")
    _, b = panel_rows(2, 5, 60, None)
    a = [r for r in a if (int(r[1][1:]) * 7 + r[2]) % 9]  # gaps
    b = [*b, (None, "s1", 3, 70.0)]  # a repeated cell
    bad = [("a", "s0", 500, None), ("a", "s0", None, 5.0), ("b", "z", 1, float("nan"))]
    df = spark.createDataFrame([*a, *b, *bad], "g string, s string, t int, y double").repartition(5)
    fit = svd.fit_svd(df, ["g"], ["s"], "t", "y", 2, center)
    rebuilt = {(r.g, r.s, r.t): r.fitted for r in fit.rebuild().collect()}
    spec = EtsSpec(trend=False)
    future = {(r.g, r.s, r.step): r.yhat for r in fit.forecast(3, spec).collect()}
    want, n_future = {}, {}
    for g, rows in (("a", a), (None, b)):
        names, times, x, means = filled(rows, center)
        u, d, vt = np.linalg.svd(x, full_matrices=False)
        low = u[:, :2] * d[:2] @ vt[:2] + means[:, None]
        want |= {(g, s, t): low[i, j] for i, s in enumerate(names) for j, t in enumerate(times)}
        courses = [v * np.sign(v[np.abs(v).argmax()]) for v in vt[:2]]
        steps = np.array([ahead(plain(list(v), spec), len(v), 0, 3) for v in courses])
        n_future |= {(g, s, h + 1): means[i] + sum(x[i] @ courses[c] * steps[c, h] for c in range(2)) for i, s in enumerate(names) for h in range(3)}
    assert rebuilt.keys() == want.keys() and future.keys() == n_future.keys()
    for k, v in want.items():
        assert rebuilt[k] == pytest.approx(v, rel=1e-8, abs=1e-8)
    for k, v in n_future.items():
        assert future[k] == pytest.approx(v, rel=1e-6, abs=1e-6)


def test_whole_table_one_series_and_more_ranks_than_periods(spark):
    df = spark.createDataFrame([("x", t, float(t)) for t in range(3)], "s string, t int, y double")
    fit = svd.fit_svd(df, [], ["s"], "t", "y", 5)
    assert {r.t: round(r.fitted, 9) for r in fit.rebuild().collect()} == {0: 0.0, 1: 1.0, 2: 2.0}
    (row,) = fit.components.collect()
    assert row.weights == pytest.approx([2**0.5, 0, 0, 0, 0]) and len(row.v) == 15


def test_empty_table(spark):
    df = spark.createDataFrame([], "s string, t int, y double")
    fit = svd.fit_svd(df, [], ["s"], "t", "y", 2)
    assert fit.rebuild().collect() == [] and fit.forecast(2).collect() == []
