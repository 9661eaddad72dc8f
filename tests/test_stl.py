"""Decomposition by loess against a plain loop, whole and cut."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rhythmica.forecast.stl import StlSpec, decompose, forecast_stl, loess, odd


def line_at(x, y, span, weight):
    """Weighted line through the nearest values, by least squares."""
    n, size = len(y), min(span, len(y))
    if n == 1:
        return y[0]
    first = min(max(round(x) - size // 2, 0), n - size)
    near = np.arange(first, first + size)
    reach = max(abs(near - x)) + max(0, span - n) / 2
    w = np.clip(1 - (abs(near - x) / (1.001 * reach)) ** 3, 0, 1) ** 3
    w = w * weight[near] if (w * weight[near]).sum() > 1e-12 else w
    used = w > 0
    if used.sum() == 1:
        return y[near][used][0]
    return np.polyval(np.polyfit(near[used] - x, y[near][used], 1, w=np.sqrt(w[used])), 0)


def plain(y, spec):
    n, m = len(y), spec.period
    trend, weight = np.zeros(n), np.ones(n)
    for turn in range(spec.outer + 1):
        for _ in range(spec.inner):
            cycles = {}
            for s in range(m):
                own = np.arange(s, n, m)
                for k in range(-1, len(own) + 1):
                    cycles[s + k * m] = line_at(k, (y - trend)[own], spec.seasonal, weight[own])
            c = np.array([cycles[i] for i in range(-m, n + m)])
            for size in (m, m, 3):
                c = np.array([c[i : i + size].mean() for i in range(len(c) - size + 1)])
            low = np.array([line_at(i, c, spec.low_pass_span, np.ones(n)) for i in range(n)])
            season = np.array([cycles[i] for i in range(n)]) - low
            trend = np.array([line_at(i, y - season, spec.trend_span, weight) for i in range(n)])
        rest = y - trend - season
        share = np.abs(rest) / (6 * np.median(np.abs(rest)))
        weight = np.where(share < 1, (1 - share**2) ** 2, 0.0)
    return trend, season, rest


def table(spark, data):
    rows = [(s, t, float(v)) for s, ys in data.items() for t, v in enumerate(ys)]
    return spark.createDataFrame([*rows, ("long", 10_000, None), ("long", -3, float("nan"))], "series string, t int, y double").repartition(5)


def values(n, seed):
    rng = np.random.default_rng(seed)
    y = 20 + 0.1 * np.arange(n) + 5 * np.sin(np.arange(n) * 2 * np.pi / 4) + rng.normal(0, 0.5, n)
    y[n // 3] += 30  # an outlier for the robustness weights
    return y


@pytest.mark.parametrize("outer", [0, 2])
@pytest.mark.parametrize("block", [None, "30"])
def test_parts_equal_a_plain_loop_and_add_up(spark, outer, block):
    spec = StlSpec(period=4, seasonal=5, outer=outer)
    data = {"long": values(400, 1), "mid": values(23, 2), None: values(60, 3)}
    if block:
        spark.conf.set("spark.rhythmica.rowsPerBlock", block)
    try:
        rows = decompose(table(spark, data), ["series"], ["t"], "y", spec).collect()
    finally:
        spark.conf.unset("spark.rhythmica.rowsPerBlock")
    for s, y in data.items():
        got = sorted((r for r in rows if r.series == s), key=lambda r: r._pos)
        assert [r.y for r in got] == list(y)
        for name, want in zip(("trend", "season", "rest"), plain(y, spec), strict=True):
            np.testing.assert_allclose([r[name] for r in got], want, atol=1e-7)
        np.testing.assert_allclose([r.trend + r.season + r.rest for r in got], y, rtol=1e-12)
        assert outer == 0 or got[len(y) // 3].weight < 0.1


def test_short_series_have_no_season(spark):
    df = spark.createDataFrame([("one", 0, 5.0), *[("few", t, float(t)) for t in range(5)]], "series string, t int, y double")
    rows = decompose(df, ["series"], ["t"], "y", StlSpec(period=4)).collect()
    assert len(rows) == 6 and all(r.season == 0 and abs(r.trend - r.y) < 1e-9 for r in rows)
    assert decompose(df.limit(0), ["series"], ["t"], "y", StlSpec(period=4)).count() == 0


def test_forecasts_continue_the_season(spark):
    y = 50 + 1.5 * np.arange(60) + np.tile([6.0, -2.0, -4.0], 20)
    df = spark.createDataFrame([("a", t, float(v)) for t, v in enumerate(y)], "series string, t int, y double")
    got = forecast_stl(df, ["series"], ["t"], "y", StlSpec(period=3), 7).orderBy("step").collect()
    want = 50 + 1.5 * np.arange(60, 67) + np.tile([6.0, -2.0, -4.0], 3)[:7]
    np.testing.assert_allclose([r.yhat for r in got], want, atol=1.5)
    assert [r.step for r in got] == list(range(1, 8)) and all(r.lower <= r.yhat <= r.upper for r in got)


def test_smoother_keeps_lines_and_spans_are_odd():
    y = 3.0 + 2.0 * np.arange(40)
    np.testing.assert_allclose(loess(y, 9, np.ones(40)), y)
    np.testing.assert_allclose(loess(y, 99, np.ones(40), np.array([-1, 40])), [1.0, 83.0])
    assert [odd(4), odd(5), odd(5.2)] == [5, 5, 7]
