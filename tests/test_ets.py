"""Exponential smoothing against a plain loop, whole and cut."""

import numpy as np
import pytest

from rhythmica.forecast.ets import EtsSpec, chain, fit_ets, run_block


def plain(y, spec):
    """Best parameters, state and squared errors, one row and one combination at a time."""
    best, m = None, spec.season
    for alpha, beta, gamma, phi in spec.grid():
        k = min(m, len(y)) or 1
        level = sum(y[:k]) / k
        step = max(m, 1)
        slope = (sum(y[step : 2 * step]) / step - level) / step if spec.trend and len(y) >= 2 * step else 0.0
        season = [y[i] - level if i < k else 0.0 for i in range(m)]
        sse = 0.0
        for t in range(k, len(y)):
            e = y[t] - level - phi * slope - (season[t % m] if m else 0.0)
            level, slope = level + phi * slope + alpha * e, phi * slope + beta * e
            if m:
                season[t % m] += gamma * e
            sse += e * e
        if best is None or sse < best[0]:
            best = (sse, (alpha, beta, gamma, phi), level, slope, season)
    return best


def ahead(best, n, m, steps):
    _, (_, _, _, phi), level, slope, season = best
    return [level + slope * sum(phi**k for k in range(1, h + 1)) + (season[(n + h - 1) % m] if m else 0.0) for h in range(1, steps + 1)]


SPECS = [EtsSpec(season=6), EtsSpec(season=0), EtsSpec(trend=False, season=3), EtsSpec(trend=False), EtsSpec(season=6, phis=(0.85,))]


def values(n, seed):
    rng = np.random.default_rng(seed)
    return 50 + 0.3 * np.arange(n) + 8 * np.sin(np.arange(n) * 2 * np.pi / 6) + rng.normal(0, 2, n)


@pytest.mark.parametrize("spec", SPECS)
@pytest.mark.parametrize("block", [None, "40"])
def test_models_and_forecasts_equal_a_plain_loop(spark, spec, block):
    data = {"long": values(600, 1), "short": values(5, 2), "one": values(1, 3), None: values(90, 4)}
    rows = [(s, t, float(v)) for s, ys in data.items() for t, v in enumerate(ys)]
    rows += [("long", 10_000, None), ("long", -5, float("nan")), ("empty", 1, None)]
    df = spark.createDataFrame(rows, "series string, t int, y double").repartition(5)
    if block:
        spark.conf.set("spark.rhythmica.rowsPerBlock", block)
    try:
        fit = fit_ets(df, ["series"], ["t"], "y", spec)
        found = {r.series: r for r in fit.models.collect()}
        steps = {(r.series, r.step): r for r in fit.forecast(8).collect()}
    finally:
        spark.conf.unset("spark.rhythmica.rowsPerBlock")
    assert set(found) == set(data)
    for s, ys in data.items():
        want, got = plain(list(ys), spec), found[s]
        assert got.n == len(ys) and got.sse == pytest.approx(want[0], rel=1e-9, abs=1e-12)
        if len(ys) > 20:
            assert (got.alpha, got.beta, got.gamma, got.phi) == pytest.approx(want[1])
            assert [got.level, got.slope, *got.season] == pytest.approx([want[2], want[3], *want[4]], rel=1e-9, abs=1e-9)
            assert [steps[s, h].yhat for h in range(1, 9)] == pytest.approx(ahead(want, len(ys), spec.season, 8), rel=1e-9)
            assert steps[s, 1].std == pytest.approx((want[0] / (len(ys) - max(spec.season, 1))) ** 0.5)
            assert steps[s, 8].std > steps[s, 1].std and steps[s, 8].lower < steps[s, 8].yhat < steps[s, 8].upper


def test_blocks_of_any_size_chain_to_the_same_state():
    spec, y = EtsSpec(season=4), values(300, 9)
    grid, position = spec.grid(), np.arange(300)
    whole = chain([run_block(position, y, spec, grid)])
    for cuts in ([8], [9, 10, 11], [50, 177, 178, 299]):
        parts = [run_block(p, v, spec, grid) for p, v in zip(np.split(position, cuts), np.split(y, cuts), strict=True)]
        x, sse = chain(parts)
        np.testing.assert_allclose(x, whole[0], rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose(sse, whole[1], rtol=1e-9)


def test_a_planted_season_and_slope_are_forecast(spark):
    y = 10 + 2.0 * np.arange(48) + np.tile([5.0, -5.0, 0.0], 16)
    df = spark.createDataFrame([("a", t, float(v)) for t, v in enumerate(y)], "series string, t int, y double")
    got = [r.yhat for r in fit_ets(df, ["series"], ["t"], "y", EtsSpec(season=3, alphas=(0.3,), betas=(0.1,), gammas=(0.3,), phis=(1.0,))).forecast(6).orderBy("step").collect()]
    np.testing.assert_allclose(got, 10 + 2.0 * np.arange(48, 54) + np.tile([5.0, -5.0, 0.0], 2), atol=0.5)


def test_no_admissible_combination_is_an_error():
    with pytest.raises(ValueError):
        EtsSpec(season=4, alphas=(0.9,), gammas=(0.5,)).grid()
