"""Harmonic regression with autoregressive errors against a loop on the rows."""

import numpy as np
import pytest

from rhythmica.forecast.fourier import FourierSpec, fit_fourier


def waves(spec, t):
    return np.stack([getattr(np, f)(2 * np.pi * k * np.asarray(t, float) / spec.period) for k, f in spec.terms()], axis=-1)


def plain(y, spec):
    """Regress, fit the residuals' autoregression, filter, regress again - on rows."""
    p, t = spec.order, np.arange(spec.order, len(y))
    back = lambda i: y[t - i]
    ones = np.ones((len(t), 1))
    beta = np.linalg.lstsq(np.hstack([ones, waves(spec, t)]), back(0), rcond=None)[0][1:]
    phi, level, e = np.zeros(p), 0.0, None
    for _ in range(spec.rounds):
        rest = [back(i) - waves(spec, t - i) @ beta for i in range(p + 1)]
        phi = np.linalg.lstsq(np.stack([*rest[1:], ones[:, 0]], axis=1), rest[0], rcond=None)[0][:p]
        left = back(0) - sum(phi[i - 1] * back(i) for i in range(1, p + 1))
        right = waves(spec, t) - sum(phi[i - 1] * waves(spec, t - i) for i in range(1, p + 1))
        solved = np.linalg.lstsq(np.hstack([ones, right]), left, rcond=None)[0]
        level, beta = solved[0], solved[1:]
        e = left - level - right @ beta
    sigma = np.sqrt(e @ e / (len(t) - p - len(beta) - 1))
    return beta, phi, level, sigma


def ahead(y, spec, model, steps):
    beta, phi, level, _ = model
    known = list(y)
    for _ in range(steps):
        t = len(known)
        known.append(level + waves(spec, t) @ beta + sum(phi[i - 1] * (known[t - i] - waves(spec, t - i) @ beta) for i in range(1, spec.order + 1)))
    return known[len(y) :]


def values(n, seed, period, phi=0.6):
    rng, e = np.random.default_rng(seed), np.zeros(n)
    for t in range(1, n):
        e[t] = phi * e[t - 1] + rng.normal()
    t = np.arange(n)
    return 100 + 5 * np.cos(2 * np.pi * t / period) - 3 * np.sin(2 * np.pi * t / period) + e


@pytest.mark.parametrize("spec", [FourierSpec(12, 2, 1), FourierSpec(4, 2, 3, rounds=6), FourierSpec(52.18, 1, 2, rounds=1)])
@pytest.mark.parametrize("block", [None, "40"])
def test_models_and_forecasts_equal_a_loop_on_rows(spark, spec, block):
    data = {"long": values(500, 1, spec.period), None: values(90, 2, spec.period)}
    rows = [(s, t, float(v)) for s, ys in data.items() for t, v in enumerate(ys)]
    rows += [("long", 9000, None), ("long", -7, float("nan")), ("two", 0, 1.0), ("two", 1, 2.0), ("empty", 0, None)]
    rows += [("same", t, 5.0) for t in range(60)]
    df = spark.createDataFrame(rows, "series string, t int, y double").repartition(5)
    if block:
        spark.conf.set("spark.rhythmica.rowsPerBlock", block)
    try:
        fit = fit_fourier(df, ["series"], ["t"], "y", spec)
        found = {r.series: r for r in fit.models.collect()}
        steps = {(r.series, r.step): r for r in fit.forecast(7).collect()}
    finally:
        spark.conf.unset("spark.rhythmica.rowsPerBlock")
    assert set(found) == {"long", None, "two", "same"}
    assert not found["two"].ok and found["two"].beta is None and not found["same"].ok
    assert {s for s, _ in steps} == set(data)
    for s, ys in data.items():
        want, got = plain(ys, spec), found[s]
        assert got.ok and got.rows == len(ys) and got.n == len(ys) - spec.order
        np.testing.assert_allclose(got.beta, want[0], rtol=1e-6, atol=1e-7)
        np.testing.assert_allclose(got.phi, want[1], rtol=1e-6, atol=1e-7)
        assert (got.intercept, got.sigma) == pytest.approx((want[2], want[3]), rel=1e-6)
        np.testing.assert_allclose([steps[s, h].yhat for h in range(1, 8)], ahead(ys, spec, want, 7), rtol=1e-6)
        psi = [1.0]
        for h in range(1, 7):
            psi.append(sum(want[1][i - 1] * psi[h - i] for i in range(1, min(h, spec.order) + 1)))
        assert steps[s, 1].std == pytest.approx(want[3], rel=1e-6)
        assert steps[s, 7].std == pytest.approx(want[3] * np.sqrt(np.sum(np.square(psi))), rel=1e-6)


def test_planted_coefficients_are_found(spark):
    y = values(20_000, 5, 24)
    df = spark.createDataFrame([(1, t, float(v)) for t, v in enumerate(y)], "series int, t int, y double")
    (got,) = fit_fourier(df, ["series"], ["t"], "y", FourierSpec(24, 1, 1)).models.collect()
    assert got.beta == pytest.approx([5, -3], abs=0.1) and got.phi == pytest.approx([0.6], abs=0.03) and got.sigma == pytest.approx(1, abs=0.03)


def test_harmonics_beyond_half_the_period_are_refused():
    with pytest.raises(ValueError):
        FourierSpec(4, 3).terms()
