"""Seasonal ARIMA by conditional least squares: against a plain loop, planted coefficients, whole and cut."""

import numpy as np
import pytest

from rhythmica.forecast.sarima import SarimaSpec, ahead, chain, fit_sarima, run_block


def product(near, far, season, sign):
    """Coefficients of (1 + sign near(B)) (1 + sign far(B^season)) by lag, the constant included."""
    out = {0: 1.0}
    for i, v in enumerate(near):
        out[i + 1] = out.get(i + 1, 0.0) + sign * v
    for j, u in enumerate(far):
        lag = (j + 1) * season
        for i, v in [(0, None), *enumerate(near, 1)]:
            out[lag + i] = out.get(lag + i, 0.0) + sign * u * (1.0 if v is None else sign * v)
    return out


def split(spec, params):
    named = dict(zip(spec.names, params, strict=True))
    pick = lambda kind: [v for k, v in named.items() if k.rsplit("_", 1)[0] == kind]
    a = product(pick("ar"), pick("seasonal_ar"), spec.season, -1)
    m = product(pick("ma"), pick("seasonal_ma"), spec.season, 1)
    return named.get("level", 0.0), named.get("slope", 0.0), a, m


def differenced(y, spec):
    w, gone = list(y), 0
    for lag in [1] * spec.d + [spec.season] * spec.seasonal_d:
        w, gone = [w[t] - w[t - lag] for t in range(lag, len(w))], gone + lag
    return w, gone


def plain_errors(y, spec, params):
    level, slope, a, m = split(spec, params)
    w, gone = differenced(y, spec)
    e, begin = {}, max(a)
    for t in range(begin, len(w)):
        e[t] = sum(c * w[t - i] for i, c in a.items()) - level - slope * (gone + t + 1) - sum(c * e.get(t - i, 0.0) for i, c in m.items() if i)
    return np.array([e[t] for t in range(begin, len(w))])


SPECS = [
    SarimaSpec(1, 0, 1, 1, 0, 1, 6, "c"), SarimaSpec(2, 1, 0, trend="ct"), SarimaSpec(0, 1, 1, 0, 1, 1, 4), SarimaSpec(0, 0, 2, trend="t"), SarimaSpec(1, 1, 1, 0, 0, 2, 3, "c"),
]


@pytest.mark.parametrize("spec", SPECS)
def test_blocks_answer_with_errors_and_derivatives_of_the_whole_series(spec):
    rng = np.random.default_rng(4)
    y, k = np.cumsum(rng.normal(0.1, 1, 700)), len(spec.names)
    params = rng.uniform(-0.4, 0.4, k)
    e = plain_errors(y, spec, params)
    jac = np.array([(plain_errors(y, spec, params + 1e-6 * u) - plain_errors(y, spec, params - 1e-6 * u)) / 2e-6 for u in np.eye(k)])
    for cuts in ([0], [0, 300], [0, 40, 41 + spec.lead, 600], [0, max(spec.lead, spec.memory)]):
        parts, total = [], 0
        for begin, end in zip(cuts, [*cuts[1:], 700], strict=True):
            from_row = max(begin - spec.lead, 0)
            n, last, gram = run_block(y[from_row:end], from_row, spec, params)
            parts.append((last, gram))
            total += n
        last, whole = chain(parts, k, spec.memory)
        assert total == len(e)
        assert whole[0, 0] == pytest.approx(e @ e, rel=1e-9)
        np.testing.assert_allclose(whole[1:, 0], jac @ e, rtol=1e-4, atol=1e-4 * np.abs(jac @ e).max())
        np.testing.assert_allclose(whole[1:, 1:], jac @ jac.T, rtol=1e-4, atol=1e-4 * np.abs(jac @ jac.T).max())
        np.testing.assert_allclose(last, e[len(e) - spec.memory :], rtol=1e-9, atol=1e-9)


def simulate(n, seed, ar=0.6, ma=0.4, far=0.5, fma=-0.3, season=6, level=2.0):
    rng = np.random.default_rng(seed)
    a, m = product([ar], [far], season, -1), product([ma], [fma], season, 1)
    e, w = rng.normal(0, 1, n + 200), np.zeros(n + 200)
    for t in range(max(*a, *m), n + 200):
        w[t] = level + sum(c * e[t - i] for i, c in m.items()) - sum(c * w[t - i] for i, c in a.items() if i)
    return w[200:]


@pytest.mark.parametrize("block", [None, "300"])
def test_planted_coefficients_come_back_whole_and_cut(spark, block):
    spec = SPECS[0]
    data = {"long": simulate(6000, 1), None: simulate(500, 2), "short": simulate(10, 3), "flat": np.full(60, 4.0)}
    rows = [(s, t, float(v)) for s, ys in data.items() for t, v in enumerate(ys)]
    rows += [("long", -3, None), ("long", 99_999, float("nan")), ("empty", 1, None)]
    df = spark.createDataFrame(rows, "series string, t int, y double").repartition(5)
    if block:
        spark.conf.set("spark.rhythmica.rowsPerBlock", block)
    try:
        fit = fit_sarima(df, ["series"], ["t"], "y", spec)
        found = {r.series: r for r in fit.models.collect()}
        steps = {(r.series, r.step): r for r in fit.forecast(9).collect()}
        named = {r.series: r for r in fit.parameters().collect()}
    finally:
        spark.conf.unset("spark.rhythmica.rowsPerBlock")
    assert set(found) == set(data)
    assert not found["short"].ok and found["short"].params is None and ("short", 1) not in steps
    for s in ("long", None):
        row, ys = found[s], data[s]
        e = plain_errors(ys, spec, row.params)
        assert row.ok and row.settled and row.n == len(ys) and row.n_errors == len(e)
        assert row.sse == pytest.approx(e @ e, rel=1e-9)
        np.testing.assert_allclose(row.errors, e[-spec.memory :], rtol=1e-8, atol=1e-8)
        np.testing.assert_allclose(row.tail, ys[-spec.lead :])
        for u in np.eye(5) * 1e-4:  # no better place nearby
            assert min((plain_errors(ys, spec, row.params + u) ** 2).sum(), (plain_errors(ys, spec, row.params - u) ** 2).sum()) >= row.sse
        yhat, std = ahead(ys[-spec.lead :], e[-spec.memory :], len(ys), spec, np.array(row.params), 9)
        np.testing.assert_allclose([steps[s, h].yhat for h in range(1, 10)], yhat, rtol=1e-7)
        np.testing.assert_allclose([steps[s, h].std for h in range(1, 10)], std * (row.sse / row.n_errors) ** 0.5, rtol=1e-9)
    one = named["long"]
    assert [one.ar_1, one.seasonal_ar_1, one.ma_1, one.seasonal_ma_1] == pytest.approx([0.6, 0.5, 0.4, -0.3], abs=0.06)
    assert one.sigma == pytest.approx(1.0, abs=0.03) and one.aic < one.bic
    assert found["flat"].ok and found["flat"].sse == pytest.approx(0.0, abs=1e-9) and steps["flat", 9].yhat == pytest.approx(4.0, abs=1e-3)


def test_forecasts_follow_the_recursion_of_the_levels():
    spec, params = SarimaSpec(1, 1, 1, 0, 1, 1, 4, "ct"), np.array([0.3, 0.01, 0.5, 0.2, -0.4])
    y = np.cumsum(np.random.default_rng(8).normal(0, 1, 80))
    e = plain_errors(y, spec, params)
    got, std = ahead(y[-spec.lead :], e[-spec.memory :], 80, spec, params, 6)
    longer = np.concatenate([y, got])
    np.testing.assert_allclose(plain_errors(longer, spec, params)[-6:], 0.0, atol=1e-9)  # forecasts are the values without a shock
    for h in range(6):  # a deviation: squared answers to one shock per step
        answers = []
        for at in range(h + 1):
            shocked = list(y)
            for step in range(h + 1):
                errors = plain_errors(np.array([*shocked, 0.0]), spec, params)
                shocked.append(-errors[-1] + (1.0 if step == at else 0.0))
            answers.append(shocked[-1] - got[h])
        assert std[h] == pytest.approx(np.sqrt(np.sum(np.square(answers))), rel=1e-9)


def test_an_autoregression_is_the_regression_on_its_lags(spark, small_blocks):
    rng = np.random.default_rng(6)
    y = 5 + np.convolve(rng.normal(0, 1, 500), [1, 0.7, 0.3])[:400]
    df = spark.createDataFrame([(t, float(v)) for t, v in enumerate(y)], "t int, y double").selectExpr("'a' AS series", "t", "y").repartition(3)
    found = fit_sarima(df, ["series"], ["t"], "y", SarimaSpec(2, trend="c")).models.first()
    want = np.linalg.lstsq(np.column_stack([np.ones(398), y[1:-1], y[:-2]]), y[2:], rcond=None)[0]
    assert found.params == pytest.approx(want, rel=1e-6)


def test_orders_that_make_no_sense_are_errors(spark):
    for wrong in (dict(trend="x"), dict(seasonal_p=1), dict(p=0), dict(p=-1, trend="c")):
        with pytest.raises(ValueError):
            SarimaSpec(**wrong)
    none = spark.createDataFrame([], "series string, t int, y double")
    fit = fit_sarima(none, ["series"], ["t"], "y", SarimaSpec(1))
    assert fit.models.count() == 0 and fit.forecast(3).count() == 0
