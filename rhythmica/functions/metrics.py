"""Forecast errors as aggregate columns.

Every builder takes the truth and the forecast and returns an aggregate ``Column``, so any number of
metrics is one pass with map-side partial aggregation, grouped or not.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
EPSILON = 1e-8
MACHINE_EPSILON = 2.220446049250313e-16

Metric = Callable[[Column, Column], Column]


def _pair(y, p) -> tuple[Column, Column]:
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return as_col(y), as_col(p)


def mae(y, p) -> Column:
    y, p = _pair(y, p)
    return F.avg(F.abs(y - p))


def mse(y, p) -> Column:
    y, p = _pair(y, p)
    return F.avg((y - p) * (y - p))


def rmse(y, p) -> Column:
    return F.sqrt(mse(y, p))


def mape(y, p, epsilon: float = EPSILON) -> Column:
    """Percent; tiny truths are replaced by epsilon in the denominator."""
    y, p = _pair(y, p)
    return 100 * F.avg(F.abs(y - p) / F.greatest(F.abs(y), F.lit(epsilon)))


def mape_signed(y, p) -> Column:
    """Percent; a zero truth becomes machine epsilon and the denominator keeps its sign."""
    y, p = _pair(y, p)
    return 100 * F.avg(F.abs((y - p) / F.when(y != 0, y).otherwise(F.lit(MACHINE_EPSILON))))


def smape(y, p, epsilon: float = EPSILON) -> Column:
    """Percent; rows whose mean magnitude is at most epsilon are left out (none left: null)."""
    y, p = _pair(y, p)
    size = (F.abs(y) + F.abs(p)) / 2.0
    return 100 * F.avg(F.when(size > epsilon, F.abs(y - p) / F.when(size > epsilon, size)))


def smape_loss(y, p, epsilon: float = EPSILON) -> Column:
    """Percent; epsilon is added to the denominator and no row is left out."""
    y, p = _pair(y, p)
    return 100 * F.avg(F.abs(y - p) / ((F.abs(y) + F.abs(p)) / 2.0 + F.lit(epsilon)))


def pinball(y, p, q: float = 0.5) -> Column:
    y, p = _pair(y, p)
    return F.avg(F.greatest(F.lit(q) * (y - p), F.lit(q - 1) * (y - p)))


def multi_quantile(y, forecasts: dict[float, Column | str]) -> Column:
    """Mean pinball loss over one forecast column per quantile level."""
    losses = [pinball(y, p, q) for q, p in forecasts.items()]
    return sum(losses[1:], losses[0]) / len(losses)


def huber(y, p, delta: float = 1.0) -> Column:
    y, p = _pair(y, p)
    e = F.abs(y - p)
    return F.avg(F.when(e <= delta, 0.5 * e * e).otherwise(delta * e - 0.5 * delta * delta))


def r2(y, p) -> Column:
    y, p = _pair(y, p)
    both = y.isNotNull() & p.isNotNull()
    spread = F.var_pop(F.when(both, y)) * F.count(F.when(both, y))
    return 1 - F.try_divide(F.sum((y - p) * (y - p)), spread)


def wmae(y, p, weight) -> Column:
    y, p = _pair(y, p)
    w = F.col(weight) if isinstance(weight, str) else weight
    return F.try_divide(F.sum(w * F.abs(y - p)), F.sum(F.when(y.isNotNull() & p.isNotNull(), w)))


# name -> builder, the collection used when no other is given
STANDARD: dict[str, Metric] = {
    "mae": mae,
    "rmse": rmse,
    "mape": mape,
    "smape": smape,
}


def collect_metrics(y, p, metrics: dict[str, Metric] | None = None, prefix: str = "") -> list[Column]:
    """Named aggregate columns; pass them to one ``agg``."""
    return [build(*_pair(y, p)).alias(f"{prefix}{name}") for name, build in (metrics or STANDARD).items()]


def quantile_levels(confidence: float) -> tuple[float, float]:
    low = (1 - confidence) / 2
    return low, 1 - low


def median_of(columns: Sequence[Column | str]) -> Column:
    """Row-wise median of a few columns."""
    ordered = F.array_sort(F.array(*columns))
    n = len(columns)
    if n % 2:
        return ordered[n // 2]
    return (ordered[n // 2 - 1] + ordered[n // 2]) / 2
