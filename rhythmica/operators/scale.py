"""Scalers fitted on the training part and applied as projections.

``fit`` runs one aggregate and keeps two numbers per column; ``transform`` and ``inverse`` are then
plain arithmetic, usable on batch and streaming tables alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rhythmica.operators.quantiles import column_quantiles


@dataclass
class Scaler:
    """``(x - center) / scale`` per column."""

    columns: Sequence[str]
    params: dict[str, tuple[float, float]] = field(default_factory=dict)

    def _measure(self, df: DataFrame) -> dict[str, tuple[float, float]]:
        raise NotImplementedError

    def fit(self, df: DataFrame) -> Scaler:
        self.params = {c: (m, s if s else 1.0) for c, (m, s) in self._measure(df).items() if m is not None}
        return self

    def _fitted(self) -> dict[str, tuple[float, float]]:
        if not self.params:
            raise RuntimeError("the scaler is not fitted")
        return self.params

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self._fitted().items() if c in df.columns})

    def inverse(self, df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
        """Undo the scaling; ``names`` maps a column of ``df`` to the fitted column it is scaled like."""
        names = names or {c: c for c in self._fitted() if c in df.columns}
        return df.withColumns({c: F.col(c) * F.lit(self.params[k][1]) + F.lit(self.params[k][0]) for c, k in names.items()})


class StandardScaler(Scaler):
    """Mean and population standard deviation."""

    def _measure(self, df):
        row = df.agg(*[f(c).alias(f"{k}_{c}") for c in self.columns for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in self.columns}


@dataclass
class RobustScaler(Scaler):
    """Median and interquantile range; exact unless ``exact=False`` asks for a sketch."""

    low: float = 0.25
    high: float = 0.75
    exact: bool = True

    def _measure(self, df):
        if not self.exact:
            row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), [self.low, 0.5, self.high]).alias(c) for c in self.columns]).first()
            return {c: (row[c][1], row[c][2] - row[c][0]) if row[c] else (None, None) for c in self.columns}
        rows = column_quantiles(df, self.columns, [self.low, 0.5, self.high], ["lo", "mid", "hi"]).collect()
        return {r["column"]: (r["mid"], r["hi"] - r["lo"]) for r in rows}


@dataclass
class MinMaxScaler(Scaler):
    """Onto [low, high]; a constant column lands on the low end."""

    low: float = 0.0
    high: float = 1.0

    def _measure(self, df):
        row = df.agg(*[f(c).alias(f"{k}_{c}") for c in self.columns for k, f in (("lo", F.min), ("hi", F.max))]).first()
        out = {}
        for c in self.columns:
            lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
            if lo is None:
                continue
            scale = ((hi - lo) or 1.0) / (self.high - self.low)
            out[c] = (lo - self.low * scale, scale)
        return out


class ScalerChain:
    """Named scalers in sequence; a name starting with ``target_`` is meant for the target.

    ``fit="raw"`` measures every step on the untransformed table, ``fit="chained"`` on the output of
    the steps before it. Both apply the steps in sequence.
    """

    def __init__(self, steps: Sequence[tuple[str, Scaler]], fit: str = "raw"):
        if fit not in ("raw", "chained"):
            raise ValueError(f"unknown fit mode {fit!r}")
        self.steps, self.mode, self.fitted = list(steps), fit, False

    def fit(self, train: DataFrame) -> ScalerChain:
        seen = train
        for _, step in self.steps:
            step.fit(seen)
            if self.mode == "chained":
                seen = step.transform(seen)
        self.fitted = True
        return self

    def _steps(self):
        if not self.fitted:
            raise RuntimeError("the chain is not fitted")
        return self.steps

    def transform(self, df: DataFrame) -> DataFrame:
        for _, step in self._steps():
            df = step.transform(df)
        return df

    def inverse_target(self, df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
        """Bring target-scaled columns (truth and forecasts) back to the original scale."""
        for name, step in reversed(self._steps()):
            if name.startswith("target_"):
                df = step.inverse(df, {c: target for c in columns})
        return df

    def inverse_features(self, df: DataFrame) -> DataFrame:
        for name, step in reversed(self._steps()):
            if not name.startswith("target_"):
                df = step.inverse(df)
        return df
