"""Exponential smoothing with level, damped trend and additive season for many series.

With state x (level, slope, one value per season slot) and one-step error e, every row does
x <- F x + g e, e = y - w x: an affine map of the state. A block of a series therefore is an affine map as
well, and its sum of squared errors is a quadratic form of the state it starts from. Blocks run side by
side: the first from its initial state, later ones from the unit states; then the blocks of a series are
chained, one small row each. A series that is cut gives the same states as one that is not. All
smoothing parameters of the grid run together, so they are chosen in one pass over the rows.

Rows without a target are left out, so a gap shortens the series; a series without any has no model.
The initial level is the mean of the first season (the first value without a season), the slope the
difference to the mean of the second one per row, the season what is left; a shorter series starts with slope 0.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rhythmica.operators.layout import BEFORE, BLOCK, Layout, plan_layout
from rhythmica.session import settled

#: Errors gathered before they are added to the quadratic form.
GATHER = 512


@dataclass(frozen=True)
class EtsSpec:
    """``season``: rows of a season, 0 for none. The grid holds all combinations with slope <= level
    and season weight <= 1 - level."""

    trend: bool = True
    season: int = 0
    alphas: tuple[float, ...] = (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)
    betas: tuple[float, ...] = (0.01, 0.05, 0.2)
    gammas: tuple[float, ...] = (0.05, 0.1, 0.3)
    phis: tuple[float, ...] = (0.9, 0.98, 1.0)

    def grid(self) -> np.ndarray:
        slopes, dampings = (self.betas, self.phis) if self.trend else ((0.0,), (1.0,))
        seasons = self.gammas if self.season else (0.0,)
        rows = [p for p in itertools.product(self.alphas, slopes, seasons, dampings) if p[1] <= p[0] and p[2] <= 1 - p[0]]
        if not rows:
            raise ValueError("no combination of the smoothing parameters is admissible")
        return np.array(rows)

    def initial(self, y: np.ndarray) -> tuple[np.ndarray, int]:
        """State before the first row that is smoothed, and that row."""
        m = self.season
        state, k = np.zeros(2 + m), min(m, len(y)) or 1
        state[0] = y[:k].mean()
        if self.trend and len(y) >= 2 * max(m, 1):
            state[1] = (y[max(m, 1) : 2 * max(m, 1)].mean() - state[0]) / max(m, 1)
        if m:
            state[2 : 2 + k] = y[:k] - state[0]
        return state, k


def run_block(position: np.ndarray, y: np.ndarray, spec: EtsSpec, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smooth the rows of a block in order: states (grid, column, state), quadratic form of the errors (grid, column, column).

    The block that starts the series has one column, its own state. Others have one for what the rows
    add, and one for each unit of the state before them.
    """
    m, (alpha, beta, gamma, phi) = spec.season, (c[:, None] for c in grid.T)
    size = 2 + m
    if position[0] == 0:
        start, begin = spec.initial(y)
        state = np.repeat(start[:, None, None], len(grid), axis=1)
    else:
        begin = 0
        state = np.repeat(np.eye(size, size + 1, 1)[:, None, :], len(grid), axis=1)
    width = state.shape[2]
    form, errors, held = np.zeros((len(grid), width, width)), np.empty((GATHER, len(grid), width)), 0
    slots = 2 + position % m if m else position
    for t in range(begin, len(y)):
        slope = phi * state[1]
        ahead = state[0] + slope
        error = -ahead - state[slots[t]] if m else -ahead
        error[:, 0] += y[t]
        state[0], state[1] = ahead + alpha * error, slope + beta * error
        if m:
            state[slots[t]] += gamma * error
        errors[held] = error
        held += 1
        if held == GATHER:
            form += np.einsum("tgi,tgj->gij", errors, errors)
            held = 0
    form += np.einsum("tgi,tgj->gij", errors[:held], errors[:held])
    return state.transpose(1, 2, 0), form


def chain(blocks: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Final state and squared errors (per grid row) of blocks in order."""
    states, form = blocks[0]
    x, sse = states[:, 0], form[:, 0, 0]
    for states, form in blocks[1:]:
        z = np.concatenate([np.ones((len(x), 1)), x], axis=1)
        sse = sse + np.einsum("gi,gij,gj->g", z, form, z)
        x = np.einsum("gi,gis->gs", z, states)
    return x, sse


@dataclass(frozen=True)
class EtsFit:
    series: tuple[str, ...]
    spec: EtsSpec
    models: DataFrame  # series, n, alpha, beta, gamma, phi, level, slope, season, sse

    def forecast(self, horizon: int, z: float = 1.959963984540054) -> DataFrame:
        """(series, step, yhat, std, lower, upper), in built-in functions only."""
        n_errors = F.col("n") - F.lit(max(self.spec.season, 1))
        sigma2 = F.try_divide(F.col("sse"), n_errors)
        rows = self.models.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        yhat = F.col("level") + F.col("slope") * _damped_sum(F.col("phi"), F.col("step"))
        if self.spec.season:
            yhat = yhat + F.get("season", F.pmod(F.col("n") + F.col("step") - 1, F.lit(self.spec.season)).cast("int"))
        reach = F.sequence(F.lit(0), F.col("step") - 1)

        def weight(j: Column) -> Column:
            seasonal = F.when(F.pmod(j, F.lit(self.spec.season)) == 0, F.col("gamma")).otherwise(0.0) if self.spec.season else F.lit(0.0)
            return F.when(j == 0, F.lit(1.0)).otherwise(F.col("alpha") + F.col("beta") * _damped_sum(F.col("phi"), j) + seasonal)

        spread = F.aggregate(reach, F.lit(0.0), lambda s, j: s + weight(j) * weight(j))
        out = rows.select(*self.series, "step", yhat.alias("yhat"), F.sqrt(sigma2 * spread).alias("std"))
        return out.withColumns({"lower": F.col("yhat") - z * F.col("std"), "upper": F.col("yhat") + z * F.col("std")})


def _damped_sum(phi: Column, steps: Column) -> Column:
    """phi + phi^2 + ... + phi^steps."""
    return F.when(phi == 1.0, steps.cast("double")).otherwise(phi * (1 - F.pow(phi, steps.cast("double"))) / (1 - phi))


def fit_ets(df: DataFrame, series: Sequence[str], order_by: Sequence[str], y: str, spec: EtsSpec = EtsSpec(), layout: Layout | None = None) -> EtsFit:
    """One model per series, the combination of the grid with the least squared one-step errors."""
    series, grid = tuple(series), spec.grid()
    rows = df.select(*dict.fromkeys([*series, *order_by]), F.col(y).cast("double").alias("_y")).filter(F.col("_y").isNotNull() & ~F.isnan("_y"))
    # the first two seasons lie in one block
    layout = layout or plan_layout(rows, series, order_by, reach=2 * max(spec.season, 1))
    placed = layout.spread(rows).withColumn("_pos", F.col(BEFORE) + F.row_number().over(layout.window()) - 1).select(*series, BLOCK, "_pos", "_y")
    keys = [placed.schema[c] for c in series]
    doubles = T.ArrayType(T.DoubleType())
    block_schema = T.StructType([*keys, T.StructField(BLOCK, T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("states", doubles), T.StructField("form", doubles)])
    numbers = ("alpha", "beta", "gamma", "phi", "level", "slope")
    fit_schema = T.StructType([*keys, T.StructField("n", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in numbers], T.StructField("season", doubles), T.StructField("sse", T.DoubleType())])

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        states, form = run_block(pdf["_pos"].to_numpy(), pdf["_y"].to_numpy(float), spec, grid)
        return pdf.iloc[[0]][[*series, BLOCK]].assign(n=len(pdf), states=[states.ravel()], form=[form.ravel()])

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for states, form in zip(*(pdf.sort_values(BLOCK)[c] for c in ("states", "form")), strict=True):
            width = round((len(form) / len(grid)) ** 0.5)
            parts.append((np.asarray(states, float).reshape(len(grid), width, -1), np.asarray(form, float).reshape(len(grid), width, width)))
        x, sse = chain(parts)
        best = int(np.argmin(sse))
        values = dict(zip(numbers, [*grid[best], x[best, 0], x[best, 1]], strict=True))
        return pdf.iloc[[0]][list(series)].assign(n=int(pdf["n"].sum()), **values, season=[x[best, 2:]], sse=sse[best])

    blocks = placed.groupBy(*series, BLOCK).applyInPandas(block, block_schema)
    return EtsFit(series, spec, settled(blocks.groupBy(*series).applyInPandas(choose, fit_schema), "ets"))
