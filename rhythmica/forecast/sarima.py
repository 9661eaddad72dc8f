"""Multiplicative seasonal ARIMA by conditional least squares, for many series at once.

With w the differenced series, a(B) = phi(B) Phi(B^s) and m(B) = theta(B) Theta(B^s), the one-step error is

    e[t] = a(B) w[t] - c - b t - (m(B) - 1) e[t],

errors before the first complete row being zero. For given parameters that is affine in the last errors
before a block, and so are the derivatives of e. A block therefore answers with a fixed number of columns: what its
own rows give, and one column per unit of the errors handed to it, each with its derivatives. The Gram
matrix of these columns and their last rows are all that leaves a block. Chaining the blocks of a series, one
small row each, gives the squared errors, the gradient and the Gauss-Newton matrix of the whole series, the same as
without cuts. One round of damped Gauss-Newton steps is one pass over the blocks of the series that have
not settled yet; derivatives are taken by complex steps, exact to rounding.

Rows without a target are left out. A series with no more errors than parameters has ``ok`` false, no parameters
and no forecasts. Nothing keeps the autoregression stationary; a step into non-invertible moving averages makes
the errors grow and is refused. Rows of a block are held as one array (``spark.rhythmica.rowsPerBlock`` numbers).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rhythmica.operators.layout import BEFORE, BLOCK, COPY, Layout, plan_layout
from rhythmica.session import settled

#: Errors gathered before they are added to the Gram matrix.
GATHER = 256
#: Length of a complex step.
STEP = 1e-30
#: Damping after a refused first step, and the damping at which a series is left where it is.
FIRST_DAMPING, LAST_DAMPING = 1e-3, 1e9


@dataclass(frozen=True)
class SarimaSpec:
    """Orders (p, d, q)(P, D, Q) with ``season`` rows; ``trend`` is n, c (level), t (slope) or ct."""

    p: int = 1
    d: int = 0
    q: int = 0
    seasonal_p: int = 0
    seasonal_d: int = 0
    seasonal_q: int = 0
    season: int = 0
    trend: str = "n"

    def __post_init__(self):
        if self.trend not in ("n", "c", "t", "ct"):
            raise ValueError(f"unknown trend {self.trend!r}")
        if min(self.p, self.d, self.q, self.seasonal_p, self.seasonal_d, self.seasonal_q) < 0:
            raise ValueError("orders are not negative")
        if self.seasonal_p + self.seasonal_d + self.seasonal_q and self.season < 2:
            raise ValueError("seasonal orders need a season of two rows at least")
        if not self.names:
            raise ValueError("there is nothing to estimate")

    @property
    def names(self) -> list[str]:
        level, slope = ["level"] * ("c" in self.trend), ["slope"] * ("t" in self.trend)
        parts = [("ar", self.p), ("seasonal_ar", self.seasonal_p), ("ma", self.q), ("seasonal_ma", self.seasonal_q)]
        return [*level, *slope, *[f"{n}_{i + 1}" for n, k in parts for i in range(k)]]

    @property
    def differences(self) -> np.ndarray:
        out = np.ones(1)
        for lag, times in ((1, self.d), (self.season, self.seasonal_d)):
            for _ in range(times):
                out = np.convolve(out, np.r_[1.0, np.zeros(lag - 1), -1.0])
        return out

    @property
    def memory(self) -> int:
        """Earlier errors a row looks at."""
        return self.q + self.season * self.seasonal_q

    @property
    def lead(self) -> int:
        """Rows before the first that has an error."""
        return len(self.differences) - 1 + self.p + self.season * self.seasonal_p

    def start(self) -> np.ndarray:
        return np.array([0.1 if "ar" in n else 0.0 for n in self.names])

    def polynomials(self, params: np.ndarray) -> tuple:
        """Level, slope, a and m of a parameter vector, real or complex."""
        params, at = list(params), 0
        level = params.pop(0) if "c" in self.trend else 0.0
        slope = params.pop(0) if "t" in self.trend else 0.0
        out = []
        for sign, short, long in ((-1, self.p, self.seasonal_p), (1, self.q, self.seasonal_q)):
            near = np.r_[1.0, sign * np.array(params[at : at + short])] if short else np.ones(1)
            at += short
            far = np.zeros(1 + long * self.season, dtype=complex)
            far[0] = 1.0
            for i in range(long):
                far[(i + 1) * self.season] = sign * params[at + i]
            at += long
            out.append(np.convolve(near, far))
        return level, slope, *out


def run_block(y: np.ndarray, first: int, spec: SarimaSpec, params: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Errors of a block: their number, last rows of the columns (column, memory), Gram matrix of the columns.

    ``y`` begins with the ``lead`` rows before the block, or with the series, whose row ``first`` it then holds. Columns: for the
    errors and for each derivative, what the rows give and, unless the series begins here, one per unit of earlier errors.
    """
    k, memory, diff = len(params), spec.memory, spec.differences
    w = np.convolve(y, diff)[len(diff) - 1 : len(y)] if len(y) >= len(diff) else np.empty(0)
    moved = [spec.polynomials(params + 1j * STEP * np.eye(k)[j]) for j in range(k)]
    lags = len(moved[0][2]) - 1
    n = max(len(w) - lags, 0)
    width = 1 if first == 0 else 1 + memory
    held = np.zeros((memory + GATHER, k, width), dtype=complex)
    if first:
        held[:memory, :, 1:] = np.eye(memory)[:, None, :]
    rows = first + spec.lead + 1.0 + np.arange(n) if n else np.empty(0)
    given = np.empty((n, k), dtype=complex)
    for j, (level, slope, a, _) in enumerate(moved):
        total = -level - slope * rows
        for lag in np.flatnonzero(a):
            total = total + a[lag] * w[lags - lag : lags - lag + n]
        given[:, j] = total
    back = sorted({int(i) for m in moved for i in np.flatnonzero(m[3])} - {0})
    weights = {i: np.array([m[3][i] for m in moved])[:, None] for i in back}
    size = (1 + k) * width
    gram = np.zeros((size, size))

    def columns(block: np.ndarray) -> np.ndarray:
        return np.concatenate([block[:, :1].real, block.imag / STEP], axis=1).reshape(len(block), size)

    with np.errstate(all="ignore"):
        for begin in range(0, n, GATHER):
            count = min(GATHER, n - begin)
            for t in range(count):
                row, at = held[memory + t], memory + t
                row[:] = 0
                row[:, 0] = given[begin + t]
                for i, weight in weights.items():
                    row -= weight * held[at - i]
            found = columns(held[memory : memory + count])
            gram += found.T @ found
            held[:memory] = held[count : count + memory].copy()
    return n, columns(held[:memory]).T, gram


def chain(blocks: list[tuple[np.ndarray, np.ndarray]], k: int, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """Last errors (memory) and the Gram matrix of errors and derivatives over blocks in order."""
    past, whole = np.zeros((1 + k, memory)), np.zeros((1 + k, 1 + k))
    with np.errstate(all="ignore"):
        for last, gram in blocks:
            width = len(gram) // (1 + k)
            own = np.concatenate([np.ones(1), past[0]])[:width]
            mix = np.zeros((1 + k, 1 + k, width))
            mix[0, 0] = own
            for j in range(1, 1 + k):
                mix[j, j] = own
                mix[j, 0, 1:] = past[j][: width - 1]
            mix = mix.reshape(1 + k, -1)
            whole += mix @ gram @ mix.T
            past = mix @ last
    return past[0], whole


def propose(best: np.ndarray, whole: np.ndarray, damping: float) -> np.ndarray:
    """A damped Gauss-Newton step from the Gram matrix at ``best``."""
    matrix, slope = whole[1:, 1:], whole[1:, 0]
    scale = np.sqrt(np.maximum(np.diag(matrix), 1e-300))
    scaled = matrix / np.outer(scale, scale) + damping * np.eye(len(best))
    return best - np.linalg.lstsq(scaled, slope / scale, rcond=1e-13)[0] / scale


_DOUBLES = T.ArrayType(T.DoubleType())
_STATE = [
    T.StructField("params", _DOUBLES), T.StructField("best", _DOUBLES), T.StructField("whole", _DOUBLES), T.StructField("errors", _DOUBLES),
    T.StructField("tail", _DOUBLES), T.StructField("n", T.LongType()), T.StructField("n_errors", T.LongType()), T.StructField("damping", T.DoubleType()),
    T.StructField("settled", T.BooleanType()),
]
_STATE_NAMES = [f.name for f in _STATE]


def advance(state: dict, n_errors: int, errors: np.ndarray, whole: np.ndarray, tolerance: float) -> dict:
    """The state of a series after its candidate was measured: keep or refuse it, propose the next."""
    params, damping, done = np.asarray(state["params"], float), state["damping"], False
    sound = bool(np.isfinite(whole).all() and np.isfinite(errors).all())
    if state["best"] is None:
        if n_errors <= len(params) or not sound:
            return state | {"n_errors": n_errors, "settled": True}
        better = True
    else:
        before = state["whole"][0]
        better = sound and whole[0, 0] <= before
        done = better and before - whole[0, 0] <= tolerance * before
    if better:
        state = state | {"best": params, "whole": whole.ravel(), "errors": errors}
        damping = damping / 10
    else:
        damping = max(damping * 10, FIRST_DAMPING)
    best, kept = np.asarray(state["best"], float), np.asarray(state["whole"], float).reshape(1 + len(params), -1)
    done = done or damping > LAST_DAMPING or kept[0, 0] == 0
    return state | {"params": propose(best, kept, damping), "n_errors": n_errors, "damping": damping, "settled": bool(done)}


@dataclass(frozen=True)
class SarimaFit:
    series: tuple[str, ...]
    spec: SarimaSpec
    models: DataFrame  # series, n, n_errors, ok, settled, params, sse, errors, tail

    def parameters(self) -> DataFrame:
        """One column per parameter, the error deviation, Akaike's and the Bayesian criterion."""
        k = len(self.spec.names) + 1
        n, sigma2 = F.col("n_errors"), F.try_divide(F.col("sse"), F.col("n_errors"))
        likelihood = -n / 2 * (F.log(2 * F.pi() * sigma2) + 1)
        named = [F.col("params")[i].alias(name) for i, name in enumerate(self.spec.names)]
        return self.models.select(
            *self.series, "n", "n_errors", "ok", "settled", *named, F.sqrt(sigma2).alias("sigma"), (2 * k - 2 * likelihood).alias("aic"), (k * F.log(n) - 2 * likelihood).alias("bic")
        )

    def forecast(self, horizon: int, z: float = 1.959963984540054) -> DataFrame:
        """(series, step, yhat, std, lower, upper) for the series that have a model."""
        spec, series = self.spec, list(self.series)
        numbers = [T.StructField(c, T.DoubleType()) for c in ("yhat", "std", "lower", "upper")]
        schema = T.StructType([*[self.models.schema[c] for c in series], T.StructField("step", T.IntegerType()), *numbers])

        def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in parts:
                for _, row in pdf.iterrows():
                    yhat, std = ahead(np.asarray(row["tail"], float), np.asarray(row["errors"], float), int(row["n"]), spec, np.asarray(row["params"], float), horizon)
                    std = std * (row["sse"] / row["n_errors"]) ** 0.5
                    out = pd.DataFrame({"step": np.arange(1, horizon + 1, dtype="int32"), "yhat": yhat, "std": std, "lower": yhat - z * std, "upper": yhat + z * std})
                    for i, c in enumerate(series):
                        out.insert(i, c, pd.Series([row[c]] * horizon, dtype=pdf[c].dtype))
                    yield out

        return self.models.where("ok").mapInPandas(batches, schema)


def ahead(tail: np.ndarray, errors: np.ndarray, n: int, spec: SarimaSpec, params: np.ndarray, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """Forecasts from the last ``lead`` values and ``memory`` errors, and their deviations for errors of deviation one."""
    level, slope, a, m = spec.polynomials(params)
    a, m = np.convolve(a.real, spec.differences), m.real
    y, e, psi = list(tail), list(errors), []
    for h in range(1, horizon + 1):
        value = level + slope * (n + h)
        value -= sum(a[i] * y[-i] for i in range(1, len(a)))
        value += sum(m[i] * e[-i] for i in range(1, len(m)))
        psi.append((m[h - 1] if h - 1 < len(m) else 0.0) - sum(a[i] * psi[h - 1 - i] for i in range(1, min(len(a), h))))
        y.append(value)
        e.append(0.0)
    return np.array(y[len(tail) :]), np.sqrt(np.cumsum(np.square(psi)))


def fit_sarima(
    df: DataFrame, series: Sequence[str], order_by: Sequence[str], y: str, spec: SarimaSpec, rounds: int = 30, tolerance: float = 1e-12,
    damping: float = FIRST_DAMPING, layout: Layout | None = None,
) -> SarimaFit:
    """One model per series. ``settled`` tells whether it stopped gaining before ``rounds`` were over; ``damping`` is that of
    the first step, 0 for plain Gauss-Newton steps until one is refused."""
    series, k, memory, lead = tuple(series), len(spec.names), spec.memory, spec.lead
    rows = df.select(*dict.fromkeys([*series, *order_by]), F.col(y).cast("double").alias("_y")).filter(F.col("_y").isNotNull() & ~F.isnan("_y"))
    layout = layout or plan_layout(rows, series, order_by, reach=max(lead, memory, 1))
    numbered = layout.spread(rows, copies=True).withColumn("_i", F.row_number().over(layout.window()))
    keys = [rows.schema[c] for c in series]
    block_schema = T.StructType([*keys, T.StructField(BLOCK, T.IntegerType()), T.StructField("first", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("ys", _DOUBLES)])

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        copied = int(pdf[COPY].sum())
        skipped = max(copied - lead, 0)  # more rows than needed may have been copied
        first = int(pdf[BEFORE].iloc[0]) - copied + skipped
        return pdf.iloc[[0]][[*series, BLOCK]].assign(first=first, rows=len(pdf) - copied, ys=[pdf["_y"].to_numpy(float)[skipped:]])

    packed = numbered.select(*series, BLOCK, BEFORE, COPY, "_i", "_y").groupBy(*series, BLOCK).applyInPandas(gather, block_schema)
    blocks = settled(packed, "sarima-blocks")
    measured_schema = T.StructType([*keys, T.StructField(BLOCK, T.IntegerType()), *_STATE, *[T.StructField(c, _DOUBLES) for c in ("last", "gram", "end")], *[T.StructField(c, T.LongType()) for c in ("found", "rows")]])
    state_schema = T.StructType([*keys, *_STATE])

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            results = [run_block(np.asarray(r.ys, float), int(r.first), spec, np.asarray(r.params, float)) for r in pdf.itertuples(index=False)]
            pdf = pdf.assign(found=[r[0] for r in results], last=[r[1].ravel() for r in results], gram=[r[2].ravel() for r in results], end=[np.asarray(v, float)[len(v) - min(lead, len(v)) :] for v in pdf["ys"]])
            yield pdf[[f.name for f in measured_schema]]

    def step(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(BLOCK)
        parts = []
        for last, gram in zip(pdf["last"], pdf["gram"], strict=True):
            gram = np.asarray(gram, float)
            size = round(len(gram) ** 0.5)
            parts.append((np.asarray(last, float).reshape(size, memory), gram.reshape(size, size)))
        errors, whole = chain(parts, k, memory)
        state = {c: pdf[c].iloc[0] for c in _STATE_NAMES}
        state |= {"n": int(pdf["rows"].sum()), "tail": pdf["end"].iloc[-1]}
        state = advance(state, int(pdf["found"].sum()), errors, whole, tolerance)
        head = pdf.iloc[[0]][list(series)].reset_index(drop=True)
        return pd.concat([head, pd.DataFrame({c: [state[c]] for c in _STATE_NAMES})], axis=1)

    none = F.lit(None)
    first_state = {"params": F.array(*[F.lit(float(v)) for v in spec.start()]), "best": none, "whole": none, "errors": none, "tail": none, "n": none, "n_errors": none, "damping": F.lit(float(damping)), "settled": F.lit(False)}
    pending = blocks.select(*series).distinct().select(*series, *[first_state[f.name].cast(f.dataType).alias(f.name) for f in _STATE])
    finished = []
    for _ in range(rounds + 1):  # the first round measures the start
        measured = layout.attach(blocks, pending).mapInPandas(measure, measured_schema)
        state = settled(measured.groupBy(*series).applyInPandas(step, state_schema), "sarima-round")
        finished.append(state.where("settled"))
        pending = state.where("not settled")
        if pending.isEmpty():
            break
    else:
        finished.append(pending)
    states = reduce(DataFrame.unionByName, finished)
    models = states.select(
        *series, "n", "n_errors", F.col("best").isNotNull().alias("ok"), (F.col("settled") & F.col("best").isNotNull()).alias("settled"), F.col("best").alias("params"), F.col("whole")[0].alias("sse"), "errors", "tail"
    )
    return SarimaFit(series, spec, settled(models, "sarima"))
