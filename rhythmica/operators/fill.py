"""Forward fill, then backward fill, then a constant - per series, split-safe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rhythmica.operators.layout import BEFORE, BLOCK, TOTAL, Layout, plan_layout


def fill_gaps(
    df: DataFrame,
    columns: Sequence[str],
    series: Sequence[str],
    order_by: Sequence[str],
    constant: float | None = 0.0,
    layout: Layout | None = None,
) -> DataFrame:
    """Each null takes the last value before it, else the first value after it, else ``constant``.

    Inside a block this is a window. For a cut series each block also contributes its first and last
    value; those per-block values (one row per block) are carried across blocks and joined back.
    """
    layout = layout or plan_layout(df, series, order_by)
    spread = layout.spread(df)
    past = layout.window().rowsBetween(Window.unboundedPreceding, 0)
    # a frame that reaches to the end is recomputed for every row; the same frame in reverse order is not
    coming = Window.partitionBy(*series, BLOCK).orderBy(*[F.col(c).desc() for c in order_by]).rowsBetween(Window.unboundedPreceding, 0)

    carried = {c: ([], []) for c in columns}
    if layout.cuts is not None:
        ends = []
        for c in columns:
            kept = F.when(F.col(c).isNotNull(), F.struct(*order_by, F.col(c).alias("_v")))
            ends += [F.max(kept)["_v"].alias(f"_last_{c}"), F.min(kept)["_v"].alias(f"_first_{c}")]
        per_block = spread.filter(F.col(TOTAL).isNotNull()).groupBy(*series, BLOCK).agg(*ends)
        earlier = Window.partitionBy(*series).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        later = Window.partitionBy(*series).orderBy(F.col(BLOCK).desc()).rowsBetween(Window.unboundedPreceding, -1)
        carry = per_block.select(
            *[F.col(s).alias(f"_s_{s}") for s in series],
            F.col(BLOCK).alias("_b"),
            *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_prev_{c}") for c in columns],
            *[F.last(f"_first_{c}", ignorenulls=True).over(later).alias(f"_next_{c}") for c in columns],
        )
        match = spread[BLOCK] == carry["_b"]
        for s in series:
            match = match & spread[s].eqNullSafe(carry[f"_s_{s}"])
        # one row per block of a cut series: at most MAX_BLOCKS rows
        spread = spread.join(F.broadcast(carry), match, "left").drop("_b", *[f"_s_{s}" for s in series])
        carried = {c: ([F.col(f"_prev_{c}")], [F.col(f"_next_{c}")]) for c in columns}

    filled = {}
    for c in columns:
        before, after = carried[c]
        options = [F.last(c, ignorenulls=True).over(past), *before, F.last(c, ignorenulls=True).over(coming), *after]
        filled[c] = F.coalesce(*options, *([F.lit(constant)] if constant is not None else []))
    out = spread.withColumns(filled)
    return out.drop(BLOCK, BEFORE, TOTAL, *[f"_prev_{c}" for c in columns], *[f"_next_{c}" for c in columns])
