"""Row order inside series, laid out so that no task ever holds an unbounded series.

Spark has no row order, so every ordered operator names a series key and an order key (time, then a
unique tiebreak). A window over the series key alone would put a series with a third of all rows
into one task. ``plan_layout`` counts the series first; the long ones are cut into blocks of bounded
size at order keys taken from a sample of the key columns. The cut points are read back as plain
values, so every later use of a layout - also after a lost executor - sees the same blocks. Short
series keep the ordinary one-shuffle window plan.

``Layout.spread`` tags rows with their block. With a *reach* of w rows, at least the last w rows
before a block are copied into it, which makes lags and trailing frames up to w rows exact across
the cut. The number of copied rows is counted, not estimated.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BLOCK_KEY = "spark.rhythmica.rowsPerBlock"
ROWS_PER_BLOCK = 2_000_000
MAX_BLOCKS = 50_000
SAMPLES_PER_BLOCK = 32
FEW_BLOCKS = 8  # rows of up to so many wanted blocks are told by comparing with the ends of the blocks

BLOCK, COPY, BEFORE, TOTAL, TAIL = "_blk", "_copy", "_before", "_total", "_tail"


def _order_key(df: DataFrame, order_by: Sequence[str]) -> Column:
    """The order columns as one comparable struct of values that survive a trip to the driver."""
    parts = []
    for i, c in enumerate(order_by):
        zoned = isinstance(df.schema[c].dataType, T.TimestampType)
        parts.append((F.unix_micros(c) if zoned else F.col(c)).alias(f"k{i}"))
    return F.struct(*parts)


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of column pairs."""
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


@dataclass(frozen=True)
class Layout:
    """Where each series is cut. ``cuts`` is None when every series fits into one block."""

    series: tuple[str, ...]
    order_by: tuple[str, ...]
    cuts: DataFrame | None = None  # series columns + _b: array<struct<start, tail, before>>, _hot_total
    n_cuts: int = 0
    reach: int = 0
    rows: int | None = None  # rows of the table it was planned for, where counted

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.series, BLOCK).orderBy(*self.order_by)

    def spread(self, df: DataFrame, copies: bool = False, tails: bool = False) -> DataFrame:
        """Add ``_blk``, ``_before`` (rows or weight in earlier blocks), ``_total`` (null for short
        series) and, with ``copies``, the repeated rows marked by ``_copy``."""
        if self.cuts is None:
            out = df.withColumns({BLOCK: F.lit(0), BEFORE: F.lit(0).cast("bigint"), TOTAL: F.lit(None).cast("bigint")})
            return out.withColumn(COPY, F.lit(False)) if copies else out

        if self.series:
            cuts = F.broadcast(self.cuts.select(*[F.col(c).alias(f"_c_{c}") for c in self.series], "_b", "_hot_total"))
            joined = df.join(cuts, _same(df, cuts, [(c, f"_c_{c}") for c in self.series]), "left").drop(*[f"_c_{c}" for c in self.series])
        else:
            one = self.cuts.select(F.struct("_b", "_hot_total").alias("s")).scalar()
            joined = df.withColumn("_s", one).withColumns({"_b": F.col("_s._b"), "_hot_total": F.col("_s._hot_total")}).drop("_s")

        key = _order_key(df, self.order_by)
        # last block whose start is not after the key: binary search, one power of two at a time
        found = F.aggregate(
            F.array(*[F.lit(1 << k) for k in reversed(range(max(1, self.n_cuts.bit_length())))]),
            F.lit(0),
            lambda at, step: F.when(
                (at + step < F.size("_b")) & (F.try_element_at("_b", at + step + 1)["start"] <= key), at + step
            ).otherwise(at),
        )
        out = joined.withColumn(BLOCK, F.when(F.col("_b").isNull(), F.lit(0)).otherwise(found))
        if copies:
            here = F.element_at("_b", F.col(BLOCK) + 1)
            # a block without a tail key is copied whole
            repeated = (F.col(BLOCK) + 1 < F.size("_b")) & (here["tail"].isNull() | (key >= here["tail"]))
            places = F.when(
                F.col("_b").isNotNull() & F.coalesce(repeated, F.lit(False)),
                F.array(F.struct(F.col(BLOCK).alias("b"), F.lit(False).alias("c")), F.struct((F.col(BLOCK) + 1).alias("b"), F.lit(True).alias("c"))),
            ).otherwise(F.array(F.struct(F.col(BLOCK).alias("b"), F.lit(False).alias("c"))))
            out = out.withColumn("_p", F.explode(places)).withColumns({BLOCK: F.col("_p.b"), COPY: F.col("_p.c")}).drop("_p")
        out = out.withColumns(
            {
                BEFORE: F.when(F.col("_b").isNull(), F.lit(0).cast("bigint")).otherwise(F.element_at("_b", F.col(BLOCK) + 1)["before"]),
                TOTAL: F.col("_hot_total"),
            }
        )
        if tails:
            out = out.withColumn(TAIL, F.element_at("_b", F.col(BLOCK) + 1)["tail"])
        return out.drop("_b", "_hot_total")

    def attach(self, spread: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
        """Join one row per series onto spread rows by (series, block).

        The small side is repeated once per block of a cut series, so a long series stays spread over
        its blocks and the rows keep the partitioning their windows already have.
        """
        names = {c: f"_t_{c}" for c in self.series}
        keyed = table.withColumnsRenamed(names)
        if self.cuts is None:
            per_block = keyed.withColumn("_t_blk", F.lit(0))
        elif self.series:
            cuts = self.cuts.select(*[F.col(c).alias(f"_c_{c}") for c in self.series], (F.size("_b") - 1).alias("_last"))
            matched = keyed.join(F.broadcast(cuts), _same(keyed, cuts, [(t, f"_c_{c}") for c, t in names.items()]), "left")
            per_block = matched.withColumn("_t_blk", F.explode(F.sequence(F.lit(0), F.coalesce("_last", F.lit(0))))).drop(
                "_last", *[f"_c_{c}" for c in self.series]
            )
        else:
            last = self.cuts.select((F.size("_b") - 1).alias("_last")).scalar()
            per_block = keyed.withColumn("_t_blk", F.explode(F.sequence(F.lit(0), last)))
        on = _same(spread, per_block, [*names.items(), (BLOCK, "_t_blk")])
        return spread.join(per_block, on, how).drop("_t_blk", *names.values())


def short_series(series: Sequence[str], order_by: Sequence[str]) -> Layout:
    """The layout for series whose length is bounded by construction (for example by a calendar)."""
    return Layout(tuple(series), tuple(order_by))


def rows_per_block(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(ROWS_PER_BLOCK_KEY, str(ROWS_PER_BLOCK)))


def plan_layout(
    df: DataFrame,
    series: Sequence[str],
    order_by: Sequence[str],
    reach: int = 0,
    weight: str | None = None,
    most: int | None = None,
) -> Layout:
    """Count the series of ``df`` and cut the ones longer than a block.

    ``weight`` names a count column: positions then count weights instead of rows. ``most`` asks for blocks of
    fewer rows than the session's.
    """
    series, order_by = tuple(series), tuple(order_by)
    plain = Layout(series, order_by, reach=reach)
    size = min(rows_per_block(df), most or ROWS_PER_BLOCK * MAX_BLOCKS)

    counts = df.groupBy(*series).agg(F.count(F.lit(1)).alias("_n"))
    names = [F.col(c).alias(f"s{i}") for i, c in enumerate(series)]
    long_one = F.when(F.col("_n") > size, F.struct("_n", *names))
    top = counts.agg(F.sum("_n").alias("rows"), F.collect_list(long_one).alias("long")).first()  # at most rows / size entries
    plain = replace(plain, rows=top["rows"] or 0)
    size = max(size, math.ceil(plain.rows / MAX_BLOCKS), 2 * reach)
    long_series = [r for r in top["long"] if r["_n"] > size]
    if not long_series:
        return plain

    spark = df.sparkSession
    key = _order_key(df, order_by)
    keep = [F.col(weight).alias("_w")] if weight else [F.lit(1).cast("bigint").alias("_w")]
    rows = df.select(*dict.fromkeys([*series, *order_by]), *keep)
    fields = [df.schema[c] for c in series]
    if series:
        picked_type = T.StructType([T.StructField(f"_c_{f.name}", f.dataType) for f in fields])
        picked = spark.createDataFrame([tuple(r[f"s{i}"] for i in range(len(series))) for r in long_series], picked_type)
        rows = rows.join(F.broadcast(picked), _same(rows, picked, [(c, f"_c_{c}") for c in series]), "left_semi")

    # Every SAMPLES_PER_BLOCK-th sampled key starts a block, the sampled key before it starts the part
    # of the previous block that is copied forward. The sample is chosen by hash, so it is repeatable,
    # and has at most SAMPLES_PER_BLOCK * MAX_BLOCKS rows.
    scale = 1 << 40
    share = max(1, scale * SAMPLES_PER_BLOCK // size)
    sample = rows.filter(F.pmod(F.xxhash64(*series, *order_by), F.lit(scale)) < share)
    ranked = sample.withColumn("_rank", F.row_number().over(Window.partitionBy(*series).orderBy(*order_by)))
    place = F.col("_rank") % SAMPLES_PER_BLOCK
    marks = ranked.filter((place == 0) | (place == SAMPLES_PER_BLOCK - 1)).select(*series, "_rank", key.alias("k"))
    key_type = marks.schema["k"].dataType
    starts: dict[tuple, dict[int, tuple]] = {tuple(r[f"s{i}"] for i in range(len(series))): {0: None} for r in long_series}
    tails: dict[tuple, dict[int, tuple]] = {s: {} for s in starts}
    for r in marks.collect():
        block, rest = divmod(r["_rank"] + 1, SAMPLES_PER_BLOCK)
        if rest:  # a start; the sampled key before it is a tail
            starts[tuple(r[c] for c in series)][block] = tuple(r["k"])
        else:
            tails[tuple(r[c] for c in series)][block - 1] = tuple(r["k"])

    block_type = T.StructType(
        [T.StructField("start", key_type), T.StructField("tail", key_type), T.StructField("before", T.LongType())]
    )
    cut_type = T.StructType([*fields, T.StructField("_b", T.ArrayType(block_type)), T.StructField("_hot_total", T.LongType())])

    def layout_of(blocks: dict[tuple, list[dict]]) -> Layout:
        table = []
        for s, parts in blocks.items():
            before, entries = 0, []
            for b in parts:
                entries.append((b["start"], b["tail"], before))
                before += b["w"]
            table.append((*s, entries, before))
        return Layout(series, order_by, spark.createDataFrame(table, cut_type), max(len(p) for p in blocks.values()), reach, plain.rows)

    draft = {s: [{"start": k, "tail": tails[s].get(i), "w": 0} for i, k in sorted(at.items())] for s, at in starts.items()}
    tagged = layout_of(draft).spread(rows, tails=True)
    counted = tagged.groupBy(*series, BLOCK).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_w").alias("w"), F.count_if(F.coalesce(key >= F.col(TAIL), F.lit(False))).alias("m")
    ).collect()  # one row per block
    sizes = {(tuple(r[c] for c in series), r[BLOCK]): r for r in counted}

    final: dict[tuple, list[dict]] = {}
    for s, parts in draft.items():
        merged: list[dict] = []
        for i, part in enumerate(parts):
            r = sizes.get((s, i))
            n, w, m = (r["n"], r["w"], r["m"]) if r else (0, 0, 0)
            # a tail with too few rows is replaced by the whole block, a block with too few rows joins the one before
            block = {"start": part["start"], "tail": part["tail"] if m >= max(reach, 1) else part["start"], "n": n, "w": w}
            if merged and merged[-1]["n"] < max(reach, 1):
                last = merged[-1]
                last.update(n=last["n"] + n, w=last["w"] + w, tail=block["tail"] if m >= reach else last["start"])
            else:
                merged.append(block)
        final[s] = merged
    return layout_of(final)


def with_windows(
    df: DataFrame,
    series: Sequence[str],
    order_by: Sequence[str],
    columns: Callable[[WindowSpec], dict[str, Column]],
    reach: int,
    layout: Layout | None = None,
) -> DataFrame:
    """Add columns computed over a window that looks back at most ``reach`` rows.

    All columns share one partitioning and one sort.
    """
    if layout is None:
        layout = plan_layout(df, series, order_by, reach=reach)
    if layout.cuts is not None and layout.reach < reach:
        raise ValueError(f"the layout was planned for a reach of {layout.reach} rows, {reach} are needed")
    split = layout.cuts is not None
    spread = layout.spread(df, copies=split)
    out = spread.withColumns(columns(layout.window()))
    if split:
        out = out.filter(~F.col(COPY)).drop(COPY)
    return out.drop(BLOCK, BEFORE, TOTAL)


def with_position(
    df: DataFrame,
    series: Sequence[str],
    order_by: Sequence[str],
    position: str = "pos",
    total: str | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """Add the 0-based row position inside each series (``series=[]``: inside the whole table) and,
    if asked for, the number of rows of the series."""
    if layout is None:
        layout = plan_layout(df, series, order_by)
    spread = layout.spread(df)
    new = {position: F.col(BEFORE) + F.row_number().over(layout.window()) - 1}
    if total:
        # same partitioning and order as the position, so both come from one window operator
        whole = layout.window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        new[total] = F.coalesce(F.col(TOTAL), F.count(F.lit(1)).over(whole))
    return spread.withColumns(new).drop(BLOCK, BEFORE, TOTAL)


def _in_blocks(layout: Layout, key: Column, blocks: Sequence[int], n_blocks: int) -> Column:
    """Whether a key of the only series lies in one of these blocks, by comparison with their ends."""
    edges = sorted({e for i in blocks for e in (i, i + 1) if 0 < e < n_blocks})
    start = layout.cuts.select(F.struct(F.lit(0), *[F.element_at("_b", e + 1)["start"].alias(f"e{e}") for e in edges]).alias("s")).scalar()
    out = F.lit(False)
    for i in blocks:
        after = key >= start[f"e{i}"] if i else F.lit(True)
        out = out | (after & (key < start[f"e{i + 1}"]) if i + 1 < n_blocks else after)
    return out


def keys_at(df: DataFrame, order_by: Sequence[str], positions: Callable[[int], Sequence[int]]) -> list[dict | None]:
    """The order keys at 0-based positions of the whole table; ``positions`` gets the row count.

    Only key columns move, and only the blocks that hold a wanted position are numbered.
    """
    keys = df.select(*order_by)
    layout = plan_layout(keys, [], order_by)
    asked = positions(layout.rows)
    wanted = sorted(set(asked))
    spread = layout.spread(keys)
    if layout.cuts is not None:
        entries = layout.cuts.select("_b.before", "_hot_total").first()
        starts, end = list(entries["before"]), entries["_hot_total"]
        ends = starts[1:] + [end]
        blocks = [i for i, (a, b) in enumerate(zip(starts, ends, strict=True)) if any(a <= p < b for p in wanted)]
        if len(blocks) <= FEW_BLOCKS:
            spread = layout.spread(keys.filter(_in_blocks(layout, _order_key(keys, order_by), blocks, len(starts))))
        else:
            spread = spread.filter(F.col(BLOCK).isin(blocks))
    numbered = spread.withColumn("_pos", F.col(BEFORE) + F.row_number().over(layout.window()) - 1)
    rows = numbered.filter(F.col("_pos").isin(wanted)).select("_pos", *order_by).collect()  # one row per wanted position
    at = {r["_pos"]: {c: r[c] for c in order_by} for r in rows}
    return [at.get(p) for p in asked]
