"""Categories as numbers: the mean target of a category, learnt only from rows that come earlier.

    (sum of the earlier targets + weight * prior) / (number of earlier targets + weight)

The sums are prefix sums inside blocks of a category plus one carried row per block of a long one, so a
category that holds a third of all rows stays spread over tasks. Blocks are short and the number of tasks grows with
the rows, because what is learnt from the statistic keeps a task's rows together. New rows, later than all of
training, take the sums of the whole training part.

Several columns of a large table are encoded together: its rows are put in order once, over tasks, and each task runs
through them with the sums of the long categories of all columns, to which those of earlier tasks are added. Only the
short categories of a column still need its rows side by side.

A null category is one of its own. Rows without a target (null or NaN) add nothing and still get their statistic; an
unknown category gets the prior. Rows of equal order keys would see each other in any order: let ``order_by`` end in a unique tiebreak.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rhythmica.operators.joins import join_per_group, join_same
from rhythmica.operators.layout import BEFORE, BLOCK, TOTAL, Layout, plan_layout
from rhythmica.session import settled

#: Rows of a block. There are two tasks for as many rows, so that few blocks meet in one.
ROWS = 250_000
#: Most tasks, and most long categories of a column, that carry sums to each other; a task's length is not bounded.
CARRIES = 1000
#: Rows that a task of ordered rows sums at a time.
CHUNK = 65_536
#: A place in the order is the number of a task and, in as many low bits, the row in it.
PLACE_BITS = 40


def _target(y: str) -> Column:
    value = F.col(y).cast("double")
    return F.when(~F.isnan(value), value)


def _smoothed(total: Column, n: Column, prior: float, weight: float) -> Column:
    """Null where there is neither a row nor a weight."""
    return F.try_divide(total + F.lit(weight * prior), n + F.lit(float(weight)))


def dealt(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """Rows over tasks that grow in number with them. Tables with less than a block for each core are left to adaptive execution."""
    return df.repartition(2 * math.ceil(rows / ROWS), *by) if is_large(df, rows) else df


def is_large(df: DataFrame, rows: int) -> bool:
    """Whether there is more than a block for each core."""
    return math.ceil(rows / ROWS) > df.sparkSession.sparkContext.defaultParallelism


def mean_target(df: DataFrame, y: str) -> float:
    """The prior: the mean target of a table, 0 without any."""
    return df.agg(F.avg(_target(y)).alias("m")).first()["m"] or 0.0


def ordered_target_statistic(
    df: DataFrame, category: str, y: str, order_by: Sequence[str], prior: float, weight: float = 1.0, name: str | None = None, layout: Layout | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add the statistic of ``category`` over the rows before each row. ``source``: the same rows before columns
    were added to them, where that is cheaper to count."""
    name = name or f"{category}_target"
    source = df if source is None else source
    layout = layout or plan_layout(source, [category], order_by, most=ROWS)
    spread = dealt(layout.spread(df), layout.rows or 0, category, *([BLOCK] if layout.cuts is not None else [])).withColumn("_t", _target(y))
    past = layout.window().rowsBetween(Window.unboundedPreceding, -1)
    total, n = F.coalesce(F.sum("_t").over(past), F.lit(0.0)), F.count("_t").over(past)
    gone = [BLOCK, BEFORE, TOTAL, "_t"]
    if layout.cuts is not None:
        per_block = layout.spread(source).withColumn("_t", _target(y)).filter(F.col(TOTAL).isNotNull()).groupBy(category, BLOCK).agg(F.coalesce(F.sum("_t"), F.lit(0.0)).alias("_s"), F.count("_t").alias("_n"))
        earlier = Window.partitionBy(category).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        carry = per_block.select(category, BLOCK, F.sum("_s").over(earlier).alias("_s"), F.sum("_n").over(earlier).alias("_n"))
        spread = join_same(spread, F.broadcast(carry), [category, BLOCK], "left")  # one row per block of a cut category
        total, n = total + F.coalesce("_s", F.lit(0.0)), n + F.coalesce("_n", F.lit(0))
        gone += ["_s", "_n"]
    return spread.withColumn(name, _smoothed(total, n, prior, weight)).drop(*gone)


def _chunks(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= size:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _earlier(codes: np.ndarray, values: np.ndarray, known: np.ndarray, total: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the known values of the same code before each row, one after the other; ``total`` and ``count``
    start them and are moved on. Codes beyond them are left out."""
    s, n = np.zeros(len(codes)), np.zeros(len(codes), np.int64)
    order = np.argsort(codes, kind="stable")
    ends = np.searchsorted(codes[order], np.arange(len(total) + 1))
    for c in np.flatnonzero(np.diff(ends)):
        rows = order[ends[c] : ends[c + 1]]
        run, seen = np.cumsum(np.concatenate((total[c : c + 1], values[rows]))), np.cumsum(np.concatenate((count[c : c + 1], known[rows])))
        s[rows], total[c], n[rows], count[c] = run[:-1], run[-1], seen[:-1], seen[-1]
    return s, n


def _summed_in_order(df: DataFrame, columns: Sequence[str], y: str, codes: dict[str, int], order_by: Sequence[str], parts: int) -> DataFrame:
    """``columns`` with the place ``_at`` in the order, of which the high bits are a stretch of rows, and for each column
    of codes (below the number given) the sum ``_s`` and the number ``_n`` of the known targets of the same code that are
    earlier in the stretch."""
    added = [T.StructField("_at", T.LongType())]
    for c in codes:
        added += [T.StructField(f"_s{c}", T.DoubleType()), T.StructField(f"_n{c}", T.LongType())]
    ordered = df.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by).select(*columns)
    schema, size = T.StructType([*ordered.schema.fields, *added]), CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << PLACE_BITS
        totals = {c: (np.zeros(k), np.zeros(k, np.int64)) for c, k in codes.items()}
        for table in _chunks(batches, size):
            known = table[y].is_valid().to_numpy().astype(np.int64)
            values = table[y].fill_null(0.0).to_numpy()
            out = table.append_column("_at", pa.array(np.arange(at, at + len(known))))
            at += len(known)
            for c, k in codes.items():
                code = table[c].fill_null(k).to_numpy().astype(np.int16)
                s, n = _earlier(code, values, known, *totals[c])
                out = out.append_column(f"_s{c}", pa.array(s)).append_column(f"_n{c}", pa.array(n))
            yield from out.to_batches()

    return settled(ordered.mapInArrow(run, schema), "ordered")


def _encoded_together(df: DataFrame, categories: Sequence[str], y: str, order_by: Sequence[str], prior: float, weight: float, rows: int, keep: Sequence[str]) -> DataFrame:
    """The statistics of several columns of a large table beside the columns in ``keep``. Long categories are summed in
    order, the others are brought together by category."""
    most, codes, short, order = math.ceil(rows / CARRIES), {}, [], list(order_by)
    out = df.withColumn("_t", _target(y))
    for i, c in enumerate(categories):
        long = df.groupBy(c).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).collect()  # fewer than CARRIES
        if sum(r["_n"] for r in long) < rows:
            short.append(c)
        if long:
            codes[f"_h{i}"] = len(long)
            table = df.sparkSession.createDataFrame([(r[0], k) for k, r in enumerate(long)], T.StructType([df.schema[c], T.StructField(f"_h{i}", T.IntegerType())]))
            out = join_same(out, F.broadcast(table), [c], "left")
    if codes:
        out = _summed_in_order(out, [*dict.fromkeys([*keep, *short]), "_t", *codes], "_t", codes, order_by, min(math.ceil(rows / ROWS), CARRIES))
        out = out.withColumn("_part", F.shiftright("_at", PLACE_BITS))
        order = ["_at"]
    stored, names = out, {c: f"{c}_target" for c in categories}
    for i, c in enumerate(categories):
        h = f"_h{i}"
        if h in codes:
            sums = stored.where(F.col(h).isNotNull()).groupBy(h, "_part").agg(F.coalesce(F.sum("_t"), F.lit(0.0)).alias("_s"), F.count("_t").alias("_n"))
            before = Window.partitionBy(h).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
            carry = sums.select(h, "_part", F.sum("_s").over(before).alias("_s"), F.sum("_n").over(before).alias("_n"))
            out = join_same(out, F.broadcast(carry), [h, "_part"], "left")  # at most one row per stretch and long category
            total, count = F.col(f"_s{h}") + F.coalesce("_s", F.lit(0.0)), F.col(f"_n{h}") + F.coalesce("_n", F.lit(0))
            out = out.withColumn(names[c], _smoothed(total, count, prior, weight)).drop("_s", "_n")
    if not short:  # as many tasks as otherwise
        out = dealt(out, rows, *order)
    for i, c in enumerate(categories):
        h, side = f"_h{i}", [c]
        if c in short:
            if h in codes:  # rows that have their statistic stay spread
                out = out.withColumn("_side", F.when(F.col(h).isNotNull(), F.col("_part") + 1).otherwise(0))
                side.append("_side")
            past = Window.partitionBy(*side).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
            found = _smoothed(F.coalesce(F.sum("_t").over(past), F.lit(0.0)), F.count("_t").over(past), prior, weight)
            out = dealt(out, rows, *side).withColumn("_found", found)
            out = out.withColumn(names[c], F.when(F.col(h).isNull(), F.col("_found")).otherwise(F.col(names[c])) if h in codes else F.col("_found")).drop("_side", "_found")
    return out.select(*keep, *names.values())


@dataclass
class OrderedTargetEncoder:
    """Statistics for several category columns; ``fit`` on the training part, which ``encode_training`` encodes row by row
    from its past, ``encode`` gives later rows the whole of it. Names of the new columns end in ``_target``."""

    categories: Sequence[str]
    target: str
    order_by: Sequence[str]
    weight: float = 1.0
    prior: float = 0.0
    tables: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [f"{c}_target" for c in self.categories]

    def fit(self, df: DataFrame) -> OrderedTargetEncoder:
        prior, tables = mean_target(df, self.target), {}
        for c in self.categories:
            sums = df.groupBy(c).agg(F.sum(_target(self.target)).alias("_s"), F.count(_target(self.target)).alias("_n"))
            value = _smoothed(F.coalesce("_s", F.lit(0.0)), F.col("_n"), prior, self.weight)
            tables[c] = settled(sums.select(c, value.alias(f"{c}_target")), "categories")
        return OrderedTargetEncoder(self.categories, self.target, self.order_by, self.weight, prior, tables)

    def encode_training(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """``keep``: the columns of ``df`` that are wanted beside the statistics, all by default."""
        keep, rows = df.columns if keep is None else list(keep), df.count()
        if is_large(df, rows):
            return _encoded_together(df, self.categories, self.target, self.order_by, self.prior, self.weight, rows, keep)
        out = df
        for c in self.categories:
            out = ordered_target_statistic(out, c, self.target, self.order_by, self.prior, self.weight, source=df)
        return out.select(*keep, *self.names)

    def encode(self, df: DataFrame) -> DataFrame:
        if not self.tables and self.categories:
            raise ValueError("fit the encoder first")
        out = df
        for c, table in self.tables.items():
            out = join_per_group(out, table, [c], "left", counted=df).fillna(self.prior, [f"{c}_target"])
        return out
