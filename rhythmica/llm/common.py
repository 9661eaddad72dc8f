"""Helpers shared by the operators: text columns, bounded slices of Arrow batches, joins on hot keys."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most this many keys are treated as hot; any other key holds less than one part in HOT_KEYS of the rows.
HOT_KEYS = 1000
#: A hot key is dealt over this many salts.
SALTS = 64
#: Keys with fewer rows than this are never worth a salt.
HOT_ROWS = 1000


def text_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", others: Sequence[str] = ()) -> DataFrame:
    """Only the id and the text, under fixed names, so that further columns cannot clash; columns that are
    to come along are one struct, ``others``."""
    more = [F.struct(*others).alias("others")] if others else []
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)


def schema_of(rows: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)


def row_hash(*columns: str | Column) -> Column:
    return F.xxhash64(*columns)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches cut so that a slice has about ``most`` bytes of text at most (a longer text is a slice of its own).

    Yields the slice and its texts as UTF-8; a null text is empty.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)) if len(column) else np.zeros(0, np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(column):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            part = batch.slice(start, stop - start)
            yield part, [x or b"" for x in column.slice(start, stop - start).to_pylist()]
            start = stop


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Sorted batches as one stream per value of ``key``."""
    def pieces():
        for batch in batches:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1), len(values)] if len(values) else [0]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield int(values[a]), batch.slice(a, b - a)

    stream = pieces()
    held = next(stream, None)
    while held is not None:
        now = held[0]

        def own():
            nonlocal held
            while held is not None and held[0] == now:  # noqa: B023
                yield held[1]
                held = next(stream, None)

        yield now, own()
        while held is not None and held[0] == now:
            held = next(stream, None)


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step, on unsigned integers."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hot_keys(many: DataFrame, key: str, least: int = HOT_ROWS) -> DataFrame:
    """The keys with the most rows: at most HOT_KEYS, whatever the size of the table."""
    counts = many.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > least) & F.col(key).isNotNull())
    return counts.orderBy(F.desc("_n"), key).limit(HOT_KEYS).select(F.col(key).alias("_hot"))


def join_one(many: DataFrame, one: DataFrame, key: str, spread: Column, how: str = "inner", least: int = HOT_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Join each row of ``many`` with the one row of ``one`` that has its key, also where a key holds much of ``many``.

    The rows of hot keys are dealt over SALTS by ``spread`` (a column that differs among them), and the
    row they meet is repeated as often. The list of hot keys is broadcast: HOT_KEYS rows at most.
    ``many`` is read twice, so give a stored table, or give ``hot`` (_hot: the keys, HOT_KEYS at most) where
    they are known. ``how``: inner or left.
    """
    hot = F.broadcast(hot_keys(many, key, least) if hot is None else hot)
    salted = many.join(hot, F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull(), F.pmod(spread, F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    )
    repeated = one.join(hot, F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    )
    return salted.drop("_hot").join(repeated.drop("_hot"), [key, "_salt"], how).drop("_salt")
