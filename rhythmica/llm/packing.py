"""Best-fit packing of documents into sequences of several permitted lengths.

A document has its words and one end token. A document longer than the largest length is cut into pieces
of that length and a rest. Pieces are dealt by hash into groups of about GROUP; a group is packed on its
own, so the number of groups grows with the input and a group fits a task. Within a group, pieces go from
the longest to the shortest; a piece goes into the open bin, of whatever length, that it fills best; if
none has room, a bin of the length with the least cost per token it can still be filled with is opened,
among all lengths that hold the piece. At the end every bin shrinks to the smallest length that holds its
contents. The cost of a length is what attention and a fixed overhead per sequence make it:
``overhead + length + length ** 2 / square``.

Defined results: null and empty texts have one token; equal rows (same id and length) are numbered as
copies; ties in length go by id, copy and piece; an empty table gives an empty table; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rhythmica.session import settled

LENGTHS = (512, 1024, 2048, 4096)
GROUP = 2000
OVERHEAD, SQUARE = 16.0, 65536.0
OUT = "doc_id {kind}, copy bigint, piece bigint, start bigint, length bigint, bin_id bigint, capacity bigint, position bigint"


def cost(length: float) -> float:
    return OVERHEAD + length + length * length / SQUARE


def pack(pieces: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Pieces in falling order: the bin of each, its position there, and the capacity of each bin."""
    lengths = sorted(lengths)
    remaining, room = sum(pieces), 0  # room: bit r is set if an open bin has r tokens left
    open_: dict[int, list[int]] = {}
    fill: list[int] = []
    size: list[int] = []
    bins, positions = [], []
    for piece in pieces:
        remaining -= piece
        fitting = room >> piece
        if fitting:
            left = (fitting & -fitting).bit_length() - 1 + piece
            at = open_[left].pop()
            if not open_[left]:
                room &= ~(1 << left)
        else:
            at = len(fill)
            best = min((c for c in lengths if c >= piece), key=lambda c: (cost(c) / min(c, piece + remaining), -c))
            fill.append(0)
            size.append(best)
        bins.append(at)
        positions.append(fill[at])
        fill[at] += piece
        left = size[at] - fill[at]
        if left:
            open_.setdefault(left, []).append(at)
            room |= 1 << left
    return bins, positions, [next(c for c in lengths if c >= f) for f in fill]


def word_tokens(text: str | Column = "text") -> Column:
    """Words parted by white space, and one end token."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint") + 1


def pack_documents(docs: DataFrame, tokens: Column | None = None, lengths: Sequence[int] = LENGTHS, group: int = GROUP, id_col: str = "doc_id") -> DataFrame:
    """Per piece: doc_id, copy, piece, start and length in the document; bin_id, the bin's capacity, and the
    position in the bin. ``tokens``: at least one token each; less or null counts as one."""
    longest = max(lengths)
    counted = docs.select(F.col(id_col).alias("doc_id"), F.greatest(F.lit(1), word_tokens() if tokens is None else tokens).cast("bigint").alias("n"))
    copies = counted.groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("copies"))
    copies = copies.select("doc_id", "n", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"))
    pieces = copies.select("doc_id", "copy", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / longest))).alias("piece"))
    pieces = pieces.select("doc_id", "copy", "piece", (F.col("piece") * longest).alias("start"), F.least(F.lit(longest), F.col("n") - F.col("piece") * longest).cast("bigint").alias("length"))
    pieces = settled(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group))
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).sort_by([("length", "descending"), ("doc_id", "ascending"), ("copy", "ascending"), ("piece", "ascending")])
        bins, positions, capacities = pack(rows["length"].to_pylist(), lengths)
        number = np.array(bins, np.int64)
        out = rows.select(["doc_id", "copy", "piece", "start", "length"])
        out = out.append_column("bin_id", pa.array((np.int64(key[0].as_py()) << 24) | number))
        out = out.append_column("capacity", pa.array(np.array(capacities, np.int64)[number])).append_column("position", pa.array(positions, pa.int64()))
        yield from out.to_batches()

    dealt = pieces.withColumn("bundle", F.pmod(F.xxhash64("doc_id", "copy", "piece"), F.lit(groups)))
    return dealt.groupBy("bundle").applyInArrow(run, OUT.format(kind=kind))
