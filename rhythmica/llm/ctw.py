"""Context-tree weighting over bytes: code lengths of whole texts under a tree trained on the corpus.

A text is its bytes with A-Z lowered, then one end mark (255, a byte that UTF-8 never has), seen after end
marks. A byte is coded as eight binary decisions, first bit first. The context of depth d is the last d
bytes, d = 0 .. D. A node is a context with the bits of the coming byte already known; it counts the
zeros and ones that the training texts put there. Its Krichevsky-Trofimov probability is
``KT = G(a+1/2) G(b+1/2) / (pi G(a+b+1))``, and its weighted probability halves between ``KT`` and the
product over its longer contexts. In a coded text, the chance of a bit is the mixture of the estimates
``(count + 1/2) / (total + 1)`` of all depths on its path, weighted by ``beta = KT / product``. The path
ends at the longest context that training has seen, which answers with its own estimate; the chances of
both bits sum to one at every node.

How it is spread. Texts are dealt into chunks by the hash of id and text. A chunk finds its distinct
(D+1)-grams with their training counts, and cuts them into buckets by the last two bytes of the context,
so that a bucket holds whole subtrees from depth 2 on. The buckets add up the chunks' counts and weigh
their subtrees bottom-up; depths 0 and 1 have 65,280 nodes at most and are summed by a grouped
aggregate. Each bucket then answers every chunk's n-grams with their log probability, and a chunk scores
its texts from the answers. What moves are the distinct n-grams of chunks, packed into arrays, never the
positions of the corpus; chunks and buckets grow in number with the input. The word counts of the base
score travel the same way.

Defined results: null counts as empty text (one end mark; one end token); repeated rows are scored each,
and learned from each; an empty table gives an empty table; without any training text the tree is empty
and every bit costs one bit; further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rhythmica.llm.common import runs, slices, splitmix
from rhythmica.session import settled

#: Longest context in bytes (an n-gram with its coming byte fits 64 bits: at most 7).
DEPTH = 5
#: Bytes of text in a chunk, about.
CHUNK = 10_000_000
END = 255
LN10 = math.log(10.0)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

# --- n-grams --------------------------------------------------------------------------------------


def grams(texts: list[bytes], depth: int) -> np.ndarray:
    """The (depth+1)-gram of every byte and end mark, as one number: last context byte first, coming byte last."""
    flat = np.frombuffer(bytes([END]) * depth + b"".join([t.translate(LOWER) + bytes([END]) for t in texts]), np.uint8).astype(np.uint64)
    n = len(flat) - depth
    keys = flat[depth:].copy()
    for d in range(1, depth + 1):
        keys |= flat[depth - d : depth - d + n] << np.uint64(8 * (depth + 1 - d))
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes) - sizes
    for at in range(depth):  # a text's byte number ``at`` sees end marks from depth at+1 on
        mask = sum(0xFF << (8 * (depth + 1 - d)) for d in range(at + 1, depth + 1))
        keys[starts[sizes > at] + at] |= np.uint64(mask)
    return keys


def distinct(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their summed weights (or how often they occur)."""
    if not len(keys):
        return keys.astype(np.uint64), np.zeros(0, np.int64)
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(first, len(keys))) if weights is None else np.add.reduceat(weights, first)
    return keys[first], counts.astype(np.int64)


# --- the tree -------------------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after shifting small arguments up by eight."""
    small = x < 8
    y = np.where(small, x + 8, x)
    out = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    if small.any():
        shift = np.zeros(int(small.sum()))
        for i in range(8):
            shift += np.log(x[small] + i)
        out[small] -= shift
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def halved(kt: np.ndarray, product: np.ndarray) -> np.ndarray:
    return np.logaddexp(kt, product) - math.log(2.0)


class Subtrees:
    """The nodes of depths ``top`` .. D over sorted distinct n-grams; a count may be zero (asked for, not seen)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int, top: int):
        self.depth, self.top = depth, top
        # by depth: distinct (context, coming byte), their counts, and their places among the next shorter ones
        self.entries, self.counts, self.shorter = {depth: keys}, {depth: counts.astype(np.float64)}, {}
        for d in range(depth - 1, top - 1, -1):
            longer = self.entries[d + 1]
            entry = (longer >> np.uint64(16) << np.uint64(8)) | (longer & np.uint64(255))
            self.entries[d], self.shorter[d + 1] = np.unique(entry, return_inverse=True)
            self.counts[d] = np.bincount(self.shorter[d + 1], self.counts[d + 1], len(self.entries[d]))

    def nodes(self, d: int, bit: int):
        """Where the nodes of the decision ``bit`` start among the entries of depth d, the node of each
        entry, and the zeros and ones of the nodes."""
        coming = (self.entries[d] & np.uint64(255)).astype(np.int64)
        node = self.entries[d] >> np.uint64(8 - bit) if bit < 8 else self.entries[d]
        new = np.concatenate([[True], node[1:] != node[:-1]])
        starts, place = np.flatnonzero(new), np.cumsum(new) - 1
        one = (coming >> (7 - bit)) & 1
        ones = np.add.reduceat(self.counts[d] * one, starts)
        return starts, place, np.add.reduceat(self.counts[d], starts) - ones, ones

    def weigh(self, bit: int) -> dict[int, tuple]:
        """Bottom-up: by depth the nodes (as above) with log beta and log weighted probability."""
        out: dict[int, tuple] = {}
        for d in range(self.depth, self.top - 1, -1):
            starts, place, zeros, ones = self.nodes(d, bit)
            kt = log_kt(zeros, ones)
            if d == self.depth:
                out[d] = (starts, place, zeros, ones, np.zeros(len(kt)), kt)
                continue
            below = out[d + 1]
            product = np.bincount(place[self.shorter[d + 1][below[0]]], below[5], len(kt))
            out[d] = (starts, place, zeros, ones, kt - product, halved(kt, product))
        return out

    def code(self, above: list[tuple[np.ndarray, ...]]) -> np.ndarray:
        """Log probability of each n-gram's coming byte after its context. ``above``: for the depths 0 ..
        top-1 dense tables of zeros, ones and log beta, by context (for depth 1) and heap number of the node."""
        keys = self.entries[self.depth]
        coming = (keys & np.uint64(255)).astype(np.int64)
        last = (keys >> np.uint64(8 * self.depth)).astype(np.int64) & 255
        total = np.zeros(len(keys))
        for bit in range(8):
            one = ((coming >> (7 - bit)) & 1).astype(bool)
            heap = (1 << bit) | (coming >> (8 - bit))
            chance = np.full(len(keys), np.nan)
            levels, entry = self.weigh(bit), np.arange(len(keys))
            for d in range(self.depth, -1, -1):
                if d >= self.top:
                    _, place, zeros, ones, beta, _ = levels[d]
                    entry = entry if d == self.depth else self.shorter[d + 1][entry]
                    at = place[entry]
                else:
                    zeros, ones, beta = above[d]
                    at = (last if d else 0) * 256 + heap
                seen = zeros[at] + ones[at]
                own = (np.where(one, ones[at], zeros[at]) + 0.5) / (seen + 1)
                weight = np.exp(np.clip(beta[at], -700, 700))
                mixed = (weight * own + chance) / (weight + 1)
                chance = np.where(np.isnan(chance), np.where(seen > 0, own, np.nan), mixed)
            total += np.log(np.where(np.isnan(chance), 0.5, chance))
        return total


def top_tables(rows: list[tuple]) -> list[tuple[np.ndarray, ...]]:
    """Depths 0 and 1 from the sums over depth 2: (last byte, heap number, zeros, ones, product)."""
    zeros, ones, product = np.zeros(65536), np.zeros(65536), np.zeros(65536)
    for c, heap, a, b, p in rows:
        zeros[c * 256 + heap], ones[c * 256 + heap], product[c * 256 + heap] = a, b, p
    kt = log_kt(zeros, ones)
    one = (zeros, ones, kt - product)
    zeros0, ones0, product0 = (x.reshape(256, 256).sum(axis=0) for x in (zeros, ones, halved(kt, product)))
    return [(zeros0, ones0, log_kt(zeros0, ones0) - product0), one]


def top_sums(keys: np.ndarray, counts: np.ndarray, depth: int) -> dict[str, np.ndarray]:
    """What a bucket's subtrees add to depth 1."""
    tree, out = Subtrees(keys, counts, depth, 2), []
    for bit in range(8):
        starts, _, zeros, ones, _, weighted = tree.weigh(bit)[2]
        entry = tree.entries[2][starts]
        node = ((entry >> np.uint64(16)) << np.uint64(8)).astype(np.int64) | (1 << bit) | ((entry & np.uint64(255)).astype(np.int64) >> (8 - bit))
        found, place = np.unique(node, return_inverse=True)
        out.append((found >> 8, found & 255, *(np.bincount(place, x) for x in (zeros, ones, weighted))))
    return {name: np.concatenate([x[i] for x in out]) for i, name in enumerate(("c", "heap", "zeros", "ones", "product"))}


class Lookup:
    """A fixed table from 64-bit keys to values: open addressing, filled and asked array-wise."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.keys, self.values = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits)
        full = np.zeros(1 << self.bits, bool)
        at, rest = self._home(keys), np.arange(len(keys))
        while len(rest):
            free = rest[~full[at[rest]]]
            slot, winner = np.unique(at[free], return_index=True)
            winner = free[winner]
            full[slot], self.keys[slot], self.values[slot] = True, keys[winner], values[winner]
            placed = np.zeros(len(keys), bool)
            placed[winner] = True
            rest = rest[~placed[rest]]
            at[rest] = (at[rest] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """All keys must be in the table."""
        at = self._home(keys)
        wrong = np.flatnonzero(self.keys[at] != keys)
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            wrong = wrong[self.keys[at[wrong]] != keys[wrong]]
        return self.values[at]


# --- packed arrays --------------------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers as byte planes, lightly compressed."""
    return zlib.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1).T).view("<u8").ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


def pack_words(words: list[bytes]) -> bytes:
    return zlib.compress(b"\n".join(words), 1)


def unpack_words(blob: bytes) -> list[bytes]:
    return zlib.decompress(blob).split(b"\n")


# --- Spark jobs -----------------------------------------------------------------------------------

#: Distinct n-grams that a task gathers before it merges them.
GATHERED = 3_000_000
PACKED = "chunk bigint, bucket bigint, kind int, a binary, b binary"
TOP = "c bigint, heap bigint, zeros double, ones double, product double"
PACKED_NAMES, TOP_NAMES = ("chunk", "bucket", "kind", "a", "b"), ("c", "heap", "zeros", "ones", "product")


class Gather:
    """Adds up n-gram counts, merged whenever enough have come."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size > GATHERED and len(self.parts) > 1:
            merged = self.result()
            self.parts, self.size = [merged], len(merged[0])
            if self.size * 2 > GATHERED:
                self.size = 0  # mostly distinct: merge again only after as many more

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return distinct(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts]))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words, parted by the ASCII white space that bytes.split knows, and the end token (b"")."""
    return [*text.translate(LOWER).split(), b""]


def emit(rows: list[tuple], names: tuple[str, ...], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


PACKED_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]


def found_in_chunks(depth: int, buckets: int) -> Callable:
    """Per chunk and bucket: the distinct n-grams (buckets below ``buckets``) and words (from there on)
    with their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, own in runs(batches, "chunk"):
            gather, words, asked = Gather(), Counter(), set()
            for part, texts in slices(own, most=2_000_000):
                learn = part.column("learn").to_numpy(zero_copy_only=False)
                for flag in (True, False):
                    chosen = [t for t, x in zip(texts, learn, strict=True) if x == flag]
                    if not chosen:
                        continue
                    keys, counts = distinct(grams(chosen, depth))
                    gather.add(keys, counts if flag else counts * 0)
                    for t in chosen:
                        (words if flag else asked).update(words_of(t))
            keys, counts = gather.result()
            bucket = (splitmix(keys >> np.uint64(8 * (depth - 1))) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.cumsum(np.bincount(bucket, minlength=buckets))
            rows = []
            for b in np.unique(bucket):
                at = order[ends[b - 1] if b else 0 : ends[b]]
                rows.append((chunk, int(b), 1, pack_sorted(keys[at]), pack(counts[at])))
            dealt: dict[int, list[bytes]] = {}
            for w in words.keys() | asked:
                dealt.setdefault(zlib.crc32(w) % buckets, []).append(w)
            rows += [(chunk, buckets + b, 1, pack_words(own_words), pack(np.array([words[w] for w in own_words]))) for b, own_words in dealt.items()]
            yield emit(rows, PACKED_NAMES, PACKED_KINDS)

    return run


def add_up(depth: int, buckets: int) -> Callable:
    """Per bucket the sums over all chunks (kind 0), and what depth 1 and the word totals get from them (kind 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, own in runs(batches, "bucket"):
            if bucket < buckets:
                gather = Gather()
                for part in own:
                    for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist(), strict=True):
                        gather.add(unpack_sorted(a), unpack(b).astype(np.int64))
                keys, counts = gather.result()
                model, top = (pack_sorted(keys), pack(counts)), top_sums(keys, counts, depth)
            else:
                words: Counter = Counter()
                for part in own:
                    for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist(), strict=True):
                        for w, n in zip(unpack_words(a), unpack(b).tolist(), strict=True):
                            words[w] += n
                counts = np.array(list(words.values()))
                model = (pack_words(list(words)), pack(counts))
                top = dict(zip(TOP_NAMES, (np.array([x]) for x in (-1, 0, float((counts > 0).sum()), float(counts.sum()), 0.0)), strict=True))
            n = len(top["c"])
            nothing = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([x], k) for x, k in zip((None, bucket, 0, *model), PACKED_KINDS, strict=True)), *(pa.nulls(1, k) for k in TOP_KINDS)], [*PACKED_NAMES, *TOP_NAMES]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.array(np.full(n, bucket)), pa.array(np.full(n, 2, np.int32)), nothing, nothing, *(pa.array(top[x]).cast(k) for x, k in zip(TOP_NAMES, TOP_KINDS, strict=True))],
                [*PACKED_NAMES, *TOP_NAMES],
            )

    return run


TOP_KINDS = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]


def answer(depth: int, buckets: int, tops: list) -> Callable:
    """Per chunk and bucket: its n-grams with log probabilities, or its words with training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, own in runs(batches, "bucket"):
            keys = values = words = None
            for part in own:
                rows = []
                for chunk, kind, a, b in zip(*(part.column(x).to_pylist() for x in ("chunk", "kind", "a", "b")), strict=True):
                    if kind == 0 and bucket < buckets:
                        keys = unpack_sorted(a)
                        values = Subtrees(keys, unpack(b), depth, 2).code(tops)
                    elif kind == 0:
                        words = dict(zip(unpack_words(a), unpack(b).tolist(), strict=True))
                    elif bucket < buckets:
                        rows.append((chunk, bucket, 0, a, values[np.searchsorted(keys, unpack_sorted(a))].tobytes()))
                    else:
                        rows.append((chunk, bucket, 0, a, pack(np.array([words[w] for w in unpack_words(a)]))))
                if rows:
                    yield emit(rows, PACKED_NAMES, PACKED_KINDS)

    return run


SCORES = "n_tokens bigint, n_known bigint, base_score double, score double"


def score_chunks(depth: int, buckets: int, train_tokens: int, train_words: int) -> Callable:
    """Texts scored from their chunk's answers, which come first."""
    unit = math.log10(train_tokens + 0.1 * (train_words + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in runs(batches, "chunk"):
            keys, values, words, look = [], [], {}, None
            for batch in own:
                kinds = batch.column("kind").to_numpy(zero_copy_only=False)
                n = int((kinds == 0).sum())
                for bucket, a, b in zip(*(batch.column(x).slice(0, n).to_pylist() for x in ("bucket", "a", "b")), strict=True):
                    if bucket < buckets:
                        keys.append(unpack_sorted(a))
                        values.append(np.frombuffer(b, np.float64))
                    else:
                        words.update(zip(unpack_words(a), unpack(b).tolist(), strict=True))
                if n == len(kinds):
                    continue
                look = look or Lookup(np.concatenate(keys), np.concatenate(values))
                for part, texts in slices([batch.slice(n)], most=2_000_000):
                    sizes = np.array([len(t) + 1 for t in texts])
                    score = np.add.reduceat(look(grams(texts, depth)), np.cumsum(sizes) - sizes) / LN10
                    tokens = [words_of(t) for t in texts]
                    lengths = np.array([len(x) for x in tokens])
                    counts = np.array([words[w] for x in tokens for w in x], np.float64)
                    starts = np.cumsum(lengths) - lengths
                    base = np.add.reduceat(np.log10(counts + 0.1) - unit, starts)
                    known = np.add.reduceat((counts > 0).astype(np.int64), starts)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), part.column("learn"), *map(pa.array, (lengths, known, base, score))], ["doc_id", "learn", "n_tokens", "n_known", "base_score", "score"]
                    )

    return run


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, chunk_bytes: int = CHUNK) -> DataFrame:
    """Per row: doc_id, learn, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities).

    ``learn``: a boolean over the columns of ``docs``; null counts as false. ``bits per byte`` of a text
    of n bytes is ``-score * log2(10) / (n + 1)``.
    """
    if not 2 <= depth <= 7:
        raise ValueError("depth is from 2 to 7")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    chunks = max(1, math.ceil(size / chunk_bytes))
    buckets = max(64, chunks)
    spread = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    id_kind = rows.schema["doc_id"].dataType.simpleString()

    asked = spread.repartition(chunks, "chunk").sortWithinPartitions("chunk").mapInArrow(found_in_chunks(depth, buckets), PACKED)
    asked = settled(asked, "ctw-asked")
    model = asked.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(add_up(depth, buckets), f"{PACKED}, {TOP}")
    model = settled(model, "ctw-model")

    sums = model.where("kind = 2").groupBy("c", "heap").agg(*(F.sum(x).alias(x) for x in ("zeros", "ones", "product"))).collect()
    tops = top_tables([tuple(r) for r in sums if r.c >= 0])
    train_words, train_tokens = next(((int(r.zeros), int(r.ones)) for r in sums if r.c < 0), (0, 0))

    answers = (
        model.where("kind = 0").select(*PACKED_NAMES).union(asked)
        .repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(answer(depth, buckets, tops), PACKED)
    )
    both = answers.select(*PACKED_NAMES, *(F.lit(None).cast(k).alias(x) for x, k in (("doc_id", id_kind), ("text", "string"), ("learn", "boolean")))).union(
        spread.select("chunk", *(F.lit(v).cast(k).alias(x) for x, v, k in (("bucket", None, "bigint"), ("kind", 1, "int"), ("a", None, "binary"), ("b", None, "binary"))), "doc_id", "text", "learn")
    )
    scored = both.repartition(chunks, "chunk").sortWithinPartitions("chunk", "kind").mapInArrow(
        score_chunks(depth, buckets, train_tokens, train_words), f"doc_id {id_kind}, learn boolean, {SCORES}"
    )
    return scored.withColumn("train_tokens", F.lit(train_tokens).cast("bigint"))
