"""Near-duplicate texts: BagMinHash signatures of word-shingle multisets, banding, exact verification.

A text's words (parted by ASCII white space, A-Z lowered) give a multiset of five-word shingles; a text of
one to four words has one shingle of all of them. The similarity is the multisets' weighted Jaccard,
sum of minima over sum of maxima; texts with 0.8 or more are linked, and a class is what links connect.

Signature (BagMinHash, Ertl 2018): the weights of a shingle are cut at 0, 1, 2, 4, 8 ...; each interval
has a Poisson process of its own, of the interval's length as rate, seeded by shingle and interval. A point
has a time, a slot and a level inside its interval; it counts if the level is below the weight, so a weight
of 1,000 costs ten processes, not 1,000. A slot keeps its earliest time; two texts agree in a slot with
probability equal to their weighted Jaccard. Points are made up to a horizon after which nearly all slots
are filled; texts with open slots go on with a doubled horizon, so the signature does not depend on it.

Jobs. Equal texts are collapsed first, by their SHA-256. Slots make bands; each band's bucket links its
members to the smallest one (a star, never all pairs), and components of the stars are neighbourhoods: any
two texts that share a band are in one. Neighbourhoods are dealt into blocks of about 64 texts, and a block
compares its texts exactly, on their whole multisets; verified links give classes. Neighbourhoods of one
block are then done. Larger ones are dealt anew twice, with their smallest member in every block, which
gathers most of a real group into one class in linear time; at last every text outside its neighbourhood's
largest class meets all blocks, a block at a time in memory, so that no pair of different classes stays
uncompared.

Chance that a pair of similarity 0.8 exactly shares none of 32 bands of 5, and so may be missed: 3e-6.

Defined results: null texts and texts without words are linked only to equal texts (null to none);
repeated rows fall into one class; a null doc_id has a null class; further columns are ignored; an empty
table gives an empty table. Class id: the smallest doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rhythmica.llm.common import join_one, runs, slices, splitmix, text_of
from rhythmica.llm.components import components
from rhythmica.session import settled

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
#: Texts in a block, and rounds of dealing large neighbourhoods into blocks anew.
BLOCK, TURNS = 64, 3
SLICE = 2_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[1], np.full(max(0, n - 1), _BASE)]).astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and the number of words of each text."""
    flat = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    space = _SPACE[flat]
    edges = np.diff(np.concatenate([[True], space]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], bounds])))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    lengths = ends - starts
    letters = flat[~space].astype(np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat((letters + np.uint64(1)) * _powers(int(lengths.max()))[place], first)
    return splitmix(sums ^ (lengths.astype(np.uint64) << np.uint64(48))), counts


def multisets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of each text in sorted order: text number, hash, count."""
    hashes, counts = word_hashes(texts)
    text = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    place = np.arange(len(hashes)) - np.repeat(first, counts)
    whole = np.repeat(counts, counts)
    total = np.zeros(len(hashes), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words):
            inside = place + k < whole
            total[inside] += splitmix(hashes[np.flatnonzero(inside) + k] + np.uint64(k + 1) * _STEP)
    keep = (place + words <= whole) | ((whole < words) & (place == 0))
    text, shingle = text[keep], splitmix(total[keep])
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    if not len(text):
        return text, shingle, np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])]))
    return text[new], shingle[new], np.diff(np.append(new, len(text)))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two multisets, each as sorted hashes and counts; two empty ones have none."""
    total = int(a[1].sum() + b[1].sum())
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    return shared / (total - shared) if total else 0.0


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, texts: int, slots: int) -> np.ndarray:
    """Earliest times, one row per text; a text without shingles keeps infinite times."""
    times = np.full(texts * slots, np.inf)
    if not len(text):
        return times.reshape(texts, slots)
    # one process per shingle and interval (0, 1], (1, 2], (2, 4], (4, 8] ...
    intervals = 1 + np.ceil(np.log2(count)).astype(np.int64)
    owner = np.repeat(np.arange(len(text)), intervals)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(intervals) - intervals, intervals)
    low = np.where(k == 0, 0.0, np.exp2(k - 1.0))
    length = np.where(k == 0, 1.0, low)
    own, weight = text[owner], count[owner].astype(np.float64)
    with np.errstate(over="ignore"):
        seed = splitmix(shingle[owner] ^ (k.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)))
    horizon = slots * (np.log(slots) + 4) / np.maximum(1, np.bincount(text, count, texts))
    at, done = np.zeros(len(owner)), np.zeros(len(owner), np.int64)  # the time and number of each process's last point
    active = np.arange(len(owner))
    while len(active):
        block = int(np.clip(200_000 // len(active), 1, 256))
        number = done[active][:, None] + np.arange(1, block + 1)
        with np.errstate(over="ignore"):
            draw = splitmix(seed[active][:, None] + number.astype(np.uint64) * _STEP)
        gaps = -np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0**-53) / length[active][:, None]
        gaps[:, 0] += at[active]
        when = np.cumsum(gaps, axis=1)
        inside = when <= horizon[own[active]][:, None]
        row, col = np.nonzero(inside)
        more = splitmix(draw[row, col] ^ np.uint64(0xA0761D6478BD642F))
        process = active[row]
        level = low[process] + length[process] * ((more >> np.uint64(32)).astype(np.float64) * 2.0**-32)
        counts = level < weight[process]
        slot = ((more & np.uint64(0xFFFFFFFF)) * np.uint64(slots)) >> np.uint64(32)
        np.minimum.at(times, (own[process] * slots + slot.astype(np.int64))[counts], when[row, col][counts])
        full = inside[:, -1]  # the block ended before the horizon: go on behind it
        at[active[full]], done[active[full]] = when[full, -1], number[full, -1]
        active = active[full]
        if not len(active):  # texts with open slots: a doubled horizon, from the start
            open_ = np.isinf(times.reshape(texts, slots)).any(axis=1) & (np.bincount(text, minlength=texts) > 0)
            horizon = np.where(open_, horizon * 2, -1.0)
            active = np.flatnonzero(open_[own])
            at[active], done[active] = 0.0, 0
    return times.reshape(texts, slots)


def bands_of(times: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit hash of each band of each signature."""
    bits = times.view(np.uint64).reshape(len(times), bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64) * _STEP, (len(times), bands)).copy()
    for r in range(rows):
        out = splitmix(out ^ bits[:, :, r])
    return out.view(np.int64)


def banded(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, the text's SHA-256, and its band hashes (null if the text has no words)."""
    source = docs.select("doc_id", F.sha2("text", 256).alias("digest"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, most=SLICE):
            text, shingle, count = multisets(texts, words)
            times = signatures(text, shingle, count, len(texts), bands * rows)
            hashes = bands_of(times, bands, rows)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * bands), pa.array(hashes.ravel()))
            empty = pa.array(np.isinf(times[:, 0]))
            lists = pa.compute.if_else(empty, pa.scalar(None, lists.type), lists)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], ["doc_id", "digest", "bands"])

    return source.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, digest string, bands array<bigint>")


class Postings:
    """The shingles of a block of texts, to compare one more text with all of them at once."""

    def __init__(self, texts: list[bytes], words: int = WORDS):
        text, shingle, count = multisets(texts, words)
        order = np.argsort(shingle, kind="stable")
        self.shingle, self.text, self.count = shingle[order], text[order], count[order]
        self.totals = np.bincount(text, count, len(texts))

    def similar(self, shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Weighted Jaccard with every text of the block."""
        low, high = np.searchsorted(self.shingle, shingle, "left"), np.searchsorted(self.shingle, shingle, "right")
        found = high - low
        at = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found) + np.repeat(low, found)
        shared = np.bincount(self.text[at], np.minimum(self.count[at], np.repeat(count, found)), len(self.totals))
        return shared / np.maximum(1, self.totals + count.sum() - shared)


class Classes:
    """Union-find over whatever names it is given."""

    def __init__(self):
        self.above: dict = {}

    def top(self, x):
        while self.above.setdefault(x, x) != x:
            self.above[x] = x = self.above[self.above[x]]
        return x

    def join(self, x, y) -> bool:
        """Whether they were apart."""
        x, y = self.top(x), self.top(y)
        self.above[max(x, y)] = min(x, y)
        return x != y


LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def linked_in_blocks(least: float, words: int):
    """Rows (unit, role, rep, class, text), sorted by unit and role: residents (role 0) of a unit are compared
    with each other or, where guests (role 1) follow, guests with residents. Yields links that connect what
    was apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in runs(batches, "unit"):
            reps, names, texts, block, classes, links = [], [], [], None, Classes(), []
            for batch in own:
                guests = batch.column("role").to_numpy(zero_copy_only=False) == 1
                n = int((~guests).sum())
                residents = batch.slice(0, n)
                reps += residents.column("rep").to_pylist()
                names += residents.column("class").to_pylist()
                texts += [t.encode() for t in residents.column("text").to_pylist()]
                if not guests.any():
                    continue
                block = block or Postings(texts, words)
                for part, more in slices([batch.slice(n)], most=SLICE):
                    links += compared(block, reps, names, part.column("rep").to_pylist(), part.column("class").to_pylist(), more, classes, least, words)
            if block is None and len(reps) > 1:
                links = compared(Postings(texts, words), reps, names, reps, names, texts, classes, least, words)
            if links:
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in links], LINK)

    return run


def compared(block: Postings, reps, names, guests, guest_names, texts, classes: Classes, least: float, words: int) -> list[tuple[int, int]]:
    text, shingle, count = multisets(texts, words)
    ends = np.searchsorted(text, np.arange(len(texts) + 1))
    out = []
    for i, (guest, name) in enumerate(zip(guests, guest_names, strict=True)):
        near = block.similar(shingle[ends[i] : ends[i + 1]], count[ends[i] : ends[i + 1]])
        out += [(guest, reps[j]) for j in np.flatnonzero(near >= least) if classes.join(name, names[j])]
    return out


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, class_id (the smallest doc_id of its class), kept (whether it is that one)."""
    source = text_of(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    signed = settled(banded(source, words=words), "signed")
    known = F.col("digest").isNotNull() & F.col("doc_id").isNotNull()
    # one representative for each text
    firsts = signed.where(known).groupBy("digest").agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"))
    firsts = settled(firsts, "texts")

    # neighbourhoods: what shares a bucket, directly or through others; a bucket is a star around its smallest member
    bands = firsts.where("bands IS NOT NULL").select("rep", F.explode("bands").alias("bucket"))
    buckets = bands.groupBy("bucket").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "least")
    shared = settled(bands.join(buckets.select("bucket"), "bucket", "left_semi"), "buckets")
    stars = join_one(shared, buckets, "bucket", F.xxhash64("rep")).select(F.col("rep").alias("a"), F.col("least").alias("b"))
    places = settled(components(stars), "neighbourhoods")
    sizes = places.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    places = join_one(places, sizes, "component", F.xxhash64("node")).select(F.col("node").alias("rep"), F.col("component").alias("place"), "blocks")
    members = firsts.select("digest", "rep").join(places, "rep").select("digest", F.col("rep").alias("doc_id"), "place", "blocks")
    # the texts meet their members in a sort-merge join whatever the sizes
    texts = source.withColumn("digest", F.sha2("text", 256)).join(members.hint("merge"), ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])
    texts = settled(texts.select(F.col("doc_id").alias("rep"), "place", "blocks", "text"), "members")

    def compare(rows: DataFrame) -> DataFrame:
        units = rows.select(F.xxhash64("place", "block").alias("unit"), "role", "rep", "class", "text")
        found = units.repartition("unit").sortWithinPartitions("unit", "role").mapInArrow(linked_in_blocks(least, words), "a bigint, b bigint")
        return settled(found, "links")

    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    links = None
    for turn in range(TURNS):  # the neighbourhood's smallest member sits in all its blocks
        own = F.array(F.pmod(F.xxhash64("rep", F.lit(turn)), F.col("blocks")).cast("int"))
        rows = texts.where("blocks > 1") if turn else texts
        blocks = F.explode(F.when(F.col("rep") == F.col("place"), every).otherwise(own)).alias("block")
        found = compare(rows.select("place", blocks, F.lit(0).alias("role"), "rep", F.col("rep").alias("class"), "text"))
        links = found if links is None else links.unionByName(found)
        large = texts.where("blocks > 1").select("rep", "place", "blocks", "text")
        if large.isEmpty():
            break
    classes = settled(components(links), "classes")
    if not large.isEmpty():  # what is not in its neighbourhood's largest class meets all blocks
        large = settled(large.join(classes, large["rep"] == classes["node"], "left").select(*large.columns, F.coalesce("component", "rep").alias("class")), "large")
        counts = large.groupBy("place", "class").agg(F.count(F.lit(1)).alias("n"))
        most = counts.groupBy("place").agg(F.max(F.struct("n", "class"))["class"].alias("main"))
        large = join_one(large, most, "place", F.xxhash64("rep"))
        own = F.pmod(F.xxhash64("rep", F.lit(0)), F.col("blocks")).cast("int").alias("block")
        residents = large.select("place", own, F.lit(0).alias("role"), "rep", "class", "text")
        guests = large.where("class <> main").select("place", F.explode(every).alias("block"), F.lit(1).alias("role"), "rep", "class", "text")
        more = compare(residents.unionByName(guests))
        stars = classes.select(F.col("node").alias("a"), F.col("component").alias("b"))
        classes = settled(components(stars.unionByName(more)), "classes")

    final = firsts.join(classes, firsts["rep"] == classes["node"], "left").select("digest", F.coalesce("component", "rep").alias("class_id"))
    out = join_one(signed.select("doc_id", F.when(known, F.col("digest")).alias("digest")), final, "digest", F.xxhash64("doc_id"), "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))
