"""Cross-tokenizer alignment: where two tokenizers cut the same text, and which of their entries go together.

Equal texts are met by a shuffle of the texts and aligned once. A slice of distinct texts is tokenised by A (byte-level
pieces) and B (pieces with byte fallback); the ends of both rows of tokens are marked on the bytes. Between two neighbouring
marks lies a stretch of exactly one A and one B token, so the marks are the links, and marks of both are the ends
of groups. A slice lists its distinct id pairs once, and how many documents hold each of them: copies of a text count by
its multiplicity. These lists go by A id to buckets, which add them up and find each A id's highest count; the slices'
lists are answered from the totals in the same buckets, and the answers go back to the slices, where every text's links
look up their counts. The measures join the documents by the SHA-256 of the text.

Where the split pattern of A is given, a second encoder that reads the same file (ranks are the ids of the merges) takes
the texts on which both must agree: letters below U+0250, whose classes no version of Unicode changes, and no run
of LONG_RUN letters. It needs a quarter of the time; all other texts go through the file's own encoder.

What is kept of a text between the steps is packed: its distinct links and how often each occurs. Lists of pairs and
totals stream through the tasks; a bucket's totals are bounded by the vocabularies, a slice's list by the slice.

Defined results: texts that are null or empty, or whose tokens of either kind do not spell a space and the text, have no
tokens: zeros and an empty hash, and they hold no pair. Every row gives one row, whatever its id; an empty table
gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rhythmica.llm.common import join_one, slices
from rhythmica.session import settled

#: Bytes of text in a slice, about; a longer text is a slice of its own.
SLICE = 2_000_000
LONG_RUN = 2000
SPACE = "▁"
_FAR = re.compile("[^\\x00-\\u024f]")
MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def _byte_levels() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokens:
    """Both tokenizers, the bytes of their entries and what the hash of the groups writes for them."""

    def __init__(self, a_file: str, b_file: str, pattern: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks run side by side already
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        letters = _byte_levels()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for piece, i in entries.items():
            known = all(c in letters for c in piece)
            self.a_bytes[i] = bytes(letters[c] for c in piece) if known else piece.encode()
        self.quick = _quick_encoder(a_file, pattern, self.a_bytes) if pattern else None
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # ids as text, with the mark that follows: A inside and at the end of a group, then B
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        self.marks = pa.array([f"{i}{m}".encode() for n, ms in ((n_a, ",|"), (n_b, ",;")) for m in ms for i in range(n)], pa.large_binary())
        self.starts = (0, n_a, 2 * n_a, 2 * n_a + n_b)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both kinds; none for a text that its tokens do not spell."""
        whole = [" " + t for t in texts]
        slow = [i for i, t in enumerate(texts) if self.quick is None or _FAR.search(t) or len(max(t.split(), key=len, default="")) >= LONG_RUN]
        a = [None] * len(texts)
        for i, e in zip(slow, self.a.encode_batch_fast([whole[i] for i in slow], add_special_tokens=False), strict=True):
            a[i] = e.ids
        a = [self.quick.encode_ordinary(t) if ids is None else ids for ids, t in zip(a, whole, strict=True)]
        b = self.b.encode(texts, out_type=int, num_threads=1)
        for i, text in enumerate(whole):
            spelled = text.encode()
            if not texts[i] or b"".join([self.a_bytes[x] for x in a[i]]) != spelled or b"".join([self.b_bytes[x] for x in b[i]]) != spelled:
                a[i], b[i] = [], []
        return a, b


def _quick_encoder(a_file: str, pattern: str, entries: list[bytes]):
    """The vocabulary of ``a_file`` as ranks, or None where its ids are not the order of its merges."""
    import tiktoken

    with open(a_file, encoding="utf-8") as f:
        stated = json.load(f)
    vocabulary, merges = stated["model"]["vocab"], stated["model"]["merges"]
    made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
    special = {t["id"] for t in stated.get("added_tokens") or []}
    if made != sorted(made) or len(made) + 256 + len(special) != len(entries):
        return None
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks={b: i for i, b in enumerate(entries) if i not in special}, special_tokens={})


class Aligned:
    """Tokens of many texts, aligned together: every text ends with tokens of both kinds."""

    def __init__(self, tokens: Tokens, a_ids: list[list[int]], b_ids: list[list[int]]):
        self.n_a, self.n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(rows), np.int64) for rows in (a_ids, b_ids))
        a_ends, b_ends = np.cumsum(tokens.a_sizes[a]), np.cumsum(tokens.b_sizes[b])
        size = int(a_ends[-1]) if len(a_ends) else 0
        a_mark, b_mark = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        a_mark[a_ends], b_mark[b_ends] = True, True
        at = np.flatnonzero(a_mark | b_mark)
        both = a_mark[at] & b_mark[at]
        a_at, b_at = np.cumsum(a_mark[at]) - a_mark[at], np.cumsum(b_mark[at]) - b_mark[at]
        self.pairs = (a[a_at] << 32) | b[b_at]  # the links in order
        text_of_a = np.repeat(np.arange(len(self.n_a)), self.n_a)
        self.text = text_of_a[a_at]
        self.n_links = np.bincount(self.text, minlength=len(self.n_a))
        self.n_groups = np.bincount(self.text[both], minlength=len(self.n_a))
        # the written form: of each group its A ids, then its B ids
        a_last, b_last = a_at[both], b_at[both]
        a_group, b_group = np.searchsorted(a_last, np.arange(len(a))), np.searchsorted(b_last, np.arange(len(b)))
        codes = np.empty(len(a) + len(b), np.int64)
        a_before = np.concatenate([[0], b_last + 1])[a_group]
        b_before = (a_last + 1)[b_group] if len(b) else b_group
        a_ends_group, b_ends_group = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_ends_group[a_last], b_ends_group[b_last] = True, True
        codes[np.arange(len(a)) + a_before] = a + np.where(a_ends_group, tokens.starts[1], tokens.starts[0])
        codes[np.arange(len(b)) + b_before] = b + np.where(b_ends_group, tokens.starts[3], tokens.starts[2])
        written = tokens.marks.take(pa.array(codes))
        letters, places = written.buffers()[2], np.frombuffer(written.buffers()[1], np.int64, len(written) + 1, written.offset * 8)
        cuts = places[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])].tolist() if len(codes) else [0] * (len(self.n_a) + 1)
        view = memoryview(letters) if letters else memoryview(b"")
        self.hashes = [hashlib.sha256(view[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def _packed(values: np.ndarray, kind: str) -> bytes:
    """Numbers in rising order as steps, or any numbers, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, dtype=kind).tobytes())


def _opened(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _steps(sorted_: np.ndarray) -> np.ndarray:
    return np.diff(sorted_, prepend=sorted_.dtype.type(0))


_ALIGNED = "slice bigint, kind int, key binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, items binary, counts binary"
_NAMES = [f.split()[0] for f in _ALIGNED.split(", ")]


def _aligner(a_file: str, b_file: str, pattern: str | None):
    """Rows of kind 1 for the texts of a slice (items: places of their pairs in the slice's list, counts: how often
    each occurs), and one of kind 0 for the slice (items: the pairs, counts: how many documents hold each)."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens, task, number = Tokens(a_file, b_file, pattern), TaskContext.get().partitionId(), 0
        for part, texts in slices(batches, most=SLICE):
            found = Aligned(tokens, *tokens.encode([t.decode() for t in texts]))
            known, place = np.unique(found.pairs, return_inverse=True)
            cells, times = np.unique(found.text * max(1, len(known)) + place, return_counts=True)
            text, pair = np.divmod(cells, max(1, len(known)))
            copies = part.column("copies").to_numpy(zero_copy_only=False)
            held = np.zeros(len(known), np.int64)
            np.add.at(held, pair, copies[text])
            cuts = np.searchsorted(text, np.arange(len(texts) + 1))
            items = [_packed(_steps(pair[i:j]), "<u4") for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            counts = [_packed(times[i:j], "<u4") for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            n = len(texts)
            one = lambda v, kind: pa.array([v], kind)
            slice_id = (task << 32) | number
            columns = [
                pa.concat_arrays([pa.array(np.full(n, slice_id)), one(slice_id, pa.int64())]),
                pa.array([1] * n + [0], pa.int32()),
                pa.array([*part.column("key").to_pylist(), None], pa.binary()),
                *[pa.array([*getattr(found, m).tolist(), None], pa.int64()) for m in MEASURES],
                pa.array([*found.hashes, None], pa.string()),
                pa.array([*items, _packed(_steps(known), "<i8")], pa.binary()),
                pa.array([*counts, _packed(held, "<i8")], pa.binary()),
            ]
            number += 1
            yield pa.RecordBatch.from_arrays(columns, _NAMES)

    return align


def _bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return (pairs >> 32) % buckets


def _requests(buckets: int):
    """A slice's pairs by bucket, in rising order in each: (bucket, kind 1, slice, pairs, counts)."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs, held = np.cumsum(_opened(row["items"], "<i8")), _opened(row["counts"], "<i8")
                bucket = _bucket_of(pairs, buckets)
                order = np.argsort(bucket, kind="stable")
                pairs, held = pairs[order], held[order]
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                used = np.flatnonzero(np.diff(cuts))
                columns = [
                    pa.array(used, pa.int64()), pa.array([1] * len(used), pa.int32()), pa.array([row["slice"]] * len(used), pa.int64()),
                    pa.array([_packed(_steps(pairs[cuts[b] : cuts[b + 1]]), "<i8") for b in used], pa.binary()),
                    pa.array([_packed(held[cuts[b] : cuts[b + 1]], "<i8") for b in used], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "kind", "slice", "pairs", "counts"])

    return ask


def _merged(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    known, place = np.unique(np.concatenate(pairs), return_inverse=True)
    sums = np.zeros(len(known), np.int64)
    np.add.at(sums, place, np.concatenate(counts))
    return known, sums


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a bucket in a row, as sorted, to its sums: (bucket, kind 0, slice null, pairs, counts)."""

    def sums(bucket, pairs, counts):
        pairs, counts = _merged(pairs, counts)
        values = [pa.array([bucket], pa.int64()), pa.array([0], pa.int32()), pa.array([None], pa.int64()), pa.array([_packed(_steps(pairs), "<i8")], pa.binary()), pa.array([_packed(counts, "<i8")], pa.binary())]
        return pa.RecordBatch.from_arrays(values, ["bucket", "kind", "slice", "pairs", "counts"])

    now, pairs, counts = None, [], []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != now:
                if pairs:
                    yield sums(now, pairs, counts)
                now, pairs, counts = row["bucket"], [], []
            pairs.append(np.cumsum(_opened(row["pairs"], "<i8")))
            counts.append(_opened(row["counts"], "<i8"))
            if len(pairs) > 1 and sum(map(len, pairs[1:])) > 1_000_000 + len(pairs[0]):
                merged = _merged(pairs, counts)
                pairs, counts = [merged[0]], [merged[1]]
    if pairs:
        yield sums(now, pairs, counts)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of a bucket (kind 0), then requests: each gets counts, and whether they are its A id's highest."""
    known = counts = best = np.zeros(0, np.int64)
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            pairs = np.cumsum(_opened(row["pairs"], "<i8"))
            if row["kind"] == 0:
                known, counts = pairs, _opened(row["counts"], "<i8")
                first = np.flatnonzero(np.diff(known >> 32, prepend=-1))
                best = counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(np.concatenate([first, [len(known)]])))
            else:
                at = np.searchsorted(known, pairs)
                out.append((row["slice"], row["bucket"], _packed(pairs, "<i8"), _packed(counts[at] * 2 + best[at], "<i8")))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["slice", "bucket", "items", "counts"])


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A slice's answers (kind 0), then its texts (kind 1), to the texts' measures."""
    now, pairs, answers, table = None, [], [], None
    for batch in batches:
        texts = np.flatnonzero(batch.column("kind").to_numpy(zero_copy_only=False) == 1)
        n_best, count_sum = [], []
        columns = {c: batch.column(c) for c in ("slice", "kind", "items", "counts")}
        for i in range(batch.num_rows):
            slice_, kind, items, counts = (columns[c][i].as_py() for c in ("slice", "kind", "items", "counts"))
            if slice_ != now:
                now, pairs, answers, table = slice_, [], [], None
            if kind == 0:
                pairs.append(_opened(items, "<i8"))
                answers.append(_opened(counts, "<i8"))
                continue
            if table is None:  # the slice's list is sorted by pair
                table = np.concatenate(answers)[np.argsort(np.concatenate(pairs))] if pairs else np.zeros(0, np.int64)
            found, times = table[np.cumsum(_opened(items, "<u4"), dtype=np.int64)], _opened(counts, "<u4").astype(np.int64)
            n_best.append(int(times[(found & 1) == 1].sum()))
            count_sum.append(int((times * (found >> 1)).sum()))
        if len(texts):
            kept = batch.take(pa.array(texts))
            yield pa.RecordBatch.from_arrays(
                [kept.column(c) for c in ("key", *MEASURES)] + [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), kept.column("groups_sha256")],
                ["key", *MEASURES, "n_best", "count_sum", "groups_sha256"],
            )


def align(docs: DataFrame, a_file: str, b_file: str, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.col(text_col).cast("string")
    key = F.unhex(F.sha2(text.cast("binary"), 256))
    texts = docs.select(text.alias("text")).where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    rows = texts.select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"), "text", "copies")
    aligned = settled(rows.mapInArrow(_aligner(a_file, b_file, pattern), _ALIGNED), "aligned")

    lists = aligned.where("kind = 0").select("slice", "items", "counts")
    schema = "bucket bigint, kind int, slice bigint, pairs binary, counts binary"
    # A ids deal the pairs, so there are at most as many buckets as these
    requests = settled(lists.mapInArrow(_requests(2 * partitions), schema), "requests")
    totals = settled(requests.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(_total, schema), "totals")
    asked = totals.unionByName(requests.drop("counts").withColumn("counts", F.lit(None).cast("binary")))
    answers = asked.repartition(partitions, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_answers, "slice bigint, bucket bigint, items binary, counts binary")
    measures = aligned.where("kind = 1").unionByName(answers.select("slice", F.lit(0).alias("kind"), "items", "counts"), allowMissingColumns=True)
    longs = ", ".join(f"{m} bigint" for m in (*MEASURES, "n_best", "count_sum"))
    measures = measures.repartition(partitions, "slice").sortWithinPartitions("slice", "kind").mapInArrow(_looked_up, f"key binary, {longs}, groups_sha256 string")
    keyed = settled(docs.select(F.col(id_col).alias("doc_id"), key.alias("key")), "keys")
    joined = join_one(keyed, settled(measures, "measures"), "key", F.xxhash64("doc_id"), "left")
    zero = {m: F.coalesce(m, F.lit(0).cast("bigint")) for m in (*MEASURES, "n_best", "count_sum")}
    return joined.withColumns(zero | {"groups_sha256": F.coalesce("groups_sha256", F.lit(""))}).drop("key")
