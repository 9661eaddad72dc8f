"""Phrase collocation mining by sorting suffix pointers.

A word's suffix is the words from it to the end of its piece, four at most. Every slice of texts cuts its suffixes,
adds up equal ones and sends them off by their leading words: all suffixes with the same leading word meet in one
bucket. There a multikey three-way quicksort of suffix pointers runs down to the fourth word; the partition that
equals the pivot at depth d holds all occurrences of one phrase of d words, so that its weight is the phrase's count.
A partition that weighs less than the least count can hold no frequent phrase and is abandoned unsorted.

Leading words: one, but a word with more occurrences than a bucket should have (a hot word) leads together with the
next, hot pairs with the third, hot triples with the fourth. A bucket's key thus stands for at most n / buckets (or
n / HOT_WORDS) words of the corpus, whatever the frequencies. Counts of phrases of hot words alone are sums over buckets.

Jobs: word counts (one pass over the texts), suffixes and their sorting (a second pass), then joins of frequent phrases
only. To the driver go the number of words and the hot words, HOT_WORDS at most; these are also what is sent to the tasks.

Defined results: a null language is ``und``, a null text is empty; repeated rows count again; an empty table gives an
empty table; further columns are ignored. Ties in a ranking go by the bytes of the phrase.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rhythmica.llm.common import join_one, slices, splitmix
from rhythmica.session import settled

DEPTH = 4
#: Suffixes a bucket should have, and the most words that can be hot.
BUCKET_ROWS, HOT_WORDS = 1_000_000, 65_536
#: Bytes of text worked on at a time.
SLICE = 8_000_000

_KIND = np.zeros(256, np.uint8)  # 0: part of a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


def tokens(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """The words of texts: number of each word, the distinct words, number of the piece, number of the text."""
    whole = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    kind = _KIND[whole]
    inside = np.concatenate([[False], kind == 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    letters = whole[inside[1:-1]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    piece = np.cumsum(kind == 2, dtype=np.int64)[starts]
    first = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, piece, np.searchsorted(first, starts, "right") - 1


def _languages(part: pa.RecordBatch) -> tuple[np.ndarray, list[str]]:
    coded = part.column("lang").dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches, most=SLICE):
        code, names = _languages(part)
        word, known, _, text = tokens(texts)
        if not len(word):
            continue
        cells, n = np.unique(code[text] * len(known) + word, return_counts=True)
        lang, word = np.divmod(cells, len(known))
        columns = [pa.array(names, pa.string()).take(pa.array(lang)), known.take(pa.array(word)).cast(pa.binary()), pa.array(n, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])


def _suffix_sender(buckets: int, hot: frozenset[tuple[str, bytes]]):
    """Sends the added-up suffixes of each slice: (bucket, lang, data), packed by ``_pack``."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, most=SLICE):
            code, names = _languages(part)
            word, known, piece, text = tokens(texts)
            spelled = known.to_pylist()
            seeds = np.fromiter(map(zlib.crc32, spelled), np.uint64, len(spelled))
            languages = code[text]
            for c, name in enumerate(names):
                here = np.flatnonzero(languages == c)  # words of a piece stay neighbours, as a text has one language
                if not len(here):
                    continue
                table = _suffixes(word[here] + 1, piece[here], len(known) + 1)
                is_hot = np.array([False, *[(name, w) in hot for w in spelled]])
                route = np.full(table.shape[1], zlib.crc32(name.encode()), np.uint64)
                leads = np.ones(table.shape[1], bool)
                for d in range(DEPTH):
                    route = np.where(leads, splitmix(route + np.concatenate([[np.uint64(0)], seeds + np.uint64(1)])[table[d]]), route)
                    leads &= is_hot[table[d]]
                bucket = (route % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                bucket, table = bucket[order], table[:, order]
                cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
                for a in range(0, len(cuts) - 1, 256):
                    ends = cuts[a : a + 257]
                    data = [_pack(table[:, i:j], spelled) for i, j in zip(ends[:-1], ends[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket[ends[:-1]], pa.int64()), pa.array([name] * len(data), pa.string()), pa.array(data, pa.binary())], ["bucket", "lang", "data"]
                    )

    return send


def _suffixes(word: np.ndarray, piece: np.ndarray, base: int) -> np.ndarray:
    """Rows 0 to 3: the words of each distinct suffix (0: ended), sorted; row 4: how often it occurs."""
    at = [word]
    for k in range(1, DEPTH):
        later = np.zeros_like(word)
        same = piece[k:] == piece[:-k]
        later[:-k] = np.where(same, word[k:], 0)
        at.append(later)
    front, back = at[0] * base + at[1], at[2] * base + at[3]
    order = np.lexsort((back, front))
    front, back = front[order], back[order]
    first = np.flatnonzero(np.concatenate([[True], (front[1:] != front[:-1]) | (back[1:] != back[:-1])]))
    n = np.diff(np.concatenate([first, [len(order)]]))
    front, back = front[first], back[first]
    return np.stack([*np.divmod(front, base), *np.divmod(back, base), n])


def _pack(table: np.ndarray, spelled: list[bytes]) -> bytes:
    """Suffixes with the words they use, spelled out: words hold neither space nor line feed."""
    used, place = np.unique(np.concatenate([[0], table[:DEPTH].ravel()]), return_inverse=True)
    words = b" ".join([spelled[w - 1] for w in used[1:]])
    body = np.concatenate([place[1:].astype("<u4"), table[DEPTH].astype("<u4")]).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(len(words).to_bytes(8, "little") + words + body)


def _unpack(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words (DEPTH rows) and weights of all suffixes, in one numbering of the words; 0: ended."""
    vocabularies, bodies = [], []
    for blob in blobs:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        size = int.from_bytes(raw[:8], "little")
        vocabularies.append(raw[8 : 8 + size].split(b" ") if size else [])
        bodies.append(np.frombuffer(raw, "<u4", offset=8 + size).reshape(DEPTH + 1, -1))
    coded = pa.array([w for v in vocabularies for w in v], pa.large_binary()).dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    table, at = [], 0
    for vocabulary, body in zip(vocabularies, bodies, strict=True):
        table.append(np.concatenate([[0], number[at : at + len(vocabulary)]])[body[:DEPTH]])
        at += len(vocabulary)
    return np.concatenate(table, axis=1), np.concatenate([b[DEPTH] for b in bodies]).astype(np.int64), coded.dictionary.to_pylist()


def frequent_prefixes(words: np.ndarray, weight: np.ndarray, least: int, from_depth: int = 0, pointers: np.ndarray | None = None) -> Iterator[tuple[int, int, int]]:
    """Multikey three-way quicksort of suffix pointers, heavy partitions only: (a suffix, number of its words, weight).

    ``words`` has a row for each depth, 0 where a suffix has ended; ``pointers`` agree before ``from_depth``.
    """
    stack = [(np.arange(words.shape[1]) if pointers is None else pointers, from_depth)]
    while stack:
        here, depth = stack.pop()
        if weight[here].sum() < least:
            continue  # abandoned: nothing in it is frequent
        key = words[depth][here]
        pivot = sorted((key[0], key[len(key) // 2], key[-1]))[1]
        stack += [(here[key < pivot], depth), (here[key > pivot], depth)]
        if pivot:
            equal = here[key == pivot]
            total = int(weight[equal].sum())
            if total >= least:
                yield int(equal[0]), depth + 1, total
                if depth + 1 < len(words):
                    stack.append((equal, depth + 1))


def _phrase_sorter(least: int, hot: frozenset[tuple[str, bytes]]):
    """Per bucket and language: phrases of two words or more with what they weigh here."""

    def sort(group: pa.Table) -> pa.Table:
        lang = group.column("lang")[0].as_py()
        words, weight, spelled = _unpack(group.column("data").to_pylist())
        is_hot = np.array([False, *[(lang, w) in hot for w in spelled]])
        found: list[tuple[int, int, int]] = []
        # hot words lead on to the next word, so what they begin is only partly here: add it up without a least weight
        leading = np.arange(words.shape[1])
        for depth in range(DEPTH):
            led = is_hot[words[depth][leading]] & (depth < DEPTH - 1)
            rest = leading[~led]
            prefix = np.zeros(len(rest), np.int64)
            if depth and len(rest):
                prefix = np.unique(words[:depth, rest], axis=1, return_inverse=True)[1].ravel()
            order = np.argsort(prefix, kind="stable")
            for part in np.split(rest[order], np.flatnonzero(np.diff(prefix[order])) + 1):
                found += [x for x in frequent_prefixes(words, weight, least, depth, part) if x[1] > 1] if len(part) else []
            leading = leading[led]
            if depth and len(leading):
                _, first, place = np.unique(words[: depth + 1, leading], axis=1, return_index=True, return_inverse=True)
                sums = np.bincount(place.ravel(), weight[leading].astype(np.float64)).astype(np.int64)
                found += zip(leading[first].tolist(), [depth + 1] * len(first), sums.tolist(), strict=True)
        phrases = [b" ".join([spelled[w - 1] for w in words[:k, i]]) for i, k, _ in found]
        columns = [pa.array([lang] * len(found), pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array([x[1] for x in found], pa.int32()), pa.array([x[2] for x in found], pa.int64())]
        return pa.table(columns, ["lang", "phrase", "k", "f"])

    return sort


def phrase_counts(docs: DataFrame, least: int, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Counts of all words (lang, phrase, f), and of the phrases of two to four words that occur ``least`` times
    or more (lang, phrase, k, f)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    words = rows.mapInArrow(_word_counts, "lang string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    words = settled(words, "words")
    n = words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    # two buckets or more for each shuffle partition, so that tasks are even
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET_ROWS))
    share = max(n // buckets, n // HOT_WORDS) + 1
    hot = frozenset((r.lang, bytes(r.word)) for r in words.where(F.col("f") > share).collect())  # fewer than HOT_WORDS
    sent = rows.mapInArrow(_suffix_sender(buckets, hot), "bucket bigint, lang string, data binary")
    sums = sent.groupBy("bucket", "lang").applyInArrow(_phrase_sorter(least, hot), "lang string, phrase string, k int, f bigint")
    phrases = sums.groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return words.select("lang", F.col("word").cast("string").alias("phrase"), "f"), settled(phrases, "phrases")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, cover: int = 80, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase that occurs a times is cut after each word into parts with counts l and r; its score is the least
    floor(2000000 a / (l + r)), of the shortest first part if tied. A phrase inside a longer one that
    has at least ``cover`` percent of its occurrences is dropped.
    """
    words, phrases = phrase_counts(docs, least, lang_col, text_col)
    key = lambda text: F.struct("lang", text.alias("phrase"))
    parts = words.where(F.col("f") >= least).unionByName(phrases.where(F.col("k") < DEPTH).drop("k"))
    parts = settled(parts.select(key(F.col("phrase")).alias("part"), "f"), "parts")
    split = F.split("phrase", " ", -1)
    cuts = phrases.select("lang", "phrase", "k", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), split.alias("w"))
    left, right = F.array_join(F.slice("w", F.lit(1), F.col("cut")), " "), F.array_join(F.slice("w", F.col("cut") + 1, F.col("k")), " ")
    spread = F.xxhash64("phrase", "cut")
    cuts = join_one(cuts.withColumn("part", key(left)), parts.withColumnRenamed("f", "l"), "part", spread)
    cuts = join_one(cuts.withColumn("part", key(right)), parts.withColumnRenamed("f", "r"), "part", spread)
    whole = "decimal(20, 0)"
    score = F.expr(f"(CAST(a AS {whole}) * 2000000) div (CAST(l AS {whole}) + CAST(r AS {whole}))")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("s"))
    longer = phrases.where("k > 2").select("lang", "k", "f", split.alias("w"))
    longer = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    longer = longer.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    inside = longer.groupBy("lang", F.array_join(F.slice("w", F.col("start"), F.col("size")), " ").alias("phrase")).agg(F.max("f").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left")
    kept = kept.where(F.col("longer").isNull() | (F.col("longer").cast(whole) * 100 < F.col("a").cast(whole) * cover))
    kept = kept.select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = """
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents),
p AS (SELECT d, lang, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS p FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
g AS MATERIALIZED (SELECT lang, ws[i] AS w, ws[i + 1] AS w2, ws[i + 2] AS w3, ws[i + 3] AS w4 FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
f AS MATERIALIZED (
  SELECT lang, w AS phrase, 1 AS k, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30 UNION ALL
  SELECT lang, w || ' ' || w2, 2, count(*) FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30 UNION ALL
  SELECT lang, w || ' ' || w2 || ' ' || w3, 3, count(*) FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30 UNION ALL
  SELECT lang, w || ' ' || w2 || ' ' || w3 || ' ' || w4, 4, count(*) FROM g WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, string_split(phrase, ' ') AS ws, phrase, f AS a FROM f WHERE k > 1),
cut AS (SELECT lang, ws, phrase, a, unnest(range(1, len(ws))) AS k FROM c),
scored AS (SELECT cut.lang, cut.phrase, cut.a, cut.k, x.f AS l, y.f AS r, CAST(CAST(cut.a AS HUGEINT) * 2000000 // (x.f + y.f) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.ws[1:cut.k], ' ') JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.ws[cut.k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, array_to_string(ws[s:s + z - 1], ' ') AS phrase, max(a) AS longer FROM (SELECT lang, ws, a, z, unnest(range(1, len(ws) - z + 2)) AS s FROM (SELECT *, unnest(range(2, len(ws))) AS z FROM c)) GROUP BY ALL),
kept AS (SELECT b.lang, b.phrase, a, l, r, score FROM best b LEFT JOIN inner_ i ON b.lang = i.lang AND b.phrase = i.phrase WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
n AS (SELECT lang, CAST(count(*) AS BIGINT) AS n FROM g GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000"""
