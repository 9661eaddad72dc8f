"""Byte-level BPE, encoded and decoded by DuckDB queries inside Spark tasks.

Encoding: a task cuts its texts into pieces with the tokenizer's pattern, and a recursive query contracts
the distinct pieces. The state of a step is one row per piece with its tokens; the step unnests it into
token positions, joins neighbours with the merge table, takes each piece's leftmost pair of least rank
and contracts it; a piece without such a pair is done. Decoding: token rows join the vocabulary, and an
ordered aggregation glues the bytes of a text together.

Pieces of more than ``LONG`` bytes would need one step per merge over all their tokens, so their step
contracts every occurrence of the least-ranked pair. That gives the same tokens where ranks never fall
from one step to the next and a merged token forms no lower-ranked pair with the next occurrence. Merges
that break the second rule are marked and contracted one at a time; a piece that breaks the first takes
the plain steps.

Defined results: a null text counts as empty; an empty text has no tokens; repeated rows give repeated
rows; further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rhythmica.llm.common import slices, text_of

#: Pieces of more bytes take the steps that contract all occurrences at once.
LONG = 64
#: Distinct pieces whose tokens a task remembers, and distinct pieces for one query.
REMEMBERED = 300_000
AT_ONCE = 25_000
#: Bytes of text that a task works on at a time (a longer text is worked on alone).
SLICE = 1_000_000
#: Tokens for one decoding query (a longer text takes several, and their bytes are joined).
TOKENS_AT_ONCE = 250_000

STEPS = """
WITH RECURSIVE s AS (
  SELECT w, l, false AS done FROM pieces
  UNION ALL
  (WITH u AS (SELECT w, unnest(l[:-2]) AS a, unnest(l[2:]) AS b, generate_subscripts(l[2:], 1) AS i FROM s WHERE NOT done),
   c AS (SELECT u.w, min(m.rank_high + u.i) AS best FROM u JOIN merges m ON m.pair = u.a * 4294967296 + u.b GROUP BY u.w)
   SELECT s.w, CASE WHEN best IS NULL THEN l
               ELSE l[:(best & 4294967295) - 1] || [best >> 32] || l[(best & 4294967295) + 2:] END,
          best IS NULL
   FROM s LEFT JOIN c USING (w) WHERE NOT s.done))
SELECT w, l FROM s WHERE done ORDER BY w"""

# Of a chain of overlapping occurrences (x x x x), those at its 1st, 3rd, 5th ... place count; a pair has
# one rank, but two pairs may make the same token, so a piece's least rank may stand for two pairs.
LONG_STEPS = """
WITH RECURSIVE s AS (
  SELECT w, l, false AS done, -1::BIGINT AS last, false AS fell FROM pieces
  UNION ALL
  (WITH u AS (SELECT w, unnest(l) AS a, unnest(l[2:] || [NULL]) AS b, generate_subscripts(l, 1) AS i FROM s WHERE NOT done),
   c AS (SELECT u.w, u.a, u.i, m.rank_high >> 32 AS rank, m.alone FROM u LEFT JOIN merges m ON m.pair = u.a * 4294967296 + u.b),
   b AS (SELECT w, min(rank) AS best FROM c GROUP BY w),
   h AS (SELECT c.w, c.i, c.alone, row_number() OVER (PARTITION BY c.w ORDER BY c.i) AS hit, c.i - hit AS chain FROM c JOIN b ON b.w = c.w AND b.best = c.rank),
   k AS (SELECT w, i FROM (SELECT w, i, alone, hit, row_number() OVER (PARTITION BY w, chain ORDER BY i) AS place FROM h)
         WHERE CASE WHEN alone THEN hit = 1 ELSE place % 2 = 1 END),
   n AS (SELECT c.w, list(CASE WHEN k.i IS NULL THEN c.a ELSE b.best END ORDER BY c.i) AS l
         FROM c JOIN b ON b.w = c.w LEFT JOIN k ON k.w = c.w AND k.i = c.i LEFT JOIN k AS gone ON gone.w = c.w AND gone.i + 1 = c.i
         WHERE gone.i IS NULL GROUP BY c.w)
   SELECT s.w, n.l, b.best IS NULL, coalesce(b.best, s.last), s.fell OR coalesce(b.best < s.last, false)
   FROM s JOIN n USING (w) JOIN b USING (w) WHERE NOT s.done))
SELECT w, l, fell FROM s WHERE done ORDER BY w"""

# a merge is alone if its token forms a lower-ranked pair with the left token of a next occurrence
MERGES = """
CREATE TABLE merges AS
SELECT m.pair, m.rank_high, coalesce(x.rank_high < m.rank_high, false) AS alone
FROM given m LEFT JOIN given x ON x.pair = (m.rank_high >> 32) * 4294967296 + (m.pair >> 32)"""

GLUED = "SELECT d, string_agg(s, '' ORDER BY p) AS s FROM tokens JOIN vocabulary USING (id) GROUP BY d"


class Codec:
    """One task's DuckDB connection with the vocabulary and the merge table, and the pieces it has met."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        if any(bytes([i]) not in self.ranks for i in range(256)):
            raise ValueError("a byte-level vocabulary has all 256 bytes")
        self.pattern = regex.compile(pattern)
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        rows = [
            (self.ranks[left] << 32 | self.ranks[right], rank << 32)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (left := token[:cut]) in self.ranks and (right := token[cut:]) in self.ranks
        ]
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        ids = sorted((rank, token) for token, rank in self.ranks.items())
        self.con.register("given", pa.table({"pair": pa.array([r[0] for r in rows], pa.int64()), "rank_high": pa.array([r[1] for r in rows], pa.int64())}))
        self.con.execute(MERGES).fetchall()
        self.con.register("given", pa.table({"id": pa.array([i for i, _ in ids], pa.int64()), "s": [t.decode("latin-1") for _, t in ids]}))
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM given").fetchall()
        self.known: dict[str, bytes] = {}

    def _run(self, sql: str, pieces: list[bytes]):
        lengths = np.array([len(x) for x in pieces], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]))
        self.con.register("pieces", pa.table({"w": pa.array(np.arange(len(pieces))), "l": lists}))
        return self.con.sql(sql).to_arrow_table()

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The tokens of each piece as little-endian 32-bit numbers. A piece that is a token is that token."""
        out: list[bytes | None] = [self.ranks[x].to_bytes(4, "little") if x in self.ranks else b"" if not x else None for x in pieces]
        open_ = [i for i, x in enumerate(out) if x is None]
        long = [i for i in open_ if len(pieces[i]) > LONG]
        for i in long:  # one at a time: a long piece is a table of its own
            done = self._run(LONG_STEPS, [pieces[i]])
            if not done["fell"][0].as_py():
                out[i] = np.asarray(done["l"].combine_chunks().flatten()).astype("<u4").tobytes()
        open_ = [i for i in open_ if out[i] is None]
        for start in range(0, len(open_), AT_ONCE):
            part = open_[start : start + AT_ONCE]
            lists = self._run(STEPS, [pieces[i] for i in part])["l"].combine_chunks()
            offsets = np.asarray(lists.offsets) * 4
            blob = np.asarray(lists.values).astype("<u4").tobytes()
            for k, i in enumerate(part):
                out[i] = blob[offsets[k] : offsets[k + 1]]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The pattern cuts whole texts; a piece is merged when it is first met."""
        found = [self.pattern.findall(t) for t in texts]
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        new = [p for p in set().union(*found) if p not in known]
        known.update(zip(new, self.merge([p.encode() for p in new]), strict=True))
        return [b"".join(map(known.__getitem__, pieces)) for pieces in found]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        step = 4 * TOKENS_AT_ONCE
        parts = [[x[i : i + step] for i in range(0, len(x), step)] for x in ids]
        glued = iter(self._glue([p for of in parts for p in of]))
        return [b"".join([next(glued) for _ in of]) for of in parts]

    def _glue(self, ids: list[bytes]) -> list[bytes]:
        counts = np.array([len(x) // 4 for x in ids], np.int64)
        out = [b""] * len(ids)
        start = 0
        ends = np.cumsum(counts)
        while start < len(ids):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + TOKENS_AT_ONCE, side="right")))
            flat = np.frombuffer(b"".join(ids[start:stop]), "<u4").astype(np.int64)
            if len(flat) and (flat >= len(self.ranks)).any():
                raise ValueError("an id is not in the vocabulary")
            rows = pa.table({"d": pa.array(np.repeat(np.arange(start, stop), counts[start:stop])), "p": pa.array(np.arange(len(flat))), "id": pa.array(flat)})
            self.con.register("tokens", rows)
            glued = self.con.sql(GLUED).to_arrow_table()
            for d, s in zip(glued["d"].to_pylist(), glued["s"].to_pylist(), strict=True):
                out[d] = s.encode("latin-1")
            start = stop
        return out


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker process keeps it from task to task."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_decoded: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit numbers); ``with_decoded``
    decodes the ids again in the same task and adds their bytes."""
    rows = text_of(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part, texts in slices(batches, most=SLICE):
            ids = own.encode([t.decode() for t in texts])
            columns = {"doc_id": part.column(0), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
            if with_decoded:
                columns["decoded"] = pa.array(own.decode(ids), pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids binary" + ", decoded binary" * with_decoded)


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: doc_id, ids and the decoded bytes. Null ids decode to nothing; an id that the vocabulary
    lacks is an error."""
    rows = tokens.select(tokens[id_col].alias("doc_id"), tokens[ids_col].alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part, ids in slices(batches, "ids"):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(own.decode(ids), pa.binary())], ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, decoded binary")
