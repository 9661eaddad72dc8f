"""WARC archives with a two-level capture index.

Writing: pages become records of gzip members in archive files, one file per task, in a folder that all
executors share. Of the pages with equal payloads of REVISIT bytes or more, the one with the smallest id is
a response, and the others are revisits without a payload that name it.

Index: captures are sorted by a key with the host reversed ("com,example,blog)/path?query"), then by page.
A task writes one range of them as an index file of compressed blocks of LINES lines, and beside it the
sparse directory of the blocks' first captures. The first capture of every index file makes the top level.
A lookup finds its file in the top level, its block in that file's directory and its lines in the block by
binary search, reads the block's byte range, and then the records' byte ranges.

Lost executors: file names are new for every attempt, and only rows of attempts that ended name them, so a
repeated task leaves at worst a file that nothing refers to. Files are reached through their URI (file,
hdfs, s3 ...), as named by ``spark.checkpoint.dir``.

Defined results: a null html is an empty payload; a null url has the key ""; null page ids are always
responses and come first; equal rows are records of their own; an empty table makes no files; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rhythmica.llm.common import join_one, slices
from rhythmica.session import settled, shared_dir

REVISIT = 100
LINES = 1000
#: Captures in an index file, about.
CAPTURES = 100_000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LOCATOR = "key string, page_id bigint, file string, offset bigint, length bigint"
LOCATORS = ("key", "page_id", "file", "offset", "length")
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def url_key(url: Column) -> Column:
    """Host reversed, port and user dropped, no fragment, white space and control characters escaped."""
    escaped = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7f]", "%20")
    host = F.lower(F.regexp_extract(escaped, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rest = F.regexp_replace(F.regexp_replace(escaped, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), "#.*$", "")
    return F.when(url.isNull(), F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


# --- records --------------------------------------------------------------------------------------


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_CONTROL.sub('%20', url)}"] if url else []), f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if revisit else []), "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def parse(member: bytes) -> dict:
    """Headers and payload of one gzip member; a response's digest and length are those of what was read."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    number = lambda name: int(x) if (x := headers.get(name, "<urn:page:>")[10:-1]) else None
    out = {"page_id": number("WARC-Record-ID"), "record_type": headers["WARC-Type"], "refers_to": number("WARC-Refers-To"), "url": headers.get("WARC-Target-URI")}
    if out["record_type"] == "revisit":
        return out | {"payload": None, "payload_bytes": int(headers["X-Payload-Length"]), "payload_digest": headers["WARC-Payload-Digest"][7:]}
    payload = block.partition(b"\r\n\r\n")[2]
    digest = hashlib.sha256(payload).hexdigest()
    if f"sha256:{digest}" != headers["WARC-Payload-Digest"]:
        raise ValueError("a record's payload does not have its digest")
    return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest}


def with_decisions(pages: DataFrame, least: int = REVISIT) -> DataFrame:
    """page_id, url, payload, digest, refers_to. Payloads are shuffled once, by page; hot payloads only as digests."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.where((F.octet_length("payload") >= least) & F.col("page_id").isNotNull())
    slim = settled(large.select("page_id", "digest"), "digests")
    firsts = slim.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = join_one(slim, firsts, "digest", F.xxhash64("page_id")).where("page_id <> refers_to").distinct()
    return rows.join(again.hint("merge"), ["page_id", "digest"], "left")


def write_archives(pages: DataFrame, folder: str, least: int = REVISIT) -> DataFrame:
    """Write all pages (page_id, url, html); the captures (key, page_id, file, offset, length)."""
    rows = with_decisions(pages, least).select(url_key(F.col("url")).alias("key"), "page_id", "url", "digest", "refers_to", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        out, at, name = None, 0, f"{base}/{uuid.uuid4().hex}.warc.gz"
        try:
            for part, payloads in slices(batches, "payload"):
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(name, compression=None)
                places = []
                for payload, *fields in zip(payloads, *(part.column(x).to_pylist() for x in ("page_id", "url", "digest", "refers_to")), strict=True):
                    member = record(fields[0], fields[1], payload, fields[2], fields[3])
                    out.write(member)
                    places.append((at, len(member)))
                    at += len(member)
                n = len(places)
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("page_id"), pa.array([name] * n), pa.array([a for a, _ in places], pa.int64()), pa.array([b for _, b in places], pa.int64())], LOCATORS)
        finally:
            if out is not None:
                out.close()

    return settled(rows.mapInArrow(run, LOCATOR), "captures")


# --- the index ------------------------------------------------------------------------------------


def rank(key: str, page) -> tuple[str, int]:
    return key, -(2**63) - 1 if page is None else page


@dataclass
class Index:
    """The top level: the first capture of every index file, in order."""

    folder: str
    firsts: list[tuple[str, int]]
    files: list[str]


def build_index(captures: DataFrame, folder: str) -> Index:
    """``captures``: a stored table."""
    files = max(1, -(-captures.count() // CAPTURES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        name, out, at, directory, lines = f"{base}/{uuid.uuid4().hex}.idx", None, 0, [], []

        def flush():
            nonlocal at
            block = zlib.compress(json.dumps(lines).encode(), 6)
            out.write(block)
            directory.append([lines[0][0], lines[0][1], at, len(block)])
            at += len(block)
            lines.clear()

        for batch in batches:
            if out is None and batch.num_rows:
                system.create_dir(base, recursive=True)
                out = system.open_output_stream(name, compression=None)
            for line in zip(*(batch.column(x).to_pylist() for x in LOCATORS), strict=True):
                lines.append(line)
                if len(lines) == LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.close()
            with system.open_output_stream(name + ".dir", compression=None) as side:
                side.write(json.dumps(directory).encode())
            yield pa.RecordBatch.from_pydict({"key": pa.array([directory[0][0]]), "page_id": pa.array([directory[0][1]], pa.int64()), "file": pa.array([name])})

    ranged = captures.repartitionByRange(files, "key", "page_id", "file", "offset").sortWithinPartitions("key", "page_id", "file", "offset")
    top = settled(ranged.mapInArrow(run, "key string, page_id bigint, file string"), "index").collect()
    top = sorted((rank(r.key, r.page_id), r.file) for r in top)
    return Index(folder, [a for a, _ in top], [b for _, b in top])


class Reader:
    """Blocks of index files as one task meets them, with the last ones kept."""

    def __init__(self, index: Index):
        self.index, self.system = index, fs.FileSystem.from_uri(index.folder)[0]
        self.directories: dict[str, list] = {}
        self.block: tuple = (None, None)

    def directory(self, file: str) -> tuple[list, list]:
        if file not in self.directories:
            with self.system.open_input_file(file + ".dir") as f:
                rows = json.loads(f.read())
            self.directories = {file: ([rank(k, p) for k, p, _, _ in rows], [(a, n) for _, _, a, n in rows])}  # queries are sorted: one file at a time
        return self.directories[file]

    def lines(self, file: str, place: tuple[int, int]) -> list:
        if self.block[0] != (file, place):
            with self.system.open_input_file(file) as f:
                rows = json.loads(zlib.decompress(f.read_at(place[1], place[0])))
            self.block = ((file, place), ([rank(r[0], r[1]) for r in rows], rows))
        return self.block[1]

    def find(self, low: tuple, high: tuple) -> Iterator[list]:
        """All captures from ``low`` to ``high``. The block before the first that starts at ``low`` may hold some."""
        top = self.index
        for f in range(max(0, bisect_left(top.firsts, low) - 1), bisect_right(top.firsts, high)):
            firsts, places = self.directory(top.files[f])
            for b in range(max(0, bisect_left(firsts, low) - 1), bisect_right(firsts, high)):
                ranks, rows = self.lines(top.files[f], places[b])
                yield from rows[bisect_left(ranks, low) : bisect_right(ranks, high)]


def lookup(index: Index, queries: DataFrame) -> DataFrame:
    """Captures of the distinct (key, page_id) in ``queries``, or of all pages of a key where there is no
    column page_id."""
    whole = "page_id" not in queries.columns
    asked = queries.select("key").distinct() if whole else queries.select("key", "page_id").distinct()
    order = asked.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(index)
        for batch in batches:
            found = []
            for key, *page in zip(*(batch.column(x).to_pylist() for x in order), strict=True):
                low = (key, -(2**63) - 1) if whole else rank(key, page[0])
                found += reader.find(low, (key, 2**63) if whole else low)
            columns = list(zip(*found, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], LOCATORS)

    return asked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, LOCATOR)


def read_records(locators: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records at (file, offset, length), read in the order of the files. ``locators``: a stored table."""
    kinds = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string" + ", payload binary" * payloads
    types = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), *([("payload", pa.binary())] if payloads else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, name, file = fs.FileSystem.from_uri(folder)[0], None, None
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                rows = []
                for path, offset, length in zip(*(batch.slice(start, 500).column(x).to_pylist() for x in ("file", "offset", "length")), strict=True):
                    if path != name:
                        name, file = path, system.open_input_file(path)
                    rows.append(parse(file.read_at(length, offset)))
                yield pa.RecordBatch.from_pylist(rows, types)

    return locators.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, kinds)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write the pages, index them, look every page up in the index and read its records back."""
    folder = shared_dir(pages.sparkSession, "warc")
    folder = folder if re.match(r"[a-z][a-z0-9+.-]*:", folder) else f"file://{folder}"
    captures = write_archives(pages, folder)
    index = build_index(captures, folder)
    queries = pages.select(url_key(F.col("url").cast("string")).alias("key"), F.col("page_id").cast("bigint").alias("page_id"))
    return read_records(settled(lookup(index, queries), "found"), folder, payloads=False)
