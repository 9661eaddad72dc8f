"""File listings, fingerprints and the feature table cache."""

from __future__ import annotations

import ctypes
import ctypes.util
import hashlib
import json
from collections.abc import Callable, Iterator, Mapping
from functools import cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rhythmica.sources.tables import path_exists

# Folders of a project's data directory
TIERS = ("raw", "interim", "processed", "external")

#: Bytes of a file that one task reads, and that are in memory at a time, where files are read by range.
RANGE = 256 << 20
PIECE = 4 << 20

_STATES = pa.schema([("path", pa.string()), ("length", pa.int64()), ("state", pa.binary()), ("digest", pa.string())])


def list_data_files(spark: SparkSession, folder: str, extension: str = ".csv") -> DataFrame:
    """Path, size and time of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{extension}")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "length", "modificationTime")
    )


def list_tier(spark: SparkSession, project: str, tier: str = "processed", extension: str = ".csv") -> DataFrame:
    if tier not in TIERS:
        raise ValueError(f"unknown tier {tier!r}")
    return list_data_files(spark, f"{project}/data/{tier}", extension)


def file_digests(spark: SparkSession, folder: str, extension: str = ".csv") -> DataFrame:
    """MD5 of each file's content.

    Files up to ``RANGE`` bytes are a value each. MD5 is a chain over the content, so a larger file is read in rounds:
    a task reads one range and hands on the 92 bytes of the chain's state; a round is one job over all files that
    have not ended. Where the workers' OpenSSL does not show that state, one task reads a large file, in pieces. Where
    Arrow does not know the file system, Spark reads all files whole, up to ``spark.sql.sources.binaryFile.maxLength``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{extension}").option("recursiveFileLookup", True).load(folder)
    digests = files.select("path", "length", F.md5("content").alias("digest"))
    large = [tuple(r) for r in files.where(F.col("length") > RANGE).select("path", "length").collect()]  # fewer than bytes / RANGE
    if not large or not _by_range(large[0][0]):
        return digests
    ended, going, start = [], [(*r, None) for r in large], 0
    while going:
        rows = spark.createDataFrame(spark.sparkContext.parallelize(going, len(going)), "path string, length bigint, state binary")
        done = rows.mapInArrow(_next_range(start, RANGE), "path string, length bigint, state binary, digest string").collect()  # 92 bytes a file
        ended += [(r["path"], r["length"], r["digest"]) for r in done if r["digest"]]
        going = [(r["path"], r["length"], bytes(r["state"])) for r in done if not r["digest"]]
        start += RANGE
    return digests.where(F.col("length") <= RANGE).unionByName(spark.createDataFrame(ended, "path string, length bigint, digest string"))


class _Chain(ctypes.Structure):
    """The state of an MD5 sum as OpenSSL's md5.h declares it."""

    _fields_ = [("sums", ctypes.c_uint32 * 4), ("bits", ctypes.c_uint32 * 2), ("data", ctypes.c_uint32 * 16), ("num", ctypes.c_uint)]

    def update(self, piece: bytes) -> None:
        _openssl().MD5_Update(ctypes.byref(self), piece, ctypes.c_size_t(len(piece)))

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(16)
        _openssl().MD5_Final(out, ctypes.byref(self))
        return out.raw.hex()


@cache
def _openssl() -> ctypes.CDLL | None:
    """The library behind ``hashlib``, if an MD5 sum can be taken up again from the bytes of its state."""
    for name in ("libcrypto.so.3", "libcrypto.so.1.1", ctypes.util.find_library("crypto")):
        try:
            lib, chain, out = ctypes.CDLL(name or ""), _Chain(), ctypes.create_string_buffer(16)
            lib.MD5_Init(ctypes.byref(chain))
            lib.MD5_Update(ctypes.byref(chain), b"ab" * 50, ctypes.c_size_t(100))
            again = _Chain.from_buffer_copy(bytes(chain))
            lib.MD5_Update(ctypes.byref(again), b"c", ctypes.c_size_t(1))
            lib.MD5_Final(out, ctypes.byref(again))
        except (OSError, AttributeError):
            continue
        if out.raw == hashlib.md5(b"ab" * 50 + b"c").digest():
            return lib
    return None


def _open(path: str) -> pa.NativeFile:
    """A file by the path that Spark gives, in which blanks and the like stand as they are."""
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    scheme, _, rest = path.partition("://")
    host, _, name = rest.partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return system.open_input_file(f"{base.rstrip('/')}/{name}")


def _by_range(path: str) -> bool:
    try:
        _open(path).close()
    except (pa.ArrowException, OSError):
        return False
    return True


def _next_range(start: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = _openssl()
        for batch in batches:
            for row in batch.to_pylist():
                stop = row["length"] if lib is None else min(start + size, row["length"])
                # a state was made where there is a library; without one here, the sum starts again
                at, chain = (0, hashlib.md5()) if lib is None else (start, _Chain())
                if lib is not None and row["state"] is None:
                    lib.MD5_Init(ctypes.byref(chain))
                elif lib is not None:
                    chain = _Chain.from_buffer_copy(row["state"])
                with _open(row["path"]) as file:
                    file.seek(at)
                    while at < stop:
                        piece = file.read(min(PIECE, stop - at))
                        if not piece:
                            raise OSError(f"{row['path']} has become shorter")
                        chain.update(piece)
                        at += len(piece)
                ended = at >= row["length"]
                state, digest = (None, chain.hexdigest()) if ended else (bytes(chain), None)
                yield pa.RecordBatch.from_pylist([{"path": row["path"], "length": row["length"], "state": state, "digest": digest}], _STATES)

    return run


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-free content fingerprint of a table: row count plus two combinations of row hashes.

    The sum notices repeated rows, which cancel out in the exclusive or. The hash of a row is the MD5 of
    its columns as text, each after its length (a null: -1), so that no two rows read alike; all 128
    bits count, in four parts of 32. Other engines can compute it too.
    """
    cells = [F.col(c).cast("string") for c in df.columns]
    text = F.concat(*[F.coalesce(F.concat(F.char_length(c).cast("string"), F.lit(":"), c), F.lit("-1:")) for c in cells]) if cells else F.lit("")
    digest = F.md5(text)
    parts = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k}") for k in range(4)]
    sums = [F.coalesce(F.sum(F.col(f"h{k}").cast("decimal(38,0)")), F.lit(0)).cast("string") for k in range(4)]
    return df.select(*parts).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.concat_ws("-", *[F.coalesce(F.bit_xor(f"h{k}"), F.lit(0)).cast("string") for k in range(4)]).alias("xor_hash"),
        F.concat_ws("-", *sums).alias("sum_hash"),
    )


def fingerprint_key(df: DataFrame) -> str:
    row = table_fingerprint(df).first()  # one row
    return f"{row['n_rows']}-{row['xor_hash']}-{row['sum_hash']}"


def listing_key(spark: SparkSession, folder: str, extension: str = ".parquet") -> str:
    """A cheaper cache key: names, sizes and times of the files, contents unread."""
    return fingerprint_key(list_data_files(spark, folder, extension))


def cached_features(
    source: DataFrame, build: Callable[[DataFrame], DataFrame], folder: str, name: str, force: bool = False, key: str | None = None,
    params: Mapping | None = None,
) -> DataFrame:
    """Stored features while the source, its schema and ``params`` are unchanged, rebuilt otherwise.

    ``key`` defaults to the content fingerprint of the source; ``params`` are what the features depend on
    besides the source, such as lags and windows.
    """
    spark = source.sparkSession
    made = hashlib.sha256(json.dumps([source.schema.jsonValue(), dict(params or {})], sort_keys=True, default=str).encode()).hexdigest()[:32]
    path = f"{folder.rstrip('/')}/{name}_{key or fingerprint_key(source)}_{made}.parquet"
    # a folder without _SUCCESS is a write that was cut short
    if force or not path_exists(spark, f"{path}/_SUCCESS"):
        build(source).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
