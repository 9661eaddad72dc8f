"""Session helpers: a local session for tests, and the shared scratch folder of a cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rhythmica")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "localhost")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone, so that calendar parts do not depend on the host."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_base: str | None = None


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent (a local test session) a local temporary folder stands in.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _local_base = _local_base or tempfile.mkdtemp(prefix="rhythmica-")
        base = _local_base
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def settled(df, purpose: str):
    """Write ``df`` to the shared folder and read it back.

    For results that several later jobs read: the plan behind them runs once, and a lost executor
    costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
