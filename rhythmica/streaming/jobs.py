"""Streaming validation, scoring, accuracy windows and lag features.

All jobs read any streaming DataFrame. State that must survive a lost executor lives in the query's
checkpoint folder or in tables next to it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from rhythmica.functions import metrics as M
from rhythmica.operators.features import history_columns
from rhythmica.operators.layout import with_windows
from rhythmica.operators.validate import Rule, failing_rows, passing
from rhythmica.sources.tables import is_folder, path_exists


def file_stream(spark: SparkSession, path: str, like: DataFrame, pattern: str | None = None, max_files: int | None = None) -> DataFrame:
    """A stream over the Parquet files of a folder, with the schema of a batch table.

    A table may also be one file: it is read from its folder by its name, since file streams start at folders.
    """
    if pattern is None and not is_folder(spark, path):
        path, pattern = path.rsplit("/", 1)
    reader = spark.readStream.schema(like.schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query; a failed query raises."""
    query.awaitTermination()


def validate_and_score(
    stream: DataFrame, rules: Sequence[Rule], score: Callable[[DataFrame], DataFrame], good: str, bad: str, checkpoint: str
) -> StreamingQuery:
    """Rows that pass go through ``score`` to one table, the others with the broken rules to a side table.

    Each micro-batch overwrites its own folder, so a repeated batch leaves no duplicates.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        score(batch.filter(passing(rules))).write.mode("overwrite").parquet(f"{good}/batch={batch_id}")
        failing_rows(batch, rules).write.mode("overwrite").parquet(f"{bad}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def accuracy_windows(
    stream: DataFrame, ts: str, y: str, p: str, by: Sequence[str] = (), size: str = "1 day", slide: str | None = None, late: str = "1 hour",
    alert_over: float | None = None,
) -> DataFrame:
    """MAPE and RMSE per event-time window and group; rows later than the watermark are dropped.

    Works on a streaming table and, for checks, on a batch one.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark(ts, late)
    span = F.window(ts, size, slide) if slide else F.window(ts, size)
    out = timed.groupBy(span.alias("w"), *by).agg(
        F.count(F.lit(1)).alias("n"), M.mape(y, p).alias("mape"), M.rmse(y, p).alias("rmse")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n", "mape", "rmse")
    return out if alert_over is None else out.withColumn("alert", (F.col("mape") > alert_over).cast("int"))


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def emit_to(df: DataFrame, path: str, checkpoint: str, mode: str = "update", trigger: dict | None = None) -> StreamingQuery:
    """Windows as they change, also those still open when the input ends; ``last_values`` reads them back.

    ``mode``: update or complete; ``trigger``: the arguments of a Spark trigger, ``availableNow`` by default.
    Each micro-batch overwrites its own folder, so a repeated batch leaves no duplicates.
    """
    if mode not in ("update", "complete"):
        raise ValueError(f"unknown mode {mode!r}: append never emits open windows")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    return query.trigger(**({"availableNow": True} if trigger is None else trigger)).start()


def last_values(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """Per key the row that the last micro-batch with it wrote to ``path``."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(path)
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*schema.names), "batch").alias("_row"))
    return last.select("_row.*")


def online_lags(
    stream: DataFrame,
    series: Sequence[str],
    order_by: Sequence[str],
    target: str,
    lags: Sequence[int],
    out: str,
    state: str,
    checkpoint: str,
    windows: Sequence[int] = (),
    late_after: str | None = None,
    compact_every: int = 20,
) -> StreamingQuery:
    """Lag features for a stream: per micro-batch the rows are joined by the last rows of their series
    seen before, and the ordinary (split-safe) window columns are computed.

    The state is a log of tail rows: a batch appends at most k rows per series it touched, and every
    ``compact_every`` batches the log is rewritten to the last k rows per series. Batches write into
    folders named by their number, so a repeated batch replaces itself. With ``late_after`` rows whose
    time lies further than that before the newest time of earlier batches are left out.
    """
    build, reach = history_columns(target, list(lags), list(windows))
    time = order_by[0]
    newest_first = Window.partitionBy(*series).orderBy(*[F.col(c).desc() for c in order_by])

    def last_rows(df: DataFrame) -> DataFrame:
        return df.withColumn("_r", F.row_number().over(newest_first)).filter(F.col("_r") <= reach).drop("_r")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # the newest complete snapshot below this batch, then the logs after it
        base = next((b for b in reversed(range(0, batch_id, compact_every)) if path_exists(spark, f"{state}/snapshot-{b}/_SUCCESS")), None)
        first_log = 0 if base is None else base
        logs = [f"{state}/tail-{b}" for b in range(first_log, batch_id) if path_exists(spark, f"{state}/tail-{b}/_SUCCESS")]
        paths = ([f"{state}/snapshot-{base}"] if base is not None else []) + logs
        kept = batch.select(*dict.fromkeys([*series, *order_by, target]))
        known = spark.read.schema(kept.schema).parquet(*paths) if paths else None
        if known is not None and late_after:
            newest = known.agg(F.max(time)).scalar()
            batch = batch.filter(F.col(time) >= newest - F.expr(f"interval {late_after}"))
            kept = kept.filter(F.col(time) >= newest - F.expr(f"interval {late_after}"))
        rows = batch.withColumn("_new", F.lit(True))
        if known is not None:
            touched = kept.select(*series).distinct()
            tails = last_rows(known.join(touched, list(series), "left_semi")).withColumn("_new", F.lit(False))
            rows = rows.unionByName(tails, allowMissingColumns=True)
        featured = with_windows(rows, series, order_by, build, reach).filter("_new").drop("_new")
        featured.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        last_rows(kept).write.mode("overwrite").parquet(f"{state}/tail-{batch_id}")
        if batch_id % compact_every == 0 and known is not None:
            # everything before this batch; this batch's own log follows the snapshot
            last_rows(known).write.mode("overwrite").parquet(f"{state}/snapshot-{batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
