"""CSV and Parquet tables in, CSV, Parquet and predictions out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the file system Spark would use for the path."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.globStatus(jpath))


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV or Parquet by suffix."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    if path.rstrip("/").endswith(".csv"):
        reader = spark.read.option("header", True)
        return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    raise ValueError(f"unsupported file format: {path}")


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, date_column: str | None = None, date_format: str | None = None
) -> DataFrame:
    """CSV with a declared schema; the date column is parsed and renamed ``date``."""
    df = spark.read.option("header", True).schema(schema).csv(path)
    if date_column is None:
        return df
    parsed = F.try_to_timestamp(F.col(date_column), F.lit(date_format)) if date_format else F.col(date_column).try_cast("timestamp")
    return df.withColumn(date_column, parsed).withColumnRenamed(date_column, "date")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_predictions(df: DataFrame, path: str, y: str = "y_true", p: str = "y_pred", by: Sequence[str] = ("split", "model")) -> None:
    """Truth, forecast and residual, one folder per split and model."""
    kept = [c for c in df.columns if c not in (y, p)]
    rows = df.select(*kept, F.col(y).alias("y_true"), F.col(p).alias("y_pred"), (F.col(y) - F.col(p)).alias("residual"))
    write_parquet(rows, path, by)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path in any store that Spark reads is a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()
