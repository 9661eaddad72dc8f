"""A corpus through the operators: quality, toxicity, near-duplicates, packing.

Each stage takes the documents that the one before kept, and its decisions take effect; all but the last
return the columns of documents. Decisions are made for rows, not for ids: rows without an id and rows
that share one are judged each on its own text. A classifier that could not be fitted, for want of labels
of both classes, keeps all. Of the rows of a near-duplicate class the one with the smallest id stays (rows without
an id last; of equal ids any one); rows without words stay, each as its own class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rhythmica.llm import bagminhash, packing, quality, toxicity
from rhythmica.session import settled, utc

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
OTHERS = ("lang", "source", "n_chars")


def _rows(scored: DataFrame, kept: str) -> DataFrame:
    return scored.where(f"{kept} OR NOT fitted").select("doc_id", "text", "others.*").select(*COLUMNS)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _rows(quality.score(docs, labels, others=OTHERS), "predicted = 1")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _rows(toxicity.score(docs, labels, others=OTHERS), "predicted = 0")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    numbered = settled(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "numbered")  # numbered once, as written
    classes = bagminhash.near_classes(numbered, id_col="_row").select(F.col("doc_id").alias("_row"), "class_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    first = numbered.select("doc_id", "_row").join(classes, "_row").groupBy("class_id").agg(F.min(order)["_row"].alias("_row"))
    return numbered.join(first.select("_row").hint("merge"), "_row", "left_semi").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("quality", good_quality), ("toxicity", not_toxic), ("near_dedup", one_of_each), ("packing", packed)]

#: The models and the packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = utc(spark).read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
