"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rhythmica.llm import alignment, bagminhash, bpe, collocations, ctw, flatgraph, linefirst, packing, quality, sharding, toxicity, vafile, warc
from rhythmica.session import utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(utc(spark), sf_dir)
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query("op7_byte_bpe")
def op7(spark, sf_dir):
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.encode(load(spark, sf_dir, "documents"), path, pattern, with_decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def remainder(modulus: int):
    """crc32 of the id's text by ``modulus``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@query("op5_context_tree_weighting")
def op5(spark, sf_dir):
    scored = ctw.score(load(spark, sf_dir, "documents"), remainder(10) != 0)
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op8_bagminhash_near_dedup")
def op8(spark, sf_dir):
    return bagminhash.near_classes(load(spark, sf_dir, "documents"))


@query("op4_quadratic_quality")
def op4(spark, sf_dir):
    scored = quality.score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), remainder(4) != 2)
    return scored.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op10_toxicity_chain")
def op10(spark, sf_dir):
    return toxicity.score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op1_best_fit_packing")
def op1(spark, sf_dir):
    return packing.pack_documents(load(spark, sf_dir, "documents"))


@query("op2_balanced_label_propagation")
def op2(spark, sf_dir):
    placed = sharding.balanced_shards(load(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# floor(256 * x) as whole numbers; the SQL scores every pair
TOP_5 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""


@query("op9_vector_approximation_top_k", TOP_5)
def op9(spark, sf_dir):
    return vafile.top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


# what the archives must give back, from the pages themselves
WARC_ROWS = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN least END AS refers_to
FROM f"""


@query("op3_warc_capture_index", WARC_ROWS)
def op3(spark, sf_dir):
    return warc.archive_and_read(load(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_flat_graph_near_dedup")
def op6(spark, sf_dir):
    return flatgraph.near_vectors(load(spark, sf_dir, "embeddings"))


@query("op11_line_first_cleaning", linefirst.SQL)
def op11(spark, sf_dir):
    return linefirst.clean_lines(load(spark, sf_dir, "documents")).drop("clean_text")


@query("op12_phrase_collocations", collocations.SQL)
def op12(spark, sf_dir):
    return collocations.collocations(load(spark, sf_dir, "documents"))


@query("op13_cross_tokenizer_alignment")
def op13(spark, sf_dir):
    import public_tokenizers

    return alignment.align(load(spark, sf_dir, "documents"), *map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")), public_tokenizers.PATTERN)


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
