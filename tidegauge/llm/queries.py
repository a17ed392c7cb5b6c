"""One query per operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, exact, language, licenses, manifest, packing, pieces, pii, quality, sharding, simhash, toxicity, warc
from .oracles import DIVERGENCE_SQL, MANIFEST_SQL

#: The key of the registered queries. Real data need one from a secret store.
SAMPLE_KEY = "sample key, not a secret"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC archives, converted, written as WARC and read back. The page's id travels in the URL's fragment."""
    pages = table(spark, sf_dir, "pages")
    uri = F.concat(F.coalesce("url", F.lit("-")), F.lit("#page="), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    archives = warc.archived(pages.select(uri.alias("uri"), "html"), "uri", "html")
    records = warc.converted(archives).withColumn("page_id", F.regexp_extract("uri", r"#page=(-?[0-9]*)$", 1))
    records = records.withColumn("page_id", F.when(F.col("page_id") != "", F.col("page_id").cast("long")))
    path = warc.write_warc(warc.with_revisits(records, "page_id"), "page_id")
    back = warc.read_warc(spark, path, payload=False)
    return back.select(F.col("key").alias("page_id"), "payload_bytes", F.col("payload_sha1").alias("payload_digest"), "record_type", "refers_to")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def packed(docs: DataFrame) -> DataFrame:
    pieces_ = packing.pack(docs, vocabulary("byte_bpe_50k.json"))
    return pieces_.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", pii.pii_counts(F.col("text")).alias("n_found"))
    return pii.pseudonymise(docs, SAMPLE_KEY)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pieces.round_trips(docs, model)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_warc, op2_licenses, op3_quality, op4_packing, op5_sharding, op6_pii, op7_simhash, op8_toxicity, op9_exact, op10_pieces, op11_language, op12_divergence, op13_manifest, pipeline)
    return {query.__name__: query for query in found}


WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
r AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest,
             max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM r
"""

EXACT_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t,
                  row_number() OVER () AS n FROM documents),
g AS (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
             row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST, n) AS place FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM g
"""


def llm_oracles() -> dict[str, str]:
    """SQL where it gives all of a query's columns; the others have columns that SQL has no word for."""
    return {"op1_warc": WARC_SQL, "op9_exact": EXACT_SQL, "op12_divergence": DIVERGENCE_SQL, "op13_manifest": MANIFEST_SQL}
