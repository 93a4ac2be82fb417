"""A training-data pipeline over ``documents``: five stages, each one operator of ``vecspark.llm``.

Every stage reads what the one before wrote as Parquet, works on all of it and returns it
with its decisions applied. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vecspark.llm import bpe, decontaminate, secrets, simhash, toxicity
from vecspark.llm.common import small_batches
from vecspark.llm.queries import table, toxicity_model, vocabulary
from vecspark.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.3 by the classifier that op10 trains."""
    return toxicity.reject(docs, toxicity_model(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that with the smallest doc_id.

    Texts are linked by op8's operator on shingles of five words: fingerprints within 4 of 64 bits, and
    sets of shingles of a similarity of 0.8 or more, as their sketches estimate it (README: measured recall).
    """
    small_batches(spark)
    return simhash.keep_one(docs, shingle=5, similar=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth lie in benchmark windows."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret. ``n_chars`` follows the text."""
    masked = secrets.mask(docs)
    changed = F.length("text") if "n_chars" in docs.columns else None
    return masked if changed is None else masked.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed as op3 packs them) and the hash of the decoded bytes.

    The decoded bytes are compared with the text by their SHA-256; a difference raises.
    """
    voc = vocabulary()
    small_batches(spark)
    own = F.struct("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha")).alias("row")
    encoded = bpe.decode(bpe.encode(docs.select(own, "text"), voc, key="row"), voc)
    decoded = F.sha2("decoded", 256)
    differs = F.raise_error(F.concat(F.lit("ids do not decode to the text of doc_id "), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null"))))
    return encoded.select(
        F.col("row.doc_id").alias("doc_id"), F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.when(decoded == F.col("row.sha"), decoded).otherwise(differs.cast("string")).alias("text_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("encoding", encode),
]

#: A trained classifier, fingerprint links and byte pairs have no SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
