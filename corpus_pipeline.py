"""Corpus pipeline: toxicity, exact and near de-duplication, secrets and packing of ``documents``.

Every stage reads what the one before has kept and written.  Rows with a null
``doc_id`` pass the filters by their texts like any others; columns other than
``text`` (which the secret stage edits, with ``n_chars``) stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm import exact_dedup, near_dedup, packing, secrets, toxicity
from trackline.llm.common import doc_text, read_table, write_shared
from trackline.llm.queries import vocabulary


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go; it learns from four fifths of ``labels``."""
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.is_held_out()))
    return docs.where(toxicity.scorer(model)(doc_text()) < 0.5)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest doc_id."""
    verdicts = exact_dedup.exact_duplicates(docs)
    dropped = verdicts.where("not kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_hash")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_id")) & (F.sha2(doc_text().cast("binary"), 256) == F.col("_hash"))
    return docs.join(dropped, same, "left_anti").select(docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest doc_id."""
    dropped = near_dedup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; all documents stay."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.when(F.contains("text", F.lit(secrets.MASK)), F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars"))).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their places in sequences."""
    made = write_shared(packing.pieces(docs, vocabulary("word_bpe_49k.json")), "pieces")
    return packing.pack(made)


STAGES = [("toxicity", toxicity_stage), ("exact dedup", exact_stage), ("near dedup", near_stage), ("secrets", secret_stage),
          ("packing", packing_stage)]

#: SQL cannot express the classifier, the forest, MinHash links or tokenisation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
