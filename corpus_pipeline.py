"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

Stages keep the columns of their input, extra ones and those named like a result included; an empty table stays
empty. Rows with null ids pass the near-duplicate stage; repeated rows of an id leave it as one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.llm import language_id, near_dup, packing, pii, quality_rules
from opsledger.llm.tables import fold, materialize, shield
from opsledger.session import checkpoint_dir

# Stages with learned models and near copies have no SQL form; the tests hold the stages against plain code.
ORACLE_SQL = None
# A language is rejected as unsure only below this score.
UNSURE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or torn between languages with a low score, go."""
    own, back = shield(docs, [*language_id.RESULTS, "has_letter"])
    model = language_id.learn(own.filter(fold() != 0))
    found = language_id.predict(own, model)
    if not model.languages:
        return docs
    unsure = (F.col("lang_pred") == language_id.UNKNOWN) | (F.col("ambiguous") & (F.col("score") < UNSURE))
    return back(found.filter(~unsure))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule, or the rules their host is held to, go."""
    own, back = shield(docs, [*quality_rules.MEASURES, "base_failed", "kept", "host", "host_rate", "host_failed"])
    return back(quality_rules.judge(materialize(quality_rules.measure(own))).filter("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, 0.8) the document with the smallest id stays."""
    kept = near_dup.near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(docs.columns).unionByName(docs.filter("doc_id is null"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind in brackets; n_chars follows the text."""
    own, back = shield(docs, ["base", "proposed", "spans", "_clean"])
    found = materialize(pii.candidates(own))
    clean = back(pii.redact(pii.select(found, pii.learn(found))))
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [("language", language), ("quality", quality), ("near_dedup", near_dedup), ("privacy", privacy), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
