"""The operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.llm import (
    cross_polytope,
    edit_counts,
    filter_audit,
    label_shards,
    language_id,
    near_dup,
    packing,
    periodic_runs,
    pii,
    piece_tokens,
    quality_rules,
    suffix_tree,
    zstd_quality,
)
from opsledger.llm.oracle import ORACLE  # noqa: F401  (read with the queries)
from opsledger.llm.tables import fold, read


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, folder, "documents"), near_dup.Rule(size=2))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.verdicts(read(spark, folder, "documents")).withColumn("host_rate", F.round("host_rate", 6))


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return suffix_tree.learn_and_score(docs.select("doc_id", (fold() == 1).alias("held_out"), "text"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = language_id.learn(docs.filter(fold() != 0))
    return language_id.predict(docs.select("doc_id", (fold() == 0).alias("held_out"), "text"), model).drop("text")


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = zstd_quality.learn(docs, read(spark, folder, "labels").filter(fold() != 0))
    return zstd_quality.predict(docs.select("doc_id", (fold() == 0).alias("held_out"), "text"), model).drop("text")


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Three edits in each document: its first character goes, words come in at half, its end is replaced."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    n = F.coalesce(F.length("text"), F.lit(0))

    def edit(start, length, text):
        return F.struct(start.cast("long").alias("start"), length.cast("long").alias("length"), F.lit(text).alias("text"))

    edits = F.array(
        edit(F.lit(0), F.lit(1), ""),
        edit(F.floor(n / 2), F.lit(0), " and it's some 12 new words\n"),
        edit(F.greatest(n + 15, F.lit(0)), F.lit(12), " the end."),
    )
    return edit_counts.count(docs.withColumn("edits", edits))


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return piece_tokens.encode_decode(read(spark, folder, "documents")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(read(spark, folder, "documents"))
    counts = [pii.counted("base", k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(pii.written("base"), 256).alias("base_sha256"), pii.written("spans").alias("spans"))


def op9_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return cross_polytope.near_vectors(read(spark, folder, "embeddings"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"))


def _replanted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, by crc32 of the id, the words from some place on repeat with some period.

    A null id counts as the empty text.
    """
    code = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    chosen = (code % 10 == 0) & F.col("text").isNotNull()
    split = F.when(chosen, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    # A generator, so that the words are split once and not again wherever they are used.
    words = docs.select("doc_id", "text", F.floor(code / 10).alias("g"), F.inline(F.array(F.struct(split.alias("ws")))))
    placed = words.withColumn("n", F.size("ws")).withColumn("a", F.when(F.col("n") > 0, F.pmod("g", "n")).cast("int"))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    cycle = F.slice("ws", F.col("a") + 1, F.col("p"))
    again = F.slice(F.flatten(F.array_repeat(cycle, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    text = F.array_join(F.concat(F.slice("ws", F.lit(1), F.col("a")), again), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find(_replanted(read(spark, folder, "documents").select("doc_id", "text")))
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period")))
    written = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    longest = found.withColumn("best", F.array_max(ranked)).withColumn("lines", F.array_join(F.transform(written, lambda line: F.concat(line, F.lit("\n"))), ""))
    return longest.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = label_shards.shard_documents(read(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard")
    )


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit_documents(read(spark, folder, "documents"), read(spark, folder, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_language_id": op4_language_id,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_token_counts": op6_token_counts,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_pii": op8_pii,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_packing": op10_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_sharding": op12_sharding,
    "op13_filter_audit": op13_filter_audit,
}
