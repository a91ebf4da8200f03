"""Combining rankings, reranking, and measuring what was retrieved."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.operators.topk import rank_top


def rrf(rankings: Sequence[DataFrame], query_id: str = "query_id", item_id: str = "doc_id", k: int = 60) -> DataFrame:
    """Reciprocal rank fusion: (query_id, item_id, fused_score, rank), nothing cut off.

    Each ranking has (query_id, item_id, rank from 0). Equal scores keep the order in which the
    items first appear when the rankings are read one after the other.
    """
    listed = [r.select(query_id, item_id, F.col("rank").alias("_rank"), F.lit(i).alias("_list")) for i, r in enumerate(rankings)]
    fused = reduce(DataFrame.unionByName, listed).groupBy(query_id, item_id).agg(
        F.sum(1.0 / (k + F.col("_rank") + 1)).alias("fused_score"),
        F.min(F.struct("_list", "_rank")).alias("_first"),
    )
    return rank_top(fused, query_id, [F.col("fused_score").desc(), F.col("_first")]).drop("_first")


def rerank(candidates: DataFrame, scorer: Column, n: int, query_id: str = "query_id", rank: str = "rank") -> DataFrame:
    """Keep the n best candidates per query by `scorer`; equal scores keep their order.

    `scorer` is any column: a built-in expression, or a pandas UDF running a model over batches.
    """
    scored = candidates.withColumn("rerank_score", scorer).withColumnRenamed(rank, "_before")
    return rank_top(scored, query_id, [F.col("rerank_score").desc(), F.col("_before")], n).withColumnRenamed(
        "_before", "candidate_rank"
    )


def evaluate_retrieval(
    ranked: DataFrame, query_id: str = "query_id", similarity: str = "similarity", threshold: float = 0.30, low: float = 0.5
) -> DataFrame:
    """Per query: share of chunks above `threshold`, mean similarity, count, the list, a low flag."""
    sim = F.col(similarity)
    listed = F.array_sort(F.collect_list(F.struct("rank", F.round(sim, 3).alias("s"))))
    return (
        ranked.groupBy(query_id)
        .agg(
            F.round(F.avg(F.when(sim > threshold, 1.0).otherwise(0.0)), 3).alias("context_precision"),
            F.round(F.avg(sim), 3).alias("avg_similarity"),
            F.count("*").alias("chunks_in_context"),
            F.transform(listed, lambda x: x["s"]).alias("per_chunk_scores"),
        )
        .withColumn("low_precision", F.col("context_precision") < low)
    )


def overall_retrieval(report: DataFrame) -> DataFrame:
    """Means over queries of the already rounded figures."""
    return report.agg(
        F.round(F.avg("context_precision"), 3).alias("avg_context_precision"),
        F.round(F.avg("avg_similarity"), 3).alias("avg_similarity"),
        F.count("*").alias("queries"),
    )
