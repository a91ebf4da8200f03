"""Turning ranked chunks into prompts, citations and live status, for a table of questions at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.flights import FLIGHT_ID_PATTERN, LIVE_STATUS_FIELDS
from opsledger.functions.text import citation, excerpt, extract_first
from opsledger.operators.skew import lookup_join
from opsledger.session import materialize

PROMPT_HEAD = "Answer the question in one or two sentences, using only the excerpts below.\n\nExcerpts:\n"
PROMPT_QUESTION = "\n\nQuestion: "
PROMPT_TAIL = "\nAnswer:"


def fetch_chunks(ranked: DataFrame, chunks: DataFrame, query_id: str = "query_id", item_id: str = "chunk_id") -> DataFrame:
    """Ranked rows with the columns of their chunk.

    Joined by id. Chunks wanted by very many questions are spread over tasks; Spark sends a short
    ranking to the chunks by its own size estimate of the written ranking.
    """
    return lookup_join(materialize(ranked), chunks, item_id, F.col(query_id), "inner")


def build_context(
    questions: DataFrame, fetched: DataFrame, query_id: str = "query_id", question: str = "query"
) -> DataFrame:
    """Per question: numbered context, prompt, and citations with excerpts, in rank order.

    `fetched` holds the few chunks kept per question (rank, doc_title, section_title, text).
    """
    entry = F.struct(
        "rank",
        "text",
        citation(F.col("doc_title"), F.col("section_title")).alias("citation"),
        excerpt(F.col("text")).alias("excerpt"),
    )
    per_query = fetched.groupBy(query_id).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    numbered = F.transform(
        "_entries", lambda e, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), e["text"])
    )
    joined = questions.select(query_id, question).join(per_query, query_id, "left")
    context = F.coalesce(F.array_join(numbered, "\n\n"), F.lit(""))
    return joined.withColumn("context", context).select(
        query_id,
        question,
        "context",
        F.concat(F.lit(PROMPT_HEAD), "context", F.lit(PROMPT_QUESTION), question, F.lit(PROMPT_TAIL)).alias("prompt"),
        F.coalesce(
            F.transform("_entries", lambda e: F.struct(e["citation"].alias("citation"), e["excerpt"].alias("excerpt"))),
            F.array().cast("array<struct<citation:string,excerpt:string>>"),
        ).alias("citations"),
    )


def lookup_extracted_key(
    questions: DataFrame,
    state: DataFrame,
    key: str,
    question: str = "query",
    query_id: str = "query_id",
    pattern: str = FLIGHT_ID_PATTERN,
    fields: Sequence[str] = tuple(LIVE_STATUS_FIELDS),
) -> DataFrame:
    """Add the state row whose key the question mentions first, as `live_status`; NULL without one."""
    keyed = questions.withColumn("_key", extract_first(F.col(question), pattern))
    row = state.select(F.col(key).alias("_key"), F.struct(*fields).alias("live_status"))
    return lookup_join(keyed, row, "_key", F.col(query_id), "left").drop("_key")
