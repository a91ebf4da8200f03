"""Building a retrieval index and answering a table of questions from it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.flights import KEY
from opsledger.functions.text import word_overlap
from opsledger.operators.answer import build_context, fetch_chunks, lookup_extracted_key
from opsledger.operators import bm25
from opsledger.operators.chunks import chunk_of, chunk_sections, corpus_order
from opsledger.operators.fusion import rerank, rrf
from opsledger.operators.knn import embed, hashed, knn_topk
from opsledger.sources.tables import read_documents, read_table, write_vectors

Embedder = Callable[[Sequence[str]], np.ndarray]


def build_index(spark: SparkSession, pattern: str, root: str, embedder: Embedder | None = None) -> None:
    """Chunk every matching markdown file and write both sides of the index under `root`."""
    docs = read_documents(spark, pattern)
    chunks = chunk_sections(docs, "slug", "text", F.col("file_name"))
    index_chunks(chunks, root, embedder)


def index_chunks(chunks: DataFrame, root: str, embedder: Embedder | None = None) -> None:
    """Write the vectors and the word index of chunks (chunk_id, doc_title, section_title, text) under `root`."""
    spark = chunks.sparkSession
    embedded = hashed(chunks, "text") if embedder is None else embed(chunks, "text", embedder)
    write_vectors(embedded, f"{root}/vectors")
    stored = read_table(spark, f"{root}/vectors").withColumn("position", corpus_order("chunk_id"))
    bm25.store(stored, "position", "text", f"{root}/words")


def search(
    questions: DataFrame, root: str, top_k: int = 10, rrf_k: int = 60, embedder: Embedder | None = None
) -> DataFrame:
    """(query_id, chunk_id, fused_score, rank) of dense and keyword search combined."""
    spark = questions.sparkSession
    vectors = read_table(spark, f"{root}/vectors").withColumn("position", corpus_order("chunk_id"))
    embedded = hashed(questions, "query") if embedder is None else embed(questions, "query", embedder)
    dense = knn_topk(embedded, vectors, top_k, item_id="position")
    sparse = bm25.search(questions, bm25.read(spark, f"{root}/words", "position"), top_k)
    fused = rrf([dense, sparse], item_id="position", k=rrf_k)
    return fused.withColumn("chunk_id", chunk_of("position")).drop("position")


def ask(
    questions: DataFrame,
    root: str,
    state: DataFrame | None = None,
    top_k: int = 8,
    top_n: int = 3,
    embedder: Embedder | None = None,
    scorer: Column | None = None,
) -> DataFrame:
    """Per question: context, prompt, citations, and the live status of a flight it names.

    `questions` has (query_id, query). `scorer` sees the columns query and text.
    """
    chunks = read_table(questions.sparkSession, f"{root}/vectors").drop("embedding")
    found = fetch_chunks(search(questions, root, top_k, embedder=embedder), chunks).join(questions, "query_id")
    best = rerank(found, word_overlap(F.col("query"), F.col("text")) if scorer is None else scorer, top_n)
    answered = build_context(questions, best)
    return answered if state is None else lookup_extracted_key(answered, state, KEY)
