"""Best-k items per query, without forming query-item pairs in Spark.

Items stream through `mapInArrow`; each task scores a slice of items against all queries at once
and keeps k per query, so what is shuffled is k rows per query and task. That needs the queries in
every task, so they are counted first and taken in blocks of a bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsledger.session import materialize

MAX_QUERIES = 2_000
MAX_QUERY_BYTES = 64 << 20
CELLS = 500_000

# From the query table to a function giving an (items x queries) matrix; larger is better and
# -inf means "not a candidate".
Scores = Callable[[pa.RecordBatch], np.ndarray]
MakeScorer = Callable[[pa.Table], Scores]


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Mask of the k best rows per column; among equal scores the earlier rows win."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k, axis=0)[len(scores) - k]
        above = scores > kth
        level = scores == kth
        chosen = above | (level & (np.cumsum(level, axis=0) <= k - above.sum(axis=0)))
    else:
        chosen = np.ones(scores.shape, dtype=bool)
    return chosen & (scores > -np.inf)


class _Best:
    """The k best (item, score) per query of everything added so far."""

    def __init__(self, k: int, n_queries: int) -> None:
        self.k, self.limit = k, max(CELLS, 4 * k * n_queries)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, scores = ids[order], scores[order]
        item, query = np.nonzero(best_of(scores, self.k))
        self.parts.append((query, ids[item], scores[item, query]))
        self.size += len(query)
        if self.size > self.limit:
            self._fold()

    def _fold(self) -> None:
        query, ids, scores = (np.concatenate(column) for column in zip(*self.parts))
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        first = np.searchsorted(query, query, side="left")
        kept = np.arange(len(query)) - first < self.k
        self.parts = [(query[kept], ids[kept], scores[kept])]
        self.size = int(kept.sum())

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.array([], dtype=int), np.array([]), np.array([])
        self._fold()
        return self.parts[0]


def _scan(queries: pa.Table, batches: Iterator[pa.RecordBatch], make: MakeScorer, qid: str, iid: str, k: int) -> pa.Table | None:
    if not queries.num_rows:
        return None
    score, best = make(queries), _Best(k, queries.num_rows)
    step = max(k, CELLS // queries.num_rows)
    id_type = None
    for batch in batches:
        id_type = batch.schema.field(iid).type
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            best.add(part.column(iid).to_numpy(zero_copy_only=False), score(part))
    query, ids, scores = best.rows()
    if not len(query):
        return None
    return pa.table(
        {qid: queries.column(qid).combine_chunks().take(pa.array(query)), iid: pa.array(ids, type=id_type), "score": scores}
    )


def topk_scan(
    queries: DataFrame,
    items: DataFrame,
    query_id: str,
    item_id: str,
    k: int,
    make: MakeScorer,
    bytes_of,
    max_queries: int = MAX_QUERIES,
    max_bytes: int = MAX_QUERY_BYTES,
) -> DataFrame:
    """(query_id, item_id, score, rank): rank counts from 0; equal scores rank by item id.

    Queries are taken in blocks whose number follows from their count and size; every block scans the
    items once. One block at a time is on the driver and in the tasks.
    """
    field = lambda df, c: f"`{c}` {df.schema[c].dataType.simpleString()}"
    schema = f"{field(queries, query_id)}, {field(items, item_id)}, score double"
    scan = partial(_scan, make=make, qid=query_id, iid=item_id, k=k)
    context = queries.sparkSession.sparkContext
    rows, size = queries.agg(F.count("*"), F.coalesce(F.sum(bytes_of), F.lit(0))).first()
    blocks = max(1, math.ceil(rows / max_queries), math.ceil(size / max_bytes))

    def scanned(block: DataFrame) -> tuple[DataFrame, Broadcast]:
        shared = context.broadcast(block.toArrow())

        def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = scan(shared.value, batches)
            if found is not None:
                yield from found.to_batches()

        return items.mapInArrow(per_task, schema), shared

    if blocks == 1:
        candidates = scanned(queries)[0]
    else:
        parts = []
        for block in range(blocks):
            found, shared = scanned(queries.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == block))
            parts.append(materialize(found))
            shared.destroy()
        candidates = reduce(DataFrame.unionByName, parts)
    return rank_top(candidates, query_id, [F.col("score").desc(), F.col(item_id)], k)


def rank_top(df: DataFrame, query_id: str, order: list, k: int | None = None) -> DataFrame:
    """Add `rank` (from 0) within each query, keeping the first k."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(query_id).orderBy(*order)))
    if k is not None:
        ranked = ranked.where(F.col("rank") <= k)
    return ranked.withColumn("rank", F.col("rank") - 1)
