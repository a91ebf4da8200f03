"""Nearest neighbours over vectors, exact and approximate, and batch embedding."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.operators.slices import slices
from opsledger.operators.slices import words as split
from opsledger.operators.topk import MAX_QUERIES, rank_top, topk_scan

# Scores are compared at this many decimals so that equal vectors tie whatever batch they came in.
DECIMALS = 9
# Scores, or components of vectors, held at a time.
CELLS = 1_000_000
# Vectors of one part of a bucket, in bytes.
PART_BYTES = 16 << 20
# Text whose distinct words are hashed once, in bytes.
EMBED_BYTES = 4 << 20


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length == 0, 1.0, length)


def _vector_scorer(vector: str, metric: str):
    def make(queries: pa.Table):
        wanted = _matrix(queries.column(vector))
        wanted = _unit(wanted) if metric == "cosine" else wanted

        def score(batch: pa.RecordBatch) -> np.ndarray:
            have = _matrix(batch.column(vector))
            have = _unit(have) if metric == "cosine" else have
            result = have @ wanted.T
            if metric == "l2":
                result = 2 * result - (have**2).sum(axis=1)[:, None] - (wanted**2).sum(axis=1)[None, :]
            return np.round(result, DECIMALS) + 0.0

        return score

    return make


def is_sound(vector: str, dim: int) -> Column:
    """Whether a vector is there, has `dim` components, and all of them are numbers."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x))
    return F.coalesce((F.size(vector) == dim) & whole, F.lit(False))


def dimension(queries: DataFrame, vector: str) -> int:
    """The length of the query vectors; items of another length cannot be compared with them."""
    return queries.agg(F.coalesce(F.max(F.size(vector)), F.lit(0))).first()[0]


def unsound(vectors: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    """The rows that no search can use: null, of another length, or holding nulls or NaN."""
    return vectors.where(~is_sound(vector, dim))


def knn_topk(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    query_id: str = "query_id",
    item_id: str = "vec_id",
    vector: str = "embedding",
    metric: str = "l2",
    max_queries: int = MAX_QUERIES,
) -> DataFrame:
    """Exact k nearest items per query: (query_id, item_id, score, rank).

    `metric` is "l2" (score is the negated squared distance), "cosine" or "dot". Unsound vectors on
    either side take no part; `unsound` lists them.
    """
    dim = dimension(queries, vector)
    size = F.size(vector) * 8
    return topk_scan(
        queries.select(query_id, vector).where(is_sound(vector, dim)),
        vectors.select(item_id, vector).where(is_sound(vector, dim)),
        query_id,
        item_id,
        k,
        _vector_scorer(vector, metric),
        size,
        max_queries,
    )


def hyperplanes(tables: int, bits: int, dim: int) -> np.ndarray:
    """(tables * bits, dim) signs that any engine can compute again: 1 where md5('table:bit:i') starts below 8."""
    return np.array(
        [
            [1.0 if hashlib.md5(f"{t}:{b}:{i}".encode()).hexdigest()[0] < "8" else -1.0 for i in range(dim)]
            for t in range(tables)
            for b in range(bits)
        ]
    )


def _bucket_rows(planes: np.ndarray, tables: int, bits: int, columns: list[str], vector: str, probes: int = 0):
    """`columns` with the bucket of a vector in each table, and the `probes` buckets across the planes that it lies closest to."""
    flips = np.arange(1 << bits)
    crossed = (flips[:, None] >> np.arange(bits)) & 1
    each = min(probes + 1, len(flips))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits)
        for batch in batches:
            place = np.round(_matrix(batch.column(vector)) @ planes.T, DECIMALS).reshape(-1, tables, bits)
            bucket = ((place > 0) @ weights)[:, :, None]
            if each > 1:
                far = np.round((place**2) @ crossed.T, DECIMALS)
                far[:, :, 0] = -1.0
                bucket = bucket ^ np.argsort(far, axis=2, kind="stable")[:, :, :each]
            table, bucket = np.repeat(np.arange(tables, dtype=np.int32), each), bucket.astype(np.int32)
            step = max(1, CELLS // (tables * each * planes.shape[1]))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                rows = pa.array(np.repeat(np.arange(part.num_rows), tables * each))
                taken = [part.column(c).take(rows) for c in columns]
                places = [pa.array(np.tile(table, part.num_rows)), pa.array(bucket[start : start + step].ravel())]
                yield pa.RecordBatch.from_arrays(taken + places, names=[*columns, "table", "bucket"])

    return run


def _dealt(df: DataFrame, columns: list[str], vector: str, dim: int, tables: int, bits: int, probes: int = 0) -> DataFrame:
    """`columns` of the sound vectors with (table, bucket) of each bucket they are in."""
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)
    rows = _bucket_rows(hyperplanes(tables, bits, dim), tables, bits, columns, vector, probes)
    return df.select(*dict.fromkeys([*columns, vector])).where(is_sound(vector, dim)).mapInArrow(rows, f"{kinds}, table int, bucket int")


def _parts(dealt: DataFrame, part: int, name: str) -> DataFrame:
    """(table, bucket, name): into how many parts of about `part` rows each bucket is cut."""
    return dealt.groupBy("table", "bucket").agg(F.ceil(F.count("*") / part).cast("int").alias(name))


def _part_of(id_col: str, parts: str) -> Column:
    return F.pmod(F.xxhash64(id_col), F.col(parts)).cast("int")


def _every(parts: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))


def candidate_pairs(
    queries: DataFrame, vectors: DataFrame, query_id: str, item_id: str, vector: str, tables: int, bits: int, part: int = 100_000, probes: int = 0
) -> DataFrame:
    """Distinct (query_id, item_id) that share a bucket in some table; a query also visits `probes` near buckets of each.

    Buckets of more than `part` items are cut into parts that the queries visit one by one. There are
    tables * 2**bits buckets at most, so their sizes can be sent everywhere.
    """
    dim = dimension(queries, vector)
    items, asked = _dealt(vectors, [item_id], vector, dim, tables, bits), _dealt(queries, [query_id], vector, dim, tables, bits, probes)
    parts = F.broadcast(_parts(items, part, "_parts"))
    placed = items.join(parts, ["table", "bucket"]).withColumn("_part", _part_of(item_id, "_parts"))
    visits = asked.join(parts, ["table", "bucket"]).withColumn("_part", _every("_parts"))
    return visits.join(placed.drop("_parts"), ["table", "bucket", "_part"]).select(query_id, item_id).distinct()


def _scored_exactly(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """What `_score` gives for each row of `a` with the row of `b`."""
    if metric == "l2":
        return np.round(-((a - b) ** 2).sum(axis=1), DECIMALS) + 0.0
    product = (a * b).sum(axis=1)
    if metric == "cosine":
        size = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
        product = np.divide(product, size, out=np.zeros(len(a)), where=size != 0)
    return np.round(product, DECIMALS) + 0.0


def _best_in_bucket(query_id: str, item_id: str, vector: str, metric: str, k: int):
    """The k best items of a part of a bucket for each query that visits it, as (query, item, score)."""
    make = _vector_scorer(vector, metric)

    def run(asked: pa.Table, items: pa.Table) -> pa.Table:
        found = [pa.table({query_id: asked.column(query_id).slice(0, 0), item_id: items.column(item_id).slice(0, 0), "score": pa.array([], pa.float64())})]
        ids = items.column(item_id).to_numpy()
        step = max(1, CELLS // max(len(ids), 1))
        for start in range(0, asked.num_rows if len(ids) else 0, step):
            block = asked.slice(start, step)
            a, b = _matrix(block.column(vector)), _matrix(items.column(vector))
            rough = make(block)(items)
            # Products of matrices choose, with room for their rounding; what they choose is scored pair by pair.
            reach = 1.0 if metric == "cosine" else (np.abs(a).max(initial=0.0) + np.abs(b).max(initial=0.0)) ** 2 * a.shape[1]
            kth = np.partition(rough, len(ids) - k, axis=0)[len(ids) - k] if len(ids) > k else np.full(block.num_rows, -np.inf)
            query, item = np.nonzero((rough >= kth - 2e-9 - 1e-13 * reach).T)
            pairs = max(1, CELLS // a.shape[1])
            score = np.concatenate([_scored_exactly(a[query[i : i + pairs]], b[item[i : i + pairs]], metric) for i in range(0, len(query), pairs)])
            order = np.lexsort((ids[item], -score, query))
            query, item, score = query[order], item[order], score[order]
            kept = np.arange(len(query)) - np.searchsorted(query, query, side="left") < k
            found.append(pa.table({
                query_id: block.column(query_id).take(pa.array(query[kept])), item_id: items.column(item_id).take(pa.array(item[kept])), "score": pa.array(score[kept]),
            }))
        return pa.concat_tables(found)

    return run


def _score(a: Column, b: Column, metric: str) -> Column:
    def total(terms: Column) -> Column:
        return F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)

    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    if metric == "l2":
        gaps = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
        return F.round(-total(gaps), DECIMALS) + 0.0
    if metric == "dot":
        return F.round(total(product), DECIMALS) + 0.0
    square = lambda v: F.sqrt(total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))
    return F.round(F.coalesce(F.try_divide(total(product), square(a) * square(b)), F.lit(0.0)), DECIMALS) + 0.0


def knn_approx(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    query_id: str = "query_id",
    item_id: str = "vec_id",
    vector: str = "embedding",
    metric: str = "l2",
    tables: int = 12,
    bits: int = 6,
    probes: int = 4,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Like `knn_topk`, but only items that share a bucket of some table with the query are looked at.

    A table cuts space by `bits` hyperplanes through the origin; the query's own bucket and `probes` more are
    visited, those across the planes that it lies closest to. Items and visits meet by bucket in a grouped
    job that gives k rows per visit, so pairs are never rows: what is shuffled is each vector once per table, and
    each query once per visit. Buckets with more vectors than `part_bytes` hold are cut into parts on either side.
    """
    dim = dimension(queries, vector)
    part = max(1, part_bytes // (4 * max(dim, 1)))
    deal = lambda df, columns, probes=0: _dealt(df.where(F.col(columns[0]).isNotNull()), columns, vector, dim, tables, bits, probes)
    bucket = ["table", "bucket"]
    parts = F.broadcast(_parts(deal(vectors, [item_id]), part, "_parts").join(F.broadcast(_parts(deal(queries, [query_id], probes), part, "_turns")), bucket))
    items = deal(vectors, [item_id, vector]).join(parts, bucket).withColumn("_part", _part_of(item_id, "_parts")).withColumn("_turn", _every("_turns"))
    asked = deal(queries, [query_id, vector], probes).join(parts, bucket).withColumn("_turn", _part_of(query_id, "_turns")).withColumn("_part", _every("_parts"))
    key = [*bucket, "_part", "_turn"]
    kind = lambda df, c: f"`{c}` {df.schema[c].dataType.simpleString()}"
    best = _best_in_bucket(query_id, item_id, vector, metric, k)
    met = asked.drop("_parts", "_turns").groupBy(key).cogroup(items.drop("_parts", "_turns").groupBy(key)).applyInArrow(
        best, f"{kind(queries, query_id)}, {kind(vectors, item_id)}, score double"
    )
    # A pair may have met in several tables.
    scored = met.groupBy(query_id, item_id).agg(F.max("score").alias("score"))
    return rank_top(scored, query_id, [F.col("score").desc(), F.col(item_id)], k)


def embed(
    df: DataFrame, text_col: str, embed_fn: Callable[[Sequence[str]], np.ndarray], out: str = "embedding"
) -> DataFrame:
    """Add one vector per text. `embed_fn` sees a batch of texts and is set up once per task."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(list(np.asarray(embed_fn(texts.fillna("").tolist()), dtype=np.float32)))

    return df.withColumn(out, run(F.col(text_col)))


def _slots(dim: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [np.zeros(0, np.float32)]
            for start, length in slices(texts, EMBED_BYTES):
                row, word = split(texts.slice(start, length))
                codes = b"".join([hashlib.md5(w).digest() for w in word.dictionary.cast(pa.binary()).to_pylist()])
                # The first four of sixteen bytes, as a number.
                slot = np.frombuffer(codes, ">u4")[::4].astype(np.int64) % dim
                step = max(1, CELLS // dim)
                cells = row * dim + slot[word.indices.to_numpy()]
                edges = np.searchsorted(row, np.arange(0, length + step, step))
                for k, first in enumerate(range(0, length, step)):
                    n = min(step, length - first)
                    dense = np.bincount(cells[edges[k] : edges[k + 1]] - first * dim, minlength=n * dim).reshape(n, dim)
                    parts.append(_unit(dense.astype(float)).astype(np.float32).ravel())
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * dim), pa.array(np.concatenate(parts)))

    return run


def hashed(df: DataFrame, text_col: str, dim: int = 256, out: str = "embedding") -> DataFrame:
    """Add the model-free embedding: word counts hashed into `dim` slots, scaled to unit length.

    Texts go through Arrow batches; a word is hashed once per slice of a batch. A null text, and one without words, gives zeros.
    """

    slots = _slots(dim)

    @F.arrow_udf("array<float>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from slots(batches)

    return df.withColumn(out, run(F.lower(F.coalesce(F.col(text_col), F.lit("")))))
