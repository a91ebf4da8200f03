"""A stored vector index: trained cells, inverted lists with short codes, and exact scores for what the codes choose.

Training takes a bounded sample of the vectors (`SAMPLE` rows, by a hash of the id): k-means places the cells, whose number grows
with the root of the table up to `MAX_CELLS`, and a codebook for every pair of components. Every row is then indexed: it
goes to the list of its nearest cell with a code of one byte per pair, an eighth of its vector at four bytes a
component. Lists lie in folders of neighbouring cells, sorted by cell, so a search opens only the cells it probes.

How many cells a search probes is measured when the index is built: for `TUNED` rows the true neighbours are found by an exact scan,
and probes are what their cells need to cover the wanted share of them. Queries meet the lists by cell in
a shuffle of codes; lists and queries of a full cell are cut into parts and blocks. What the codes choose, a few
times k per query, is compared in full. Rows whose vector cannot be compared are not indexed (`knn.unsound` lists them).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.operators.knn import _matrix, _score, dimension, is_sound, knn_topk
from opsledger.operators.topk import rank_top
from opsledger.session import materialize

SAMPLE = 65_536
MAX_CELLS = 4096
TUNED = 200
CODES = 64
ROUNDS = 12
SHELVES = 64
# Rows of a list, and queries, that meet in one group; scores held at a time in it.
PART, BLOCK, CELLS = 50_000, 10_000, 8_000_000


@dataclass(frozen=True)
class VectorIndex:
    """The lists (id, vector, cell, code), their sizes, the trained places, and the number of cells a search probes."""

    lists: DataFrame
    sizes: DataFrame
    centroids: np.ndarray
    codebooks: np.ndarray
    probes: int
    item_id: str
    vector: str


def _distances(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Squared distances but for the part that is the same for all places."""
    return (places**2).sum(axis=1)[None, :] - 2 * rows @ places.T


def _nearest(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    step = max(1, CELLS // max(len(places), 1))
    return np.concatenate([_distances(rows[i : i + step], places).argmin(axis=1) for i in range(0, len(rows), step)] or [np.empty(0, int)])


def kmeans(rows: np.ndarray, wanted: int, rounds: int = ROUNDS, seed: int = 0) -> np.ndarray:
    """At most `wanted` centres of `rows`; a centre that loses all rows stays where it was."""
    distinct = np.unique(rows, axis=0)
    centres = distinct[np.random.default_rng(seed).permutation(len(distinct))[:wanted]].copy()
    for _ in range(rounds if len(centres) < len(distinct) else 0):
        own = _nearest(rows, centres)
        count = np.bincount(own, minlength=len(centres))
        order = np.argsort(own, kind="stable")
        sums = np.add.reduceat(rows[order], (np.cumsum(count) - count)[count > 0], axis=0)
        centres[count > 0] = sums / count[count > 0, None]
    return centres


def _pairs(rows: np.ndarray) -> np.ndarray:
    """(rows, parts, 2): components two by two; an odd last one meets a zero."""
    if rows.shape[1] % 2:
        rows = np.pad(rows, ((0, 0), (0, 1)))
    return rows.reshape(len(rows), -1, 2)


def _codebooks(rows: np.ndarray) -> np.ndarray:
    parts = _pairs(rows)
    books = np.full((parts.shape[1], CODES, 2), np.inf)
    for j in range(parts.shape[1]):
        made = kmeans(parts[:, j], CODES, seed=j)
        books[j, : len(made)] = made
    return books


def _in_line(centres: np.ndarray) -> np.ndarray:
    """Centres ordered along the direction in which they differ most, so that cells of one folder lie near each other."""
    if len(centres) < 3:
        return centres
    around = centres - centres.mean(axis=0)
    return centres[np.argsort(around @ np.linalg.svd(around, full_matrices=False)[2][0], kind="stable")]


def _assign(centroids: np.ndarray, books: np.ndarray, item_id: str, vector: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(vector))
            parts = _pairs(rows)
            codes = np.stack([_nearest(parts[:, j], np.nan_to_num(books[j], posinf=1e300)) for j in range(len(books))], axis=1).astype(np.uint8)
            cell = _nearest(rows, centroids).astype(np.int32)
            written = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(item_id), batch.column(vector), pa.array(cell), written], names=[item_id, vector, "cell", "code"])

    return run


def build(vectors: DataFrame, path: str, item_id: str = "vec_id", vector: str = "embedding", k: int = 10, cover: float = 0.96) -> None:
    """Train and write an index of all sound rows of `vectors` under `path`. `cover` is the share of the k true neighbours that probes must reach."""
    spark = vectors.sparkSession
    dim = dimension(vectors, vector)
    sound = vectors.select(item_id, vector).where(is_sound(vector, dim))
    rows = sound.count()
    if not rows:
        raise ValueError("no vector to index")
    part = 1_000_000
    chosen = sound if rows <= SAMPLE else sound.where(F.pmod(F.xxhash64(item_id), F.lit(part)) < int(part * SAMPLE / rows))
    sample = _matrix(chosen.select(vector).toArrow().column(vector))  # about SAMPLE rows at most
    centroids = _in_line(kmeans(sample, max(1, min(MAX_CELLS, rows // 4, math.ceil(4 * math.sqrt(rows))))))
    books = _codebooks(sample)
    per_shelf = -(-len(centroids) // SHELVES)
    kinds = ", ".join(f"`{c}` {sound.schema[c].dataType.simpleString()}" for c in (item_id, vector))
    listed = sound.mapInArrow(_assign(centroids, books, item_id, vector), f"{kinds}, cell int, code binary")
    shelved = listed.withColumn("shelf", F.floor(F.col("cell") / per_shelf).cast("int"))
    # Rebalancing sizes the files by the data; a shelf larger than a file is split.
    shelved.hint("rebalance", "shelf").sortWithinPartitions("shelf", "cell").write.partitionBy("shelf").parquet(f"{path}/lists")
    lists = spark.read.parquet(f"{path}/lists")
    lists.groupBy("cell").agg(F.count("*").alias("rows")).write.parquet(f"{path}/sizes")
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], "cell int, place array<double>").write.parquet(f"{path}/cells")
    flat = [(j, c, books[j, c].tolist()) for j in range(len(books)) for c in range(CODES) if np.isfinite(books[j, c, 0])]
    spark.createDataFrame(flat, "part int, code int, place array<double>").write.parquet(f"{path}/codebooks")
    probes = _tuned(lists, centroids, item_id, vector, k, cover, rows)
    spark.createDataFrame([(probes, per_shelf, item_id, vector)], "probes int, per_shelf int, item_id string, vector string").write.parquet(f"{path}/about")


def _tuned(lists: DataFrame, centroids: np.ndarray, item_id: str, vector: str, k: int, cover: float, rows: int) -> int:
    """Cells to probe so that the k true neighbours of sampled rows lie in them, up to the wanted share."""
    part = 1_000_000
    asked = lists.where(F.pmod(F.xxhash64(item_id, F.lit(1)), F.lit(part)) < math.ceil(part * min(1.0, TUNED / rows)))
    asked = materialize(asked.select(F.col(item_id).alias("_query"), vector))
    true = knn_topk(asked, lists, k, "_query", item_id, vector).select("_query", item_id).join(lists.select(item_id, "cell"), item_id).join(asked, "_query")
    found = true.select("cell", vector).toArrow()  # k rows for each of about TUNED queries
    if not found.num_rows:
        return len(centroids)
    gaps = _distances(_matrix(found.column(vector)), centroids)
    own = gaps[np.arange(len(gaps)), found.column("cell").to_numpy()]
    needed = np.sort((gaps < own[:, None]).sum(axis=1) + 1)
    return int(needed[min(len(needed) - 1, math.ceil(cover * len(needed)) - 1)])


def read(spark: SparkSession, path: str) -> VectorIndex:
    table = lambda name: spark.read.parquet(f"{path}/{name}")
    about = table("about").first()
    places = [r["place"] for r in table("cells").orderBy("cell").collect()]  # MAX_CELLS rows at most
    coded = table("codebooks").collect()
    books = np.full((max(r["part"] for r in coded) + 1, CODES, 2), np.inf)
    for r in coded:
        books[r["part"], r["code"]] = r["place"]
    return VectorIndex(table("lists"), table("sizes"), np.array(places), books, about["probes"], about["item_id"], about["vector"])


def _probed(queries: DataFrame, index: VectorIndex, query_id: str, vector: str, probes: int) -> DataFrame:
    """(query_id, vector, cell): each query once for each of its nearest cells."""
    centroids = index.centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, CELLS // len(centroids))
            for i in range(0, batch.num_rows, step):
                piece = batch.slice(i, step)
                cells = np.argsort(_distances(_matrix(piece.column(vector)), centroids), axis=1, kind="stable")[:, :probes]
                nested = pa.ListArray.from_arrays(pa.array(np.arange(len(cells) + 1, dtype=np.int32) * cells.shape[1]), pa.array(cells.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([piece.column(query_id), piece.column(vector), nested], names=[query_id, vector, "cells"])

    kinds = ", ".join(f"`{c}` {queries.schema[c].dataType.simpleString()}" for c in (query_id, vector))
    return queries.select(query_id, vector).mapInArrow(run, f"{kinds}, cells array<int>").withColumn("cell", F.explode("cells")).drop("cells")


def _meet(books: np.ndarray, query_id: str, vector: str, item_id: str, keep: int):
    """Of one part of a list and one block of queries: the `keep` items of each query that lie nearest by their codes."""

    def run(items: pa.Table, asked: pa.Table) -> pa.Table:
        names, ids = asked.column(query_id), items.column(item_id)
        out = []
        if asked.num_rows and items.num_rows:
            codes = np.frombuffer(b"".join(items.column("code").to_pylist()), np.uint8).reshape(items.num_rows, -1)
            wanted = _pairs(_matrix(asked.column(vector)))
            step = max(1, CELLS // items.num_rows)
            for i in range(0, asked.num_rows, step):
                some = wanted[i : i + step]
                gap = np.zeros((len(some), len(codes)))
                for j in range(codes.shape[1]):
                    gap += ((some[:, j, None, :] - books[j][None]) ** 2).sum(axis=2)[:, codes[:, j]]
                best = np.argpartition(gap, keep - 1, axis=1)[:, :keep] if keep < len(codes) else np.tile(np.arange(len(codes)), (len(some), 1))
                row = np.repeat(np.arange(len(some)), best.shape[1])
                out.append((row + i, best.ravel(), gap[row, best.ravel()]))
        row, item, gap = (np.concatenate([o[c] for o in out] or [np.empty(0, int)]) for c in range(3))
        return pa.table({query_id: names.take(pa.array(row, pa.int64())), item_id: ids.take(pa.array(item, pa.int64())), "gap": pa.array(gap, pa.float64())})

    return run


def _shares(sizes: DataFrame, name: str, each: int) -> DataFrame:
    """(cell, name): into how many pieces a cell's rows are cut. At most MAX_CELLS rows."""
    return F.broadcast(sizes.select("cell", F.ceil(F.col("rows") / each).cast("int").alias(name)))


def chosen(queries: DataFrame, index: VectorIndex, keep: int, query_id: str = "query_id", probes: int | None = None) -> DataFrame:
    """(query_id, item_id): the `keep` items per query whose codes lie nearest, of the lists it probes."""
    vector, item_id = index.vector, index.item_id
    sound = queries.where(is_sound(vector, index.centroids.shape[1]))
    probed = materialize(_probed(sound, index, query_id, vector, probes or index.probes))
    asked = probed.groupBy("cell").agg(F.count("*").alias("rows"))
    opened = [r["cell"] for r in asked.select("cell").collect()]  # MAX_CELLS at most
    per_shelf = -(-len(index.centroids) // SHELVES)
    lists = index.lists.where(F.col("shelf").isin(sorted({c // per_shelf for c in opened})) & F.col("cell").isin(opened))
    parts, blocks = _shares(index.sizes, "parts", PART), _shares(asked, "blocks", BLOCK)
    dealt = lambda name, by: F.pmod(F.xxhash64(by), F.col(name)).cast("int")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    held = lists.select(item_id, "cell", "code").join(parts, "cell").join(blocks, "cell")
    held = held.select(item_id, "cell", "code", dealt("parts", item_id).alias("part"), every("blocks").alias("block"))
    come = probed.join(parts, "cell").join(blocks, "cell").select(query_id, vector, "cell", every("parts").alias("part"), dealt("blocks", query_id).alias("block"))
    kinds = f"`{query_id}` {queries.schema[query_id].dataType.simpleString()}, `{item_id}` {index.lists.schema[item_id].dataType.simpleString()}"
    met = held.groupBy("cell", "part", "block").cogroup(come.groupBy("cell", "part", "block")).applyInArrow(
        _meet(index.codebooks, query_id, vector, item_id, keep), f"{kinds}, gap double"
    )
    return rank_top(met, query_id, [F.col("gap"), F.col(item_id)], keep).drop("rank", "gap")


def search(
    queries: DataFrame, index: VectorIndex, k: int, query_id: str = "query_id", rerank: int = 5, probes: int | None = None
) -> DataFrame:
    """Nearest k items per query by squared distance: (query_id, item_id, score, rank) as `knn_topk` gives them.

    `rerank` times k items per query are compared in full. `queries` has the index's vector column; unsound ones find nothing.
    """
    vector, item_id = index.vector, index.item_id
    pairs = materialize(chosen(queries, index, rerank * k, query_id, probes))
    left = queries.select(query_id, F.col(vector).alias("_a"))
    right = index.lists.select(item_id, F.col(vector).alias("_b"))
    met = pairs.join(left, query_id).join(right, item_id)
    score: Column = _score(F.col("_a"), F.col("_b"), "l2").alias("score")
    return rank_top(met.select(query_id, item_id, score), query_id, [F.col("score").desc(), F.col(item_id)], k)


def compared(queries: DataFrame, index: VectorIndex, keep: int, probes: int | None = None) -> DataFrame:
    """One row: all pairs of queries and items, those compared by code, and those compared in full."""
    sound = queries.where(is_sound(index.vector, index.centroids.shape[1]))
    probed = _probed(sound.withColumn("_query", F.monotonically_increasing_id()), index, "_query", index.vector, probes or index.probes)
    per_query = probed.join(F.broadcast(index.sizes), "cell").groupBy("_query").agg(F.sum("rows").alias("n"))
    looked = per_query.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("by_code"), F.coalesce(F.sum(F.least("n", F.lit(keep))), F.lit(0)).alias("in_full"))
    every = index.sizes.agg(F.sum("rows").alias("items")).join(F.broadcast(sound.agg(F.count("*").alias("queries"))))
    return every.select((F.col("items") * F.col("queries")).alias("pairs")).join(F.broadcast(looked))
