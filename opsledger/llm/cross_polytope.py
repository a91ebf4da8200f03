"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets.

A hash rotates the unit vector (three rounds of random signs and a Hadamard transform) and names the nearest
signed axis. A table key joins `hashes` of them; each vector also enters the buckets in which one of them is
replaced by its second nearest axis. Candidates are compared by exact cosine in double precision.

Equal vectors are one class first. Buckets are cut into blocks of BLOCK members that meet block by block, so
no task holds a whole bucket; a block returns link counts and in-block components, never pairs. A pair that
meets in several buckets is counted in the first.

Vectors that are null, zero, or hold null or non-finite components link with nothing; vectors of different
lengths never link. Rows with a null id are returned with null component. Repeated ids are separate rows of
equal id. Other columns, labels included, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.llm import rolling
from opsledger.llm.components import components
from opsledger.llm.tables import materialize

BLOCK = 512


@dataclass(frozen=True)
class Rule:
    cosine: float = 0.9
    tables: int = 6
    hashes: int = 2

    @property
    def width(self) -> int:
        """Buckets a vector enters."""
        return self.tables * (self.hashes + 1)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    x, width, step = x.copy(), x.shape[1], 1
    while step < width:
        v = x.reshape(len(x), -1, 2, step)
        a, b = v[:, :, 0] + v[:, :, 1], v[:, :, 0] - v[:, :, 1]
        v[:, :, 0], v[:, :, 1] = a, b
        step *= 2
    return x / np.sqrt(width)


def bucket_keys(unit: np.ndarray, rule: Rule) -> np.ndarray:
    """(vectors, width) keys of the buckets each unit vector enters; those of one table lie together."""
    n, dim = unit.shape
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = unit
    draw = np.random.Generator(np.random.PCG64(104729 + dim))
    out = np.empty((n, rule.tables, rule.hashes + 1), dtype=np.uint64)
    for t in range(rule.tables):
        axes = []
        for _ in range(rule.hashes):
            y = padded
            for _ in range(3):
                y = hadamard(y * draw.choice([-1.0, 1.0], width))
            size = np.abs(y)
            best = np.argmax(size, axis=1)
            row = np.arange(n)
            first = 2 * best + (y[row, best] < 0)
            size[row, best] = -1
            second = np.argmax(size, axis=1)
            axes.append((first.astype(np.uint64), (2 * second + (y[row, second] < 0)).astype(np.uint64)))
        for probe in range(rule.hashes + 1):
            key = np.full(n, t * 1_000_003 + dim, dtype=np.uint64)
            for h, (first, second) in enumerate(axes):
                key = rolling.mix(key * np.uint64(2 * width) + (second if probe == h + 1 else first), 61)
            out[:, t, probe] = key
    return out.reshape(n, -1)


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of equal length as unit vectors in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares in range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _explode_keys(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                keys = bucket_keys(_units(part.column("vector")), rule)
                ids = np.repeat(part.column("vec_id").to_numpy(), rule.width)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids)], names=["key", "vec_id"])

    return run


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of n positions over links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(group: dict[str, np.ndarray], rule: Rule) -> list[tuple[int, int, int]]:
    """(vector, links, root) of one block pair, members sorted by id."""
    left, right = np.flatnonzero(group["side"] != 1), np.flatnonzero(group["side"] != 0)
    unit = group["unit"]
    close = unit[left] @ unit[right].T >= rule.cosine
    a, b = np.nonzero(close)
    i, j = left[a], right[b]
    keep = i < j if group["same"] else slice(None)
    i, j = i[keep], j[keep]
    if not len(i):
        return []
    keys = bucket_keys(unit, rule)
    here = group["key"].view(np.uint64) if isinstance(group["key"], np.ndarray) else np.uint64(group["key"] % 2**64)
    first = np.full(len(i), np.iinfo(np.uint64).max)
    done = np.zeros(len(i), dtype=bool)
    probes = rule.hashes + 1
    for t in range(rule.tables):
        x, y = keys[i, t * probes : (t + 1) * probes], keys[j, t * probes : (t + 1) * probes]
        same = x[:, :, None] == y[:, None, :]
        shared = same.any(axis=2)
        least = np.where(shared, x, np.iinfo(np.uint64).max).min(axis=1)
        new = ~done & shared.any(axis=1)
        first[new] = least[new]
        done |= new
    mine = first == here
    i, j = i[mine], j[mine]
    if not len(i):
        return []
    n = len(unit)
    copies = group["copies"]
    links = np.bincount(i, weights=copies[j], minlength=n) + np.bincount(j, weights=copies[i], minlength=n)
    root = _roots(n, i, j)
    ids = group["vec_id"]
    on = np.flatnonzero(links)
    return [(int(ids[k]), int(links[k]), int(ids[root[k]])) for k in on]


def _blocks(rule: Rule):
    """Rows sorted by (key, bi, bj, vec_id): one comparison for each block pair."""

    def flush(table: pa.Table) -> list[tuple[int, int, int]]:
        if table.num_rows < 2:
            return []
        bi, bj, home = (table.column(c)[0].as_py() if c != "home" else table.column(c).to_numpy() for c in ("bi", "bj", "home"))
        same = bi == bj
        dims = table.column("dim").to_numpy()
        rows = []
        for dim in np.unique(dims):
            part = table.filter(pa.array(dims == dim))
            own = home[dims == dim]
            rows += _compare({
                "key": table.column("key")[0].as_py(), "same": same,
                "side": np.full(len(own), 2) if same else (own != bi).astype(int),
                "unit": _units(part.column("vector").combine_chunks()), "vec_id": part.column("vec_id").to_numpy(),
                "copies": part.column("copies").to_numpy(),
            }, rule)
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["vec_id", "links", "root"])

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
            key = np.stack([table.column(c).to_numpy() for c in ("key", "bi", "bj")])
            cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            edges = [0, *cut.tolist()]
            rows = [r for s, e in zip(edges[:-1], edges[1:]) for r in flush(table.slice(s, e - s))]
            rest = table.slice(edges[-1])
            if rows:
                yield out(rows)
        if rest is not None and (rows := flush(rest)):
            yield out(rows)

    return run


def near_vectors(vectors: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of `vectors` (vec_id, embedding)."""
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    huge = F.lit(float("inf"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < huge)) & F.exists("vector", lambda x: x != 0)
    marked = materialize(own.withColumn("sound", F.coalesce(F.col("vec_id").isNotNull() & sound, F.lit(False))))
    classes = materialize(
        marked.filter("sound").groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")).withColumn("dim", F.size("vector"))
    )
    keys = classes.select("vec_id", "vector", "dim").mapInArrow(_explode_keys(rule), "key long, vec_id long").distinct()
    # What is joined back to many rows of one key is a table of its own: then Spark can split those rows.
    sizes = materialize(keys.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    placed = keys.join(sizes, "key").withColumn("home", F.pmod(F.xxhash64("vec_id"), "blocks"))
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    paired = placed.withColumn("other", F.explode(others)).select(
        "key", F.least("home", "other").alias("bi"), F.greatest("home", "other").alias("bj"), "home", "vec_id"
    )
    rows = paired.join(classes, "vec_id").repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "vec_id")
    found = materialize(rows.mapInArrow(_blocks(rule), "vec_id long, links long, root long"))
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    label = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("vec_id"), "component")
    ended = classes.join(counts, "vec_id", "left").join(label, "vec_id", "left").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    )
    ends = materialize(ended)
    linked = marked.filter("sound").join(ends, "vector").select("vec_id", "n_links", "component_id")
    alone = marked.filter("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
