"""Near duplicates by MinHash with tensored banding: pairs of half keys form the table keys.

Two collections of `tables` half keys, each of `rows` minima, give tables**2 table keys of 2 * rows minima
for 2 * tables * rows hash functions instead of 2 * tables**2 * rows.

1. Texts with the same shingle set are one class; only its smallest id goes on.
2. In each bucket everything is compared with one hub, the member that meets most others anywhere. A copy
   of a common original is compared with the original, so a bucket of n members costs n comparisons.
3. Where a bucket still holds members outside its hub's component, exactly these are compared with the
   members of other components, in bounded blocks by half key. No candidate of the tables is left out.
4. Candidates whose minima agree in fewer than `floor` of all hash functions, or whose set sizes rule the
   similarity out, are dropped (five standard deviations below the threshold); the others are confirmed
   on their full sets, computed from whole texts.

Rows with a null id are returned with null component and kept; a text that is null or has no word has an
empty set and is linked with nothing; repeated rows give repeated results. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.llm import rolling
from opsledger.llm.batches import mapper, steps, text_column
from opsledger.llm.components import components
from opsledger.llm.spans import gather
from opsledger.llm.suffix_tree import Filter
from opsledger.llm.tables import materialize

_SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, minima array<int>"
_KEYS = "key long, doc_id long"
_LINKS = "a long, b long"
BLOCK = 256
# Texts whose table keys are made at a time.
KEYED = 2048


@dataclass(frozen=True)
class Rule:
    """Shingle size, threshold as a ratio of whole numbers, and the shape of the tables."""

    size: int = 5
    share: int = 80
    of: int = 100
    rows: int = 3
    tables: int = 12

    @property
    def hashes(self) -> int:
        return 2 * self.rows * self.tables

    @property
    def floor(self) -> int:
        """Fewest agreeing minima of a candidate: five standard deviations below the expected number."""
        s = self.share / self.of
        return max(1, int(self.hashes * s - 5 * (self.hashes * s * (1 - s)) ** 0.5))


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64(7919))
    return draw.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 2**63, n, dtype=np.uint64)


def _minima(codes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """(sets, n) minima of n hash functions; `starts` are the first positions of non-empty sets."""
    out = np.empty((len(starts), n), dtype=np.int32)
    for k, (a, b) in enumerate(zip(*_multipliers(n))):
        h = ((codes * a + b) >> np.uint64(33)).astype(np.int32)
        out[:, k] = np.minimum.reduceat(h, starts)
    return out


def _sign(rule: Rule):
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        rows, codes = rolling.shingle_sets(rolling.Texts.of(text_column(batch.column("text"))), rule.size)
        sizes = np.bincount(rows, minlength=n)
        full = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[full]
        marks = [np.zeros(n, dtype=np.int64) for _ in range(2)]
        minima = np.zeros((n, rule.hashes), dtype=np.int32)
        if len(full):
            for k, mark in enumerate(marks):
                mark[full] = np.add.reduceat(rolling.mix(codes, 11 + k), starts).view(np.int64)
            minima[full] = _minima(codes, starts, rule.hashes)
        spans = pa.array(np.arange(n + 1, dtype=np.int32) * rule.hashes)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes), *map(pa.array, marks), pa.ListArray.from_arrays(spans, pa.array(minima.ravel()))],
            names=["doc_id", "n_shingles", "set_a", "set_b", "minima"],
        )

    return mapper(step)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _halves(minima: np.ndarray, rule: Rule) -> np.ndarray:
    """(docs, 2 * tables) half keys; column i of the first half belongs to collection A."""
    folded = np.zeros((len(minima), 2 * rule.tables), dtype=np.uint64)
    for r in range(rule.rows):
        folded = rolling.mix(folded ^ minima[:, r :: rule.rows].astype(np.uint64), 31)
    return rolling.mix(folded + np.arange(2 * rule.tables, dtype=np.uint64), 37)


def _keys_of(minima: pa.Array, rule: Rule) -> np.ndarray:
    """(docs, tables**2) table keys."""
    half = _halves(_matrix(minima, rule.hashes), rule)
    left, right = half[:, : rule.tables], half[:, rule.tables :]
    return rolling.mix(left[:, :, None] * np.uint64(0x9E3779B97F4A7C15) ^ right[:, None, :], 41).reshape(len(half), -1).view(np.int64)


def _key_counts(rule: Rule):
    """(key, n) of some texts at a time. Nearly all keys differ, so a task keeps no table of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, KEYED):
                keys, n = np.unique(_keys_of(batch.column("minima").slice(at, KEYED), rule), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    return run


def _table_keys(rule: Rule, shared: Broadcast):
    """(key, doc_id) of the keys that the filter lets through: those of several texts, and a few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, KEYED):
                batch = whole.slice(at, KEYED)
                keys = _keys_of(batch.column("minima"), rule).ravel()
                ids = np.repeat(batch.column("doc_id").to_numpy(), rule.tables**2)
                able = shared.value.has(keys)
                yield pa.RecordBatch.from_arrays([pa.array(keys[able]), pa.array(ids[able])], names=["key", "doc_id"])

    return run


def _sizes_fit(x: Column, y: Column, rule: Rule) -> Column:
    return F.least(x, y) * rule.of >= F.greatest(x, y) * rule.share


def _enough(inter: np.ndarray, x: np.ndarray, y: np.ndarray, rule: Rule) -> np.ndarray:
    return inter * rule.of >= rule.share * (x + y - inter)


def _confirm_stars(rule: Rule):
    """Rows sorted by (a, part, lead first): compare each text with its hub's, on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_codes = None, np.empty(0, np.uint64)
        for batch in steps(batches):
            a = batch.column("a").to_numpy()
            rows, codes = rolling.shingle_sets(rolling.Texts.of(text_column(batch.column("text"))), rule.size)
            lead = batch.column("lead").to_numpy(zero_copy_only=False)
            sizes = np.bincount(rows, minlength=len(a))
            ids = batch.column("doc_id").to_numpy()
            edge = np.concatenate([[0], np.cumsum(sizes)])
            cuts = np.concatenate([[0], np.flatnonzero((a[1:] != a[:-1]) | lead[1:]) + 1, [len(a)]])
            found = []
            for s, e in zip(cuts[:-1], cuts[1:]):
                if lead[s]:
                    hub, hub_codes, s = a[s], codes[edge[s] : edge[s + 1]], s + 1
                if s == e or a[s] != hub or not len(hub_codes):
                    continue
                part = codes[edge[s] : edge[e]]
                at = np.minimum(np.searchsorted(hub_codes, part), len(hub_codes) - 1)
                inter = np.bincount(rows[edge[s] : edge[e]] - s, weights=hub_codes[at] == part, minlength=e - s)
                same = _enough(inter, sizes[s:e], len(hub_codes), rule)
                found += [(int(hub), int(x)) for x in ids[s:e][same] if x != hub]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    return run


def _star_links(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) confirmed on full sets. Each hub's partners are dealt into parts of about BLOCK."""
    counts = materialize(pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("parts")))
    dealt = pairs.join(counts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    members = dealt.select("a", "part", F.lit(False).alias("lead"), F.col("b").alias("doc_id")).join(texts, "doc_id")
    leads = dealt.select("a", "part").distinct().select("a", "part", F.lit(True).alias("lead"), F.col("a").alias("doc_id")).join(texts, "doc_id")
    columns = ["a", "part", "lead", "doc_id", "text"]
    rows = leads.select(columns).unionByName(members.select(columns))
    return rows.repartition("a", "part").sortWithinPartitions("a", "part", F.desc("lead")).mapInArrow(_confirm_stars(rule), _LINKS)


def _confirm_block(rule: Rule):
    """One block: compare its outliers with its members of other components; one link a component is enough."""

    def run(block: pa.Table) -> pa.Table:
        minima = _matrix(block.column("minima").combine_chunks(), rule.hashes)
        half = _halves(minima, rule)[:, : rule.tables]
        table = int(block.column("table")[0].as_py())
        probe = block.column("probe").combine_chunks().to_numpy(zero_copy_only=False)
        ids, comp, n = (block.column(c).to_numpy() for c in ("doc_id", "component", "n_shingles"))
        outer, inner = np.flatnonzero(probe), np.flatnonzero(~probe)
        least, most = np.minimum.outer(n[outer], n[inner]), np.maximum.outer(n[outer], n[inner])
        wanted = (comp[outer][:, None] != comp[inner]) & (least * rule.of >= most * rule.share)
        # A pair is looked at in the first table of collection A that it shares.
        for t in range(table):
            wanted &= half[outer, t][:, None] != half[inner, t]
        agree = np.zeros(wanted.shape, dtype=np.int16)
        if wanted.any():
            for k in range(rule.hashes):
                agree += minima[outer, k][:, None] == minima[inner, k]
            wanted &= agree >= rule.floor
        found: list[tuple[int, int]] = []
        if wanted.any():
            used = np.union1d(outer[wanted.any(axis=1)], inner[wanted.any(axis=0)])
            column = text_column(block.column("text").combine_chunks().take(pa.array(used)))
            rows, codes = rolling.shingle_sets(rolling.Texts.of(column), rule.size)
            edge = np.searchsorted(rows, np.arange(len(used) + 1))
            names, word = np.unique(codes, return_inverse=True)
            own = np.zeros(len(names), dtype=bool)
            place = np.full(len(ids), -1)
            place[used] = np.arange(len(used))
            for x, mask in zip(outer, wanted):
                if not mask.any():
                    continue
                mine = word[edge[place[x]] : edge[place[x] + 1]]
                some = inner[mask]
                start, size = edge[place[some]], edge[place[some] + 1] - edge[place[some]]
                own[mine] = True
                hits = own[gather(word, start, size)]
                both = np.add.reduceat(hits, np.cumsum(size) - size, dtype=np.int64)
                own[mine] = False
                linked = some[_enough(both, len(mine), size, rule)]
                _, first = np.unique(comp[linked], return_index=True)
                found += [(int(ids[x]), int(ids[y])) for y in linked[first]]
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _half_rows(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = _halves(_matrix(batch.column("minima"), rule.hashes), rule)[:, : rule.tables]
            ids = np.repeat(batch.column("doc_id").to_numpy(), rule.tables)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(rule.tables), len(half))), pa.array(half.ravel().view(np.int64)), pa.array(ids)],
                names=["table", "half", "doc_id"],
            )

    return run


def _left_over(buckets: DataFrame, hubs: DataFrame, found: DataFrame, reps: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Links between members that no hub has tied together yet."""
    label = materialize(components(found).select(F.col("node").alias("doc_id"), "component"))
    hub_label = label.select(F.col("doc_id").alias("hub"), F.col("component").alias("hub_component"))
    marked = (
        buckets.filter("n > 2").join(hubs, "key").join(label, "doc_id", "left").join(hub_label, "hub", "left")
        .select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"), F.coalesce("hub_component", "hub").alias("main"))
        .withColumn("outside", F.col("component") != F.col("main"))
    )
    open_keys = materialize(marked.groupBy("key").agg(F.max("outside").alias("open")).filter("open").select("key"))
    status = materialize(
        marked.join(open_keys, "key").groupBy("doc_id").agg(F.max("outside").alias("outside"), F.first("component").alias("component"))
    )
    halves = reps.join(status.select("doc_id"), "doc_id").select("doc_id", "minima").mapInArrow(_half_rows(rule), "table long, half long, doc_id long")
    placed = materialize(halves.join(status, "doc_id"))
    groups = materialize(
        placed.groupBy("table", "half")
        .agg(F.count("*").alias("members"), F.count_if("outside").alias("probes"))
        .filter("members > 1 and probes > 0")
        .select("table", "half", F.ceil(F.col("members") / BLOCK).alias("m"), F.ceil(F.col("probes") / BLOCK).alias("p"))
    )
    dealt = placed.join(groups, ["table", "half"])
    inner = dealt.withColumns({
        "probe": F.lit(False), "mi": F.pmod(F.xxhash64("doc_id"), "m"), "pi": F.explode(F.sequence(F.lit(0).cast("long"), F.col("p") - 1)),
    })
    outer = dealt.filter("outside").withColumns({
        "probe": F.lit(True), "pi": F.pmod(F.xxhash64("doc_id", F.lit(1)), "p"), "mi": F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)),
    })
    keep = ["table", "half", "mi", "pi", "probe", "doc_id", "component"]
    rows = inner.select(keep).unionByName(outer.select(keep))
    full = rows.join(reps.select("doc_id", "n_shingles", "minima"), "doc_id").join(texts, "doc_id")
    return full.groupBy("table", "half", "mi", "pi").applyInArrow(_confirm_block(rule), _LINKS)


def link_classes(docs: DataFrame, rule: Rule = Rule()) -> tuple[DataFrame, DataFrame]:
    """(members, links): each document's shingle count and class, and links that tie the classes together."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialize(docs.filter("doc_id is not null").mapInArrow(_sign(rule), _SIGNATURE))
    # What is joined back to many rows of one key is a table of its own: then Spark can split those rows.
    same = materialize(signed.filter("n_shingles > 0").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep")))
    members = materialize(
        signed.join(same, ["set_a", "set_b"], "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("rep")).otherwise(F.col("doc_id")).alias("rep"),
                F.when(F.col("rep") == F.col("doc_id"), F.col("minima")).alias("minima"))
    )
    reps = materialize(members.filter("rep = doc_id and n_shingles > 0 and minima is not null").dropDuplicates(["doc_id"]).drop("rep"))
    # Counts go to their keys as they are: adding them up before the exchange would only fill the memory of its tasks.
    counts = reps.select("minima").mapInArrow(_key_counts(rule), "key long, n long").repartition("key")
    shared = materialize(counts.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1"))
    several = docs.sparkSession.sparkContext.broadcast(Filter.of(shared))
    keys = reps.select("doc_id", "minima").mapInArrow(_table_keys(rule, several), _KEYS)
    buckets = materialize(keys.join(shared, "key"))
    met = buckets.groupBy("doc_id").agg(F.sum("n").alias("met"))
    hubs = materialize(
        buckets.join(met, "doc_id").groupBy("key").agg(F.max_by("doc_id", F.struct("met", -F.col("doc_id"))).alias("hub"))
    )
    pairs = buckets.join(hubs, "key").filter("hub <> doc_id").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    side = reps.select("doc_id", F.col("n_shingles").alias("n"), "minima")
    left, right = (side.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("minima").alias(f"m_{c}")) for c in "ab")
    agree = F.aggregate(F.zip_with("m_a", "m_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    likely = materialize(
        pairs.join(left, "a").join(right, "b").filter(_sizes_fit(F.col("n_a"), F.col("n_b"), rule)).filter(agree >= rule.floor).select("a", "b")
    )
    texts = materialize(docs.join(buckets.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    stars = materialize(_star_links(likely, texts, rule))
    rest = _left_over(buckets, hubs, stars, reps, texts, rule)
    return members.select("doc_id", "n_shingles", "rep"), materialize(stars.unionByName(rest))


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document; kept is the smallest id of each component."""
    members, links = link_classes(docs, rule)
    label = components(links).select(F.col("node").alias("rep"), "component")
    found = members.join(label, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    void = docs.filter("doc_id is null").select(F.lit(None).cast("long").alias("doc_id"), "text")
    unnamed = void.mapInArrow(_sign(rule), _SIGNATURE).select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return found.unionByName(unnamed).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

