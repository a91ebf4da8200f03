"""A keyword index kept up to date in segments, and a search that skips blocks of postings that cannot matter.

Each load is a segment of its own: new and changed texts are counted into it, and what they replace, or what is deleted,
goes to a mask; older segments are never written again. A segment holds its texts (words and their counts), from which postings
can be rebuilt without the text, and postings in blocks. A text belongs to a zone of 2**`ZONE_BITS` texts of its
segment; a block holds one word's postings in one zone, with the highest gain in it at the mean length the segment had; that
bounds every gain in the block whatever the mean length has become. Statistics add up over segments, masked texts counting
negatively. Small segments are merged into one by `merge`.

Texts lie in chunks of some megabytes of text, one row each, and blocks in one row for each chunk and folder of words, as packed arrays:
what Spark moves, sorts and writes are a few rows for a chunk, however many postings it has.

The bounds of a zone's blocks add up to the best score any of its texts could have. A search brings the blocks of its words together by
chunk once, scores the few zones that promise most, and takes the k-th best score there as its threshold; only postings of zones that can
reach it are scored. All postings of a text lie in one zone, so scores are complete and lists are those of `bm25.search`.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.functions.text import tokenize
from opsledger.operators import bm25
from opsledger.operators.bm25 import CELLS, DECIMALS, MAX_WORD_BYTES, MAX_WORDS, Corpus, _idf, term_weight
from opsledger.operators.slices import hashes, pack, pack_words, slices, unpack, unpack_words
from opsledger.operators.slices import words as split
from opsledger.operators.topk import best_of, rank_top
from opsledger.session import materialize
from opsledger.sources.tables import table_exists

ZONE_BITS = 3
BUCKETS = 16
# Text of a chunk, in bytes; postings of one that `merge` makes; a text's place is its chunk and a number of so many bits.
CHUNK_BYTES = 4 << 20
CHUNK_POSTINGS = 400_000
TEXT_BITS = 16
# Bytes that a Parquet row group of packed rows may have: what a task reads at a time.
GROUP_BYTES = 16 << 20
# Words of chunks that one task adds up at a time, so many in each range of hashes.
RANGE_WORDS = 250_000
# Masked places that may be sent to every task; more of them meet their chunks in a shuffle.
MAX_MASKED = 2_000_000
# Bounds and thresholds are sums of rounded parts.
SLACK = 1e-6
# Saturation and length parameters of the gains; bounds are stored for these, as so many steps up to the highest gain there can be.
K1, B = 1.5, 0.75
STEPS = 65_535


class _Best:
    """The k best (item, score) per query seen so far; equal scores keep the earlier item."""

    def __init__(self, k: int, n_queries: int) -> None:
        self.k, self.parts, self.size = k, [], 0
        self.most = max(CELLS, 4 * k * n_queries)
        # The k-th best score of a query; what is below it cannot enter its list any more.
        self.least = np.full(n_queries, -np.inf)

    def add(self, query: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        able = score >= self.least[query]
        self.parts.append((query[able], item[able], score[able]))
        self.size += int(able.sum())
        if self.size > self.most:
            self.fold()

    def fold(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, int), np.empty(0, object), np.empty(0)
        query, item, score = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((item, -score, query))
        query, item, score = query[order], item[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        last, kept = place == self.k - 1, place < self.k
        self.least[query[last]] = score[last]
        self.parts, self.size = [(query[kept], item[kept], score[kept])], int(kept.sum())
        return self.parts[0]


@dataclass(frozen=True)
class Segments:
    """The live segments of an index: blocks and chunks of texts, masked ones included, the mask, and what is so without them: document frequencies and corpus facts."""

    blocks: DataFrame
    chunks: DataFrame
    mask: DataFrame
    terms: DataFrame
    corpus: Corpus
    item_id: str
    live: list[str]

    @property
    def texts(self) -> DataFrame:
        """A row per text (segment, id, length, words, counts), masked ones included."""
        kind = self.mask.schema[self.item_id].dataType.simpleString()
        schema = f"segment string, `{self.item_id}` {kind}, length int, words array<string>, counts array<int>"
        return self.chunks.select("segment", *_CHUNK).mapInArrow(_rows(self.item_id), schema)


# A chunk of texts by length: their ids and lengths, their distinct words with the number of texts that have them, and, text by text,
# how many distinct words it has, which, and how often.
_CHUNK = ["ids", "lengths", "terms", "dfs", "sizes", "words", "counts"]


@dataclass
class _Chunk:
    ids: pa.Array
    lengths: np.ndarray
    terms: pa.Array
    sizes: np.ndarray
    words: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(row: int, batch: pa.RecordBatch) -> _Chunk:
        sizes, words, counts = (unpack(batch.column(c)[row].as_py()) for c in ("sizes", "words", "counts"))
        terms = unpack_words(batch.column("terms")[row].as_py())
        return _Chunk(batch.column("ids")[row].values, batch.column("lengths")[row].values.to_numpy(), terms, sizes, words, counts)

    @staticmethod
    def made(parts: list[_Chunk]) -> _Chunk:
        """One of several: words in one list, texts in order of length."""
        if len(parts) == 1:
            return parts[0]
        terms = pa.concat_arrays([p.terms for p in parts]).dictionary_encode()
        code, first = terms.indices.to_numpy(), np.cumsum([0, *(len(p.terms) for p in parts)])
        words = np.concatenate([code[at:][p.words] for p, at in zip(parts, first)])
        join = lambda c: np.concatenate([getattr(p, c) for p in parts])
        ids, lengths = pa.concat_arrays([p.ids for p in parts]), join("lengths")
        return _Chunk(ids, lengths, terms.dictionary, join("sizes"), words, join("counts")).take(np.argsort(lengths, kind="stable"))

    def take(self, texts: np.ndarray) -> _Chunk:
        """These texts, and the words they have."""
        at = _runs((np.cumsum(self.sizes) - self.sizes)[texts], self.sizes[texts])
        used, words = np.unique(self.words[at], return_inverse=True)
        return _Chunk(self.ids.take(pa.array(texts)), self.lengths[texts], self.terms.take(pa.array(used)), self.sizes[texts], words, self.counts[at])

    def row(self, number: int) -> pa.RecordBatch:
        list_of = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
        one = lambda v, kind: pa.array([v], kind)
        dfs = np.bincount(self.words, minlength=len(self.terms))
        packed = [pack_words(self.terms), *map(pack, (dfs, self.sizes, self.words, self.counts))]
        columns = [one(v, pa.int64()) for v in (number, len(self.lengths), int(self.lengths.sum()), len(self.terms))]
        columns += [list_of(self.ids), list_of(pa.array(self.lengths, pa.int32())), *(one(p, pa.binary()) for p in packed)]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "documents", "total", "kinds", *_CHUNK])


def _chunk_schema(kind: str) -> str:
    return f"chunk long, documents long, total long, kinds long, ids array<{kind}>, lengths array<int>, terms binary, dfs binary, sizes binary, words binary, counts binary"


def _runs(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each of several runs."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _rows(item_id: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                c = _Chunk.of(row, batch)
                ends = pa.array(np.append(0, np.cumsum(c.sizes)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, c.terms.take(pa.array(c.words))), pa.ListArray.from_arrays(ends, pa.array(c.counts, pa.int32()))]
                columns = [pa.array([batch.column("segment")[row].as_py()] * len(c.ids), pa.string()), c.ids, pa.array(c.lengths, pa.int32()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["segment", item_id, "length", "words", "counts"])

    return run


def _bucket_of(terms: pa.Array) -> np.ndarray:
    """The folder of each word."""
    return (hashes(terms) % np.uint64(BUCKETS)).astype(np.int64)


def _live(spark: SparkSession, root: str) -> list[str]:
    """Names of the segments of the newest version."""
    if not table_exists(spark, f"{root}/versions"):
        return []
    newest = spark.read.parquet(f"{root}/versions").agg(F.max_by("segments", "version")).first()[0]
    return list(newest or [])


def _commit(spark: SparkSession, root: str, segments: list[str]) -> None:
    """The new version is what readers see; everything it names has been written before."""
    known = spark.read.parquet(f"{root}/versions").agg(F.max("version")).first()[0] if table_exists(spark, f"{root}/versions") else 0
    spark.createDataFrame([(known + 1, segments)], "version long, segments array<string>").coalesce(1).write.mode("append").parquet(f"{root}/versions")


def _union(spark: SparkSession, root: str, segments: list[str], part: str, item: str) -> DataFrame:
    """One table of a part of all named segments, with the segment's name; `item` is the id column with its type."""
    columns = {
        "texts": _chunk_schema(item.split(" ", 1)[1]),
        "blocks": "chunk long, mean double, terms binary, sizes binary, zones binary, best binary, filled binary, counts binary, bucket int",
        "mask": f"of string, {item}, length int, place long",
        "terms": "of string, term string, df long",
        "facts": "of string, documents long, words long",
    }[part]
    # The schema is stated, so that a segment without rows is read like any other.
    reader = spark.read.schema(f"{columns}, segment string, part string").option("basePath", f"{root}/segments")
    return reader.parquet(*(f"{root}/segments/segment={s}/part={part}" for s in segments)).drop("part")


def _item(df: DataFrame, item_id: str) -> str:
    return f"{item_id} {df.schema[item_id].dataType.simpleString()}"


def _write_segment(root: str, name: str, chunks: DataFrame, masked: DataFrame, held: DataFrame | None, item: str) -> None:
    """`chunks` of texts and what they mask (segment, id, length, place) among the chunks `held` become a segment.

    Counts carry the segment they are about (`of`), so that those about a merged segment go with it.
    """
    spark = chunks.sparkSession
    place = lambda part: f"{root}/segments/segment={name}/part={part}"
    table = lambda part: _union(spark, root, [name], part, item)
    chunks.write.option("parquet.block.size", GROUP_BYTES).parquet(place("texts"))
    masked.select(F.col("segment").alias("of"), item.split()[0], "length", "place").write.parquet(place("mask"))
    documents, total, kinds = table("texts").agg(F.sum("documents"), F.sum("total"), F.sum("kinds")).first()
    mean = total / documents if total else 1.0
    blocks = table("texts").select("chunk", *_CHUNK).mapInArrow(_make_blocks(mean), "chunk long, mean double, terms binary, sizes binary, zones binary, best binary, filled binary, counts binary, bucket int")
    blocks.write.option("parquet.block.size", GROUP_BYTES).partitionBy("bucket").parquet(place("blocks"))
    words = (kinds or 0) + (masked.agg(F.sum("length")).first()[0] or 0 if held is not None else 0)
    ranges, row = -(-words // RANGE_WORDS) or 1, "range int, of string, terms binary, dfs binary"
    counts = table("texts").select("terms", "dfs").mapInArrow(_frequencies(name, ranges), row)
    if held is not None:
        found = _with_gone(held.select("segment", "chunk", *_CHUNK), masked, "inner")
        counts = counts.unionByName(found.mapInArrow(_lost_frequencies(ranges), row))
    together = counts.repartition("range").sortWithinPartitions("range", "of")
    together.mapInArrow(_added(name), "of string, term string, df long").write.parquet(place("terms"))
    lost = masked.groupBy(F.col("segment").alias("of")).agg((-F.count("*")).alias("documents"), (-F.sum("length")).alias("words"))
    own = spark.createDataFrame([(name, documents or 0, total or 0)], "of string, documents long, words long")
    own.unionByName(lost).coalesce(1).write.parquet(place("facts"))


def _gone(masked: DataFrame) -> DataFrame:
    """(segment, chunk, gone) of masked places (segment, place): the numbers of a chunk's masked texts."""
    number = F.col("place").bitwiseAND((1 << TEXT_BITS) - 1).cast("int")
    return masked.groupBy("segment", F.shiftright("place", TEXT_BITS).alias("chunk")).agg(F.collect_list(number).alias("gone"))


def _with_gone(chunks: DataFrame, masked: DataFrame, how: str) -> DataFrame:
    """Chunks with their masked texts, sent to where the chunks are unless there are too many of them."""
    gone = _gone(masked)
    return chunks.join(F.broadcast(gone) if masked.count() <= MAX_MASKED else gone, ["segment", "chunk"], how)


def _dealt(of: str, terms: pa.Array, dfs: np.ndarray, ranges: int) -> pa.RecordBatch:
    """Words with their numbers, a row for each range of hashes."""
    part = (hashes(terms) // np.uint64(BUCKETS) % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    terms, dfs, (parts, first) = terms.take(pa.array(order)), dfs[order], np.unique(part[order], return_index=True)
    cuts = [slice(a, b) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(order)])]
    lists = [pa.array(parts, pa.int32()), pa.array([of] * len(parts), pa.string())]
    lists += [pa.array([pack_words(terms[c]) for c in cuts], pa.binary()), pa.array([pack(dfs[c]) for c in cuts], pa.binary())]
    return pa.RecordBatch.from_arrays(lists, names=["range", "of", "terms", "dfs"])


def _summed(parts: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    """Each word once, its numbers added up."""
    terms = pa.concat_arrays([t for t, _ in parts]).dictionary_encode()
    sums = np.bincount(terms.indices.to_numpy(), weights=np.concatenate([n for _, n in parts]), minlength=len(terms.dictionary))
    return terms.dictionary, sums.astype(np.int64)


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple[pa.RecordBatch, int]], list[pa.Array]]]:
    """Rows, some with a bounded number of words at a time, and their words."""
    own, terms, size = [], [], 0
    for batch in batches:
        for row in range(batch.num_rows):
            own, terms = [*own, (batch, row)], [*terms, unpack_words(batch.column("terms")[row].as_py())]
            size += len(terms[-1])
            if size > 2 * RANGE_WORDS:
                yield own, terms
                own, terms, size = [], [], 0
    if own:
        yield own, terms


def _frequencies(name: str, ranges: int):
    """In how many texts the words of chunks are, those of some chunks added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, terms in _worded(batches):
            yield _dealt(name, *_summed([(t, unpack(batch.column("dfs")[row].as_py())) for (batch, row), t in zip(own, terms)]), ranges)

    return run


def _lost_frequencies(ranges: int):
    """In how many masked texts (gone) the words of chunks are, those of some chunks of a segment added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, _ in _worded(batches):
            lost = defaultdict(list)
            for batch, row in own:
                c = _Chunk.of(row, batch)
                gone = np.zeros(len(c.sizes), bool)
                gone[batch.column("gone")[row].values.to_numpy()] = True
                df = np.bincount(c.words[np.repeat(gone, c.sizes)], minlength=len(c.terms))
                some = np.flatnonzero(df)
                lost[batch.column("segment")[row].as_py()].append((c.terms.take(pa.array(some)), df[some]))
            for of, parts in lost.items():
                yield _dealt(of, *_summed(parts), ranges)

    return run


def _added(name: str):
    """(of, term, df) of rows by range and segment: those about the segment `name` count, those about others are taken from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def made() -> Iterator[pa.RecordBatch]:
            if held:
                terms, df = _summed(held)
                of = pa.array([key[1]] * len(terms), pa.string())
                yield pa.RecordBatch.from_arrays([of, terms, pa.array(df if key[1] == name else -df)], names=["of", "term", "df"])

        for batch in batches:
            for here, *words in zip(zip(batch.column("range").to_pylist(), batch.column("of").to_pylist()), batch.column("terms"), batch.column("dfs")):
                if here != key:
                    yield from made()
                    held, key = [], here
                held.append((unpack_words(words[0].as_py()), unpack(words[1].as_py())))
        yield from made()

    return run


def _make_blocks(mean: float):
    """A row for each chunk and folder of words: words, how many blocks each has, and by block the zone, the highest gain, which texts of
    the zone have the word, and how often each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                c, number = _Chunk.of(at, batch), batch.column("chunk")[at].as_py()
                if not len(c.words):
                    continue
                bucket = _bucket_of(c.terms)
                by_bucket = np.argsort(bucket, kind="stable")
                rank = np.empty(len(bucket), np.int64)
                rank[by_bucket] = np.arange(len(bucket))
                text = np.repeat(np.arange(len(c.sizes)), c.sizes)
                key = rank[c.words] << TEXT_BITS | text
                order = np.argsort(key)
                key, tf, length = key[order], c.counts[order], c.lengths[text[order]]
                block = key >> ZONE_BITS
                first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
                gain = np.maximum.reduceat(_gain(tf, length, mean), first)
                best = np.minimum(np.ceil(gain * (STEPS / (K1 + 1))), STEPS).astype(np.int64)
                filled = np.bitwise_or.reduceat(1 << (key & ((1 << ZONE_BITS) - 1)), first)
                term, zone = key[first] >> TEXT_BITS, (key[first] & ((1 << TEXT_BITS) - 1)) >> ZONE_BITS
                sizes = np.bincount(term, minlength=len(bucket))
                terms = c.terms.take(pa.array(by_bucket))
                words = np.searchsorted(bucket[by_bucket], np.arange(BUCKETS + 1))
                blocks = np.append(0, np.cumsum(sizes))[words]
                postings = np.append(first, len(key))[blocks]
                rows = []
                for k in range(BUCKETS):
                    w, b, p = (slice(int(e[k]), int(e[k + 1])) for e in (words, blocks, postings))
                    if w.stop > w.start:
                        rows.append((number, mean, pack_words(terms[w]), *map(pack, (sizes[w], zone[b], best[b], filled[b], tf[p])), k))
                kinds = [pa.int64(), pa.float64(), *[pa.binary()] * 6, pa.int32()]
                names = ["chunk", "mean", "terms", "sizes", "zones", "best", "filled", "counts", "bucket"]
                yield pa.RecordBatch.from_arrays([pa.array(list(v), kind) for v, kind in zip(zip(*rows), kinds)], names=names)

    return run


def _count_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 20
    for batch in batches:
        for start in range(0, batch.num_rows, 1 << TEXT_BITS):
            part = batch.slice(start, 1 << TEXT_BITS)
            for at, size in slices(part.column("text"), CHUNK_BYTES):
                texts = part.slice(at, size)
                row, word = split(texts.column("text"))
                bits = len(word.dictionary).bit_length()
                lengths = np.bincount(row, minlength=size)
                # 2**ZONE_BITS texts of like length in a row make a zone: like lengths make for like gains, and so for close bounds.
                order = np.argsort(lengths, kind="stable")
                rank = np.empty(size, np.int64)
                rank[order] = np.arange(size)
                pair = np.sort(rank[row] << bits | word.indices.to_numpy())
                first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])[: len(pair)])
                text, words = pair[first] >> bits, pair[first] & ((1 << bits) - 1)
                counts, sizes = np.diff(np.append(first, len(pair))), np.bincount(text, minlength=size)
                terms = word.dictionary.cast(pa.string())
                yield _Chunk(texts.column("id").take(pa.array(order)), lengths[order], terms, sizes, words, counts).row(number)
                number += 1


def _counted(df: DataFrame, item_id: str, text: str) -> DataFrame:
    """Chunks of texts, each with its words counted; texts without words are there too. No shuffle."""
    lowered = df.select(F.col(item_id).alias("id"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    return lowered.mapInArrow(_count_texts, _chunk_schema(df.schema[item_id].dataType.simpleString()))


def _repacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks without their masked texts (gone), put together to chunks of full size."""
    number, held, size, texts = TaskContext.get().partitionId() << 20, [], 0, 0
    for batch in batches:
        for row in range(batch.num_rows):
            c, gone = _Chunk.of(row, batch), batch.column("gone")[row]
            if gone.is_valid:
                kept = np.ones(len(c.sizes), bool)
                kept[gone.values.to_numpy()] = False
                c = c.take(np.flatnonzero(kept))
            if held and (size + len(c.words) > CHUNK_POSTINGS or texts + len(c.sizes) > 1 << TEXT_BITS):
                yield _Chunk.made(held).row(number)
                number, held, size, texts = number + 1, [], 0, 0
            held, size, texts = [*held, c], size + len(c.words), texts + len(c.sizes)
    if held:
        yield _Chunk.made(held).row(number)


def _placed(chunks: DataFrame, item_id: str) -> DataFrame:
    """(segment, id, length, place) of every text."""
    each = chunks.select("segment", "chunk", F.posexplode(F.arrays_zip("ids", "lengths")).alias("number", "text"))
    place = F.shiftleft("chunk", TEXT_BITS) + F.col("number")
    return each.select("segment", F.col("text.ids").alias(item_id), F.col("text.lengths").alias("length"), place.alias("place"))


def _unmasked(texts: DataFrame, mask: DataFrame, item_id: str) -> DataFrame:
    gone = mask.select(F.col("of").alias("segment"), F.col(item_id).alias("_id"))
    return texts.join(gone, (texts["segment"] == gone["segment"]) & (texts[item_id] == gone["_id"]), "left_anti")


def apply(spark: SparkSession, root: str, load: DataFrame, item_id: str = "doc_id", text: str = "text", deleted: DataFrame | None = None) -> str:
    """Add a load (one row per id) to the index under `root`: its texts replace older ones of their ids, `deleted` ids go.

    An id that is loaded and deleted at once stays as loaded. A load that dies half way leaves no trace in the index: its segment is in no version.
    """
    live, item = _live(spark, root), _item(load, item_id)
    name = f"{len(live):06d}-{uuid.uuid4().hex[:12]}"
    touched = load.select(item_id) if deleted is None else load.select(item_id).unionByName(deleted.select(item_id)).distinct()
    if live:
        held = _union(spark, root, live, "texts", item)
        known = _unmasked(_placed(held, item_id), _union(spark, root, live, "mask", item).drop("segment"), item_id)
        masked = materialize(known.join(touched, item_id, "left_semi").select("segment", item_id, "length", "place"))
    else:
        held, masked = None, spark.createDataFrame([], f"segment string, {item}, length int, place long")
    _write_segment(root, name, _counted(load, item_id, text), masked, held, item)
    _commit(spark, root, [*live, name])
    return name


def merge(spark: SparkSession, root: str, most: int, item: str = "doc_id bigint") -> list[str]:
    """Merge all segments of at most `most` texts into one; returns the live segments. The merged ones stay as they were."""
    live = _live(spark, root)
    table = lambda part, of: _union(spark, root, of, part, item)
    sizes = {r["segment"]: r["n"] for r in table("texts", live).groupBy("segment").agg(F.sum("documents").alias("n")).collect()}
    small = [s for s in live if sizes.get(s, 0) <= most]
    if len(small) < 2:
        return live
    large = [s for s in live if s not in small]
    gone = table("mask", live).where(F.col("of").isin(small)).select(F.col("of").alias("segment"), "place")
    chunks = _with_gone(table("texts", small).select("segment", "chunk", *_CHUNK), gone, "left")
    # What the merged segments masked in others stays masked.
    masked = materialize(table("mask", small).where(F.col("of").isin(large)).select(F.col("of").alias("segment"), item.split()[0], "length", "place"))
    name = f"{len(live):06d}-{uuid.uuid4().hex[:12]}"
    _write_segment(root, name, chunks.mapInArrow(_repacked, _chunk_schema(item.split(" ", 1)[1])), masked, table("texts", large) if large else None, item)
    _commit(spark, root, [*large, name])
    return [*large, name]


def read(spark: SparkSession, root: str, item: str = "doc_id bigint") -> Segments:
    """The newest version of the index; `item` is the id column with its type."""
    live = _live(spark, root)
    table = lambda part: _union(spark, root, live, part, item)
    facts = table("facts").where(F.col("of").isin(live)).agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("n"), F.sum("words").alias("w")).first()
    mean_length = facts["w"] / facts["n"] if facts["n"] else 0.0
    terms = materialize(table("terms").where(F.col("of").isin(live)).groupBy("term").agg(F.sum("df").alias("df")).where("df > 0"))
    mean_idf = terms.agg(F.avg(_idf(F.lit(facts["n"]), F.col("df")))).first()[0]
    corpus = Corpus(facts["n"], mean_length, mean_idf or 0.0)
    return Segments(table("blocks"), table("texts"), table("mask").drop("segment"), terms, corpus, item.split()[0], live)


def plain(index: Segments) -> bm25.Index:
    """The unmasked texts of all segments as an index of plain postings."""
    item_id, corpus = index.item_id, index.corpus
    texts = _unmasked(index.texts, index.mask, item_id)
    each = texts.select(item_id, "length", F.inline(F.arrays_zip(F.col("words").alias("term"), F.col("counts").alias("tf"))))
    facts = [(corpus.documents, corpus.mean_length, corpus.mean_idf)]
    stats = texts.sparkSession.createDataFrame(facts, "documents long, mean_length double, mean_idf double")
    return bm25.Index(each, index.terms, stats, texts.select(item_id), item_id)


def _gain(tf: np.ndarray, length: np.ndarray, mean: float) -> np.ndarray:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def _weighed(queries: DataFrame, index: Segments, query_id: str, query_text: str, eps: float) -> DataFrame:
    """(query_id, term, weight): the words of each query that the index knows."""
    words = queries.select(query_id, F.explode(tokenize(F.col(query_text))).alias("term")).groupBy(query_id, "term").agg(F.count("*").alias("_n"))
    weight = (F.col("_n") * term_weight(index.corpus, F.col("df"), eps)).alias("weight")
    return materialize(words.join(index.terms, "term").select(query_id, "term", weight))


def _numbered(index: Segments, segment: str) -> Column:
    return (F.array_position(F.array(*(F.lit(s) for s in index.live)), F.col(segment)) - 1).cast("int").alias("segment")


@dataclass(frozen=True)
class _Asked:
    """What every task of a search knows: numbered words with their queries and weights, and, later, zones chosen and thresholds."""

    names: pa.Array
    terms: pa.Array  # by number
    first: np.ndarray  # of each term in `query` and `weight`, and the end
    query: np.ndarray
    weight: np.ndarray
    mean: float
    k: int
    chosen: dict[tuple[int, int], np.ndarray]  # queries by (segment, zone)
    threshold: np.ndarray | None = None

    @staticmethod
    def of(words: pa.Table, index: Segments, k: int, query_id: str) -> _Asked:
        names, terms = words.column(query_id).combine_chunks().unique(), words.column("term").combine_chunks().dictionary_encode()
        code = terms.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        first = np.searchsorted(code[order], np.arange(len(terms.dictionary) + 1))
        query = pc.index_in(words.column(query_id).combine_chunks(), value_set=names).to_numpy()[order].astype(np.int64)
        return _Asked(names, terms.dictionary, first, query, words.column("weight").to_numpy()[order], index.corpus.mean_length or 1.0, k, {})

    def met(self, word: np.ndarray, sizes: np.ndarray | int = 1) -> np.ndarray:
        """How many (query, posting) the blocks of these words make."""
        return np.where(word >= 0, (self.first[word + 1] - self.first[np.maximum(word, 0)]) * sizes, 0)

    def each(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in `word`, query, weight) of every query that has a word."""
        many = self.met(word)
        at = np.repeat(np.arange(len(word)), many)
        slot = np.repeat(self.first[np.maximum(word, 0)] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return at, self.query[slot], self.weight[slot]

    def able(self, bounds: np.ndarray, segment: np.ndarray, zone: np.ndarray) -> np.ndarray:
        """(zones x queries): what is still to be scored, or, without thresholds, what has been chosen to be scored first."""
        wanted = np.zeros(bounds.shape, bool) if self.threshold is None else (bounds > 0) & (bounds >= self.threshold - SLACK)
        for row, place in enumerate(zip(segment.tolist(), zone.tolist())):
            if place in self.chosen:
                wanted[row, self.chosen[place]] = self.threshold is None
        return wanted


def _meet(asked: _Asked):
    """Of the rows of blocks, the blocks of words asked for: each once however many queries have the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, lists in _worded(batches):
            number = pc.fill_null(pc.index_in(pa.concat_arrays(lists), value_set=asked.terms), -1).to_numpy()
            ends = np.cumsum([0, *map(len, lists)])
            for at, (batch, row) in enumerate(own):
                word = number[ends[at] : ends[at + 1]]
                if (word < 0).all():
                    continue
                sizes, zones, best, filled, counts = (unpack(batch.column(c)[row].as_py()) for c in ("sizes", "zones", "best", "filled", "counts"))
                word = np.repeat(word, sizes)
                met = word >= 0
                counts = counts[np.repeat(met, np.bitwise_count(filled))]
                packed = [pa.array([pack(a)], pa.binary()) for a in (zones[met], word[met], best[met], filled[met], counts)]
                columns = [batch.column("segment").slice(row, 1), batch.column("chunk").slice(row, 1), pa.array([_scale(batch.column("mean")[row].as_py(), asked.mean)]), *packed]
                yield pa.RecordBatch.from_arrays(columns, names=["segment", "chunk", "scale", "zones", "words", "best", "filled", "counts"])

    return run


def _scale(then: float, now: float) -> float:
    """What a step of a block's highest gain is worth at another mean length than that of its segment's own texts, rounded up.

    With a longer mean length a gain grows by the ratio of the two at most; with a shorter one it shrinks.
    """
    return max(1.0, now / then) * (1 + 1e-6) * (K1 + 1) / STEPS


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk of the rows about it, which lie next to each other: its texts, its masked texts, and its blocks by zone."""

    def made(rows: list[tuple[pa.RecordBatch, int]]) -> Iterator[pa.RecordBatch]:
        of = lambda c: [b.column(c)[row] for b, row in rows if b.column(c)[row].is_valid]
        blocks = {c: np.concatenate([unpack(v.as_py()) for v in of(c)]) for c in ("zones", "words", "best", "filled", "counts") if of(c)}
        if not blocks:
            return
        order, many = np.argsort(blocks["zones"] << 32 | blocks["words"]), np.bitwise_count(blocks["filled"]).astype(np.int64)
        counts = blocks["counts"][_runs((np.cumsum(many) - many)[order], many[order])]
        zones, sizes = np.unique(blocks["zones"], return_counts=True)
        packed = [pack(a) for a in (zones, sizes, blocks["words"][order], blocks["best"][order], blocks["filled"][order], counts)]
        batch, row = rows[0]
        (ids,), (lengths,), gone, scale = of("ids"), of("lengths"), of("gone"), of("scale")[0]
        columns = [batch.column("segment").slice(row, 1), batch.column("chunk").slice(row, 1)]
        columns += [pa.array([v.as_py() if isinstance(v, pa.Scalar) else v], kind) for v, kind in ((ids, ids.type), (lengths, lengths.type), (gone[0] if gone else [], pa.list_(pa.int32())))]
        columns += [pa.array([scale.as_py()]), *(pa.array([p], pa.binary()) for p in packed)]
        yield pa.RecordBatch.from_arrays(columns, names=["segment", "chunk", "ids", "lengths", "gone", "scale", "zones", "sizes", "words", "best", "filled", "counts"])

    held, key = [], None
    for batch in batches:
        for row, here in enumerate(zip(batch.column("segment").to_pylist(), batch.column("chunk").to_pylist())):
            if here != key and held:
                yield from made(held)
                held = []
            held, key = [*held, (batch, row)], here
    if held:
        yield from made(held)


class _Zones:
    """The blocks of a chunk that a search asks for, zone by zone."""

    def __init__(self, asked: _Asked, batch: pa.RecordBatch, row: int) -> None:
        self.asked, self.segment = asked, batch.column("segment")[row].as_py()
        self.zones, sizes, self.word, best = (unpack(batch.column(c)[row].as_py()) for c in ("zones", "sizes", "words", "best"))
        self.heads = np.append(0, np.cumsum(sizes))
        self.high = best * batch.column("scale")[row].as_py()
        # Zones are told apart in their whole segment.
        self.numbers = self.zones + (batch.column("chunk")[row].as_py() << (TEXT_BITS - ZONE_BITS))

    def parts(self, met: np.ndarray) -> Iterator[tuple[int, int]]:
        """Zones of a bounded number of cells in a row; `met` has what each block makes."""
        ends = np.cumsum(np.maximum(np.add.reduceat(met, self.heads[:-1]), len(self.asked.names)))
        start = 0
        while start < len(ends):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + CELLS, side="right")))
            yield start, stop
            start = stop

    def bounds(self, start: int, stop: int) -> np.ndarray:
        """(zones x queries): the best score that a text of a zone could have."""
        n, own = len(self.asked.names), slice(self.heads[start], self.heads[stop])
        at, query, weight = self.asked.each(self.word[own])
        zone = np.repeat(np.arange(stop - start), np.diff(self.heads[start : stop + 1]))
        return np.bincount(zone[at] * n + query, weights=weight * self.high[own][at], minlength=(stop - start) * n).reshape(-1, n)


def _best_zones(asked: _Asked, query_id: str):
    """The k zones of a task with the highest bounds for each query."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for batch in batches:
            for row in range(batch.num_rows):
                met = _Zones(asked, batch, row)
                for start, stop in met.parts(asked.met(met.word)):
                    bounds = met.bounds(start, stop)
                    zone, query = np.nonzero(best_of(bounds, asked.k) & (bounds > 0))
                    yield pa.table({"query": query, "segment": np.full(len(zone), met.segment, np.int32), "zone": met.numbers[start:stop][zone], "bound": bounds[zone, query]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for part in chain(found(batches), [None]):
            held += [part] if part is not None else []
            if held and (part is None or sum(map(len, held)) > max(CELLS, 4 * asked.k * len(asked.names))):
                rows = pa.concat_tables(held).sort_by([("query", "ascending"), ("bound", "descending"), ("segment", "ascending"), ("zone", "ascending")])
                query = rows.column("query").to_numpy()
                held = [rows.filter(pa.array(np.arange(len(query)) - np.searchsorted(query, query, side="left") < asked.k))]
        for rows in held:
            yield from rows.set_column(0, query_id, asked.names.take(rows.column("query").combine_chunks())).to_batches()

    return run


def _zone_scores(asked: _Asked, item_id: str, query_id: str):
    """The k best (query, id, score) of a task, masked texts left out, and a row that counts the postings that match (matching) and are scored (read)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, n, read, matching, kind = _Best(asked.k, len(asked.names)), len(asked.names), 0, 0, None

        for batch in batches:
            for row in range(batch.num_rows):
                met, ids, length = _Zones(asked, batch, row), batch.column("ids")[row].values, batch.column("lengths")[row].values.to_numpy()
                kind, names = ids.type, ids.to_numpy(zero_copy_only=False)
                masked = np.zeros(len(ids), bool)
                masked[batch.column("gone")[row].values.to_numpy()] = True
                filled, tf = (unpack(batch.column(c)[row].as_py()) for c in ("filled", "counts"))
                block, bit = np.nonzero(filled[:, None] >> np.arange(1 << ZONE_BITS) & 1)
                zone = np.repeat(np.arange(len(met.zones)), np.diff(met.heads))
                gain = _gain(tf, length[met.zones[zone[block]] << ZONE_BITS | bit], asked.mean)
                first = np.append(0, np.cumsum(np.bitwise_count(filled), dtype=np.int64))
                pairs = asked.met(met.word, np.diff(first))
                matching += int(pairs.sum())
                for start, stop in met.parts(pairs):
                    # The zones chosen first need no bounds.
                    bounds = met.bounds(start, stop) if asked.threshold is not None else np.zeros((stop - start, n))
                    wanted = asked.able(bounds, np.full(stop - start, met.segment), met.numbers[start:stop])
                    own = np.arange(first[met.heads[start]], first[met.heads[stop]])
                    own = own[wanted.any(axis=1)[zone[block[own]] - start]]
                    at, query, weight = asked.each(met.word[block[own]])
                    able = wanted[(zone[block[own]] - start)[at], query]
                    at, query, weight = at[able], query[able], weight[able]
                    read += len(at)
                    text = (zone[block[own]] - start) << ZONE_BITS | bit[own]
                    cells, gains, many = text[at] * n + query, weight * gain[own][at], (stop - start << ZONE_BITS) * n
                    if many <= max(CELLS, 2 * len(cells)):
                        total = np.bincount(cells, weights=gains, minlength=many)
                        cells = np.flatnonzero(total)
                        total = total[cells]
                    else:
                        cells, back = np.unique(cells, return_inverse=True)
                        total = np.bincount(back, weights=gains, minlength=len(cells))
                    text = met.zones[start:stop][cells // n >> ZONE_BITS] << ZONE_BITS | (cells // n & ((1 << ZONE_BITS) - 1))
                    kept = ~masked[text]
                    best.add(cells[kept] % n, names[text[kept]], np.round(total[kept], DECIMALS))
        if kind is None:
            return
        query, items, score = best.fold()
        q, m = asked.names.take(pa.array(query.astype(np.int64))), len(query)
        columns = [pa.concat_arrays([q, pa.nulls(1, q.type)]), pa.concat_arrays([pa.array(items, kind), pa.nulls(1, kind)])]
        counts = [pa.array([*score.tolist(), None], pa.float64()), *(pa.array([None] * m + [v], pa.int64()) for v in (read, matching))]
        yield pa.RecordBatch.from_arrays(columns + counts, names=[query_id, item_id, "score", "read", "matching"])

    return run


def _found(words: DataFrame, index: Segments, k: int, query_id: str) -> DataFrame:
    """(query_id, id, score, read, matching): whole scores of texts that include the k best of each query, and rows that count postings.

    A block meets the queries inside the task that holds its chunk, so what is shuffled is each block once, however many queries ask for it.
    """
    kind = lambda df, c: f"`{c}` {df.schema[c].dataType.simpleString()}"
    rows, size = words.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term") + 16), F.lit(0))).first()
    turns = max(1, -(-rows // MAX_WORDS), -(-size // MAX_WORD_BYTES))
    parts = [_found_block(words.where(F.pmod(F.xxhash64(query_id), F.lit(turns)) == t) if turns > 1 else words, index, k, query_id, kind) for t in range(turns)]
    return reduce(DataFrame.unionByName, parts)


def _found_block(words: DataFrame, index: Segments, k: int, query_id: str, kind) -> DataFrame:
    item_id, spark = index.item_id, words.sparkSession
    schema = f"{kind(words, query_id)}, {kind(index.mask, item_id)}, score double, read long, matching long"
    table = words.toArrow()  # bounded by MAX_WORDS
    if not table.num_rows:
        return spark.createDataFrame([], schema)
    asked = _Asked.of(table, index, k, query_id)
    # Only folders of the words are opened.
    opened = np.unique(_bucket_of(asked.terms)).tolist()
    own = [_numbered(index, "segment"), "chunk"]
    blocks = index.blocks.where(F.col("bucket").isin(opened)).select(*own, "mean", "terms", "sizes", "zones", "best", "filled", "counts")
    places = "segment int, chunk long"
    packed = lambda *columns: ", ".join(f"{c} binary" for c in columns)
    blocks = blocks.mapInArrow(_meet(asked), f"{places}, scale double, {packed('zones', 'words', 'best', 'filled', 'counts')}")
    texts = index.chunks.select(*own, "ids", "lengths")
    gone = _gone(index.mask.where(F.col("of").isin(index.live)).select(F.col("of").alias("segment"), "place")).select(*own, "gone")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [blocks, texts, gone]).repartition("segment", "chunk")
    ids = index.chunks.schema["ids"].dataType.simpleString()
    gathered = f"{places}, ids {ids}, lengths array<int>, gone array<int>, scale double, {packed('zones', 'sizes', 'words', 'best', 'filled', 'counts')}"
    met = materialize(rows.sortWithinPartitions("segment", "chunk").mapInArrow(_gathered, gathered))

    order = [F.col("bound").desc(), "segment", "zone"]
    bounds = met.select("segment", "chunk", "scale", "zones", "sizes", "words", "best")
    promising = bounds.mapInArrow(_best_zones(asked, query_id), f"{kind(words, query_id)}, segment int, zone long, bound double")
    # k zones a query, sent to all tasks.
    first = rank_top(promising, query_id, order, k).select(query_id, "segment", "zone").toArrow()
    chosen: dict[tuple[int, int], list[int]] = defaultdict(list)
    for q, *place in zip(pc.index_in(first.column(query_id).combine_chunks(), value_set=asked.names).to_pylist(), first.column("segment").to_pylist(), first.column("zone").to_pylist()):
        chosen[tuple(place)].append(q)
    asked = replace(asked, chosen={place: np.array(q) for place, q in chosen.items()})

    scores = lambda asked, rows: materialize(rows.mapInArrow(_zone_scores(asked, item_id, query_id), schema))
    chunks = spark.createDataFrame([*{(segment, zone >> (TEXT_BITS - ZONE_BITS)) for segment, zone in chosen}], places)
    near = scores(asked, met.join(F.broadcast(chunks), ["segment", "chunk"], "left_semi")).withColumn("matching", F.lit(0).cast("long"))
    # Threshold: the k-th best of the texts in the k zones that promise most.
    ranked = rank_top(near.where(F.col("read").isNull()), query_id, [F.col("score").desc(), F.col(item_id)], k)
    kth = ranked.where(F.col("rank") == k - 1).select(query_id, "score").toArrow()
    threshold = np.full(len(asked.names), -np.inf)
    threshold[pc.index_in(kth.column(query_id).combine_chunks(), value_set=asked.names).to_numpy()] = kth.column("score").to_numpy()
    return near.unionByName(scores(replace(asked, threshold=threshold), met))


def search(queries: DataFrame, index: Segments, k: int, query_id: str = "query_id", query_text: str = "query", eps: float = 0.25) -> DataFrame:
    """Best k texts per query: (query_id, item_id, score, rank), as `bm25.search` gives them."""
    item_id = index.item_id
    if index.corpus.mean_idf < 0 or not index.corpus.documents:
        # A shared word can cost a text, so no bound holds and any text may fill a list: the search that scores every text is used.
        return bm25.search(queries, plain(index), k, query_id, query_text, K1, B, eps)
    scored = _found(_weighed(queries, index, query_id, query_text, eps), index, k, query_id).where(F.col("read").isNull()).drop("read", "matching")
    # Only the first k ids can fill a list with zeros.
    first = [r[0] for r in _unmasked(_placed(index.chunks, item_id), index.mask, item_id).select(item_id).orderBy(item_id).limit(k).collect()]
    kind = index.mask.schema[item_id].dataType.simpleString()
    fill = queries.select(query_id).distinct().select(query_id, F.explode(F.array(*map(F.lit, first)).cast(f"array<{kind}>")).alias(item_id))
    # A first id met with a score keeps it: its zero is the smaller of the two.
    both = scored.unionByName(fill.withColumn("score", F.lit(0.0))).groupBy(query_id, item_id).agg(F.max("score").alias("score"))
    return rank_top(both, query_id, [F.col("score").desc(), F.col(item_id)], k)


def postings_read(queries: DataFrame, index: Segments, k: int, query_id: str = "query_id", query_text: str = "query", eps: float = 0.25) -> DataFrame:
    """One row: postings that match a query's word, over all queries, and those that a search reads, repeats counted again."""
    found = _found(_weighed(queries, index, query_id, query_text, eps), index, k, query_id)
    return found.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("matching", "read")))
