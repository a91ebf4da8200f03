"""Language-model scoring with a probabilistic suffix tree over words.

Symbols are words and the end of a text; a context is up to `depth` symbols before one, the start of the text
among them. Every context that the learning texts hold at least `least` times is tested, however many there are; it
becomes a state if its next symbols differ from its parent's (the context without its oldest symbol) by
`divergence` nats a symbol and by more than chance; a state's suffixes are states too. The test against chance
compares the context's counts, under Dirichlet priors centred on the parent, with the parent itself: by chance
one of all the contexts of a depth passes with a probability below exp(-`chance`). Distributions are smoothed
towards the parent's (Witten-Bell), the root's by adding one half to every count, one more word standing for
all unseen. Scoring uses the longest suffix that is a state. The tree with no state but its root is the word model of `base_score`.

Word counts, next-symbol counts and states are tables. A depth counts only contexts whose parts were seen `least`
times at the depths before, which a bit filter tells; it lets too much through, never too little, and exact counts decide
afterwards. A state's probability of a symbol is its parent's times a factor, so a text's score is its
base score plus a sum of logarithms that meets them in a join on hashes; the most frequent ones, bounded by
a share of the tokens, are looked up in the task instead. Words and contexts are told apart by 64-bit hashes.

A null text is an empty one: it has the end token alone. Rows are scored one by one, repeated and null ids
included. With no learning row every count is 0. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.llm import rolling
from opsledger.llm.batches import steps, text_column
from opsledger.llm.tables import materialize, scratch

END = 0  # the key of the end token among word hashes
START = 0x5851F42D4C957F2D  # what stands before the first word, in contexts only
WORD, TEXT, STATE, PAIR = 0, 1, 2, 3  # what a key names
PRIORS = (1.0, 64.0, 4096.0)
FILTER_WORDS = 1 << 22  # the longest bit filter, in words of 64 bits
_PAIR_SQL = "ctx ^ (shiftleft(next, 23) | shiftrightunsigned(next, 41))"


@dataclass(frozen=True)
class Rule:
    least: int = 5  # times a context is seen
    depth: int = 4
    divergence: float = 0.02
    chance: float = 3.0
    known: int = 100_000  # what has at least this share of the tokens is looked up in the task


class Tally:
    """Counts of keys, merged now and then; `drain` gives them up when there are many. Further columns follow their key."""

    def __init__(self, names: list[str], most: int = 400_000):
        self.names, self.most, self.waiting, self.size = names, most, [], 0

    def _merge(self, keys: np.ndarray, n: np.ndarray | None, more: list[np.ndarray]) -> tuple:
        keys, first, back = np.unique(keys, return_index=True, return_inverse=True)
        return keys, np.bincount(back, weights=n, minlength=len(keys)).astype(np.int64), [c[first] for c in more]

    def add(self, keys: np.ndarray, *more: np.ndarray) -> None:
        self.waiting.append(self._merge(keys, None, list(more)))
        self.size += len(self.waiting[-1][0])

    def drain(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.waiting and (last or self.size > 2 * self.most):
            keys, n, more = (list(c) for c in zip(*self.waiting))
            merged = self._merge(np.concatenate(keys), np.concatenate(n), [np.concatenate(c) for c in zip(*more)])
            self.waiting, self.size = [merged], len(merged[0])
            if last or self.size > self.most:
                self.waiting, self.size = [], 0
                columns = [*merged[2], merged[1]] if merged[2] else [merged[0], merged[1]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=self.names)


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word, number of words of each text)."""
    low = rolling.Texts.of(text_column(batch.column("text"))).lower()
    found = rolling.words(low)
    return rolling.word_hashes(low, found).view(np.int64), found.counts


def _tallied(columns: Callable[[pa.RecordBatch], tuple[np.ndarray, ...]], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(names)
        for batch in steps(batches):
            tally.add(*columns(batch))
            yield from tally.drain()
        yield from tally.drain(True)

    return run


def _word_keys(batch: pa.RecordBatch) -> tuple[np.ndarray]:
    hashes, counts = _words(batch)
    return (np.concatenate([hashes, np.full(len(counts), END)]),)


def vocabulary(learning: DataFrame) -> DataFrame:
    """(key, n): every distinct token of the learning texts with its count, the end token included."""
    counts = learning.select("text").mapInArrow(_tallied(_word_keys, ["key", "n"]), "key long, n long")
    return materialize(counts.groupBy("key").agg(F.sum("n").alias("n")))


def _mixed(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of two."""
    with np.errstate(over="ignore"):
        x = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(b, np.int64).view(np.uint64)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        return (x ^ (x >> np.uint64(31))).view(np.int64)


class Tokens:
    """The tokens of a batch, ends included, and the contexts before them."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, depth: int):
        self.row = np.repeat(np.arange(len(counts)), counts + 1)
        self.word = np.full(len(self.row), END, dtype=np.int64)
        self.word[np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)] = hashes
        first = np.cumsum(counts + 1) - (counts + 1)
        self.at = np.arange(len(self.row)) - np.repeat(first, counts + 1)
        self.contexts = [np.zeros(len(self.row), np.int64)]
        for d in range(1, depth + 1):
            before = np.where(self.at == d - 1, START, self.back(self.word, d))
            self.contexts.append(_mixed(before, self.contexts[-1]))

    def back(self, values: np.ndarray, by: int) -> np.ndarray:
        """The value of the token `by` before, whatever text it is of."""
        return np.concatenate([np.zeros(min(by, len(values)), values.dtype), values[: max(len(values) - by, 0)]])

    def pairs(self, depth: int) -> np.ndarray:
        w = self.word.view(np.uint64)
        return self.contexts[depth] ^ ((w << np.uint64(23)) | (w >> np.uint64(41))).view(np.int64)


@dataclass(frozen=True)
class Filter:
    """Bits that tell keys which are not in a set; some others pass too."""

    words: np.ndarray

    @staticmethod
    def of(keys: DataFrame) -> Filter:
        """Of the column `key`; four keys a word while the longest filter is not reached."""
        size = min(max(keys.count() // 4, 1), FILTER_WORDS)
        bits = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(key, {s}) & 63 as int))" for s in (0, 6, 12))
        place = F.expr(f"shiftrightunsigned(key, 18) % {size}L").alias("place")
        rows = keys.select(place, F.expr(bits).alias("bits")).groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
        words = np.zeros(size, dtype=np.uint64)
        words[rows.column("place").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
        return Filter(words)

    def has(self, keys: np.ndarray) -> np.ndarray:
        k, one, low = keys.view(np.uint64), np.uint64(1), np.uint64(63)
        bits = reduce(np.bitwise_or, (one << ((k >> np.uint64(s)) & low) for s in (0, 6, 12)))
        return self.words[(k >> np.uint64(18)) % np.uint64(len(self.words))] & bits == bits


def _next_counts(learning: DataFrame, depths: range, grams: Filter) -> DataFrame:
    """(depth, ctx, parent, next, n) of contexts whose runs of as many symbols as `grams` tells were all seen often enough.

    `grams` holds what is one symbol shorter than the contexts of the first depth.
    """
    names = ["depth", "ctx", "parent", "next", "n"]
    least, most = depths[0], depths[-1]
    shared = learning.sparkSession.sparkContext.broadcast(grams)

    def columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        tokens = Tokens(*_words(batch), most)
        seen = shared.value.has(tokens.pairs(least - 1) if least > 1 else tokens.word)
        found, often = [], np.ones(len(seen), bool)
        for d in depths:
            # A context of d symbols before a token ends where the token before it does.
            often = often & tokens.back(seen, d - least + 1)
            ok = (often & (tokens.at >= d - 1)) | ((tokens.at == 0) & (d == 1))
            parent = tokens.contexts[d - 1][ok]
            found.append((tokens.pairs(d)[ok], np.full(len(parent), d, np.int32), tokens.contexts[d][ok], parent, tokens.word[ok]))
        return tuple(np.concatenate(c) for c in zip(*found))

    raw = learning.select("text").mapInArrow(_tallied(columns, names), "depth int, ctx long, parent long, next long, n long")
    return raw.groupBy("ctx", "next").agg(F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.sum("n").alias("n"))


def _log_gamma(x: Column) -> Column:
    z = x + 8
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z)
    return series - F.log(reduce(lambda a, b: a * b, (x + i for i in range(8))))


def _measured(pairs: DataFrame, rule: Rule) -> DataFrame:
    """(ctx, parent, total, kinds, far, gain) per context of (ctx, parent, next, n, p): p is the parent's probability."""
    n, p = F.col("n").cast("double"), F.col("p")
    sums = [F.sum(_log_gamma(n + a * p) - _log_gamma(a * p) - n * F.log(p)).alias(f"g{i}") for i, a in enumerate(PRIORS)]
    total = F.col("total").cast("double")
    gains = [F.col(f"g{i}") + math.lgamma(a) - _log_gamma(total + a) for i, a in enumerate(PRIORS)]
    grouped = pairs.groupBy("ctx").agg(
        F.max("parent").alias("parent"), F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum(n * F.log(n / p)).alias("far"), *sums
    )
    return grouped.filter(F.col("total") >= rule.least).select(
        "ctx", "parent", "total", "kinds", (F.col("far") - total * F.log(total)).alias("far"),
        (F.greatest(*gains) - math.log(len(PRIORS))).alias("gain"),
    )


def _own() -> Column:
    """The smoothed probability of a counted symbol in its context."""
    return (F.col("n") + F.col("kinds") * F.col("p")) / (F.col("total") + F.col("kinds"))


@dataclass(frozen=True)
class Tree:
    """`states` is a table (ctx, parent, depth, total, kinds), `pairs` a table (ctx, next, n, p, own, rest); p is the parent's probability."""

    vocab: DataFrame
    states: DataFrame | None
    pairs: DataFrame | None
    tokens: int
    words: int
    ends: int

    @property
    def whole(self) -> float:
        return self.tokens + 0.5 * (self.words + 1)

    @property
    def log10(self) -> np.ndarray:
        """(states, words and one unseen) of a small tree, the root first."""
        vocab = self.vocab.orderBy("key").collect()
        place = {r["key"]: k for k, r in enumerate(vocab)}
        made = {0: np.array([r["n"] + 0.5 for r in vocab] + [0.5]) / self.whole}
        for s in [] if self.states is None else self.states.orderBy("depth").collect():
            made[s["ctx"]] = made[s["parent"]] * s["kinds"] / (s["total"] + s["kinds"])
            for r in self.pairs.filter(F.col("ctx") == s["ctx"]).collect():
                made[s["ctx"]][place[r["next"]]] = r["own"]
        return np.log10(np.stack(list(made.values())))


def grow(learning: DataFrame, vocab: DataFrame, rule: Rule = Rule()) -> Tree:
    """The suffix tree of the learning texts."""
    totals = vocab.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.sum(F.when(F.col("key") == END, F.col("n"))), F.lit(0)).alias("e")
    ).first()
    plain = Tree(vocab, None, None, int(totals["n"]), int(totals["v"]), int(totals["e"]))
    if not plain.tokens:
        return plain
    # Counts of contexts that did not become states go with the block.
    with scratch(learning.sparkSession):
        states, pairs = _states(learning, plain, rule)
    return Tree(vocab, states, pairs, plain.tokens, plain.words, plain.ends)


def _states(learning: DataFrame, plain: Tree, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """The tables `states` and `pairs` of a tree; the tables they are made from belong to the current `scratch`."""
    vocab = plain.vocab
    levels: list[tuple[DataFrame, DataFrame]] = []  # (pairs, contexts) by depth

    def add(counted: DataFrame, depth: int) -> None:
        """Bring the parent's probabilities to the counts of a depth, and measure its contexts."""
        if depth == 1:
            above = vocab.select(F.col("key").alias("next"), ((F.col("n") + 0.5) / plain.whole).alias("p"))
            met = counted.join(above, "next")
        else:
            pairs, contexts = levels[-1]
            own = pairs.join(contexts.select("ctx", "total", "kinds"), "ctx").select(F.col("ctx").alias("parent"), "next", _own().alias("p"))
            met = counted.join(own, ["parent", "next"])
        pairs = materialize(met.select("ctx", "parent", "next", "n", "p"))
        levels.append((pairs, materialize(_measured(pairs, rule))))

    grams = Filter.of(vocab.filter((F.col("n") >= rule.least) & (F.col("key") != END)).select("key"))
    add(_next_counts(learning, range(1, 2), grams), 1)
    for depths in (range(2, 3), range(3, rule.depth + 1)):
        if rule.depth >= depths[0]:
            pairs = levels[-1][0]
            often = pairs.filter((F.col("n") >= rule.least) & (F.col("next") != END)).select(F.expr(_PAIR_SQL).alias("key"))
            counted = _next_counts(learning, depths, Filter.of(often))
            counted = materialize(counted) if len(depths) > 1 else counted
            for d in depths:
                add(counted.filter(F.col("depth") == d), d)

    # From the longest contexts up, so that the suffixes of a state are states.
    kept: list[DataFrame] = []
    for depth in range(len(levels), 0, -1):
        contexts = levels[depth - 1][1]
        least = math.log(max(contexts.count(), 1)) + rule.chance
        chosen = contexts.filter((F.col("far") >= rule.divergence * F.col("total")) & (F.col("gain") >= least)).select("ctx")
        if kept:
            chosen = chosen.union(kept[-1].select(F.col("parent").alias("ctx"))).distinct()
        kept.append(materialize(contexts.join(chosen, "ctx").select("ctx", "parent", F.lit(depth).alias("depth"), "total", "kinds")))
    kept.reverse()
    met = [pairs.join(states.select("ctx", "total", "kinds"), "ctx") for (pairs, _), states in zip(levels, kept)]
    pairs = reduce(DataFrame.unionAll, (m.select("ctx", "next", "n", "p", _own().alias("own"), (F.col("kinds") / (F.col("total") + F.col("kinds"))).alias("rest")) for m in met))
    return materialize(reduce(DataFrame.unionAll, kept), outer=True), materialize(pairs, outer=True)


_SCORED = "row long, doc_id long, held_out boolean, part int, key long, n long, known long, base double, score double"
_NAMES = [c.split()[0] for c in _SCORED.split(", ")]


def _lookups(tree: Tree) -> DataFrame:
    """(key, part, n, value): what a word, a state or a pair of state and next symbol adds to a score, and how often it was seen."""
    words = tree.vocab.select("key", F.lit(WORD).alias("part"), "n", F.log10(F.col("n") + 0.5).alias("value"))
    if tree.states is None:
        return words
    rest = F.log10(F.col("kinds") / (F.col("total") + F.col("kinds")))
    states = tree.states.select(F.col("ctx").alias("key"), F.lit(STATE).alias("part"), F.col("total").alias("n"), rest.alias("value"))
    value = F.log10(F.col("own") / F.col("p") / F.col("rest"))
    return words.unionAll(states).unionAll(tree.pairs.select(F.expr(_PAIR_SQL).alias("key"), F.lit(PAIR).alias("part"), "n", value.alias("value")))


def score(docs: DataFrame, vocab: DataFrame, tree: Tree, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of (doc_id, held_out, text)."""
    spark = docs.sparkSession
    whole, lookups = float(np.log10(tree.whole)), _lookups(tree)
    often = lookups.filter(F.col("n") * rule.known >= tree.tokens).toArrow()  # at most `known` words, and as many states and pairs of a depth
    part, key, value = (often.column(c).to_numpy() for c in ("part", "key", "value"))
    tables = {}
    for kind in (WORD, STATE, PAIR):
        order = np.argsort(key[part == kind])
        tables[kind] = key[part == kind][order], value[part == kind][order]
    shared = spark.sparkContext.broadcast((tables, None if tree.states is None else Filter.of(tree.states.select(F.col("ctx").alias("key")))))
    depth, ends = rule.depth, tree.ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, states = shared.value
        end_seen, end = int(ends > 0), float(np.log10(ends + 0.5))
        next_row = TaskContext.get().partitionId() << 40

        def meet(kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            have, values = tables[kind]
            if not len(have):
                return np.zeros(len(keys), bool), np.zeros(len(keys))
            at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
            here = have[at] == keys
            return here, np.where(here, values[at], 0.0)

        for batch in steps(batches):
            hashes, sizes = _words(batch)
            n = batch.num_rows
            rows = next_row + np.arange(n)
            next_row += n
            asked = [(WORD, hashes, np.repeat(np.arange(n), sizes))]
            if states is not None:
                tokens = Tokens(hashes, sizes, depth)
                inside = np.arange(len(tokens.word))
                for d in range(1, depth + 1):
                    inside = inside[tokens.at[inside] >= d - 1]
                    inside = inside[states.has(tokens.contexts[d][inside])]
                    asked += [(STATE, tokens.contexts[d][inside], tokens.row[inside]), (PAIR, tokens.pairs(d)[inside], tokens.row[inside])]
            base, shift, known, away = np.zeros(n), np.zeros(n), np.full(n, end_seen), []
            for kind, keys, row in asked:
                here, values = meet(kind, keys)
                total = np.bincount(row, weights=values, minlength=n)
                if kind == WORD:
                    base, known = base + total, known + np.bincount(row[here], minlength=n)
                else:
                    shift = shift + total
                away.append((np.full(len(keys) - here.sum(), kind), keys[~here], row[~here]))
            flags = batch.column("held_out")
            yield pa.RecordBatch.from_arrays([
                pa.array(rows), batch.column("doc_id"), flags, pa.array(np.full(n, TEXT, np.int32)), pa.array(rows), pa.array(sizes + 1),
                pa.array(known), pa.array(base + end - (sizes + 1) * whole), pa.array(shift),
            ], names=_NAMES)
            kind, h, r = (np.concatenate(c) for c in zip(*away))
            if len(h):
                order = np.lexsort((h, kind, r))
                kind, h, r = kind[order], h[order], r[order]
                first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (r[1:] != r[:-1]) | (kind[1:] != kind[:-1])))
                m = len(first)
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows[r[first]]), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.array(kind[first].astype(np.int32)), pa.array(h[first]),
                    pa.array(np.diff(np.append(first, len(h)))), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()),
                ], names=_NAMES)

    wide = docs.selectExpr("cast(doc_id as long) as doc_id", "held_out", "text").mapInArrow(run, _SCORED)
    # Rows of a text meet nothing; its rarer words, states and pairs meet what they add.
    met = wide.join(lookups.select("key", "part", F.col("n").alias("c"), "value"), ["key", "part"], "left")
    text, word = F.col("part") == TEXT, F.col("part") == WORD
    by_row = met.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max(F.when(text, F.col("n"))).alias("n_tokens"),
        F.sum(F.when(text, F.col("known")).when(word & F.col("c").isNotNull(), F.col("n"))).alias("n_known"),
        F.sum(F.when(text, F.col("base")).when(word, F.col("n") * F.coalesce("value", F.lit(math.log10(0.5))))).alias("base"),
        F.sum(F.when(text, F.col("score")).when(~word, F.col("n") * F.coalesce("value", F.lit(0.0)))).alias("shift"),
    )
    return by_row.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tree.tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), (F.col("base") + F.col("shift")).alias("score"),
    )


def learn_and_score(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Scores of all rows of (doc_id, held_out, text), learned from those not held out: those of `grow` and `score`.

    As all texts are at hand, no table of next symbols is kept, and `known` has no effect.
    """
    from opsledger.llm import suffix_chunks  # which builds on this module

    return suffix_chunks.learn_and_score(docs, rule)
