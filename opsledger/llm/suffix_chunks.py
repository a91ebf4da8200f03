"""The suffix tree of `suffix_tree` grown and used in one go, for texts that are scored with a tree of their own corpus.

Texts are cut into chunks of about CHUNK tokens, which keep their words as places in a chunk's own list. What a chunk
needs of the corpus are sums by key: of a word, of a context with its next symbol, of a context. In each round every
chunk gives its distinct keys with its own sums, a grouped job adds up those of one range of hashes, and each chunk
gets the sums of its keys back. From them it knows at every token which contexts are seen often enough, their totals
(the count of the context's last symbol after the rest of it), and the symbol's probability in each.

A pair of context and next symbol that is seen n times stands in the sums of its context with one n-th for each time,
so that sums over chunks are those over distinct pairs. No key is in more rows than there are chunks, whatever its
frequency; keys and sums travel as packed arrays. Every round's keys are deleted with its shuffle files.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.llm.batches import steps
from opsledger.llm.suffix_tree import END, PRIORS, START, Rule, _mixed, _words
from opsledger.llm.tables import materialize, scratch

CHUNK = 1 << 20  # tokens of a chunk; a longer text makes a longer chunk
RANGE = 1 << 21  # tokens for each range of hashes
RANGES = 16  # at least
UNITS = 1 << 24  # a chunk's sums of shares and logarithms are sent in parts of one
# What a row holds: a chunk's texts, keys that ask, or sums for a chunk; `step` tells of which kind and depth.
_ROW = "chunk long, step int, range int, data binary, keys long, total long, often long"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
TEXTS, WORDS, PAIRS, CONTEXTS, CLOSED = 0, 1, 10, 20, 30  # steps; the depth is added


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, compressed; whole numbers from 0 byte by byte, without the bytes that no number has."""
    laid = []
    for a in arrays:
        if a.dtype.kind == "f":
            laid.append((a.dtype.str, len(a), [a.tobytes()]))
        else:
            used = max(1, -(-int(a.max(initial=0)).bit_length() // 8))
            laid.append((a.dtype.str, len(a), [a.view(np.uint8)[k :: a.dtype.itemsize].tobytes() for k in range(used)]))
    raw = pickle.dumps(laid)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    made = []
    for kind, size, planes in pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)):
        if np.dtype(kind).kind in "fb":
            made.append(np.frombuffer(planes[0], kind))
            continue
        a = np.frombuffer(planes[0], np.uint8).astype(kind)
        for k, plane in enumerate(planes[1:], 1):
            a |= np.frombuffer(plane, np.uint8).astype(kind) << np.dtype(kind).type(8 * k)
        made.append(a)
    return made


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in order, a place that holds each, the number of each place's key)."""
    order = np.argsort(keys)
    told = keys[order]
    new = np.append(True, told[1:] != told[:-1])[: len(told)]
    back = np.empty(len(keys), np.int64)
    back[order] = np.cumsum(new) - 1
    return told[new], order[new], back


def _gaps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def _fixed(values: np.ndarray) -> np.ndarray:
    """Sums in units of 1 / UNITS, the sign in the lowest bit."""
    whole = np.rint(values * UNITS).astype(np.int64)
    return ((whole << 1) ^ (whole >> 63)).view(np.uint64)


def _float(units: np.ndarray) -> np.ndarray:
    return ((units >> np.uint64(1)).view(np.int64) ^ -(units & np.uint64(1)).view(np.int64)) / UNITS


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int32) if not len(values) or values.max() < 1 << 31 else values


def _table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=_NAMES)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per chunk: ids, held out, words and list of words."""
    chunk, waiting, size = TaskContext.get().partitionId() << 32, [], 0

    def made() -> pa.RecordBatch:
        ids = [i for w in waiting for i in w[0]]
        none = np.array([i is None for i in ids])
        held = np.concatenate([w[1] for w in waiting])
        sizes = np.concatenate([w[3] for w in waiting])
        told = np.full(int((sizes + 1).sum()), END, np.uint64)
        words = np.ones(len(told), bool)
        words[np.cumsum(sizes + 1) - 1] = False
        told[words] = np.concatenate([w[2] for w in waiting]).view(np.uint64)
        keys, _, place = distinct(told)
        number = np.array([i or 0 for i in ids], np.int64).view(np.uint64)
        data = pack(number, none, held, sizes.astype(np.int64), place.astype(np.int32), _gaps(keys))
        return _table([(chunk, TEXTS, -1, data, int((~held).sum()), len(told), 0)]).to_batches()[0]

    for batch in steps(batches):
        hashes, sizes = _words(batch)
        held = np.array([bool(h) for h in batch.column("held_out").to_pylist()])
        waiting.append((batch.column("doc_id").to_pylist(), held, hashes, sizes))
        size += len(hashes) + len(sizes)
        if size >= CHUNK:
            yield made()
            chunk, waiting, size = chunk + 1, [], 0
    if waiting:
        yield made()


@dataclass(frozen=True)
class Corpus:
    """What all chunks know."""

    rule: Rule
    ranges: int
    tokens: int = 0
    words: int = 0
    contexts: dict[int, int] = field(default_factory=dict)  # number by depth

    @property
    def whole(self) -> float:
        return self.tokens + 0.5 * (self.words + 1)

    def least(self, depth: int) -> float:
        """The gain that a context must reach. No gain is above the divergence of all its symbols, which therefore decides
        only where `divergence` asks for more than this."""
        return math.log(max(self.contexts[depth], 1)) + self.rule.chance


def _log_gamma(x: np.ndarray) -> np.ndarray:
    z = x + 8
    series = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z)
    low = x.copy()
    for i in range(1, 8):
        low *= x + i
    return series - np.log(low)


def _rising(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The logarithm of x (x + 1) ... (x + n - 1), for n from 2."""
    made = np.empty(len(x))
    for k in range(2, 9):
        at = np.flatnonzero(n == k)
        y = x[at]
        made[at] = np.log(reduce(np.multiply, (y + i for i in range(1, k)), y))
    at = np.flatnonzero(n > 8)
    made[at] = _log_gamma(n[at] + x[at]) - _log_gamma(x[at])
    return made


class Chunk:
    """The tokens of a chunk and what rounds have told about them.

    Arrays of a depth hold only the tokens whose context of that length is seen often enough; they are among those of the depth before.
    """

    def __init__(self, rows: pa.Table, corpus: Corpus):
        self.chunk, self.corpus, self.rule = rows.column("chunk")[0].as_py(), corpus, corpus.rule
        self.sums: dict[int, list[tuple[int, bytes]]] = {}
        for step, at, data in zip(*(rows.column(c).to_pylist() for c in ("step", "range", "data"))):
            self.sums.setdefault(step, []).append((at, data))
        self.ids, self.none, self.held, self.sizes, self.place, gaps = unpack(self.sums[TEXTS][0][1])
        self.keys = np.cumsum(gaps, dtype=np.uint64).view(np.int64)
        self.starts = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        self.learns = np.repeat(~self.held, self.sizes + 1)
        self.settled: list[tuple[int, np.ndarray]] = []
        # By depth: tokens, their places among those of the depth before, hashes of their contexts, totals of these, and counts of the symbols in them.
        self.at: list[np.ndarray] = []
        self.among: list[np.ndarray] = []
        self.hashes: list[np.ndarray] = []
        self.total: list[np.ndarray] = []
        self.n: list[np.ndarray] = []
        self.kinds: list[np.ndarray] = []
        self.passed: list[np.ndarray] = []

    def answer(self, step: int) -> np.ndarray:
        """The sums of the keys that were asked for, in their order."""
        return np.concatenate([unpack(data)[0] for _, data in sorted(self.sums[step])])

    def tokenwise(self, step: int, back: Callable[[], np.ndarray]) -> np.ndarray:
        """A round's sums, token by token; `back` gives the numbers of the keys. They are kept as such for later rounds."""
        if step not in self.sums:  # no keys
            return np.zeros(0, np.int64)
        if self.sums[step][0][0] < 0:
            return unpack(self.sums[step][0][1])[0]
        values = self.answer(step)[back()]
        self.settled.append((step, values))
        return values

    def counted(self) -> None:
        """Word counts; the end's key is the lowest."""
        self.count = self.answer(WORDS)

    def word(self, at: np.ndarray) -> np.ndarray:
        return self.keys[self.place[at]]

    def deepen(self) -> None:
        """The tokens of the next depth."""
        if not self.at:
            first = np.zeros(len(self.place), bool)
            first[self.starts] = True
            # The word before tells the context; the list of words with the start behind it.
            code = np.empty(len(self.place), np.int32)
            code[1:] = self.place[:-1]
            code[self.starts] = len(self.keys)
            total = np.append(self.count, self.count[0] if len(self.count) else 0)
            often = np.flatnonzero((total >= self.rule.least)[code])
            self.code = code[often]
            self.first = first
            hashes = _mixed(np.append(self.keys, START), np.zeros(1, np.int64))
            self.among.append(often)
            self.at.append(often)
            self.total.append(total[self.code])
            self.hashes.append(hashes[self.code])
            return
        d, last = len(self.at) + 1, self.at[-1]
        goes = np.flatnonzero((self.n[-1] >= self.rule.least) & (self.place[last] != 0))
        at = last[goes] + 1
        here = np.zeros(len(self.place), bool)
        here[at] = True
        among = np.flatnonzero(here[last])
        # What stands `d` before; the start if the text begins right behind it.
        before = self.word(np.maximum(at - d, 0))
        before[self.first[at - d + 1]] = START
        self.at.append(at)
        self.among.append(among)
        self.total.append(self.n[-1][goes])
        self.hashes.append(_mixed(before, self.hashes[-1][among]))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct pairs of the last depth: keys, one token of each, and the number of each token's pair."""
        w = self.word(self.at[-1]).view(np.uint64)
        self.found = distinct(self.hashes[-1].view(np.uint64) ^ ((w << np.uint64(23)) | (w >> np.uint64(41))))
        return self.found

    def contexts(self, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = self.hashes[d - 1].view(np.uint64)
        if d > 1:
            return distinct(keys)
        first = np.full(len(self.keys) + 1, -1)
        first[self.code] = np.arange(len(self.code))
        have = np.flatnonzero(first >= 0)
        have = have[np.argsort(keys[first[have]])]
        number = np.zeros(len(first), np.int64)
        number[have] = np.arange(len(have))
        return keys[first[have]], first[have], number[self.code]

    def ask(self, step: int, keys: np.ndarray, *more: np.ndarray) -> Iterator[tuple]:
        """Rows of the ranges of sorted keys."""
        ranges = self.corpus.ranges
        edges = np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)
        cut = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
        for r, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            if b > a:
                yield self.chunk, step, r, pack(_gaps(keys[a:b]), *(m[a:b] for m in more)), 0, 0, 0

    def ask_words(self) -> Iterator[tuple]:
        n = np.bincount(self.place[self.learns], minlength=len(self.keys))
        yield from self.ask(WORDS, self.keys.view(np.uint64), n.astype(np.int32), self.keys != END)

    def ask_pairs(self) -> Iterator[tuple]:
        keys, first, back = self.pairs()
        n = np.bincount(back[self.learns[self.at[-1]]], minlength=len(keys)).astype(np.int32)
        yield from self.ask(PAIRS + len(self.at), keys, n, self.place[self.at[-1][first]] != 0)

    def told_pairs(self) -> None:
        self.n.append(self.tokenwise(PAIRS + len(self.at), lambda: self.pairs()[2]))

    def told_contexts(self) -> None:
        d = len(self.kinds) + 1
        told = self.answer(CONTEXTS + d)[self.contexts(d)[2]] if CONTEXTS + d in self.sums else np.zeros(0, np.int64)
        self.kinds.append(told >> 1)
        self.passed.append((told & 1).astype(bool))

    def chance(self, d: int, at: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
        """The symbol's probability in the contexts of a depth, at tokens whose places at each depth up to it are given."""
        p = ((self.count + 0.5) / self.corpus.whole)[self.place[at]]
        for n, kinds, total, k in zip(self.n[:d], self.kinds, self.total, places):
            p = (n[k] + kinds[k] * p) / (total[k] + kinds[k])
        return p

    def places(self, d: int) -> list[np.ndarray]:
        """The places of a depth's tokens at the depths before."""
        made = [self.among[d - 1]]
        for k in range(d - 2, 0, -1):
            made.append(self.among[k][made[-1]])
        return made[::-1] if d > 1 else []

    def ask_contexts(self) -> Iterator[tuple]:
        """Sums over the next symbols of each context of the last depth."""
        d, at = len(self.at), self.at[-1]
        if not len(at):
            return
        keys, first, number = self.contexts(d)
        # One token stands for all of a pair in the chunk.
        _, one, back = self.found
        here = np.bincount(back[self.learns[at]], minlength=len(one))
        one, here = one[here > 0], here[here > 0]
        total, n, ctx = self.total[-1][first], self.n[-1][one], number[one]
        # A symbol seen once adds the prior's logarithm, whatever its probability: these are only counted.
        ones = np.bincount(ctx[n == 1], minlength=len(keys)).astype(np.int32)
        wide = total * self.rule.divergence > self.corpus.least(d)
        some = np.flatnonzero((n > 1) | wide[ctx])
        one, here, n, ctx = one[some], here[some], n[some], ctx[some]
        log_p = np.log(p := self.chance(d - 1, at[one], [k[one] for k in self.places(d)]))
        far = np.where(wide[ctx], here * (np.log(n) - log_p), 0.0)
        several = np.flatnonzero(n > 1)
        share, ns, ps, log_ps, within = here[several] / n[several], n[several], p[several], log_p[several], ctx[several]
        sums = [np.bincount(within, share, len(keys)), np.bincount(ctx, far, len(keys))]
        sums += [np.bincount(within, share * (_rising(a * ps, ns) - ns * log_ps), len(keys)) for a in PRIORS]
        yield from self.ask(CONTEXTS + d, keys, total, ones, *map(_fixed, sums))

    def ask_closed(self) -> Iterator[tuple]:
        """Whether a context that does not pass is the suffix of one that does."""
        deepest = np.zeros(len(self.place), np.int8)
        for d, (at, passed) in enumerate(zip(self.at, self.passed), 1):
            deepest[at[passed]] = d
        for d in range(1, len(self.at)):
            keys, _, number = self.contexts(d)
            inside = np.bincount(number, deepest[self.at[d - 1]] > d, len(keys)) > 0
            yield from self.ask(CLOSED + d, keys, inside.astype(np.int32), inside)

    def scored(self) -> pa.Table:
        n = len(self.sizes)
        base = np.log10((self.count + 0.5) / self.corpus.whole)[self.place]
        best = base.copy()
        for d, (at, passed) in enumerate(zip(self.at, self.passed), 1):
            if CLOSED + d in self.sums:
                passed = passed | (self.answer(CLOSED + d)[self.contexts(d)[2]] > 0)
            best[at[passed]] = np.log10(self.chance(d, at[passed], [k[passed] for k in [*self.places(d), np.arange(len(at))]]))
        known = (self.count > 0).astype(np.int64)[self.place]
        return pa.Table.from_arrays([
            pa.array(self.ids.view(np.int64), mask=self.none), pa.array(self.held), pa.array(self.sizes + 1), pa.array(np.add.reduceat(known, self.starts)),
            pa.array(np.full(n, self.corpus.tokens)), pa.array(np.add.reduceat(base, self.starts)), pa.array(np.add.reduceat(best, self.starts)),
        ], names=[c.split()[0] for c in _SCORED.split(", ")])


def _known(rows: pa.Table, corpus: Corpus, d: int) -> Chunk:
    """A chunk that has been told the pairs up to a depth, and what is known of contexts."""
    chunk = Chunk(rows, corpus)
    chunk.counted()
    for _ in range(min(d, corpus.rule.depth)):
        chunk.deepen()
        chunk.told_pairs()
    for _ in range(min(d - 1, corpus.rule.depth)):
        chunk.told_contexts()
    return chunk


def _round(corpus: Corpus, d: int) -> Callable[[pa.Table], pa.Table]:
    """A chunk told the pairs of depth `d` asks for the contexts of that depth and the pairs of the next one; then for suffixes."""

    def run(rows: pa.Table) -> pa.Table:
        chunk, made = _known(rows, corpus, d), []
        if 0 < d <= corpus.rule.depth:
            made += chunk.ask_contexts()
        if d < corpus.rule.depth:
            chunk.deepen()
            made += chunk.ask_pairs()
        if d > corpus.rule.depth:
            made += chunk.ask_closed()
        # What the chunk keeps goes through the same exchange, each chunk's as a group.
        own = -1 - (chunk.chunk * 0x9E3779B1 >> 8) % (1 << 30)
        made += [(chunk.chunk, step, own, pack(_narrow(values)), 0, 0, 0) for step, values in chunk.settled]
        return _table(made)

    return run


def _scores(corpus: Corpus) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        return _known(rows, corpus, corpus.rule.depth + 1).scored()

    return run


def _words_asked(corpus: Corpus) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                chunk = Chunk(pa.Table.from_batches([batch.slice(k, 1)]), corpus)
                yield from _table(list(chunk.ask_words())).to_batches()

    return run


def _added(corpus: Corpus) -> Callable[[pa.Table], pa.Table]:
    """The sums of one range of one step's keys, for each chunk that asks; the first row tells how many there are."""
    rule = corpus.rule

    def run(rows: pa.Table) -> pa.Table:
        step, at = rows.column("step")[0].as_py(), rows.column("range")[0].as_py()
        if at < 0:
            return rows
        asked = [unpack(d) for d in rows.column("data").to_pylist()]
        keys, _, place = distinct(np.concatenate([np.cumsum(a[0], dtype=np.uint64) for a in asked]))
        sums = [np.concatenate(c) for c in list(zip(*asked))[1:]]
        told = (0, 0, 0)
        if CONTEXTS <= step < CLOSED:
            total = np.zeros(len(keys))
            total[place] = sums[0]
            ones, share, far, *gains = (np.bincount(place, s, len(keys)) for s in [sums[1], *map(_float, sums[2:])])
            far -= total * np.log(total)
            gain = np.max([g + ones * math.log(a) + math.lgamma(a) - _log_gamma(total + a) for a, g in zip(PRIORS, gains)], axis=0) - math.log(len(PRIORS))
            least = corpus.least(step - CONTEXTS)
            wide = total * rule.divergence > least
            made = (np.rint(ones + share).astype(np.int64) << 1) | ((gain >= least) & (~wide | (far >= rule.divergence * total)))
        else:
            made = np.bincount(place, sums[0], len(keys)).astype(np.int64)
            goes = np.zeros(len(keys), bool)
            goes[place] = sums[1]
            told = (int((made > 0).sum()), int(made.sum()), int(((made >= rule.least) & goes).sum()))
        cut = np.cumsum([0] + [len(a[0]) for a in asked])
        chunks, back = rows.column("chunk").to_pylist(), made[place]
        return _table([(c, step, at, pack(_narrow(back[a:b])), *(told if k == 0 else (0, 0, 0))) for k, (c, a, b) in enumerate(zip(chunks, cut[:-1], cut[1:]))])

    return run


def learn_and_score(docs: DataFrame, rule: Rule) -> DataFrame:
    """Scores of all rows of (doc_id, held_out, text), learned from those not held out."""
    spark = docs.sparkSession
    with scratch(spark):
        kept = [materialize(docs.selectExpr("cast(doc_id as long) as doc_id", "held_out", "text").mapInArrow(_chunks, _ROW))]
        size, learning = kept[0].agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("keys"), F.lit(0))).first()
        corpus = Corpus(rule, max(RANGES, -(-size // RANGE)))

        def added(asked: DataFrame) -> DataFrame:
            return materialize(asked.groupBy("step", "range").applyInArrow(_added(corpus), _ROW))

        def told(sums: DataFrame) -> dict[int, tuple[int, int, int]]:
            rows = sums.groupBy("step").agg(F.sum("keys"), F.sum("total"), F.sum("often")).collect()
            return {r[0]: tuple(r)[1:] for r in rows}

        kept.append(added(kept[0].mapInArrow(_words_asked(corpus), _ROW)))
        kinds, tokens, often = told(kept[1]).get(WORDS, (0, 0, 0))
        # The start of the text is a context, too.
        corpus = Corpus(rule, corpus.ranges, tokens, kinds, {1: often + int(learning >= rule.least)})
        sums: list[DataFrame] = []
        for d in range(rule.depth + 2):
            known = reduce(DataFrame.unionAll, kept + sums).groupBy("chunk")
            answers = added(known.applyInArrow(_round(corpus, d), _ROW))
            # Counts of pairs are kept token by token, as finding the pairs again is dear.
            stays = (F.col("range") < 0) | F.floor(F.col("step") / 10).eqNullSafe(CONTEXTS // 10)
            kept.append(answers.filter(stays))
            sums = [answers.filter(~stays)]
            corpus.contexts[d + 2] = told(answers).get(PAIRS + d + 1, (0, 0, 0))[2]
        known = reduce(DataFrame.unionAll, kept + sums).groupBy("chunk")
        return materialize(known.applyInArrow(_scores(corpus), _SCORED), outer=True)
