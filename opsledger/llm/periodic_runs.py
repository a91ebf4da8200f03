"""Periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q, at least twice as long as q, that no neighbouring
word extends. Every factor of 2**k words of a text has a name; equal factors of one text share it. A run of period
q shows as two occurrences of one factor of L words, q apart, where L <= q < 2 * L. Occurrences at most L / 2 apart
lie in arithmetic progressions whose step is the factor's own period; two progressions of a, and of b occurrences
propose a + b - 1 periods, not a * b, and only progressions nearer than 2 * L are paired. The rest a proposal needs
is read off the names: it is extended both ways by factors of falling length. Of proposals that extend to one
stretch the smallest period is its own, and of those that are too short nothing stays. The work for a text of n words is
about n * log n.

Words are told apart by their bytes, not by hashes. A null text is an empty one; texts without words have
no run. Very long texts are taken alone. Repeated rows count each; other columns pass through,
but for those named like a result. An empty table stays empty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from opsledger.llm.batches import mapper, text_column

RESULTS = ["n_words", "runs", "collapsed"]
RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
_ARROW_RUN = pa.struct([(f.name, pa.int64()) for f in RUN.fields])


@dataclass(frozen=True)
class Rule:
    """Runs of fewer than `least` words do not count."""

    least: int = 12


def _named(keys: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Names of all places: equal for equal keys, below zero and unlike all others where a key is the only one."""
    names = -1 - np.arange(size, dtype=np.int64)
    _, back, count = np.unique(keys, return_inverse=True, return_counts=True)
    twice = count[back] > 1
    names[places[twice]] = back[twice]
    return names


def basic_factors(symbols: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of 1, 2, 4, ... symbols beginning at each place, as long as any occurs twice."""
    size = len(symbols)
    levels = [_named(symbols, np.arange(size), size)]
    while True:
        last, length = levels[-1], 1 << (len(levels) - 1)
        places = np.flatnonzero(last >= 0)
        if not len(places):
            return levels[:-1]
        places = places[places + length < size]
        places = places[last[places + length] >= 0]
        levels.append(_named(last[places] * size + last[places + length], places, size))


def proposals(names: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs with length <= period < 2 * length: a factor occurs at the place and a period later."""
    places = np.flatnonzero(names >= 0)
    order = np.argsort(names[places], kind="stable")
    places = places[order]
    of = names[places]
    breaks = np.ones(len(places), dtype=bool)
    breaks[1:] = (of[1:] != of[:-1]) | (2 * np.diff(places) > length)
    heads = np.flatnonzero(breaks)
    tails = np.append(heads[1:], len(places)) - 1
    first, last, more, of = places[heads], places[tails], tails - heads, of[heads]
    step = np.where(more > 0, (last - first) // np.maximum(more, 1), 0)
    found_place, found_period = [], []
    ahead = 1
    while ahead < len(heads):
        gap = first[ahead:] - last[:-ahead]
        near = np.flatnonzero((of[ahead:] == of[:-ahead]) & (gap < 2 * length))
        if not len(near):
            break
        gap, other = gap[near], near + ahead
        by = np.maximum(np.maximum(step[near], step[other]), 1)
        low = -(-np.maximum(length - gap, 0) // by)
        high = np.minimum(more[near] + more[other], (2 * length - 1 - gap) // by)
        count = np.maximum(high - low + 1, 0)
        row = np.repeat(np.arange(len(near)), count)
        steps = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        back = np.minimum(steps, more[near][row])
        found_place.append(last[near][row] - back * by[row])
        found_period.append(gap[row] + steps * by[row])
        ahead += 1
    if not found_place:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, period = np.concatenate(found_place), np.concatenate(found_period)
    # Proposals of one period whose factors touch belong to one stretch.
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (period[1:] != period[:-1]) | (np.diff(place) > length)
    return place[new], period[new]


def _extended(levels: list[np.ndarray], place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the stretch around each place that keeps the period begins and ends."""
    right, left = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        names, length = levels[k], 1 << k
        at = place + right
        right += length * (names[at] == names[at + period])
        at = place - left - length
        left += length * ((at >= 0) & (names[np.maximum(at, 0)] == names[at + period]))
    return place - left, place + period + right


def runs(symbols: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of at least `least` symbols, by start, then period.

    The last symbol must occur nowhere else. Texts may lie end to end with such a symbol after each.
    """
    levels = basic_factors(symbols)
    found = [proposals(names, 1 << k) for k, names in enumerate(levels)]
    place, period = (np.concatenate([f[k] for f in found] + [np.empty(0, np.int64)]) for k in (0, 1))
    start, end = _extended(levels, place, period)
    kept = end - start >= np.maximum(2 * period, least)
    start, end, period = start[kept], end[kept], period[kept]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _symbols(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, equal for equal words of one text, a number of its own after each text; and where each begins."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    row = np.repeat(np.arange(len(texts)), sizes)
    words = pa.array([w for t in texts for w in t], pa.large_binary()).dictionary_encode()
    symbols = -1 - np.arange(int(sizes.sum()) + len(texts), dtype=np.int64)
    at = np.arange(len(row)) + row
    symbols[at] = row * np.int64(len(words.dictionary)) + words.indices.to_numpy()
    return symbols, begin


def _step(least: int):
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        # Bytes split at exactly the six space characters; text would also split at others.
        texts = [t.encode().split() for t in text_column(batch.column("text")).to_pylist()]
        symbols, begin = _symbols(texts)
        start, end, period = runs(symbols, least)
        row = np.searchsorted(begin, start, side="right") - 1
        dropped = np.zeros(len(symbols) + 1, dtype=np.int64)
        np.add.at(dropped, start + period, 1)
        np.add.at(dropped, end, -1)
        stays = np.cumsum(dropped[:-1]) == 0
        # Texts that no run touches are only joined.
        touched = set(row.tolist())
        collapsed = [
            b" ".join([w for w, s in zip(text, stays[at : at + len(text)].tolist()) if s] if k in touched else text)
            for k, (text, at) in enumerate(zip(texts, begin.tolist()))
        ]
        fields = [pa.array(v) for v in (start - begin[row], end - start, period)]
        offsets = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, fields=list(_ARROW_RUN)))
        made = [pa.array([len(t) for t in texts], pa.int64()), listed, pa.array(collapsed, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *RESULTS])

    return step


def find(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """`docs` with n_words, runs (start, length, period in words; by start, then period) and the collapsed text.

    The collapsed text keeps, joined by one space, the words that no run contains after its first period.
    """
    docs = docs.drop(*RESULTS)
    made = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    return docs.mapInArrow(mapper(_step(rule.least)), T.StructType([*docs.schema.fields, *made]))
