"""Host-level quality rules: documents' rule failures by host, rates shrunk by an empirical beta prior.

Each document is measured once, over its whole text. Every rule has a lenient and a strict form. A host
(`source`) has a failure rate: documents that fail a strict rule, shrunk towards the mean of all hosts by a beta
prior whose strength is estimated from the hosts' spread (method of moments). Documents of hosts above
`host_rate` must pass the strict rules, others the lenient ones. A clean document stays on any host.

A null text is an empty one and fails the base rule. Documents with a null source form one host. Repeated
rows count each time. Other columns pass through `measure` unless their names clash with the measures.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.llm import rolling
from opsledger.llm.batches import mapper, text_column
from opsledger.llm.tables import materialize

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim", "n_same_next"]
WINDOW = 8
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass(frozen=True)
class Rule:
    """A document fails where left * ratio denominators exceed right: `left * per > limit * right`."""

    name: str
    left: str
    right: str
    per: int
    lenient: int
    strict: int

    def fails(self, strict: bool) -> Column:
        limit = self.strict if strict else self.lenient
        return F.col(self.left) * self.per > F.col(self.right) * limit


#: Percentages: symbols per word, repeated lines per line, repeated words per word, capitals per word character, exclamation marks per word, words
#: equal to the one before them.
RULES = (
    Rule("symbols", "n_symbols", "n_words", 100, 40, 15),
    Rule("dup_lines", "n_dup_lines", "n_lines", 100, 40, 20),
    Rule("repeats", "n_repeat_words", "n_words", 100, 30, 20),
    Rule("capitals", "n_upper", "word_chars", 100, 60, 40),
    Rule("exclaims", "n_exclaim", "n_words", 100, 50, 25),
    Rule("echoes", "n_same_next", "n_words", 100, 40, 20),
    Rule("long_words", "word_chars", "n_words", 1, 20, 15),
)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def _repeated(rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether each (row, code) occurs more than once; and, second, whether it is not the first."""
    order = np.lexsort((np.arange(len(codes)), codes, rows))
    r, c = rows[order], codes[order]
    same = np.zeros(len(order) + 1, dtype=bool)
    same[1:-1] = (r[1:] == r[:-1]) & (c[1:] == c[:-1])
    twice, later = np.empty(len(order), bool), np.empty(len(order), bool)
    twice[order], later[order] = same[1:] | same[:-1], same[:-1]
    return np.stack([twice, later])


def _measures(column: pa.Array) -> list[np.ndarray]:
    texts = rolling.Texts.of(column)
    data, at, n = texts.data, texts.offsets, len(column)
    inside = ~rolling.SPACE[data]
    found = rolling.words(texts)
    lead = (data & 0xC0) != 0x80
    # Lines: from one line feed or text border to the next.
    feeds = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([at[:-1], feeds + 1]), kind="stable")
    end = np.sort(np.concatenate([at[1:], feeds]), kind="stable")
    with_word = np.concatenate([[0], np.cumsum(inside)])
    real = with_word[end] > with_word[start]
    n_lines = np.bincount(np.searchsorted(at, start[real], side="right") - 1, minlength=n)
    line_rows = np.searchsorted(at, start[real], side="right") - 1
    lines = rolling.byte_hashes(texts, start[real], end[real], 4)
    dup = np.bincount(line_rows[_repeated(line_rows, lines)[1]], minlength=n)
    hashes = rolling.word_hashes(texts, found)
    of = found.rows()
    same = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    echo = np.bincount(of[1:][same], minlength=n)
    codes, first = rolling.windows(hashes, found, WINDOW)
    rows = np.searchsorted(found.bounds, first, side="right") - 1
    hit = first[_repeated(rows, codes)[0]]
    cover = np.zeros(len(found.start) + 1, dtype=np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + WINDOW, -1)
    repeat = _sums(np.cumsum(cover[:-1]) > 0, found.bounds)
    upper, bang = (data >= 65) & (data <= 90), data == 33
    return [found.counts, _sums(lead & inside, at), _sums(_SYMBOL[data], at), dup, repeat, n_lines, _sums(upper, at), _sums(bang, at), echo]


def measure(docs: DataFrame) -> DataFrame:
    """`docs` with the measures of each whole text; columns of the same names are replaced."""
    docs = docs.drop(*MEASURES)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [pa.array(m.astype(np.int64)) for m in _measures(text_column(batch.column("text")))]
        return pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *MEASURES])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(m, T.LongType()) for m in MEASURES)])
    return docs.mapInArrow(mapper(step), schema)


def host_rates(measured: DataFrame) -> DataFrame:
    """(source, documents, failed, host_rate): each host's shrunk share of documents failing a strict rule."""
    strict = F.lit(False)
    for rule in RULES:
        strict = strict | rule.fails(True)
    hosts = measured.groupBy("source").agg(
        F.count("*").alias("documents"), F.count_if(strict | base_failed()).alias("failed")
    )
    rate = F.col("failed") / F.col("documents")
    moments = hosts.agg(
        (F.sum("failed") / F.sum("documents")).alias("mean"),
        F.avg(rate * rate).alias("square"),
        F.avg(rate).alias("plain"),
        F.avg(1 / F.col("documents")).alias("inverse"),
    )
    # Spread between hosts beyond what counting alone would show; none means a prior as strong as can be.
    counted = F.col("mean") * (1 - F.col("mean")) * F.col("inverse")
    spread = F.greatest(F.col("square") - F.col("plain") * F.col("plain") - counted, F.lit(1e-6))
    strength = F.greatest(F.col("mean") * (1 - F.col("mean")) / spread - 1, F.lit(1.0))
    prior = moments.select(F.col("mean"), strength.alias("strength"))  # one row
    return hosts.join(F.broadcast(prior)).select(
        "source", "documents", "failed",
        ((F.col("failed") + F.col("mean") * F.col("strength")) / (F.col("documents") + F.col("strength"))).alias("host_rate"),
    )


def judge(measured: DataFrame, host_rate: float = 0.5) -> DataFrame:
    """`measured` with its host's rate and verdict joined back, and each document's own."""
    # A table of its own, so that the documents of a host with very many can be split in the join.
    rates = materialize(host_rates(measured))
    hosts = rates.select(F.col("source").alias("host"), F.col("host_rate"), (F.col("host_rate") > host_rate).alias("host_failed"))
    lenient, strict = F.lit(False), F.lit(False)
    for rule in RULES:
        lenient, strict = lenient | rule.fails(False), strict | rule.fails(True)
    joined = measured.join(hosts, measured["source"].eqNullSafe(hosts["host"])).drop("host")
    failed = base_failed()
    return joined.withColumns({
        "base_failed": failed,
        "kept": ~failed & ~F.when(F.col("host_failed"), strict).otherwise(lenient),
    })


def verdicts(docs: DataFrame) -> DataFrame:
    """(doc_id, measures, base_failed, kept, host_rate, host_failed) per document."""
    measured = materialize(measure(docs.select("doc_id", "source", "text")).drop("text"))
    return judge(measured).select("doc_id", *MEASURES[:5], "base_failed", "kept", "host_rate", "host_failed")
