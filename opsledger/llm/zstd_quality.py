"""Quality by compression: how much better a dictionary of good text compresses a text than one of bad text.

Two zstandard dictionaries are built from labelled texts, one of each label. A text's measure is the
difference of its two compressed sizes over their sum, taken with and without respect to its own
repetition (its size under no dictionary over its length); a logistic calibration, fitted on labelled rows
that the dictionaries have not seen, turns it into a score from 0 to 1.

Learning uses at most `most_rows` rows per label of at most `most_bytes` bytes each; scoring reads every
whole text. Null and empty texts score alike, as an empty text. Without rows of both labels every score is
the share of label 1 (0.5 without any). Repeated rows give repeated results; other columns pass through.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.llm.batches import mapper, text_column


@dataclass(frozen=True)
class Rule:
    most_rows: int = 1500
    most_bytes: int = 20_000
    dictionary_bytes: int = 65_536
    level: int = 3
    threshold: float = 0.3
    seed: int = 23


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    level: int
    center: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]  # one for each measure, then the constant


@functools.lru_cache(maxsize=8)
def _compressors(good: bytes, bad: bytes, level: int) -> tuple:
    made = []
    for data in (good, bad):
        book = zstandard.ZstdCompressionDict(data)
        book.precompute_compress(level=level)
        made.append(zstandard.ZstdCompressor(dict_data=book, write_content_size=False, write_checksum=False, write_dict_id=False))
    return (*made, zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False))


def measures(texts: list[bytes], good: bytes, bad: bytes, level: int) -> np.ndarray:
    """(texts, 3): size difference over the sum, size without a dictionary per byte, log length."""
    one, two, plain = (c.compress for c in _compressors(good, bad, level))
    g, b, p, n = (np.array(x, dtype=float) for x in ([len(one(t)) for t in texts], [len(two(t)) for t in texts], [len(plain(t)) for t in texts], [len(t) for t in texts]))
    return np.stack([(b - g) / (b + g + 16), p / (n + 16), np.log1p(n)], axis=1)


def _expand(x: np.ndarray) -> np.ndarray:
    """The measures with their squares and products, and a constant."""
    pairs = [x[:, i] * x[:, j] for i in range(x.shape[1]) for j in range(i, x.shape[1])]
    return np.stack([*x.T, *pairs, np.ones(len(x))], axis=1)


def score(x: np.ndarray, model: Model) -> np.ndarray:
    z = np.clip((x - np.array(model.center)) / np.array(model.scale), -6, 6)
    return 1 / (1 + np.exp(-np.clip(_expand(z) @ np.array(model.weights), -40, 40)))


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (weight * (y - p)) - 1e-2 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, rule: Rule = Rule()) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, quality).

    A repeated label counts once, a contradicted one as 0. The rows are drawn from the labels alone, by a hash of
    their ids; only those texts, at most twice `most_rows`, are fetched.
    """
    one = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {r["quality"]: r["n"] for r in one.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    odds = float(np.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5)))
    constant = Model(b"", b"", rule.level, (0.0,) * 3, (1.0,) * 3, (0.0,) * 9 + (odds,))
    place = F.xxhash64("doc_id", F.lit(rule.seed))
    draws = [one.filter(F.col("quality") == label).orderBy(place, "doc_id").limit(rule.most_rows) for label in (0, 1)]
    texts = docs.filter("text is not null").filter(F.octet_length("text") <= rule.most_bytes).select("doc_id", "text")
    # At most twice `most_rows` ids are broadcast.
    drawn = texts.join(F.broadcast(draws[0].unionByName(draws[1])), "doc_id").select("quality", "text")
    rows = [(r["quality"], r["text"].encode()) for r in drawn.limit(2 * rule.most_rows).collect()]
    if min(sum(label == k for label, _ in rows) for k in (0, 1)) < 8:
        return constant
    rows = sorted(set(rows))
    y, texts = np.array([r[0] for r in rows]), [r[1] for r in rows]
    fresh = np.zeros(len(rows), dtype=bool)
    for label in (0, 1):
        own = np.flatnonzero(y == label)
        fresh[own[::2]] = True
    books = []
    for label in (1, 0):
        own = [texts[k] for k in np.flatnonzero((y == label) & ~fresh)]
        # Texts are cut into pieces so that one long text does not fill a dictionary.
        pieces = [t[k : k + 2048] for t in own for k in range(0, len(t), 2048)]
        try:
            books.append(zstandard.train_dictionary(rule.dictionary_bytes, pieces).as_bytes())
        except zstandard.ZstdError:  # too little text for a trained dictionary: its words as they are
            books.append(b" ".join(pieces)[-rule.dictionary_bytes :])
    x = measures([t for t, f in zip(texts, fresh) if f], *books, rule.level)
    center, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    known = y[fresh]
    # Each label counts as it does among all labelled rows.
    weight = np.where(known == 1, counts[1] / max(1, (known == 1).sum()), counts[0] / max(1, (known == 0).sum()))
    w = _fit(_expand(np.clip((x - center) / scale, -6, 6)), known, weight / total * len(known))
    return Model(*books, rule.level, tuple(center), tuple(scale), tuple(w))


def predict(docs: DataFrame, model: Model, rule: Rule = Rule()) -> DataFrame:
    """`docs` with `score` and `predicted`. Only the text is looked at."""
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t.encode() for t in text_column(batch.column("text")).to_pylist()]
        x = measures(texts, model.good, model.bad, model.level) if model.good else np.zeros((len(texts), 3))
        s = score(x, model)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(s), pa.array((s >= rule.threshold).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"]
        )

    return docs.mapInArrow(mapper(step), schema)
