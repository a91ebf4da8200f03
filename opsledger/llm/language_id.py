"""Language identification by error-correcting output codes over hashed byte n-grams.

Each language gets a codeword; one binary classifier per bit predicts it from the text's 1- to 3-byte grams.
A text's language is the codeword with the least loss, each bit weighted by how reliable its classifier was
on learning rows it had not seen. `ambiguous` marks texts whose two nearest codewords are nearly as far.

Learning uses at most `most_rows` distinct labelled texts (at least one a language), the same number of each language where it
has as many, by lowest hash; prediction reads every whole text. A null text, or one without a letter, is `und` with score 0, as is
every text when no language was learned. Rows with a null language are not learned from. Repeated rows give
repeated results; other columns pass through unless their names clash with the results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.llm import rolling
from opsledger.llm.batches import mapper, text_column

RESULTS = ["lang_pred", "score", "ambiguous"]
UNKNOWN = "und"
ROWS = 256
PLACES = 1 << 40
# Byte values as features: letters in lower case and bytes of longer characters stay, the rest reads as a space.
_FOLD = np.full(256, 32, dtype=np.int64)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Rule:
    most_rows: int = 2000
    width: int = 2048
    rounds: int = 80
    margin: float = 0.2  # between the two best codewords, in shares of the score
    seed: int = 11


@dataclass(frozen=True)
class Model:
    languages: list[str]
    codes: np.ndarray  # (languages, bits) of -1 and 1
    weights: np.ndarray  # (width + 1, bits)
    trust: np.ndarray  # (bits,)


def features(column: pa.Array, width: int) -> np.ndarray:
    """(texts, width) square-rooted, normalised counts of hashed 1-, 2- and 3-grams of bytes."""
    texts = rolling.Texts.of(column)
    n, codes = len(column), _FOLD[texts.data]
    row = np.repeat(np.arange(n), np.diff(texts.offsets))
    counts = np.zeros(n * width)
    gram = codes.astype(np.uint64)
    for size in (1, 2, 3):
        if size > 1:
            gram = gram[:-1] * np.uint64(257) + codes[size - 1 :].astype(np.uint64)
        if not len(gram):
            break
        last = row[size - 1 :]
        ok = (row[: len(gram)] == last) & (gram != sum(32 * 257**k for k in range(size)))
        at = gram[ok] if size == 1 else np.uint64(256) + rolling.mix(gram[ok], 70 + size) % np.uint64(width - 256)
        counts += np.bincount(last[ok] * width + at.astype(np.int64), minlength=n * width)
    made = np.sqrt(counts.reshape(n, width))
    return made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-12)


def codewords(k: int, seed: int) -> np.ndarray:
    """(k, bits) of -1 and 1. Every split of up to seven languages; a random code beyond, best of many."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= 7:
        splits = np.arange(1, 2 ** (k - 1))
        return np.stack([np.where(splits >> b & 1, 1.0, -1.0) if b < k - 1 else -np.ones(len(splits)) for b in range(k)])
    draw = np.random.Generator(np.random.PCG64(seed))
    bits, best, far = int(np.ceil(15 * np.log2(k))), None, -1
    for _ in range(200):
        code = draw.choice([-1.0, 1.0], (k, bits))
        apart = (bits - code @ code.T) / 2 + np.eye(k) * bits
        if apart.min() > far:
            best, far = code, apart.min()
    return best


def _fit(x: np.ndarray, y: np.ndarray, rounds: int) -> np.ndarray:
    """Logistic regressions for all bits at once, by accelerated gradient steps with a small ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = look = np.zeros((x.shape[1], y.shape[1]))
    rate, ridge = 8.0, 1e-4
    for k in range(rounds):
        pull = x.T @ (y / (1 + np.exp(np.clip(y * (x @ look), -50, 50)))) / len(x) - ridge * look
        new = look + rate * pull
        look, w = new + k / (k + 3) * (new - w), new
    return w


def learn(labelled: DataFrame, rule: Rule = Rule()) -> Model:
    """A model from (text, lang) rows; the same for the same rows in any order."""
    known = labelled.filter("lang is not null and text is not null").select("text", "lang")
    known = known.withColumn("place", F.pmod(F.xxhash64("text", F.lit(rule.seed)), F.lit(PLACES)))
    counts = known.groupBy("lang").agg(F.approx_count_distinct("place").alias("n")).collect()  # one row a language
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return Model([], codewords(0, 0), np.zeros((rule.width + 1, 1)), np.ones(1))
    # Distinct texts by lowest place, so that copies neither fill the draw nor empty it. About twice as many as
    # wanted pass the cut of their language; the lowest of them are taken.
    each = max(1, rule.most_rows // len(languages))
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, 2 * each / r["n"]))])
    low = known.filter(F.col("place") < share[F.col("lang")] * PLACES).dropDuplicates(["lang", "place"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    drawn = low.withColumn("rank", rank).filter(F.col("rank") <= each).select("text", "lang")
    width = rule.width

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = text_column(batch.column("text"))
        x = [r.astype(np.float32).tobytes() for k in range(0, len(texts), ROWS) for r in features(texts.slice(k, ROWS), width)]
        return pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(x, pa.binary())], names=["lang", "x"])

    rows = drawn.mapInArrow(mapper(step), "lang string, x binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows]).astype(float)
    name = {v: i for i, v in enumerate(languages)}
    kind = np.array([name[r["lang"]] for r in rows])
    codes = codewords(len(languages), rule.seed)
    y = codes[kind]
    test = np.arange(len(x)) % 5 == 0
    trial = _fit(x[~test], y[~test], rule.rounds) if (~test).any() else np.zeros((width + 1, y.shape[1]))
    seen = np.hstack([x[test], np.ones((test.sum(), 1))]) @ trial
    wrong = ((seen * y[test]) <= 0).mean(axis=0) if test.any() else np.zeros(y.shape[1])
    trust = np.maximum(1 - 2 * wrong, 0.05)
    return Model(languages, codes, _fit(x, y, rule.rounds), trust / trust.sum())


def decode(margins: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best language, its score, the runner-up's score) by weighted logistic loss to each codeword."""
    loss = np.stack([(np.logaddexp(0, -code * margins) * model.trust).sum(axis=1) for code in model.codes], axis=1)
    # Losses of all bits read as a log likelihood, and that as a share.
    like = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * model.codes.shape[1])
    share = like / like.sum(axis=1, keepdims=True)
    order = np.argsort(-share, axis=1, kind="stable")
    row = np.arange(len(share))
    second = share[row, order[:, 1]] if share.shape[1] > 1 else np.zeros(len(share))
    return order[:, 0], share[row, order[:, 0]], second


def _has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model, rule: Rule = Rule()) -> DataFrame:
    """`docs` with lang_pred, score and ambiguous. Only the text is looked at."""
    docs = docs.drop(*RESULTS, "has_letter")
    if not model.languages:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "ambiguous": F.lit(True)})
    names = [f.name for f in docs.schema.fields]
    schema = T.StructType([
        *docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType()),
    ])

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = text_column(batch.column("text"))
        # Short texts are many: their feature rows are made a few at a time.
        made = [features(texts.slice(k, ROWS), rule.width) @ model.weights[:-1] for k in range(0, len(texts), ROWS)]
        margins = np.concatenate(made) + model.weights[-1]
        best, score, second = decode(margins, model)
        letters = batch.column("has_letter").to_numpy(zero_copy_only=False)
        lang = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist())]
        score = np.where(letters, score, 0.0)
        unsure = ~letters | (score - second < rule.margin)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array(lang, pa.string()), pa.array(score), pa.array(unsure)], names=[*names, *RESULTS]
        )

    return docs.withColumn("has_letter", _has_letter()).mapInArrow(mapper(step), schema)
