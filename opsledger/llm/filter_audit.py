"""What filters remove together, in every order: one pass over the documents, then a recursive query over masks.

Each document becomes a mask with one bit per filter that it fails. All that the audit says depends on how many documents
of a part have each mask, so documents are counted into cells of (part, mask), at most 2**filters a part. A recursive common table
expression then extends every prefix of filters by each letter not used in it, joined with its part's cells and carrying
the bits applied so far; each level of the recursion emits the figures of that step. Prefixes are shared by the
orders that begin with them: 325 of them stand for the 600 steps of the 120 orders of five filters.

A null text is an empty one and equals other empty ones. A document without an id is no copy of another and has no
labels; repeated rows count each, and rows of one id are no copies of each other. Labels given more than once for an
id count when any of them is set. A null part is the empty string. An empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.llm import rolling
from opsledger.llm.batches import mapper, text_column
from opsledger.llm.tables import materialize

COUNTS = ["n_words", "n_distinct", "n_chars", "n_upper", "n_marks"]
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in "#$%&*|"]] = True

#: The five filters by letter: when a document fails them.
FILTERS: dict[str, Column | str] = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_upper > 3 * n_chars",
    "D": "n_marks > 0",
    "E": "is_copy",
}


def _count(batch: pa.RecordBatch) -> pa.RecordBatch:
    column = text_column(batch.column("text"))
    texts = rolling.Texts.of(column)
    # Bytes split at exactly the six space characters; text would also split at others.
    words = [t.encode().split() for t in column.to_pylist()]
    sums = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[texts.offsets])
    made = [
        [len(w) for w in words],
        [len(set(w)) for w in words],
        sums((texts.data & 0xC0) != 0x80),
        sums((texts.data >= 65) & (texts.data <= 90)),
        sums(_MARK[texts.data]),
    ]
    rest = [n for n in batch.schema.names if n != "text"]
    arrays = [batch.column(n) for n in rest] + [pa.array(np.asarray(m, dtype=np.int64)) for m in made]
    return pa.RecordBatch.from_arrays(arrays, names=[*rest, *COUNTS])


def measure(docs: DataFrame) -> DataFrame:
    """The columns of `docs` but for `text`, and the counts of each whole text: words, distinct words, characters,
    capitals A-Z and marks."""
    rest = docs.drop(*COUNTS)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields if f.name != "text"]
    return rest.mapInArrow(mapper(_count), ", ".join([*fields, *(f"{c} bigint" for c in COUNTS)]))


def text_key() -> Column:
    """The same for equal texts, null and empty alike: half of a SHA-256."""
    return F.unhex(F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 32))


def mark_copies(rows: DataFrame, key: str = "key", doc_id: str = "doc_id") -> DataFrame:
    """`rows` with is_copy: whether a smaller id has the same key. `rows` is read twice.

    What is joined back holds keys of at least two rows and is a table of its own, so that rows of a very common text are split.
    """
    first = rows.groupBy(key).agg(F.min(doc_id).alias("_first"), F.count("*").alias("_n"))
    first = materialize(first.where("_n > 1").drop("_n"))
    return rows.join(first, key, "left").withColumn("is_copy", F.coalesce(F.col(doc_id) > F.col("_first"), F.lit(False))).drop("_first")


def cells(rows: DataFrame, part: Column, filters: Mapping[str, Column | str], good: Column, toxic: Column) -> DataFrame:
    """(part, mask, documents, good, toxic): how many documents of each part fail exactly the filters in the mask."""
    mask = F.lit(0)
    for k, fails in enumerate(filters.values()):
        fails = F.expr(fails) if isinstance(fails, str) else fails
        mask = mask.bitwiseOR(F.when(fails, 1 << k).otherwise(0))
    return rows.groupBy(F.coalesce(part, F.lit("")).alias("part"), mask.alias("mask")).agg(
        F.count("*").alias("documents"), F.count_if(good).alias("good"), F.count_if(toxic).alias("toxic")
    )


def _total(field: str, where: str) -> str:
    return f"aggregate(filter(c.cells, x -> {where}), CAST(0 AS BIGINT), (s, x) -> s + x.{field})"


_REMOVED = "(x.mask & p.applied) = 0 AND (x.mask & f.bit) <> 0"
PREFIXES = f"""
WITH RECURSIVE prefix(part, letters, step, applied, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
  SELECT part, '', 0, 0, {", ".join(["CAST(0 AS BIGINT)"] * 6)} FROM {{parts}}
  UNION ALL
  SELECT p.part, p.letters || f.letter, p.step + 1, p.applied | f.bit,
         {_total("documents", "(x.mask & (p.applied | f.bit)) = 0")}, {_total("documents", _REMOVED)},
         {_total("documents", "(x.mask & p.applied) <> 0 AND (x.mask & f.bit) <> 0")}, {_total("documents", "x.mask = f.bit")},
         {_total("good", _REMOVED)}, {_total("toxic", _REMOVED)}
  FROM prefix p JOIN {{filters}} f ON (p.applied & f.bit) = 0 JOIN {{parts}} c ON c.part = p.part
)
SELECT * FROM prefix WHERE step > 0 LIMIT ALL
"""


def audit(counted: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of `letters` and step, from the cells of all parts; bit k of a mask stands for letter k.

    Columns: part, filter_order, step, and how many documents the filters up to the step keep, how many this one removes, how many it
    fails that an earlier one has removed, how many fail it only, good and toxic ones it removes, and what it removes
    summed over all orders (`shapley`, in documents times orders).
    """
    spark = counted.sparkSession
    listed = F.collect_list(F.struct("mask", "documents", "good", "toxic"))
    parts = materialize(counted.groupBy("part").agg(listed.alias("cells")))
    filters = spark.createDataFrame([(letter, 1 << k) for k, letter in enumerate(letters)], "letter string, bit int")
    prefixes = materialize(spark.sql(PREFIXES, parts=parts, filters=filters))
    # An order of all letters shares its prefix of each length.
    orders = prefixes.where(F.col("step") == len(letters)).select("part", F.col("letters").alias("filter_order"))
    steps = orders.withColumn("at", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    steps = steps.withColumn("letters", F.expr("substring(filter_order, 1, at)"))
    shared = F.element_at(F.array(*(F.lit(math.factorial(len(letters) - k)) for k in range(1, len(letters) + 1))), F.col("step"))
    last = F.expr("right(letters, 1)")
    shares = prefixes.groupBy("part", last.alias("letter")).agg(F.sum(F.col("removed") * shared).alias("shapley"))
    told = prefixes.withColumn("letter", last).join(shares, ["part", "letter"])
    return steps.join(told, ["part", "letters"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit_documents(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column | str] = FILTERS) -> DataFrame:
    """The audit of `docs` (doc_id, text, lang) by language; `labels` (doc_id, quality, toxic) says what was good or toxic."""
    chosen = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "text").withColumn("key", text_key())
    rows = materialize(measure(chosen))
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic")
    )
    judged = mark_copies(rows).join(known, "doc_id", "left")
    return audit(cells(judged, F.col("part"), filters, F.col("good"), F.col("toxic")), "".join(filters))
