"""Joins that stay balanced when a few keys own most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.001
HOT_ROWS = 100_000
SALTS = 256


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys that own more than `share` of the rows (and at least `min_rows`).

    There can be at most `1 / share` of them however large `df` is, which is what makes the
    result safe to broadcast.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total")).scalar()
    return counts.where((F.col("_n") >= min_rows) & (F.col("_n") > total * share)).select(
        key, F.lit(True).alias("_hot")
    )


def join_on(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """An equal join in which NULL equals NULL; the columns are those of the left side."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in columns})
    condition = reduce(lambda a, b: a & b, (left[c].eqNullSafe(renamed[f"_right_{c}"]) for c in columns))
    return left.join(renamed, condition, how).drop(*(f"_right_{c}" for c in columns))


def lookup_join(
    rows: DataFrame,
    unique: DataFrame,
    key: str,
    spread: Column,
    how: str = "left",
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
    salts: int = SALTS,
    nulls_match: bool = False,
) -> DataFrame:
    """Join many `rows` to a side holding each `key` once, without a hot task.

    Rows of hot keys, and rows without a key, are spread over `salts` tasks by a hash of `spread`
    (a per-row identifier). Only the few hot keys of `unique` are repeated to meet them. With `nulls_match` rows without
    a key meet the entry without one.
    """
    hot = F.broadcast(hot_keys(rows, key, share, min_rows))
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    spread_rows = rows.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col(key).isNull() | F.col("_hot"), salt).otherwise(0)
    )
    met = unique.join(hot, key, "left").withColumn(
        "_salt",
        F.explode(F.when(F.col("_hot") | (F.lit(nulls_match) & F.col(key).isNull()), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))),
    )
    if nulls_match:
        return join_on(spread_rows.drop("_hot"), met.drop("_hot"), [key, "_salt"], how).drop("_salt")
    return spread_rows.drop("_hot").join(met.drop("_hot"), [key, "_salt"], how).drop("_salt")
