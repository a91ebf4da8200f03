"""Current state, past state and version bookkeeping over an append-only history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.operators.skew import HOT_ROWS, lookup_join


def _comparable(field: T.StructField) -> bool:
    return not isinstance(field.dataType, (T.MapType, T.VariantType))


def _newest_per_key(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key the row with the largest `order`; rows equal in it are told apart by their other columns.

    An aggregate, not a window: every task sends at most one row per key, so a key with a third of
    the rows costs no more than any other. The row itself is the thing compared, which carries it
    once; only columns that have no order are carried beside it.
    """
    rest = [f.name for f in df.schema.fields if f.name not in (*order, key)]
    ordered = [f.name for f in df.schema.fields if f.name in rest and _comparable(f)]
    compared = F.struct(*order, *ordered)
    if ordered == rest:
        newest = df.groupBy(key).agg(F.max(compared).alias("_row"))
    else:
        newest = df.groupBy(key).agg(F.max_by(F.struct(*order, *rest), compared).alias("_row"))
    return newest.select(*(F.col(c) if c == key else F.col("_row")[c].alias(c) for c in columns))


def latest_per_key(df: DataFrame, key: str, ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest by `ts`, then `ties`, then the remaining columns."""
    return _newest_per_key(df, key, [ts, *ties], df.columns)


def merge_latest(target: DataFrame | None, source: DataFrame, key: str, ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """Upsert: a source row replaces the target row of its key only when strictly newer.

    Unknown keys are inserted, nothing is deleted, and an equal time keeps the target. The source
    may hold many rows per key. `target` is None before the first load. One shuffle by key.
    """
    if target is None:
        return latest_per_key(source, key, ts, ties)
    held = target.select(*source.columns).withColumn("_held", F.lit(True))
    both = held.unionByName(source.withColumn("_held", F.lit(False)))
    # A held row without a time cannot be beaten: "newer than unknown" is never true.
    both = both.withColumn("_fixed", F.col("_held") & F.col(ts).isNull())
    return _newest_per_key(both, key, ["_fixed", ts, "_held", *ties], source.columns)


def state_as_of(df: DataFrame, key: str, ts: str, batch: str, cut: Column, ties: Sequence[str] = ()) -> DataFrame:
    """The state as it stood after the batches up to `cut`, recomputed from the history."""
    return latest_per_key(df.where(F.col(batch) <= cut), key, ts, ties)


def merge_audit(df: DataFrame, key: str, ts: str, batch: str) -> DataFrame:
    """What each batch did to the state: keys (not rows) inserted, updated, or left alone because stale.

    The history is folded to one row per key and batch before any window sees it. `version`
    numbers the batches from zero and `state_rows` is the size of the state after each.
    """
    per_batch = df.groupBy(key, batch).agg(F.max(ts).alias("_ts"))
    earlier = Window.partitionBy(key).orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    seen = per_batch.withColumn("_known", F.max("_ts").over(earlier)).withColumn(
        "_first", F.row_number().over(Window.partitionBy(key).orderBy(batch)) == 1
    )
    newer = F.coalesce(F.col("_ts") > F.col("_known"), F.lit(False))
    counts = seen.groupBy(batch).agg(
        F.count_if(F.col("_first")).alias("inserted"),
        F.count_if(~F.col("_first") & newer).alias("updated"),
        F.count_if(~F.col("_first") & ~newer).alias("stale"),
    )
    # One row per load from here on, so that numbering them in one place is a small matter.
    in_order = Window.partitionBy(F.lit(0)).orderBy(batch)
    return counts.select(
        (F.row_number().over(in_order) - 1).cast("bigint").alias("version"),
        batch,
        F.when(F.row_number().over(in_order) == 1, "WRITE").otherwise("MERGE").alias("operation"),
        "inserted",
        "updated",
        "stale",
        F.sum("inserted").over(in_order).alias("state_rows"),
    )


def version_range(audit: DataFrame) -> DataFrame:
    """First and last version of an audit."""
    return audit.agg(F.min("version").alias("earliest_version"), F.max("version").alias("latest_version"))


def expired_versions(
    df: DataFrame, key: str, ts: str, horizon: Column, row_id: str, min_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows that a newer row of their key replaced before `horizon`; a clean-up may remove them.

    A row is expired exactly when it is not the newest among its key's rows before the horizon, so
    one aggregate per key decides it and no key's history is sorted in one task. Rows without a key are
    versions of one record without a key.
    """
    old = df.where(F.col(ts) < horizon)
    keep = old.groupBy(key).agg(F.max(F.struct(ts, row_id)).alias("_keep"))
    joined = lookup_join(old, keep, key, F.col(row_id), "inner", min_rows=min_rows, nulls_match=True)
    return joined.where(F.struct(ts, row_id) < F.col("_keep")).drop("_keep")


def purge_bad_keys(state: DataFrame, history: DataFrame, key: str, bad: Column) -> tuple[DataFrame, DataFrame]:
    """Remove failing rows from the history, and from the state every key that had one.

    Returns (clean history, remaining state). `merge_latest` of the two rebuilds the removed keys.
    """
    is_bad = F.coalesce(bad, F.lit(False))
    bad_keys = history.where(is_bad).select(key).distinct()
    return history.where(~is_bad), state.join(bad_keys, key, "left_anti")
