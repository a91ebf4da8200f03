"""Null-aware quality checks, their verdict, and table profiles.

Row checks of a scan share one pass and one aggregate. Checks that compare rows with each other
(uniqueness, duplicates) add one key aggregate each, folded before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.functions.times import EXACT_TIMES, day_drift

RESULT_COLUMNS = ["check", "dimension", "success", "unexpected_count", "row_count"]


class QualityGateError(ValueError):
    """A gate failed; the stages after it must not run."""


@dataclass(frozen=True)
class Check:
    """`bad` marks unexpected rows, `considered` the rows a tolerance is measured against.

    A check succeeds when the share of considered rows that are not bad reaches `mostly`, or, where
    `below` is given, when the share of bad rows lies strictly under it (an empty table fails that).
    `group_by` turns the check into one over groups of equal rows: `bad` then sees `_rows`, the
    group size, and yields the number of unexpected rows.
    """

    name: str
    dimension: str
    bad: Column
    considered: Column | None = None
    mostly: float = 1.0
    below: float | None = None
    group_by: tuple[Column, ...] = ()


def _nulls(bad: Column, nulls: str) -> Column:
    """Nulls are skipped, or fail with `nulls="fail"`."""
    return F.coalesce(bad, F.lit(False)) if nulls == "skip" else F.coalesce(bad, F.lit(True))


def _value_check(name: str, dimension: str, col: str, good: Column, nulls: str, mostly: float) -> Check:
    considered = F.col(col).isNotNull() if nulls == "skip" else None
    return Check(name, dimension, _nulls(~good, nulls), considered, mostly)


def not_null(col: str, mostly: float = 1.0) -> Check:
    return Check(f"not_null({col})", "completeness", F.col(col).isNull(), mostly=mostly)


def null_ratio(col: str, below: float) -> Check:
    return Check(f"null_ratio({col})", "completeness", F.col(col).isNull(), below=below)


def in_set(col: str, values: Sequence, nulls: str = "skip", dimension: str = "validity", mostly: float = 1.0) -> Check:
    return _value_check(f"in_set({col})", dimension, col, F.col(col).isin(list(values)), nulls, mostly)


def between(col: str, low=None, high=None, nulls: str = "skip", dimension: str = "accuracy", mostly: float = 1.0) -> Check:
    """Both bounds are inclusive; either may be left open."""
    bounds = [F.col(col) >= low] if low is not None else []
    bounds += [F.col(col) <= high] if high is not None else []
    return _value_check(f"between({col})", dimension, col, reduce(lambda a, b: a & b, bounds), nulls, mostly)


def regex(col: str, pattern: str, nulls: str = "skip", dimension: str = "validity", mostly: float = 1.0) -> Check:
    return _value_check(f"regex({col})", dimension, col, F.col(col).rlike(pattern), nulls, mostly)


def pair_differs(a: str, b: str) -> Check:
    """Two columns must not be equal; a null equals nothing."""
    return Check(f"pair_differs({a},{b})", "consistency", F.coalesce(F.col(a) == F.col(b), F.lit(False)))


def equals(col: str, value, nulls: str = "fail", dimension: str = "timeliness") -> Check:
    return _value_check(f"equals({col})", dimension, col, F.col(col) == value, nulls, 1.0)


def max_drift(ts: str, day: str, days: int) -> Check:
    """The day of an instant must lie within `days` of a date; nulls are skipped."""
    drift = day_drift(F.col(ts), F.col(day))
    return Check(f"max_drift({ts},{day})", "timeliness", F.coalesce(drift > days, F.lit(False)), drift.isNotNull())


def unique(col: str) -> Check:
    """Every member of a repeated value counts as unexpected; nulls are skipped."""
    repeated = F.when(F.col("_g0").isNotNull() & (F.col("_rows") > 1), F.col("_rows"))
    return Check(f"unique({col})", "uniqueness", repeated, group_by=(F.col(col),))


def no_duplicate_rows(cols: Sequence[str]) -> Check:
    """Rows equal to an earlier row in all `cols`, nulls being equal to each other.

    Wide rows are compared by a 256-bit digest of their content, so the shuffle carries 32 bytes a
    group whatever the text length.
    """
    content = F.to_json(F.struct(*cols), {"ignoreNullFields": "false", **EXACT_TIMES})
    return Check("no_duplicate_rows", "uniqueness", F.col("_rows") - 1, group_by=(F.unhex(F.sha2(content, 256)),))


def _success(check: Check, unexpected: Column, considered: Column) -> Column:
    if check.below is not None:
        return F.coalesce(F.try_divide(unexpected, considered) < check.below, F.lit(False))
    if check.mostly >= 1.0:
        return unexpected == 0
    return F.coalesce(F.try_divide(considered - unexpected, considered) >= check.mostly, F.lit(True))


def _results(folded: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(c.name).alias("check"),
            F.lit(c.dimension).alias("dimension"),
            _success(c, F.col(f"_bad{i}"), F.col(f"_seen{i}")).alias("success"),
            F.col(f"_bad{i}").alias("unexpected_count"),
            F.col("_rows").alias("row_count"),
        )
        for i, c in checks
    ]
    return folded.select(F.inline(F.array(*rows)))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: check, dimension, success, unexpected_count, row_count."""
    numbered = list(enumerate(checks))
    row_checks = [(i, c) for i, c in numbered if not c.group_by]
    parts = []
    if row_checks:
        counts = [F.count_if(c.bad).alias(f"_bad{i}") for i, c in row_checks]
        counts += [
            (F.count("*") if c.considered is None else F.count_if(c.considered)).alias(f"_seen{i}") for i, c in row_checks
        ]
        parts.append(_results(df.agg(F.count("*").alias("_rows"), *counts), row_checks))
    for i, c in numbered:
        if c.group_by:
            groups = df.groupBy(*(g.alias(f"_g{n}") for n, g in enumerate(c.group_by))).agg(F.count("*").alias("_rows"))
            folded = groups.select("_rows", F.coalesce(c.bad, F.lit(0)).alias("_bad")).agg(
                F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows"), F.coalesce(F.sum("_bad"), F.lit(0)).alias(f"_bad{i}")
            )
            parts.append(_results(folded.withColumn(f"_seen{i}", F.col("_rows")), [(i, c)]))
    return reduce(DataFrame.unionByName, parts)


def verdict(results: DataFrame) -> DataFrame:
    """One row: did everything pass, and how many checks did."""
    return results.agg(
        F.bool_and("success").alias("passed"),
        F.count_if("success").alias("checks_passed"),
        F.count("*").alias("checks"),
        F.max("row_count").alias("row_count"),
    )


def gate(results: DataFrame, name: str = "quality gate") -> tuple[int, int]:
    """Raise when any check failed; otherwise return (rows checked, checks satisfied).

    Only the result rows, one per check, reach the driver.
    """
    outcome = results.collect()
    failed = [r for r in outcome if not r["success"]]
    if failed:
        found = ", ".join(f"{r['check']} ({r['unexpected_count']} of {r['row_count']} rows)" for r in failed)
        raise QualityGateError(f"{name}: {found}")
    return max((r["row_count"] for r in outcome), default=0), len(outcome)


def bronze_checks(statuses: Sequence[str]) -> list[Check]:
    """Structural checks on the event history."""
    return [
        not_null("flight_id"),
        in_set("status", statuses),
        between("delay_minutes", low=0),
        pair_differs("origin", "destination"),
    ]


def silver_checks(airport_pattern: str, max_days: int) -> list[Check]:
    """Checks that only hold once there is one current row per key."""
    return [
        unique("flight_id"),
        regex("origin", airport_pattern),
        regex("destination", airport_pattern),
        max_drift("event_ts", "scheduled_date", max_days),
    ]


def profile_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, nulls, null percentage, smallest and largest value as text. One pass."""
    names = list(columns or df.columns)
    orderable = {f.name: not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in df.schema.fields}
    folded = df.agg(
        F.count("*").alias("_rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"_null{i}") for i, c in enumerate(names)),
        *(F.min(c).cast("string").alias(f"_min{i}") for i, c in enumerate(names) if orderable[c]),
        *(F.max(c).cast("string").alias(f"_max{i}") for i, c in enumerate(names) if orderable[c]),
    )
    none = F.lit(None).cast("string")
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").alias("row_count"),
            F.col(f"_null{i}").alias("null_count"),
            F.round(F.try_divide(100.0 * F.col(f"_null{i}"), F.col("_rows")), 1).alias("null_pct"),
            (F.col(f"_min{i}") if orderable[c] else none).alias("min_value"),
            (F.col(f"_max{i}") if orderable[c] else none).alias("max_value"),
        )
        for i, c in enumerate(names)
    ]
    return folded.select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per distinct value, nulls included."""
    return df.groupBy(F.col(col).cast("string").alias("value")).agg(F.count("*").alias("rows"))
