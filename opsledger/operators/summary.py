"""Rate summaries over current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rate(part: Column, whole: Column, decimals: int = 1) -> Column:
    """The part in percent of the whole; NULL for an empty whole."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), decimals)


def daily_summary(
    df: DataFrame, group_cols: Sequence[str | Column], status: str, measure: str, delayed: str, cancelled: str
) -> DataFrame:
    """Per group: all rows, those delayed, those cancelled, the mean measure of the delayed, and the on-time rate.

    A row is on time unless its status says delayed or cancelled; one without a status counts as on time.
    """
    state = F.col(status)
    on_time = ~F.coalesce(state.isin(delayed, cancelled), F.lit(False))
    counted = {
        "total_flights": F.count(F.lit(1)),
        "delayed_count": F.count_if(state == delayed),
        "cancelled_count": F.count_if(state == cancelled),
        "avg_delay_minutes": F.avg(F.when(state == delayed, F.col(measure))),
        "on_time_pct": rate(F.count_if(on_time), F.count(F.lit(1))),
    }
    return df.groupBy(*group_cols).agg(*(column.alias(name) for name, column in counted.items()))


def in_order(summary: DataFrame, *columns: str) -> DataFrame:
    """A summary sorted for reading. Tables are stored unsorted; whoever shows one asks for the order."""
    return summary.orderBy(*columns)


def delay_by_cause(
    df: DataFrame, day: Column, cause: str, status: str, measure: str, delayed: str
) -> DataFrame:
    """Delayed rows per day and cause, with their mean measure."""
    late = df.where(F.col(status) == delayed)
    by = late.groupBy(day.alias("day"), F.col(cause).alias("cause"))
    return by.agg(F.count("*").alias("delayed_count"), F.avg(measure).alias("avg_delay_minutes"))
