"""Event-time windows as batch replays: the result a per-event loop would give, computed in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.functions.times import interval, interval_micros, micros
from opsledger.operators.running import BLOCK, running
from opsledger.operators.skew import join_on
from opsledger.session import materialize

# Block sizes within one key: arrival numbers, and half-microsecond slots (about 33 seconds of them).
# They bound what one task sorts for a hot key, and keep the blocks of ordinary keys few.
KEY_BLOCK = 1 << 22
TIME_BLOCK = 1 << 26


def flag_late(
    df: DataFrame,
    ts: str,
    order: str,
    lateness: str,
    start: Column | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Add `watermark` (highest event time seen before the row) and `late`.

    A row is late when it lies more than `lateness` behind the watermark; exactly `lateness`
    behind is on time. Late rows never raise the maximum, so taking it over all rows is right.
    """
    marked = running(df, order, {"watermark": ("max", F.col(ts))}, block=block, exclusive=True).drop("_block")
    if start is not None:
        marked = marked.withColumn("watermark", F.greatest("watermark", start))
    return marked.withColumn("late", F.coalesce(F.col(ts) < F.col("watermark") - interval(lateness), F.lit(False)))


def tumbling_count(df: DataFrame, ts: str, width: str, keys: Sequence[str] = ()) -> DataFrame:
    """Events per fixed window (and key)."""
    return (
        df.groupBy(*keys, F.window(ts, width).alias("_w"))
        .agg(F.count("*").alias("events"))
        .select(*keys, F.col("_w.start").alias("window_start"), "events")
    )


def hopping_mean(df: DataFrame, keys: Sequence[str], ts: str, value: Column, width: str, slide: str) -> DataFrame:
    """Mean per hopping window. Rows are first folded into panes of one `slide`, and only the
    panes, not the rows, are copied into the windows they belong to. `width` is a multiple of `slide`.
    """
    panes = (
        df.groupBy(*keys, F.window(ts, slide).alias("_p"))
        .agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
        .select(*keys, F.col("_p.start").alias("_pane"), "_sum", "_n")
    )
    starts = F.sequence(F.col("_pane") - interval(width) + interval(slide), F.col("_pane"), interval(slide))
    return (
        panes.withColumn("window_start", F.explode(starts))
        .groupBy(*keys, "window_start")
        .agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias("mean_value"), F.sum("_n").alias("events"))
    )


def sliding_mean(
    df: DataFrame,
    key: str,
    ts: str,
    order: str,
    value: str,
    width: str,
    block: int = KEY_BLOCK,
    time_block: int = TIME_BLOCK,
) -> DataFrame:
    """Mean of `value` over the last `width` of each key, evaluated at every row in arrival order.

    `df` holds on-time rows only (see `flag_late`), with a lateness shorter than `width`. A frame
    forgets for good: once some row has pushed an instant out, an older row does not bring it
    back, so the frame of a row reaches back from the highest event time its key has seen. Any row
    at or before that edge has arrived already (a later one would have been late), hence

        frame total = total in arrival order - total in event-time order up to the edge

    and no row is ever paired with another. Values are summed as decimals, never as floats, so taking a
    difference loses nothing: 30 digits behind the point are kept, and a value of 1e32 or more stops the
    job. A NULL value counts for nothing; rows without a key form one key.
    """
    v = F.col(value)
    if isinstance(df.schema[value].dataType, T.IntegralType):
        coarse, fine = v.cast("decimal(38,0)"), F.lit(None).cast("decimal(38,30)")
    else:
        # Two exact parts: millionths of any size, and what is left of them down to 30 digits.
        coarse = v.cast("decimal(38,6)")
        fine = (v - coarse.cast("double")).cast("decimal(38,30)")
    # Written first: the running totals read their input twice, and late flags are costly to redo.
    rows = materialize(df.withColumns({"_v": coarse, "_f": fine, "_t": micros(F.col(ts))}))
    arrived = running(
        rows,
        order,
        {
            "_seen_sum": ("sum", F.col("_v")),
            "_seen_fine": ("sum", F.col("_f")),
            "_seen_n": ("sum", F.col("_v").isNotNull().cast("bigint")),
            "_high": ("max", F.col("_t")),
        },
        keys=[key],
        block=block,
    )
    arrived = materialize(arrived.withColumn("_edge", F.col("_high") - interval_micros(width)))

    # Event-time totals, asked for once per distinct edge: an instant sorts before an edge at the same time.
    instants = arrived.groupBy(key, (F.col("_t") * 2).alias("_slot")).agg(
        F.sum("_v").alias("_v"), F.sum("_f").alias("_f"), F.count("_v").alias("_n")
    )
    edges = arrived.select(key, (F.col("_edge") * 2 + 1).alias("_slot")).distinct()
    passed = running(
        instants.unionByName(edges, allowMissingColumns=True),
        "_slot",
        {"_gone_sum": ("sum", F.col("_v")), "_gone_fine": ("sum", F.col("_f")), "_gone_n": ("sum", F.col("_n"))},
        keys=[key],
        block=time_block,
    )
    at_edge = passed.where(F.col("_slot") % 2 != 0).select(
        key, F.expr("(_slot - 1) div 2").alias("_edge"), "_gone_sum", "_gone_fine", "_gone_n"
    )
    # One edge can serve a long run of rows; meet it once per block of rows before meeting the rows.
    per_block = join_on(arrived.select(key, "_block", "_edge").distinct(), at_edge, [key, "_edge"], "left")
    left = lambda name: F.coalesce(F.col(f"_seen_{name}"), F.lit(0)) - F.coalesce(F.col(f"_gone_{name}"), F.lit(0))
    total, count = left("sum").cast("double") + left("fine").cast("double"), left("n")
    return join_on(arrived, per_block, [key, "_block", "_edge"], "left").select(
        *df.columns, F.try_divide(total, count).alias("rolling_mean"), count.alias("rolling_count")
    )


def severe(df: DataFrame, value: str, limit: float, late: str | None = None) -> DataFrame:
    """Rows above `limit`, on time where a lateness flag is given."""
    found = df.where(F.col(value) > limit)
    return found.where(~F.col(late)) if late else found
