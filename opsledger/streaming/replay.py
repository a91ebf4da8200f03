"""The exact per-event window semantics on a stream: every micro-batch is a batch replay.

What a per-event loop would remember is kept as a small table per batch: the watermark, and per key
the rows that can still be in a frame. State is therefore as wide as one window, is spread like any
table, and a hot key is handled by the same distributed prefix sums as in batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger import flights
from opsledger.functions.times import interval
from opsledger.operators.skew import lookup_join
from opsledger.operators.windows import flag_late, severe, sliding_mean, tumbling_count
from opsledger.session import scratch
from opsledger.sources.streams import each_batch, write_batch
from opsledger.sources.tables import read_table


@dataclass(frozen=True)
class Replay:
    """Columns and limits of a replay. `order` is the unique arrival number of a row."""

    ts: str = flights.EVENT_TIME
    order: str = "arrival"
    key: str = "airline_code"
    value: str = "delay_minutes"
    delayed: str = f"status = '{flights.DELAYED}' AND delay_minutes IS NOT NULL"
    tumbling: str = flights.TUMBLING_WIDTH
    sliding: str = flights.SLIDING_WIDTH
    lateness: str = flights.LATENESS
    limit: float = flights.SEVERE_DELAY
    start: str | None = None


def replay(stream: DataFrame, root: str, checkpoint: str, cfg: Replay = Replay()):
    """A writer that adds to the tables `late`, `tumbling`, `rolling` and `anomalies` under `root`.

    Each batch reads the state its predecessor left and writes its own, all under its batch id, so
    a repeated batch starts from the same state and replaces its own output. `tumbling` holds one
    partial count per batch and window; `tumbling_totals` adds them up.
    """
    spark = stream.sparkSession
    columns = [cfg.key, cfg.ts, cfg.order, cfg.value]

    def handle(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark):
            one_batch(batch, batch_id)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        mark, carried = f"{root}/state_watermark/batch_id={batch_id - 1}", f"{root}/state_frames/batch_id={batch_id - 1}"
        start: Column | None = F.lit(cfg.start).cast(batch.schema[cfg.ts].dataType) if cfg.start else None
        if batch_id > 0:  # a missing predecessor is an error, not an empty state
            known = read_table(spark, mark).first()["watermark"]
            start = F.lit(known) if known is not None else start
        write_batch(flag_late(batch, cfg.ts, cfg.order, cfg.lateness, start), f"{root}/flagged", batch_id)
        flagged = read_table(spark, f"{root}/flagged/batch_id={batch_id}")
        on_time = flagged.where(~F.col("late")).drop("late", "watermark")
        highest = F.max(cfg.ts)
        reached = on_time.agg((F.greatest(highest, start) if start is not None else highest).alias("watermark"))
        write_batch(reached.coalesce(1), f"{root}/state_watermark", batch_id)
        write_batch(flagged.where("late").drop("late"), f"{root}/late", batch_id)
        write_batch(tumbling_count(on_time, cfg.ts, cfg.tumbling), f"{root}/tumbling", batch_id)

        delayed = on_time.where(cfg.delayed)
        now = F.current_timestamp().alias("detected_at")
        write_batch(severe(delayed, cfg.value, cfg.limit).select("*", now), f"{root}/anomalies", batch_id)
        framed = delayed.select(*columns, F.lit(True).alias("_new"))
        if batch_id > 0:
            framed = framed.unionByName(read_table(spark, carried).withColumn("_new", F.lit(False)))
        rolled = sliding_mean(framed, cfg.key, cfg.ts, cfg.order, cfg.value, cfg.sliding)
        write_batch(rolled.where("_new").drop("_new"), f"{root}/rolling", batch_id)
        edge = framed.groupBy(cfg.key).agg(F.max(cfg.ts).alias("_high"))
        kept = lookup_join(framed, edge, cfg.key, F.col(cfg.order), "inner", nulls_match=True).where(F.col(cfg.ts) > F.col("_high") - interval(cfg.sliding))
        write_batch(kept.select(*columns), f"{root}/state_frames", batch_id)

    return each_batch(stream, checkpoint, handle)


def tumbling_totals(partial: DataFrame) -> DataFrame:
    """Counts per window over all batches."""
    return partial.groupBy("window_start").agg(F.sum("events").alias("events"))
