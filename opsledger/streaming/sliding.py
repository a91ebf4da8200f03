"""The sliding mean as one stateful operator on a stream.

Per key the state holds the rows that can still be in a frame and the highest event time seen: it is as wide as one window. A timer
in event time drops it once the watermark has passed the last frame, so keys that fall silent cost nothing. Rows that come
later than the watermark are dropped by Spark and counted in its progress. Spark's watermark moves once per micro-batch: on
ordered input the means equal those of `operators.windows.sliding_mean`; `streaming.replay` applies the per-event lateness
rule on unordered input, and spreads a key with very many rows, whose rows here meet in the one task that holds its state.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from opsledger import flights
from opsledger.functions.times import micros

FRAME, HIGH = "at bigint, value double", "high bigint"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started in the block keep their state in RocksDB, which list state and timers need."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def frame_means(
    held_at: np.ndarray, held: np.ndarray, high: int | None, at: np.ndarray, value: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(sums, counts, times to hold, values to hold, highest time) of rows in arrival order that follow the held ones.

    A row's frame holds what arrived up to it and lies less than `width` before the highest time reached. A missing
    value counts for nothing. Sums are taken in extended precision.
    """
    reached = np.maximum.accumulate(at if high is None else np.maximum(at, high))
    edge = reached - width
    every_at, every = np.concatenate([held_at, at]), np.concatenate([held, value])
    known = ~np.isnan(every)
    amount = np.where(known, every, 0).astype(np.longdouble)
    by_time = np.argsort(every_at, kind="stable")
    gone = np.searchsorted(every_at[by_time], edge, side="right")
    first = len(held_at)

    def left(terms: np.ndarray) -> np.ndarray:
        passed = np.concatenate([[0], np.cumsum(terms[by_time])])[gone]
        return np.cumsum(terms)[first:] - passed

    kept = every_at > edge[-1]
    return left(amount).astype(float), left(known.astype(np.int64)), every_at[kept], every[kept], int(reached[-1])


class SlidingMean(StatefulProcessor):
    """Per key: the rows that can still be in a frame, the highest event time, and a timer that drops both."""

    def __init__(self, columns: Sequence[str], order: Sequence[str], width: int) -> None:
        self.columns, self.order, self.width = list(columns), list(order), width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.frame = handle.getListState("frame", FRAME)
        self.high = handle.getValueState("high", HIGH)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.sort_values(self.order, kind="stable", ignore_index=True)
        held = list(self.frame.get())
        known = self.high.get()
        at, value = batch["sliding_at"].to_numpy(np.int64), batch["sliding_value"].to_numpy(float)
        held_at = np.array([row[0] for row in held], np.int64)
        held_value = np.array([np.nan if row[1] is None else row[1] for row in held], float)
        total, count, kept_at, kept, high = frame_means(held_at, held_value, known[0] if known else None, at, value, self.width)
        self.frame.put([(int(t), None if np.isnan(v) else float(v)) for t, v in zip(kept_at, kept)])
        self.high.update((high,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        # The watermark is in milliseconds: one more, and every frame that could hold these rows has passed.
        self.handle.registerTimer(max((high + self.width) // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))
        mean = np.divide(total, count, out=np.full(len(total), np.nan), where=count > 0)
        told = pd.Series(mean, dtype=object).where(count > 0, None)
        yield batch[self.columns].assign(rolling_mean=told.astype("Float64"), rolling_count=count)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.frame.clear()
        self.high.clear()
        yield from ()

    def close(self) -> None:
        pass


def sliding_means(
    stream: DataFrame, key: str, ts: str, order: Sequence[str], value: str, width: str = flights.SLIDING_WIDTH, lateness: str = flights.LATENESS
) -> DataFrame:
    """(key, order columns, ts, rolling_mean, rolling_count) for every row that is not late, in append mode.

    Rows of one micro-batch arrive in the order of the columns `order`. A NULL value counts for nothing; a row without an
    event time is left out; rows without a key form one key. Start the query within `state_in_rocksdb`.
    """
    # The helper columns have no leading underscore: such names do not reach the processor.
    span = int(stream.sparkSession.range(1).select(F.expr(f"unix_micros(TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL {width})")).first()[0])
    rows = stream.where(F.col(ts).isNotNull()).withWatermark(ts, lateness).select(*dict.fromkeys([key, *order, ts]), micros(F.col(ts)).alias("sliding_at"), F.col(value).cast("double").alias("sliding_value"))
    kind = lambda c: f"`{c}` {stream.schema[c].dataType.simpleString()}"
    named = dict.fromkeys([key, *order, ts])
    out = f"{', '.join(kind(c) for c in named)}, rolling_mean double, rolling_count bigint"
    return rows.groupBy(key).transformWithStateInPandas(SlidingMean(list(named), order, span), out, "Append", "EventTime")
