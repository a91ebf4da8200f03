"""Event-time windows with Spark's own watermark.

That watermark moves once per micro-batch and drops a window by its end, so on out-of-order input
these differ from the per-event replay in `opsledger.streaming.replay`; on ordered input they agree.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from opsledger import flights
from opsledger.operators import windows


def tumbling_counts(
    stream: DataFrame, ts: str, width: str = flights.TUMBLING_WIDTH, lateness: str = flights.LATENESS, keys: Sequence[str] = ()
) -> DataFrame:
    """Events per window; too-late rows are dropped and counted in the query's progress."""
    return windows.tumbling_count(stream.withWatermark(ts, lateness), ts, width, keys)


def hopping_means(
    stream: DataFrame, keys: Sequence[str], ts: str, value: Column, width: str, slide: str, lateness: str = flights.LATENESS
) -> DataFrame:
    """Mean per hopping window and key."""
    frame = F.window(ts, width, slide)
    return (
        stream.withWatermark(ts, lateness)
        .groupBy(*keys, frame.alias("_w"))
        .agg(F.avg(value).alias("mean_value"), F.count(value).alias("events"))
        .select(*keys, F.col("_w.start").alias("window_start"), "mean_value", "events")
    )


def severe_delays(stream: DataFrame, limit: int = flights.SEVERE_DELAY) -> DataFrame:
    """Delayed flights above the limit, stamped with the time of detection."""
    delayed = stream.where(F.col("status") == flights.DELAYED)
    return windows.severe(delayed, "delay_minutes", limit).select(
        "flight_id", "airline_code", "delay_minutes", "event_ts", F.current_timestamp().alias("detected_at")
    )


class DropCounter(StreamingQueryListener):
    """Rows dropped as too late, added up over every progress report of the queries it hears of.

    Register it with `spark.streams.addListener` before a query starts. A query's own list of recent
    reports is cut, and so cannot be summed.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(int(operator.numRowsDroppedByWatermark) for operator in progress.stateOperators)
        self.dropped[str(progress.id)] = self.dropped.get(str(progress.id), 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


@contextlib.contextmanager
def counting_drops(spark: SparkSession) -> Iterator[DropCounter]:
    """A counter that hears of every query in the block; its figures are complete once the block is left."""
    counter = DropCounter()
    spark.streams.addListener(counter)
    try:
        yield counter
    finally:
        # Reports arrive on their own thread: all that were sent are waited for.
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(counter)
