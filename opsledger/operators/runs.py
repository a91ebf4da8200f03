"""Run events around a stage, and what they say about each run."""

from __future__ import annotations

import contextlib
import datetime
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.functions.times import micros

RUN_SCHEMA = "run_id string, job string, namespace string, state string, event_time timestamp"
START, COMPLETE, FAIL = "START", "COMPLETE", "FAIL"

Sink = Callable[[DataFrame], None]


def parquet_sink(path: str) -> Sink:
    """Append run events to a table."""
    return lambda events: events.write.mode("append").parquet(path)


@contextlib.contextmanager
def stage_run(spark: SparkSession, job: str, sink: Sink, namespace: str = "ops") -> Iterator[str]:
    """Record START, then COMPLETE or FAIL, around a stage. Any failure, interrupts included, is re-raised."""
    run_id = str(uuid.uuid4())

    def record(state: str) -> None:
        now = datetime.datetime.now(datetime.timezone.utc)
        sink(spark.createDataFrame([(run_id, job, namespace, state, now)], RUN_SCHEMA).coalesce(1))

    record(START)
    try:
        yield run_id
    except BaseException:
        record(FAIL)
        raise
    record(COMPLETE)


def latest_run_state(
    events: DataFrame, run: str = "run_id", state: str = "state", time: str = "event_time", order: Column | None = None
) -> DataFrame:
    """Last state, start, end and duration of every run; runs still going have no end.

    `order` breaks ties between events of one instant.
    """
    when = F.col(time)
    position = when if order is None else F.struct(when, order)
    folded = events.groupBy(run).agg(
        F.max_by(state, position).alias("last_state"),
        F.min(F.when(F.col(state) == START, when)).alias("started_at"),
        F.max(F.when(F.col(state).isin(COMPLETE, FAIL), when)).alias("ended_at"),
        F.count("*").alias("events"),
    )
    elapsed = micros(F.col("ended_at")) - micros(F.col("started_at"))
    return folded.withColumn("duration_s", elapsed / 1_000_000)
