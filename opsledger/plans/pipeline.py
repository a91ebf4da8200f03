"""The batch pipeline: messages, contract, history, gate, state, gate, summary.

Each stage is recorded as a run. A failed gate raises, and no later stage runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger import flights
from opsledger.operators import quality
from opsledger.operators.runs import parquet_sink, stage_run
from opsledger.operators.state import latest_per_key, merge_latest
from opsledger.operators.summary import daily_summary
from opsledger.session import materialize, scratch
from opsledger.sources.streams import drain, read_messages, write_batch
from opsledger.sources.tables import append, overwrite, read_or_empty, read_table
from opsledger.streaming.ingest import DAY, ingest

KEY, TIME, TIES = flights.KEY, flights.EVENT_TIME, [flights.INGEST_TIME]
# Parts of the state, by a hash of the key: the least that a merge rewrites.
PARTS = 64
MANIFEST = T.StructType([T.StructField("version", T.LongType()), T.StructField("part", T.IntegerType())])


@dataclass(frozen=True)
class Paths:
    """Where the tables live: one root on storage every executor can reach."""

    messages: str
    root: str

    def __getattr__(self, name: str) -> str:
        if name in ("bronze", "dead_letters", "silver", "gold", "runs", "purged", "checkpoint"):
            return f"{self.root}/{name}"
        raise AttributeError(name)


def bronze_table(spark: SparkSession, paths: Paths) -> DataFrame:
    """The event history with the number of the load that brought each row, in folders by load and day."""
    columns = [F.col(f.name).cast(f.dataType) for f in flights.BRONZE_SCHEMA.fields]
    return read_table(spark, paths.bronze).select(*columns, F.col("batch_id").cast("long"))


def _manifest(spark: SparkSession, paths: Paths) -> DataFrame:
    """(version, part): which parts of the state each merge wrote."""
    return read_or_empty(spark, f"{paths.silver}/manifest", MANIFEST)


def _part() -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(PARTS)).cast("int")


def silver_versions(spark: SparkSession, paths: Paths) -> list[int]:
    """Versions of the state, oldest first: one for every merge."""
    return sorted(r["version"] for r in _manifest(spark, paths).select("version").distinct().collect())


def newest_load(spark: SparkSession, paths: Paths) -> int:
    """The last load that the state contains; -1 before the first merge."""
    return _manifest(spark, paths).agg(F.coalesce(F.max("version"), F.lit(-1))).first()[0]


def silver_table(
    spark: SparkSession, paths: Paths, version: int | None = None, parts: Sequence[int] | None = None
) -> DataFrame | None:
    """The newest state, or an older version of it, or some parts of it; None before the first merge.

    A version is every part as the last merge up to it left it. Parts are never changed, only superseded.
    """
    rows = _manifest(spark, paths)
    rows = rows if version is None else rows.where(F.col("version") <= version)
    rows = rows if parts is None else rows.where(F.col("part").isin(list(parts)))
    newest = rows.groupBy("part").agg(F.max("version").alias("version")).collect()  # PARTS rows at most
    folders = [f"{paths.silver}/version={r['version']}/part={r['part']}" for r in newest]
    return spark.read.schema(flights.BRONZE_SCHEMA).parquet(*folders) if folders else None


def unmerged(spark: SparkSession, paths: Paths) -> DataFrame:
    """The history rows of loads that the state does not contain yet."""
    return bronze_table(spark, paths).where(F.col("batch_id") > newest_load(spark, paths))


def load(spark: SparkSession, paths: Paths, timeout: int | None = None) -> None:
    """Validate and append every message that has arrived since the last run."""
    drain(ingest(read_messages(spark, paths.messages), paths.bronze, paths.dead_letters, paths.checkpoint), timeout)


def check_bronze(spark: SparkSession, paths: Paths) -> tuple[int, int]:
    """Gate the loads that are about to be merged; older ones have passed."""
    return quality.gate(quality.run_checks(unmerged(spark, paths), quality.bronze_checks(flights.STATUSES)), "bronze gate")


def purge(spark: SparkSession, paths: Paths) -> int:
    """After a failed gate: move the failing rows of unmerged loads to the table `purged`; returns their number.

    Each touched load is copied first and then replaced, so a purge that died half way can be repeated.
    """
    bad = reduce(lambda a, b: a | b, (c.bad for c in quality.bronze_checks(flights.STATUSES) if not c.group_by))
    bad = F.coalesce(bad, F.lit(False))
    with scratch(spark):
        rows = materialize(unmerged(spark, paths).withColumn("_bad", bad))
        touched = [r["batch_id"] for r in rows.where("_bad").select("batch_id").distinct().collect()]
        if not touched:
            return 0
        moved = append(rows.where("_bad").drop("_bad"), paths.purged)
        for load_id in touched:
            kept = rows.where((F.col("batch_id") == load_id) & ~F.col("_bad")).drop("_bad", "batch_id")
            write_batch(kept, paths.bronze, load_id, by=DAY)
    return moved


def merge(spark: SparkSession, paths: Paths) -> int:
    """Merge the loads that arrived since the newest version; only parts of the state that they touch are rewritten.

    A version is numbered by the last load it contains, and is in the manifest only once it is complete; a
    merge that died half way is simply redone.
    """
    current = newest_load(spark, paths)
    loads = unmerged(spark, paths)
    newest = loads.agg(F.max("batch_id")).first()[0]
    if newest is None:
        return current
    loads = loads.drop("batch_id")
    touched = sorted(r["part"] for r in loads.select(_part().alias("part")).distinct().collect())
    merged = merge_latest(silver_table(spark, paths, parts=touched), loads, KEY, TIME, TIES).withColumn("part", _part())
    merged.write.mode("overwrite").partitionBy("part").parquet(f"{paths.silver}/version={newest}")
    spark.createDataFrame([(int(newest), p) for p in touched], MANIFEST).coalesce(1).write.mode("append").parquet(f"{paths.silver}/manifest")
    return newest


def check_silver(spark: SparkSession, paths: Paths) -> tuple[int, int]:
    checks = quality.silver_checks(flights.AIRPORT_PATTERN, flights.MAX_DRIFT_DAYS)
    return quality.gate(quality.run_checks(silver_table(spark, paths), checks), "silver gate")


def summarize(spark: SparkSession, paths: Paths) -> None:
    """Daily summary per airline. Not sorted before writing; readers order what they show."""
    groups = ["airline_code", "scheduled_date"]
    summary = daily_summary(
        silver_table(spark, paths), groups, "status", "delay_minutes", flights.DELAYED, flights.CANCELLED
    )
    overwrite(summary, paths.gold)


def rebuild_silver(spark: SparkSession, paths: Paths) -> DataFrame:
    """The state recomputed from the whole history, to check or replace the merged one."""
    return latest_per_key(bronze_table(spark, paths).drop("batch_id"), KEY, TIME, TIES)


STAGES = {
    "load": load,
    "quality_gate_bronze": check_bronze,
    "merge": merge,
    "quality_gate_silver": check_silver,
    "summarize": summarize,
}


def run(spark: SparkSession, paths: Paths) -> None:
    """All stages in order, stopping at the first that fails."""
    sink = parquet_sink(paths.runs)
    for name, stage in STAGES.items():
        with stage_run(spark, name, sink):
            stage(spark, paths)
