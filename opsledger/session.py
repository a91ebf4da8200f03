"""Session settings and the one place that decides where checkpoints live."""

from __future__ import annotations

import contextlib
import io
import pathlib
import re
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # JSON objects that repeat a key keep the last value, as JSON readers usually do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "opsledger", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators assume; `extra` wins over `SETTINGS`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give every Python worker this package, wherever the driver was started; once per session."""
    sc = spark.sparkContext
    if getattr(sc, "_opsledger_shipped", False):
        return
    buffer = io.BytesIO()
    root = pathlib.Path(__file__).resolve().parent
    with zipfile.ZipFile(buffer, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    # Python workers read it from the session's own file server, not from a folder they would have to share.
    name = pathlib.Path(sc._temp_dir) / "opsledger.zip"
    name.write_bytes(buffer.getvalue())
    sc.addPyFile(str(name))
    sc._opsledger_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in `spark.checkpoint.dir`.

    A session that runs in one process, where no other machine could miss it, gets one under its warehouse.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    sc.setCheckpointDir(made)
    return made


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that `materialize` writes in the block are deleted at its end, when all results are written."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


# Spark's own setting: the shuffle files of a query go when it ends, not when its plan is collected as garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, outer: bool = False) -> DataFrame:
    """Write `df` as a table in the checkpoint folder and read it back.

    Several consumers then read it, each only the columns it needs, instead of recomputing it, and
    losing an executor costs no more than a re-read; what was shuffled to make it is deleted. Inside `scratch` it goes with
    the block (`outer`: with the block around that one); else it stays until the folder is cleaned, because what reads it may run later.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/opsledger-{uuid.uuid4().hex}"
    scopes = _scopes[:-1] if outer else _scopes
    if scopes:
        scopes[-1].append(path)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
