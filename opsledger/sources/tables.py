"""Reading and writing tables and documents. Parquet by default; `fmt` names any installed source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.operators.layout import check_append

# What Spark says of a place without a table. Anything else (permissions, broken files) is an error.
ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND"}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a table can be read at `path` (on whatever storage the path names)."""
    try:
        spark.read.format(fmt).load(path).schema  # noqa: B018
        return True
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return False
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything lies at `path`, on whatever storage it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The table, or an empty one of the same shape before its first write."""
    return read_table(spark, path, fmt) if table_exists(spark, path, fmt) else spark.createDataFrame([], schema)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, limit: int | None = None) -> DataFrame:
    """A CSV file with a header, optionally only its first rows. The schema is given, not guessed."""
    df = spark.read.schema(schema).csv(path, header=True)
    return df if limit is None else df.limit(limit)


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first n rows in a stated order, for a seed or a report; never "any n rows"."""
    return df.orderBy(*order).limit(n)


def seed(df: DataFrame, order: Sequence[str | Column], n: int, path: str, fmt: str = "parquet") -> int:
    """Replace the table at `path` by the first n rows of `df`."""
    return overwrite(first_rows(df, order, n), path, fmt)


def read_documents(spark: SparkSession, pattern: str) -> DataFrame:
    """One row per text file: (file_name, slug, text). The slug is the name without its extension."""
    files = spark.read.text(pattern, wholetext=True).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text")
    )
    return files.withColumn("slug", F.regexp_replace("file_name", r"(?<=.)\.[^.]*$", ""))


def _write(df: DataFrame, path: str, mode: str, fmt: str) -> int:
    """Write and return the number of rows, counted on the way instead of by a second pass."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode).save(path)
    return seen.get["rows"]


def append(df: DataFrame, path: str, table: T.StructType | None = None, fmt: str = "parquet", allow_new: bool = False) -> int:
    """Append rows; with `table`, refuse rows that do not fit its schema before anything is written."""
    return _write(df if table is None else check_append(df, table, allow_new), path, "append", fmt)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Replace a table, schema included. `df` must not be read from `path` itself."""
    return _write(df, path, "overwrite", fmt)


def route_batch(df: DataFrame, passed: bool, production: str, quarantine: str, fmt: str = "parquet") -> str:
    """Write a whole batch to one of two places by its verdict; returns where it went."""
    path = production if passed else quarantine
    overwrite(df, path, fmt)
    return path


def write_vectors(embedded: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Rebuild the dense side of a retrieval index: ids, vectors, texts and titles."""
    overwrite(embedded.select("chunk_id", "embedding", "text", "doc_title", "section_title"), path, fmt)
