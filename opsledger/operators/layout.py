"""Schema rules for appends, schema evolution, and file layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaRefused(ValueError):
    """An append does not fit the table."""


def schema_problems(found: T.StructType, table: T.StructType, allow_new: bool = False) -> list[str]:
    """Missing required columns, changed types, and columns the table does not have."""
    have = {f.name: f.dataType for f in found.fields}
    want = {f.name: f for f in table.fields}
    problems = [f"required column {n!r} is missing" for n, f in want.items() if not f.nullable and n not in have]
    problems += [
        f"column {n!r} is {have[n].simpleString()}, the table has {f.dataType.simpleString()}"
        for n, f in want.items()
        if n in have and have[n] != f.dataType
    ]
    if not allow_new:
        problems += [f"column {n!r} is not in the table" for n in have if n not in want]
    return problems


def check_append(df: DataFrame, table: T.StructType, allow_new: bool = False) -> DataFrame:
    """Refuse `df` with `SchemaRefused` unless it can be appended; otherwise return it in table order.

    NOT NULL columns are checked while the rows are written: a null in one stops the write.
    """
    problems = schema_problems(df.schema, table, allow_new)
    if problems:
        raise SchemaRefused("; ".join(problems))
    columns = []
    for f in table.fields:
        if f.name not in df.columns:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.nullable:
            columns.append(F.col(f.name))
        else:
            refuse = F.raise_error(F.lit(f"NULL in required column {f.name}")).cast(f.dataType)
            columns.append(F.coalesce(F.col(f.name), refuse).alias(f.name))
    new = [c for c in df.columns if c not in table.fieldNames()]
    return df.select(*columns, *new)


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; a column only one side has is NULL on the other."""
    return old.unionByName(new, allowMissingColumns=True)


def rewrite_clustered(df: DataFrame, key: str, path: str, files: int) -> DataFrame:
    """Write `df` to the new folder `path` as `files` files with disjoint, sorted ranges of `key`.

    Readers that filter on `key` then skip all but a file or two by their min/max statistics.
    """
    df.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def file_metrics(df: DataFrame, key: str) -> DataFrame:
    """Per data file: rows and the smallest and largest key, as a nested `metrics` column."""
    return df.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.struct(
            F.count("*").alias("numRows"), F.min(key).alias("minKey"), F.max(key).alias("maxKey")
        ).alias("metrics")
    )


def layout_change(before: DataFrame, after: DataFrame) -> tuple[int, int]:
    """(files removed, files added) between two layouts of a table; the names are counted in Spark."""
    count = lambda df: df.select(F.col("_metadata.file_path").alias("f")).agg(F.count_distinct("f")).first()[0]
    return count(before), count(after)
