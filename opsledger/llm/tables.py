"""What the operators share on the table side: input columns, folds, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.session import materialize, scratch  # noqa: F401  (general helpers, used by the operators)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(column: str = "doc_id", parts: int = 5) -> Column:
    """The remainder of crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % parts


def shield(docs: DataFrame, taken: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`docs` with columns of the `taken` names set aside, and what gives a result the columns of `docs` again."""
    aside = {c: f"_own_{c}" for c in docs.columns if c.lower() in {t.lower() for t in taken}}
    columns = [aside.get(c, c) for c in docs.columns]
    return docs.withColumnsRenamed(aside), lambda df: df.select(columns).withColumnsRenamed({v: k for k, v in aside.items()})
