"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step is a grouped minimum (with a map-side part) and a join, so a node with very many links is never
gathered in one task. Links are written to the shared folder between steps; only two numbers reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.llm.tables import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.filter("v < u")
    # A table of its own, so that the rows of a node with very many links can be split in the join.
    least = materialize(both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m")))
    moved = both.join(least, "u")
    if large:
        made = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        made = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return made.filter("u <> v").distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame, first: str = "a", second: str = "b", most: int = 60) -> DataFrame:
    """(node, component): every node of a link and the smallest node it can reach.

    Null ends and self links are left out; repeated links count once. No link gives no row.
    """
    now = materialize(
        links.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"))
        .filter("u <> v")
        .distinct()
    )
    mark = _mark(now)
    for _ in range(most):
        if not mark[0]:
            break
        now = materialize(_star(_star(now, True), False))
        last, mark = mark, _mark(now)
        if mark == last:
            break
    else:
        raise RuntimeError(f"components not settled after {most} steps")
    return now.groupBy("u").agg(F.min("v").alias("component")).select(
        F.col("u").alias("node"), "component"
    ).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
