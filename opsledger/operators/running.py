"""Running aggregates over an ordered stream of any length, without a single-task window.

A plain `window(order by seq)` moves the whole table to one task. Here rows are cut into blocks
of consecutive sequence numbers. One small row per block carries the block's total; an exclusive
prefix over those totals says what came before each block; and the ordinary window runs inside a
block only. A block holds at most `block` rows because sequence numbers are unique.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsledger.operators.skew import join_on

BLOCK = 1 << 16
BLOCKS_PER_GROUP = 1 << 16
_COMBINE = {
    "max": (F.max, lambda a, b: F.greatest(a, b)),
    "sum": (F.sum, lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)),
}


def running(
    df: DataFrame,
    order: str,
    totals: Mapping[str, tuple[str, Column]],
    keys: Sequence[str] = (),
    block: int = BLOCK,
    exclusive: bool = False,
) -> DataFrame:
    """Add one running aggregate per entry of `totals`: `{name: ("max" | "sum", value)}`.

    `order` is an integer column, unique within `keys`. With `exclusive` the row itself is left
    out. A NULL key is a key like any other; a NULL `order` stops the job. The block number stays in the result as `_block` for callers that join on it.
    """
    keys = list(keys)
    refuse = F.raise_error(F.lit(f"NULL in {order}: a row without a place cannot be put in order")).cast("bigint")
    rows = df.withColumn("_block", F.coalesce(F.expr(f"`{order}` div {block}"), refuse))
    for name, (_, value) in totals.items():
        rows = rows.withColumn(f"_{name}", value)

    def folded(source: DataFrame, by: list[str], prefix: str) -> DataFrame:
        aggregates = [_COMBINE[fn][0](f"{prefix}{name}").alias(f"{prefix}{name}") for name, (fn, _) in totals.items()]
        return source.groupBy(*by).agg(*aggregates)

    def before(source: DataFrame, by: list[str], sort: str, suffix: str) -> DataFrame:
        earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy(sort).rowsBetween(Window.unboundedPreceding, -1)
        prefixes = [_COMBINE[fn][0](f"_{name}").over(earlier).alias(f"{name}{suffix}") for name, (fn, _) in totals.items()]
        return source.select("*", *prefixes)

    blocks = folded(rows, [*keys, "_block"], "_").withColumn("_group", F.expr(f"_block div {BLOCKS_PER_GROUP}"))
    groups = before(folded(blocks, [*keys, "_group"], "_"), keys, "_group", "_before_group").select(
        *keys, "_group", *(f"{name}_before_group" for name in totals)
    )
    blocks = before(blocks, [*keys, "_group"], "_block", "_before_block")
    blocks = join_on(blocks, groups, [*keys, "_group"])
    blocks = blocks.select(
        *keys,
        "_block",
        *(
            _COMBINE[fn][1](F.col(f"{name}_before_group"), F.col(f"{name}_before_block")).alias(f"{name}_before")
            for name, (fn, _) in totals.items()
        ),
    )
    within = (
        Window.partitionBy(*keys, "_block")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    )
    joined = join_on(rows, blocks, [*keys, "_block"])
    result = [
        _COMBINE[fn][1](F.col(f"{name}_before"), _COMBINE[fn][0](f"_{name}").over(within)).alias(name)
        for name, (fn, _) in totals.items()
    ]
    return joined.select(*df.columns, "_block", *result)
