"""Sharding by balanced label propagation: linked documents move towards their neighbours' shards under quotas.

Links are given as groups: the members of a group are linked with each other, a pair is a group of two. Documents
start in a shard by hash. In each round a join gives every document the weight of its neighbours in each shard; it
asks for the shard with most (ties by a hash that all members of a group share), if that has room and beats its own.
What a shard may take in is its quota, the capacity it has left: requests are admitted by ranges of the group's
hash, so that a group comes whole or waits; of a group that fits nowhere whole, as many rows come as there is room
for, and the members left outside gather in the next shard with room. Rounds end when nothing moves. No round pairs members: a
group is one row of shard weights, and what reaches the driver are histograms of fixed size.

Documents without a link are not part of the rounds. They fill what is left of each shard, so that the law
holds exactly: by rows, no two shards differ by more than one. Members beyond a shard's capacity after the last
round, which happens only where nearly all documents are linked, are dealt out like documents without a link.

A null text is an empty one; equal texts form a group, empty ones too. Rows without an id and repeated rows count each.
Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsledger.llm.filter_audit import text_key
from opsledger.llm.tables import materialize


@dataclass(frozen=True)
class Rule:
    """`ranges` cut a shard's requests by group hash; rows are numbered in blocks of about `block`."""

    shards: int = 8
    rounds: int = 20
    ranges: int = 1024
    block: int = 50_000


def _loads(state: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["w"] for r in state.groupBy("shard").agg(F.sum("weight").alias("w")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _wishes(state: DataFrame, links: DataFrame, room: list[int], least_room: list[int]) -> DataFrame:
    """(node, weight, shard, want, lead, total): the shard each node asks for, the group that leads it and that group's weight."""
    n = len(room)
    members = links.join(state, "node")
    # A table of its own, so that the members of a very large group are split in the join.
    held = [F.sum(F.when(F.col("shard") == s, F.col("weight")).otherwise(0)).alias(f"w{s}") for s in range(n)]
    votes = materialize(members.groupBy("group").agg(*held, F.sum("weight").alias("total")))
    pulled = members.join(votes, "group").groupBy("node").agg(
        F.first("weight").alias("weight"), F.first("shard").alias("shard"), *(F.sum(f"w{s}").alias(f"w{s}") for s in range(n)),
        F.min(F.struct("group", "total")).alias("lead"),
    )
    # A shard is open to a group whose missing members it can take, and, unless nearly full, to one that no shard could take whole.
    missing = lambda s: F.col("lead.total") - F.col(f"w{s}")
    least = reduce(F.least, (F.greatest(missing(s) - room[s], F.lit(0)) for s in range(n)))
    is_open = lambda s: (F.col("shard") == s) | (missing(s) <= room[s]) | (F.lit(room[s] > least_room[s]) & (least > 0))
    tie = lambda s: F.xxhash64("lead.group", F.lit(s))
    choices = [F.when(is_open(s), F.struct(F.col(f"w{s}").alias("votes"), tie(s).alias("tie"), F.lit(s).alias("to"))) for s in range(n)]
    want = F.array_max(F.array(*choices))["to"]
    return pulled.select("node", "weight", "shard", want.alias("want"), F.col("lead.group").alias("lead"), F.col("lead.total").alias("total"))


def _admitted(wishes: DataFrame, room: list[int], rule: Rule, turn: int) -> Column | None:
    """Which requests the quotas admit in this turn; None when there is none."""
    at = F.pmod(F.xxhash64("lead"), F.lit(rule.ranges))
    rows = wishes.where("want <> shard").groupBy("want", at.alias("at")).agg(F.sum("weight").alias("w"), F.max("total").alias("most")).collect()
    if not rows:
        return None
    whole: dict[int, list[int]] = {}
    split: dict[int, tuple[int, float, str]] = {}
    for shard in range(rule.shards):
        left = room[shard]
        waiting = []
        # The largest first: they are the hardest to place.
        for row in sorted((r for r in rows if r["want"] == shard), key=lambda r: (-r["w"], r["at"])):
            if row["w"] <= left:
                whole.setdefault(shard, []).append(row["at"])
                left -= row["w"]
            else:
                waiting.append(row)
        # Of one range that does not fit a share of its groups comes, or, where a group fits nowhere whole, of its rows.
        if waiting and left > 0:
            large = [r for r in waiting if r["most"] > max(room)]
            row = (large or waiting)[0]
            split[shard] = (row["at"], left / row["w"], "node" if large else "lead")
    if not whole and not split:
        return None
    admit = F.lit(False)
    for shard, ranges in whole.items():
        admit = admit | ((F.col("want") == shard) & at.isin(ranges))
    for shard, (place, share, by) in split.items():
        part = F.pmod(F.xxhash64(by, F.lit(turn)), F.lit(1_000_000)) < int(share * 1_000_000)
        admit = admit | ((F.col("want") == shard) & (at == place) & part)
    return admit & (F.col("want") != F.col("shard"))


def propagate(nodes: DataFrame, links: DataFrame, capacity: list[int], rule: Rule = Rule()) -> DataFrame:
    """(node, weight, shard) of `nodes` (node, weight), linked by `links` (node, group)."""
    start = F.pmod(F.xxhash64("node"), F.lit(rule.shards)).cast("int")
    state = materialize(nodes.select("node", "weight", start.alias("shard")))
    for turn in range(rule.rounds):
        room = [c - load for c, load in zip(capacity, _loads(state, rule.shards))]
        if max(room) <= 0:
            break
        wishes = materialize(_wishes(state, links, room, [c // 50 for c in capacity]))
        admit = _admitted(wishes, room, rule, turn)
        if admit is None:
            break
        state = materialize(wishes.select("node", "weight", F.when(admit, F.col("want")).otherwise(F.col("shard")).alias("shard")))
    return state


def numbered(df: DataFrame, by: list[str], key: list[str], name: str, block: int) -> DataFrame:
    """`df` with `name`: numbers from 0 without gaps within `by`. No task holds more than about a block of rows.

    Rows are dealt to blocks by a hash of `key`; a block's first number is the sum of the blocks before it. `df` is
    read three times.
    """
    rows = df.count()
    blocked = df.withColumn("_block", F.pmod(F.xxhash64(*key), F.lit(max(1, -(-rows // block)))))
    sizes = blocked.groupBy(*by, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(*by, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    place = F.row_number().over(Window.partitionBy(*by, "_block").orderBy(*key))
    return blocked.join(first, [*by, "_block"]).withColumn(name, F.col("_first") + place - 1).drop("_block", "_first")


def _filled(rows: DataFrame, room: list[int], key: list[str], block: int) -> DataFrame:
    """`rows` with a shard each: the first room[0] of them go to shard 0, the next room[1] to shard 1, and so on."""
    shard, total = F.lit(len(room) - 1), sum(room)
    for s in range(len(room) - 1, -1, -1):
        total -= room[s]
        shard = F.when(F.col("_number") < total, F.lit(s - 1)).otherwise(shard) if s else shard
    return numbered(rows, [], key, "_number", block).withColumn("shard", shard).drop("_number")


def shard_documents(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of `docs` (doc_id, text); equal texts are linked.

    `size` is the bytes of the text and one; `slot` numbers a shard's rows from 0.
    """
    text = F.coalesce("text", F.lit(""))
    rows = materialize(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        text_key().alias("group"), F.monotonically_increasing_id().alias("node"),
    ))
    several = materialize(rows.groupBy("group").agg(F.count("*").alias("_n")).where("_n > 1").select("group", F.lit(True).alias("linked")))
    rows = materialize(rows.join(several, "group", "left").withColumn("linked", F.coalesce("linked", F.lit(False))))
    total = rows.count()
    capacity = [total // rule.shards + (s < total % rule.shards) for s in range(rule.shards)]
    linked = rows.where("linked")
    state = propagate(linked.select("node", F.lit(1).alias("weight")), linked.select("node", "group"), capacity, rule)
    loads = _loads(state, rule.shards)
    placed = linked.join(state.select("node", "shard"), "node")
    spare = rows.where("NOT linked")
    if any(load > c for load, c in zip(loads, capacity)):
        ranked = materialize(numbered(placed, ["shard"], ["node"], "_number", rule.block))
        over = F.col("_number") >= F.element_at(F.array(*map(F.lit, capacity)), F.col("shard") + 1)
        spare = spare.unionByName(ranked.where(over).select(spare.columns))
        placed = ranked.where(~over).drop("_number")
    room = [max(c - load, 0) for c, load in zip(capacity, loads)]
    filled = _filled(spare, room, ["node"], rule.block)
    columns = ["doc_id", "size", "text_crc32", "node", "shard"]
    whole = materialize(placed.select(columns).unionByName(filled.select(columns)))
    return numbered(whole, ["shard"], ["node"], "slot", rule.block).select("doc_id", "size", "text_crc32", "shard", "slot")
