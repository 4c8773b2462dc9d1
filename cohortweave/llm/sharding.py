"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import bisect
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm.common import first_after, ranked_within, slots_frame, written

#: Virtual nodes of each shard: more of them even out the arcs between neighbours.
VIRTUAL_NODES = 128
#: The ring is looked up by its top bits, so a row compares itself with a few nodes only.
CELL_BITS = 10


def ring(spark: SparkSession, n_shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node in ring order; n_shards * virtual_nodes rows.

    A node's position depends on its shard and number alone: one more shard adds nodes and
    moves none.
    """
    nodes = spark.range(n_shards * virtual_nodes).select(
        (F.col("id") / virtual_nodes).cast("int").alias("shard"), (F.col("id") % virtual_nodes).alias("node")
    )
    placed = nodes.select(F.xxhash64(F.lit("node"), "shard", "node").alias("at"), "shard")
    return sorted((r["at"], r["shard"]) for r in placed.collect())


def capacities(n_rows: int, n_shards: int, slack: float = 0.0) -> list[int]:
    """Rows each shard may hold: the mean and `slack` of it more, rounded so that all rows fit."""
    room = max(n_rows, int(n_rows * (1 + slack)))
    return [room // n_shards + (s < room % n_shards) for s in range(n_shards)]


def plan(owners: list[int], demand: list[int], limits: list[int]) -> list[tuple[int, int, int, int]]:
    """(arc, end rank, shard, first slot less first rank) for every run of an arc's rows.

    First each shard admits the rows of its own arcs until it is full; what is left over
    goes on clockwise to the next node whose shard has room.
    """
    free, used, left = list(limits), [0] * len(limits), list(demand)
    taken, out = [0] * len(owners), []

    def admit(arc: int, shard: int) -> None:
        if n := min(left[arc], free[shard]):
            out.append((arc, taken[arc] + n, shard, used[shard] - taken[arc]))
            taken[arc] += n
            left[arc] -= n
            free[shard] -= n
            used[shard] += n

    for arc, shard in enumerate(owners):
        admit(arc, shard)
    for arc in range(len(owners)):
        step = arc
        while left[arc]:
            step += 1
            admit(arc, owners[step % len(owners)])
    return out


def shard_rows(rows: DataFrame, key: str, n_shards: int, slack: float = 0.0, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """`rows` with `shard` (from 0) and `slot` (gapless from 0 in its shard).

    A row's key hashes to a point of the ring and belongs to the next virtual node clockwise.
    A shard holds at most its capacity (mean and `slack`); the rest goes on clockwise. With
    no slack, counts differ by at most one. What crosses the driver is one count per virtual
    node; arcs with many rows (one key may hold a third of them) are ranked in slices. Ranks go
    by a hash of the row's values, so the same rows get the same shards in whatever order they
    come; rows that are equal in all of them are interchangeable.

    Null keys share one point of the ring; repeated rows are rows of their own; an empty table
    gives an empty result. `shard`, `slot` and names with a leading underscore are reserved
    in `rows`, everything else is passed through. `rows` is written once, so pass few columns.
    """
    spark = rows.sparkSession
    hashed = [F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    nodes = ring(spark, n_shards, virtual_nodes)
    positions = [at for at, _ in nodes]
    cells = []
    for cell in range(-(1 << CELL_BITS - 1), 1 << CELL_BITS - 1):
        low, high = cell << (64 - CELL_BITS), (cell + 1) << (64 - CELL_BITS)
        first, last = bisect.bisect_left(positions, low), bisect.bisect_left(positions, high)
        inside = [(positions[i], i) for i in range(first, last)]
        cells.append((cell, [*inside, ((1 << 63) - 1, last % len(nodes))]))
    lookup = slots_frame(spark, cells, "_cell long, _nodes array<struct<upto:long,arc:int>>")
    placed = (
        rows.withColumn("_at", F.xxhash64(F.lit("key"), key))
        .withColumn("_cell", F.shiftright("_at", 64 - CELL_BITS))
        .join(lookup, "_cell")
        .withColumn("_arc", F.filter("_nodes", lambda x: x["upto"] >= F.col("_at"))[0]["arc"])
        .drop("_cell", "_nodes", "_at")
        .withColumn("_tie", F.xxhash64(F.lit("row"), key, *hashed))
    )
    placed = written(placed, "shard-rows")
    counts = {r["_arc"]: r["n"] for r in placed.groupBy("_arc").agg(F.count("*").alias("n")).collect()}
    limits = capacities(sum(counts.values()), n_shards, slack)
    runs = defaultdict(list)
    for arc, upto, shard, shift in plan([s for _, s in nodes], [counts.get(i, 0) for i in range(len(nodes))], limits):
        runs[arc].append((upto, shard, shift))
    runs_of = slots_frame(spark, list(runs.items()), "_arc int, _runs array<struct<upto:long,shard:int,shift:long>>")
    ranked = ranked_within(placed, "_arc", "_tie", counts, "_rank")
    return (
        ranked.join(runs_of, "_arc")
        .withColumn("_run", first_after(F.col("_runs"), "upto", F.col("_rank")))
        .withColumn("shard", F.col("_run")["shard"])
        .withColumn("slot", F.col("_rank") + F.col("_run")["shift"])
        .drop("_arc", "_runs", "_run", "_rank", "_tie")
    )


def shard_documents(docs: DataFrame, n_shards: int = 16, slack: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document; see `shard_rows`.

    Size: UTF-8 bytes of the text and 1. A null text counts as no bytes.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard_rows(narrow, "doc_id", n_shards, slack)
