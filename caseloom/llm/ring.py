"""Shards on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

Each shard owns ``points`` places on a ring of 2**60 positions, each key the next place clockwise. A shard takes keys up to
its capacity; keys that find it full go on clockwise to the next other shard. Which keys overflow depends only on how many
keys each arc of the ring holds: the arc counts (shards x points rows, a fixed number) come to the driver, which turns them
into rank intervals (at most shards per arc), and every row finds its interval by its rank in its arc. Ranks come from
cells of bounded size inside the arcs, so no task sorts an arc.
"""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RING_BITS = 60
ROWS_PER_CELL = 20_000
_GRID_BITS = 12


def ring_points(shards: int, points: int, seed: int) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes, clockwise."""
    return sorted((int(hashlib.md5(f"{seed}:{s}:{v}".encode()).hexdigest()[:RING_BITS // 4], 16), s) for s in range(shards) for v in range(points))


def place(ring: list[tuple[int, int]], arcs: dict[int, int], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, slot of the first rank): keys of full shards go on clockwise."""
    free, used = list(capacity), [0] * len(capacity)
    order = []
    for a in range(len(ring)):
        seen = dict.fromkeys(ring[(a + i) % len(ring)][1] for i in range(len(ring)))
        order.append(list(seen))
    waiting = [(a, 0, n) for a, n in sorted(arcs.items()) if n]
    out = []
    for step in range(len(capacity)):
        later = []
        for a, low, high in waiting:
            s = order[a][step]
            take = min(free[s], high - low)
            if take:
                out.append((a, low, low + take, s, used[s]))
                free[s] -= take
                used[s] += take
            if low + take < high:
                later.append((a, low + take, high))
        waiting = later
    if waiting:
        raise ValueError("the shards hold fewer rows than there are")
    return out


def _json_rows(spark, rows: list[tuple], schema: str) -> DataFrame:
    """Driver-side rows as one literal of the plan."""
    names = [c.split()[0] for c in schema.split(", ")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    inner = ", ".join(f"{c.split()[0]}: {c.split()[1]}" for c in schema.split(", "))
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{inner}>>")))


def _arc(position: Column, ring: list[tuple[int, int]]) -> Column:
    """Number of the first point at or behind a position: a grid cell gives the first candidate, its few points the rest."""
    cells = 1 << _GRID_BITS
    shift = RING_BITS - _GRID_BITS
    base, inner, i = [], [], 0
    for c in range(cells):
        base.append(i)
        here = []
        while i < len(ring) and ring[i][0] >> shift == c:
            here.append(ring[i][0])
            i += 1
        inner.append(here)
    cell = F.shiftright(position, shift).cast("int") + 1
    first = F.element_at(F.from_json(F.lit(json.dumps(base)), "array<int>"), cell)
    passed = F.size(F.filter(F.element_at(F.from_json(F.lit(json.dumps(inner)), "array<array<bigint>>"), cell), lambda p: p < position))
    return F.pmod(first + passed, F.lit(len(ring)))


def ring_shards(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 16, points: int = 64, slack: float = 0.0,
                seed: int = 7, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Per row: doc_id, size (UTF-8 bytes plus 1), CRC-32 of the text, shard, slot (0, 1, ... in each shard).

    With ``slack`` 0 the capacities add up to the number of rows, so that shard counts differ by at most one; a larger
    slack gives every shard ``ceil((1 + slack) * rows / shards)`` places and moves fewer keys. A key is the id; a row
    without one takes the hash of its text. Repeated keys share a ring position and are ordered by CRC and size; equal
    rows may swap slots. A null text has size 1 and CRC 0. Other columns are ignored. No rows, no result rows.
    """
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    key = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text:"), content))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), (F.octet_length(content) + 1).cast("bigint").alias("size"),
                       F.crc32(content.cast("binary")).alias("text_crc32"),
                       F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 64 - RING_BITS).alias("position"))
    n = rows.count()
    cell_bits = min(40, max(0, math.ceil(math.log2(max(1, n / rows_per_cell)))))
    ring = ring_points(shards, points, seed)
    rows = rows.withColumns({"arc": _arc(F.col("position"), ring), "cell": F.shiftright("position", RING_BITS - cell_bits)})
    cells = rows.groupBy("arc", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("low"))
    arcs = {r["arc"]: r["n"] for r in cells.groupBy("arc").agg(F.sum("n").alias("n")).collect()}  # shards x points rows
    if slack > 0:
        capacity = [math.ceil((1 + slack) * n / shards)] * shards
    else:
        capacity = [n // shards + (s < n % shards) for s in range(shards)]
    plan = _json_rows(spark, place(ring, arcs, capacity), "arc int, low bigint, high bigint, shard int, slot0 bigint")
    # the arc of the first point also holds the positions behind the last one: clockwise they come first
    behind = F.when((F.col("arc") == 0) & (F.col("low") > ring[0][0]), 0).otherwise(1)
    before = F.sum("n").over(W.partitionBy("arc").orderBy(behind, "cell").rowsBetween(W.unboundedPreceding, -1))
    offsets = cells.select("arc", "cell", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(W.partitionBy("arc", "cell").orderBy("position", "doc_id", "text_crc32", "size"))
    ranked = rows.withColumn("rank", rank.cast("bigint") - 1).join(offsets, ["arc", "cell"]).withColumn("rank", F.col("rank") + F.col("before"))
    found = ranked.join(F.broadcast(plan), (ranked["arc"] == plan["arc"]) & (ranked["rank"] >= plan["low"]) & (ranked["rank"] < plan["high"]))
    return found.select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("low") + F.col("slot0")).alias("slot"))
