"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns `vnodes` points of a ring. A row's key is hashed to the ring and belongs to the next point clockwise.
A shard holds at most its capacity; what exceeds it continues clockwise to the next point whose shard has room.

Only counts decide who overflows, so rows never meet in one task:

1. rows are counted by ring cell (a fine, equal slice of the ring; points lie on cell borders),
2. cell counts are summed to arcs (`shards * vnodes` of them, a fixed number) and the overflow is settled on those,
3. a row's rank within its arc is its cell's offset plus its rank within the cell, and the rank gives shard and slot.

With `load_factor=1` capacities are the floor or ceiling of rows / shards, so the row counts of any two shards differ by
one at most (law `rows`). With a larger factor, shards hold up to that many times the mean and fewer keys move when the
number of shards changes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from medleaf.llm.common import table

RING_BITS = 62


def ring_points(shards: int, vnodes: int, bits: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise; points that fall into one cell keep the order of their shards."""
    points = []
    for shard in range(shards):
        for v in range(vnodes):
            digest = hashlib.blake2b(f"{shard}/{v}".encode(), digest_size=8).digest()
            points.append((int.from_bytes(digest, "big") >> (64 - bits), shard))
    return sorted(points)


def arc_table(points: list[int], bits: int) -> Iterator[tuple[int, int, bool]]:
    """(cell, arc, wrapped) of every cell of the coarse ring: its arc is that of the first point at or after it."""
    arc = 0
    for cell in range(1 << bits):
        while arc < len(points) and points[arc] < cell:
            arc += 1
        yield (cell, arc, False) if arc < len(points) else (cell, 0, True)


def settle(arcs: list[int], owners: list[int], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Segments (arc, first rank, end rank, shard, first slot): who takes which ranks of which arc.

    First every shard takes of its own arcs, in ring order; what is left moves one point clockwise at a time, and full
    shards let it pass. Works on the fixed number of arcs, never on rows.
    """
    room, used, out = list(capacity), [0] * len(capacity), []
    waiting = [(arc, 0, n, arc) for arc, n in enumerate(arcs) if n]
    while waiting:
        passed = []
        for arc, lo, hi, at in waiting:
            shard = owners[at % len(owners)]
            take = min(room[shard], hi - lo)
            if take:
                out.append((arc, lo, lo + take, shard, used[shard]))
                room[shard] -= take
                used[shard] += take
            if lo + take < hi:
                passed.append((arc, lo + take, hi, at + 1))
        waiting = passed
    return out


def assign_shards(df: DataFrame, key: Column, shards: int, vnodes: int = 64, load_factor: float = 1.0, order: tuple[str, ...] = ()) -> DataFrame:
    """Adds `shard` and `slot` (gapless from 0 in its shard) to every row.

    key decides the ring position; `order` names columns that break ties between equal keys. Null keys are keys like any
    other. Rows that are alike in key and order may swap slots between runs, which changes no content. An empty table
    gives an empty table; keys may be of any length, as only their hashes are used. Columns named shard or slot are
    replaced, others may have any names but __pos, __cell, __arc, __rank, __offset, __of, __lo, __hi, __shard, __first.
    """
    if shards < 1 or vnodes < 1 or load_factor < 1:
        raise ValueError("shards and vnodes must be at least 1, load_factor at least 1.0")
    spark = df.sparkSession
    rows = df.count()
    arcs_n = shards * vnodes
    coarse = math.ceil(math.log2(arcs_n)) + 2  # points lie on the borders of 2**coarse cells
    bits = min(40, max(coarse, math.ceil(math.log2(max(rows, 1) / 1000 + 1))))
    points = ring_points(shards, vnodes, coarse)
    arc_of = spark.createDataFrame(list(arc_table([c for c, _ in points], coarse)), "big_cell long, arc int, wrapped boolean")
    hashed = df.drop("shard", "slot").withColumn("__pos", F.xxhash64(key, F.lit(7)).bitwiseAND(F.lit((1 << RING_BITS) - 1)))
    hashed = hashed.withColumn("__cell", F.shiftright("__pos", RING_BITS - bits))
    cells = hashed.groupBy("__cell").agg(F.count("*").alias("__n"))
    cells = cells.join(F.broadcast(arc_of), F.shiftright("__cell", bits - coarse) == F.col("big_cell"))
    # the stretch of arc 0 behind the last point comes before its other cells
    ahead = W.partitionBy("arc").orderBy(F.col("wrapped").desc(), "__cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select("__cell", F.col("arc").alias("__arc"), "__n", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__offset"))
    counts = [0] * arcs_n
    for arc, n in cells.groupBy("__arc").agg(F.sum("__n")).collect():  # as many rows as there are virtual nodes
        counts[arc] = n
    whole = math.ceil(rows * load_factor)
    capacity = [whole // shards + (k < whole % shards) for k in range(shards)]
    segments = spark.createDataFrame(settle(counts, [s for _, s in points], capacity), "__of int, __lo long, __hi long, __shard int, __first long")
    in_cell = W.partitionBy("__cell").orderBy("__pos", *order)
    ranked = hashed.withColumn("__rank", F.row_number().over(in_cell) - 1).join(cells.select("__cell", "__arc", "__offset"), "__cell")
    ranked = ranked.withColumn("__rank", F.col("__rank") + F.col("__offset"))
    placed = ranked.join(F.broadcast(segments), (ranked["__arc"] == segments["__of"]) & (ranked["__rank"] >= segments["__lo"]) & (ranked["__rank"] < segments["__hi"]))
    return placed.select(*[c for c in df.columns if c not in ("shard", "slot")], F.col("__shard").alias("shard"), (F.col("__rank") - F.col("__lo") + F.col("__first")).alias("slot"))


def op7_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards whose row counts are at most one apart."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )
    out = assign_shards(docs, F.col("doc_id"), shards=40, order=("doc_id", "text_crc32"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
