"""Count tables of fixed size, and connected components, for operators over pairs."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medleaf.llm.common import stored

BLOCK_BITS = 14


def tally(df: DataFrame, cells: Callable[[pa.RecordBatch], np.ndarray], bits: int, finish: Callable[[np.ndarray], np.ndarray], few: bool = False) -> np.ndarray:
    """Counts all rows into 2**bits cells and gives `finish` of the counts, a table of fixed size, to the driver.

    Every task counts into a table of its own and sends its blocks, compressed; blocks are added as they come, so that no
    task holds more than its share of one table. With few, a task counts up to 3 only, in a quarter of the memory.
    """
    kind_of = np.uint8 if few else np.uint32
    size = 1 << min(bits, BLOCK_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, kind_of)
        for batch in batches:
            at = cells(batch)
            if few:
                at, n = np.unique(at, return_counts=True)
                table[at] = np.minimum(3, table[at] + n)
            else:
                np.add.at(table, at, 1)
        blocks = table.reshape(-1, size)
        full = np.flatnonzero(blocks.any(axis=1))
        for some in np.array_split(full, max(1, len(full) // 64)):
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([zlib.compress(blocks[b].tobytes(), 1) for b in some], pa.binary())], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                one = np.frombuffer(zlib.decompress(data), kind_of).astype(np.uint32)
                sums[b] = sums[b] + one if b in sums else one
        for b, one in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([finish(one).tobytes()], pa.binary())], names=["block", "counts"])

    kind = finish(np.zeros(size, np.uint32))
    out = np.tile(kind, (1 << bits) // size).reshape((1 << bits) // size, len(kind))
    rows = df.mapInArrow(count, "block int, counts binary").repartition("block").mapInArrow(add, "block int, counts binary")
    for b, data in rows.collect():  # as many bytes as the table has, whatever the input
        out[b] = np.frombuffer(bytes(data), kind.dtype)
    return out.reshape(-1)


SALTS, HUB = 16, 256


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every node of edges (a, b): label is the smallest id that can be reached.

    Labels spread to neighbours and to the nodes that neighbours are labelled with, then labels of labels are taken, until
    nothing changes. A round's joins look labels up on unique ids and its aggregates are minima, so a hub with many edges
    is combined before it is shuffled. What more than HUB rows look up is there SALTS times, and they are dealt over it.
    Rounds are written to the shared folder. An empty table gives an empty table.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct()
    both = stored(both, "edges")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    hubs = stored(both.groupBy("b").count().filter(F.col("count") > HUB).select("b", F.lit(True).alias("hub")), "hubs")
    both = both.join(hubs, "b", "left").select("a", "b", _salt("hub", "a"))
    while True:
        seen = both.join(_salted(labels.withColumnRenamed("id", "b"), hubs, "b"), ["b", "salt"]).groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        seen = labels.join(seen, "id").withColumn("near", F.least("near", "label"))
        low = stored(seen.select("id", "near").union(seen.select("label", "near")).groupBy("id").agg(F.min("near").alias("low")), "low")
        used = stored(low.groupBy("low").agg((F.count("*") > HUB).alias("hub")), "used")
        crowded = used.filter("hub")
        hop = low.select(F.col("id").alias("low"), F.col("low").alias("lower")).join(used.select("low"), "low")
        new = low.join(crowded, "low", "left").withColumn("salt", _salt("hub", "id"))
        new = new.join(_salted(hop, crowded, "low"), ["low", "salt"], "left").select("id", F.coalesce("lower", "low").alias("new"))
        new = stored(new.join(labels, "id"), "labels")
        if new.filter("new <> label").isEmpty():
            return labels
        labels = new.select("id", F.col("new").alias("label"))


def _salt(hub: str, by: str) -> Column:
    return F.when(F.col(hub), F.pmod(F.hash(by), F.lit(SALTS))).otherwise(F.lit(0)).alias("salt")


def _salted(rows: DataFrame, hubs: DataFrame, key: str) -> DataFrame:
    """rows with salt 0, and those of hubs with the other salts too."""
    more = rows.join(hubs.select(key), key, "left_semi").select(*rows.columns, F.explode(F.array(*[F.lit(k) for k in range(1, SALTS)])).alias("salt"))
    return rows.withColumn("salt", F.lit(0)).union(more)
