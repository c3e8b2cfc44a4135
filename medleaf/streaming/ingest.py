"""Incremental import: records are normalised as their archives land, and published after the gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medleaf.operators import products as P
from medleaf.operators import publish
from medleaf.sources import archives


#: What the source of whole files gives.
FILES = "path string, modificationTime timestamp, length long, content binary"


def landed_records(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A stream of (archive, pos, record) from JSON documents {"results": [...]} that land in a folder."""
    whole = T.StructType([T.StructField("results", T.ArrayType(schema))])
    return spark.readStream.schema(whole).option("multiLine", True).json(folder).select(F.col("_metadata.file_name").alias("archive"), F.posexplode("results").alias("pos", "record"))


def landed_archives(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A stream of (archive, pos, record) from zip archives that land in a folder, each holding one such document. An archive
    is held by one task; maxFilesPerTrigger of the source bounds a batch.
    """
    return archives.unzipped(spark.readStream.format("binaryFile").schema(FILES).load(folder).select("path", "content"), schema)


def ingest_together(records: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame]], folder: str, checkpoint: str) -> None:
    """Reads a stream of records once, until all that has landed is read, and feeds several tables from it: `sinks` says how
    each is made of records (archive, pos, record), keeping archive and pos.

    Each batch has a folder of its own in each table, which it overwrites when it is tried again, and an entry in a ledger,
    written last; only batches in the ledger count. So a batch that fails between two tables adds nothing, and nothing
    twice when it is tried again.
    """

    def add(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # unzipped once for all tables
        try:
            for name, made in sinks.items():
                made(batch).write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
            batch.sparkSession.range(1).select(F.current_timestamp().alias("at")).write.mode("overwrite").parquet(f"{folder}/ledger/batch={number}")
        finally:
            batch.unpersist()

    records.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingested(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """The rows of a table that ingest_together has fed. Of rows that share a key, those of the first batch stand; within
    it, the last in the order of archive and position.
    """
    done = spark.read.parquet(f"{folder}/ledger").select("batch").distinct()
    rows = spark.read.parquet(f"{folder}/{name}").join(done, "batch", "left_semi").filter(F.col(key).isNotNull())
    first = W.partitionBy(key).orderBy("batch", F.desc("archive"), F.desc("pos"))
    return rows.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n", "batch", "archive", "pos")


def ingest(records: DataFrame, normal: Callable[[DataFrame], DataFrame], table: str, run: str, key: str, checkpoint: str) -> int:
    """Appends what is new to the staged copy of a table, batch by batch, until all that has landed is read. Gives the
    number of staged rows.

    A batch that is tried again adds nothing twice: rows whose key is staged already are skipped. Staged rows are those of
    the first batch that has their key; within a batch, the last in the order of archive and position stands.
    """
    spark, name = records.sparkSession, publish.staged_name(table, run)

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = P.last_per_key(normal(batch), key, "archive", "pos").drop("archive", "pos")
        if spark.catalog.tableExists(name):
            publish.append_new(rows, name, key)
        else:
            rows.write.saveAsTable(name)

    query = records.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if not spark.catalog.tableExists(name):
        return 0
    spark.catalog.refreshTable(name)  # batches run in a session of their own
    return spark.read.table(name).count()


def finish(spark: SparkSession, table: str, run: str, key: str, staged: int, expected: int) -> None:
    """Publishes the staged copy if it passes the gate."""
    publish.checked(spark, table, key, publish.product_gate(staged, expected)[0])
    publish.publish_with_backup(spark, table, run)
