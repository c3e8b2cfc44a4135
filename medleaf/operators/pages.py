"""Pages of a long listing without sorting it for each.

The listing is stored once, in ranges of its order, with a directory of how many rows each range has. A page is a run of
places, so that the directory says which ranges hold it; these alone are read and sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from medleaf.operators.lookups import PAGE


def store_listing(rows: DataFrame, folder: str, *order: str, ranges: int | None = None) -> None:
    """Stores a listing in the order of some columns, nulls last, which must leave no ties. `ranges`: how many, the session's
    shuffle partitions if not given.
    """
    by = [F.asc_nulls_last(c) for c in order]
    dealt = rows.repartitionByRange(*([ranges] if ranges else []), *by)
    # numbered as they are dealt, and read back: a task that is run again for another write might deal otherwise
    dealt = dealt.withColumn("__range", F.spark_partition_id())
    dealt.limit(0).write.mode("overwrite").parquet(f"{folder}/columns")
    dealt.write.mode("overwrite").partitionBy("__range").parquet(f"{folder}/rows")
    stored = rows.sparkSession.read.schema(dealt.schema).parquet(f"{folder}/rows")
    counts = stored.groupBy("__range").count().withColumnRenamed("count", "rows")
    before = F.sum("rows").over(W.orderBy("__range")) - F.col("rows")  # one row for each range
    counts.withColumn("before", before).coalesce(1).write.mode("overwrite").parquet(f"{folder}/directory")


def stored_page(spark: SparkSession, folder: str, order: list[str], size: int = PAGE, page: int | None = None) -> DataFrame:
    """A page of a stored listing; pages count from 0, a negative or missing one is the first."""
    if size < 0:
        raise ValueError("page size must not be negative")
    first = size * max(page or 0, 0)
    directory = spark.read.parquet(f"{folder}/directory").filter((F.col("before") < first + size) & (F.col("before") + F.col("rows") > first))
    held = sorted((r.before, r["__range"]) for r in directory.collect())  # no more than the page has rows
    rows = spark.read.schema(spark.read.parquet(f"{folder}/columns").schema).parquet(f"{folder}/rows")
    rows = rows.filter(F.col("__range").isin([k for _, k in held])) if held else rows.limit(0)
    offset = first - held[0][0] if held else 0
    return rows.drop("__range").orderBy(*[F.asc_nulls_last(c) for c in order]).offset(offset).limit(size)
