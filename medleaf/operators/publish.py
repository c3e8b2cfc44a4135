"""Staging, gates and publication of tables in the session's catalog."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed values.
LEAST_SHARE, LEAST_EVIDENCE, ID_LENGTH = 0.95, 100, 32
#: Rows of evidence for each range of its bridges.
RANGE_ROWS = 1_000_000


class GateError(RuntimeError):
    """A staged table is not complete enough to be published."""


def import_id(raw: str | None = None) -> str:
    """Letters and digits of a given id, 32 at most; today's UTC date if none are left."""
    kept = "".join(c for c in raw or "" if c.isalnum())[:ID_LENGTH]
    return kept or datetime.datetime.now(datetime.UTC).strftime("%Y%m%d")


def staged_name(table: str, run: str) -> str:
    return f"{table}_{run}"


def stage(df: DataFrame, table: str, run: str) -> str:
    """Writes df as the staged copy of a table, replacing a leftover of the same run. Gives its name."""
    name = staged_name(table, run)
    df.write.mode("overwrite").saveAsTable(name)
    return name


def counted(df: DataFrame, key: str) -> tuple[DataFrame, Observation]:
    """df, and what gives the number of its rows with a key once it has been written: no job of its own counts them."""
    seen = Observation(f"counted-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(key).alias("n")), seen


def stage_counted(df: DataFrame, table: str, run: str, key: str) -> tuple[str, int]:
    """Stages a table; gives its name and the number of rows with a key."""
    rows, seen = counted(df, key)
    return stage(rows, table, run), seen.get["n"]


def append_new(df: DataFrame, table: str, key: str, *order: str) -> None:
    """Appends the rows whose key the table does not have; of rows that share a key, the first in the given order stands
    (in the order of all columns if none is given).
    """
    there = df.sparkSession.read.table(table)
    first = W.partitionBy(key).orderBy(*[F.asc_nulls_last(c) for c in order or df.columns])
    rows = df.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")
    rows.join(there.select(key), key, "left_anti").select(*there.columns).write.mode("append").saveAsTable(table)


def product_gate(staged: int, expected: int, share: float = LEAST_SHARE) -> tuple[bool, bool]:
    """(publish, warn): at least the share of the expected rows, and not none; warn if the count merely differs."""
    good = staged > 0 and staged >= int(expected * share)
    return good, good and staged != expected


def label_gate(staged: int, expected: int | None) -> bool:
    return bool(expected) and staged == expected


def evidence_gate(staged: int, least: int = LEAST_EVIDENCE, allow_empty: bool = False) -> bool:
    return allow_empty or staged >= least


def gate(staged: DataFrame, key: str, expected: int, share: float = LEAST_SHARE) -> DataFrame:
    """(staged, expected, publish, warn) of a staged table of products, as a row."""
    counted = F.count(key)
    good = (counted > 0) & (counted >= F.floor(F.lit(expected) * F.lit(share)))
    return staged.agg(counted.alias("staged"), F.lit(expected).cast("long").alias("expected"), good.alias("publish"), (good & (counted != expected)).alias("warn"))


def gate_labels(staged: DataFrame, key: str, expected: int | None) -> DataFrame:
    """The same for labels: no row may be missing, none too many, and the expected count must be known."""
    counted = F.count(key)
    good = (counted == F.lit(expected)) & F.lit(bool(expected))
    return staged.agg(counted.alias("staged"), F.lit(expected).cast("long").alias("expected"), F.coalesce(good, F.lit(False)).alias("publish"), F.lit(False).alias("warn"))


def gate_evidence(staged: DataFrame, key: str, least: int = LEAST_EVIDENCE, allow_empty: bool = False) -> DataFrame:
    """The same for evidence: a least count, unless an empty table is allowed."""
    counted = F.count(key)
    return staged.agg(counted.alias("staged"), F.lit(least).cast("long").alias("expected"), ((counted >= least) | F.lit(allow_empty)).alias("publish"), F.lit(False).alias("warn"))


def checked(spark: SparkSession, table: str, key: str, good: bool) -> None:
    if not good:
        raise GateError(f"{table}: not enough rows with {key}")


def publish_with_backup(spark: SparkSession, table: str, run: str) -> None:
    """The live table becomes the backup and the staged one live. Two renames, the last steps of an import."""
    spark.sql(f"DROP TABLE IF EXISTS {table}_old")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}_old")
    spark.sql(f"ALTER TABLE {staged_name(table, run)} RENAME TO {table}")


def publish_by_replacement(spark: SparkSession, table: str, run: str, test: bool = False, force: bool = False) -> bool:
    """The staged table becomes live, without a backup; in a test only if forced. Gives whether it was published."""
    if test and not force:
        return False
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {staged_name(table, run)} RENAME TO {table}")
    return True


def publish_products(spark: SparkSession, products: DataFrame, packages: DataFrame, expected: int, run: str, prefix: str = "") -> None:
    """Stages both tables, gates on the products, then publishes both; prefix may name a database (`db.`)."""
    name, count = stage_counted(products, f"{prefix}product", run, "product_id")
    stage(packages, f"{prefix}package", run)
    checked(spark, name, "product_id", product_gate(count, expected)[0])
    publish_with_backup(spark, f"{prefix}product", run)
    publish_with_backup(spark, f"{prefix}package", run)


def add_column(spark: SparkSession, table: str, column: str, kind: str) -> bool:
    """Adds a column if the table lacks it; gives whether it did."""
    if column in spark.read.table(table).columns:
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{column}` {kind})")
    return True


def without_column(df: DataFrame, column: str) -> DataFrame:
    return df.drop(column)


def product_bridge(products: DataFrame) -> DataFrame:
    """(rxcui, product_ndc): what takes the place of an index on the ids; write it bucketed or sorted by rxcui."""
    return products.select(F.explode("rxnorm_ids").alias("rxcui"), "product_ndc").distinct()


def label_bridge(labels: DataFrame) -> DataFrame:
    """(product_ndc, label_id)."""
    return labels.select(F.explode("product_ndc").alias("product_ndc"), F.col("id").alias("label_id")).distinct()


def laid_out(df: DataFrame, table: str, key: str, buckets: int = 64) -> None:
    """Writes a table bucketed and sorted by the key that lookups and joins use."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def sorted_by(df: DataFrame, table: str, *columns: str, least: int = 0) -> None:
    """Writes a table in ranges of some columns, so that a lookup reads the files and row groups that may hold its key. Unlike
    a bucket, a range that ends in a column of distinct values splits a key that many rows have. There are at least `least`
    ranges, where that is more than the session's number of shuffle partitions.
    """
    more = [least] if least > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    df.repartitionByRange(*more, *columns).sortWithinPartitions(*columns).write.mode("overwrite").saveAsTable(table)


def store_evidence(spark: SparkSession, evidence: DataFrame, run: str, prefix: str = "", least: int = LEAST_EVIDENCE, allow_empty: bool = False) -> None:
    """Derives evidence once: stages it bucketed by its id, gates it, and publishes it with its bridges evidence_rxnorm
    (rxnorm_id, evidence_id) and evidence_product (product_code, evidence_id).
    """
    from medleaf.operators.lookups import evidence_bridge

    name = f"{prefix}drug_condition_evidence"
    staged = staged_name(name, run)
    found, seen = counted(evidence, "evidence_id")
    laid_out(found, staged, "evidence_id")
    checked(spark, staged, "evidence_id", evidence_gate(seen.get["n"], least, allow_empty))
    rows = spark.read.table(staged)
    bridges = {f"{prefix}evidence_rxnorm": ("rxnorm_ids", "rxnorm_id"), f"{prefix}evidence_product": ("product_ndc", "product_code")}
    for bridge, (ids, key) in bridges.items():
        sorted_by(evidence_bridge(rows, ids, key), staged_name(bridge, run), key, "evidence_id", least=seen.get["n"] // RANGE_ROWS)
    for table in (*bridges, name):
        publish_by_replacement(spark, table, run)
