"""Import queries: manifests, archives, staging, gates and publication on the given tables. Tables that they publish go to
a database of their own for each run.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf import schemas
from medleaf.operators import products as product_ops
from medleaf.operators import publish, versions
from medleaf.plans.bindings import new_database, packages, products, shared_folder, table
from medleaf.sources import archive_source, archives
from medleaf.streaming import ingest


def manifest_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest with an archive of products for each nation's customers and one of labels for its suppliers."""
    customers = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n")).agg(F.count("*").alias("c"))
    suppliers = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n")).agg(F.count("*").alias("s"))
    nations = table(spark, sf_dir, "nation").join(customers, F.col("n_nationkey") == customers["n"], "left").join(suppliers, F.col("n_nationkey") == suppliers["n"], "left")

    def listed(count: str, ending: str):
        part = F.struct(F.col("n_nationkey"), F.struct(F.concat("n_name", F.lit(ending)).alias("file"), F.coalesce(F.col(count).cast("string"), F.lit("none")).alias("records")).alias("p"))
        parts = F.transform(F.array_sort(F.collect_list(part)), lambda x: x["p"])  # one for each nation
        return F.struct(F.sum(count).alias("total_records"), parts.alias("partitions"))

    drug = F.struct(listed("c", "-ndc.json.zip").alias("ndc"), listed("s", "-label.json.zip").alias("label"))
    path = f"{shared_folder(spark)}/manifest-{uuid.uuid4().hex}"
    nations.agg(F.to_json(F.struct(F.struct(drug.alias("drug")).alias("results"))).alias("value")).write.text(path)
    kinds = [archives.read_manifest(spark, path, kind).withColumn("kind", F.lit(kind)) for kind in ("ndc", "label")]
    return kinds[0].unionByName(kinds[1])


MANIFEST_PARTITIONS = """
WITH c AS (SELECT c_nationkey AS n, count(*) AS k FROM customer GROUP BY 1), s AS (SELECT s_nationkey AS n, count(*) AS k FROM supplier GROUP BY 1)
SELECT 'ndc' AS kind, n_name || '-ndc.json.zip' AS file, k AS records, (row_number() OVER (ORDER BY n_nationkey))::INTEGER AS partition_index, (SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey) AS total_records FROM nation LEFT JOIN c ON n = n_nationkey
UNION ALL
SELECT 'label', n_name || '-label.json.zip', k, (row_number() OVER (ORDER BY n_nationkey))::INTEGER, (SELECT count(*) FROM supplier JOIN nation ON s_nationkey = n_nationkey) FROM nation LEFT JOIN s ON n = n_nationkey
"""

ARCHIVE = 1000


def archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as records in zip archives in the shared folder, read as a manifest of them says; with what it says of their
    sizes.
    """
    folder = f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    files = _zipped(table(spark, sf_dir, "part"), _parts_as_records(), "p_partkey")
    written = archive_source.write_archives(files, folder)
    entry = F.struct(F.col("file"), F.col("records").cast("string").alias("records"))
    listed = written.agg(F.sum("records").alias("total_records"), F.array_sort(F.collect_list(entry)).alias("partitions"))  # one for each archive
    listed.select(F.to_json(F.struct(F.struct(F.struct(F.struct("total_records", "partitions").alias("ndc")).alias("drug")).alias("results"))).alias("value")).write.text(f"{folder}-manifest")
    manifest = archives.read_manifest(spark, f"{folder}-manifest", "ndc")
    records = archive_source.read_archives(spark, manifest, schemas.PRODUCT_RECORD, folder)
    sizes = archive_source.completeness(records, manifest).select(F.substring_index("file", "/", -1).alias("archive"), "expected", "found")
    return product_ops.products(records).select("archive", "pos", "product_id", "generic_name").join(sizes, "archive")


def archive_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A smoke run: 50 records of the first archive of a manifest; no other one is opened (one that is missing is no
    matter).
    """
    folder = f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    files = _zipped(table(spark, sf_dir, "part"), _parts_as_records(), "p_partkey")
    archive_source.write_archives(files, folder).count()
    manifest = spark.createDataFrame([("in/part-0.json.zip", 1), ("in/not there.json.zip", 2)], "file string, partition_index int")
    records = archive_source.read_archives(spark, manifest, schemas.PRODUCT_RECORD, folder, max_records=50, max_archives=1)
    return product_ops.products(records).select("archive", "pos", "product_id")


def _zipped(rows: DataFrame, record, order: str) -> DataFrame:
    """Zip archives (path, content) of ARCHIVE records each; every document has a `results` of another object before its own."""
    groups = rows.select(F.floor(F.col(order) / ARCHIVE).alias("g"), F.struct(order, record.alias("r")).alias("x"))
    texts = groups.groupBy("g").agg(F.array_sort(F.collect_list("x")).alias("x"))
    meta = F.struct(F.struct(F.struct(F.lit(0).alias("skip"), F.array(F.lit("results")).alias("results")).alias("results")).alias("inner"))
    texts = texts.select("g", F.to_json(F.struct(meta.alias("meta"), F.transform("x", lambda v: v["r"]).alias("results"))).alias("json"), F.size("x").cast("long").alias("records"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for g, text in zip(batch.column("g").to_pylist(), batch.column("json").to_pylist(), strict=True):
                raw = io.BytesIO()
                with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("read.me", "first")
                    archive.writestr(f"part-{g}.json", text)
                out.append((f"in/part-{g}.json.zip", raw.getvalue()))
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.string()), pa.array([c for _, c in out], pa.binary()), batch.column("records")], names=["path", "content", "records"])

    return texts.mapInArrow(pack, "path string, content binary, records long")


def _parts_as_records():
    key = F.col("p_partkey")
    return F.struct(F.concat(F.lit("P"), key.cast("string")).alias("product_id"), key.cast("string").alias("product_ndc"), F.col("p_name").alias("generic_name"), F.concat_ws(", ", "p_type", "p_brand").alias("dosage_form"))


def zipped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as records in zip archives, read back and normalised."""
    records = archives.unzipped(_zipped(table(spark, sf_dir, "part"), _parts_as_records(), "p_partkey"), schemas.PRODUCT_RECORD)
    return product_ops.products(records).select("archive", "pos", "product_id", "generic_name", "short_dosage_form")


_ZIPPED = f"""
SELECT 'part-' || (p_partkey // {ARCHIVE}) || '.json.zip' AS archive, (row_number() OVER (PARTITION BY p_partkey // {ARCHIVE} ORDER BY p_partkey) - 1)::INTEGER AS pos,
  'P' || p_partkey AS product_id, p_name AS generic_name, p_type AS short_dosage_form FROM part"""


def capped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A smoke run over the archives: the first 100 records of the first one."""
    records = archives.unzipped(_zipped(table(spark, sf_dir, "part"), _parts_as_records(), "p_partkey"), schemas.PRODUCT_RECORD)
    return product_ops.products(archives.capped(records, "part-0.json.zip", 100)).select("archive", "pos", "product_id")


def empty_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers, with terminology that cannot be read counted as empty."""
    kind = table(spark, sf_dir, "supplier").schema
    there = archives.or_empty(lambda: table(spark, sf_dir, "supplier"), spark, kind)
    missing = archives.or_empty(lambda: table(spark, sf_dir, "no_such_table"), spark, kind, allow_empty=True)
    return there.unionByName(missing).select("s_suppkey", "s_name")


def publish_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two imports after each other: the second is live, with its packages, and the first is the backup. A third that is too
    small for the gate changes nothing.
    """
    db, everything = f"{new_database(spark)}.", products(spark, sf_dir)
    some = everything.filter("cast(product_ndc AS long) % 2 = 0")
    lines = packages(spark, sf_dir)
    publish.publish_products(spark, some, lines.filter("size > 10"), some.count(), publish.import_id("2024-01-01"), db)
    publish.publish_products(spark, everything, lines, everything.count(), publish.import_id("2024-01-02"), db)
    try:
        publish.publish_products(spark, some, lines, everything.count(), publish.import_id("2024-01-03"), db)
    except publish.GateError:
        pass
    shown = [("product", "product_id"), ("product_old", "product_id"), ("package", "package_ndc"), ("package_old", "package_ndc")]
    rows = [spark.read.table(db + name).select(F.lit(name).alias("which"), F.col(key).alias("key")) for name, key in shown]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


PUBLISH_CYCLE = """
SELECT 'product' AS which, 'P' || p_partkey AS key FROM part UNION ALL SELECT 'product_old', 'P' || p_partkey FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT 'package', l_orderkey || '-' || l_linenumber FROM lineitem UNION ALL SELECT 'package_old', l_orderkey || '-' || l_linenumber FROM lineitem WHERE l_quantity::BIGINT > 10
"""


def publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products and packages published together, twice; then an import that fails between both tables, and one that its gate
    stops. What a reader sees that held on to the first version, and what one sees now.
    """
    root = f"{shared_folder(spark)}/versions-{uuid.uuid4().hex}"
    everything, lines = products(spark, sf_dir), packages(spark, sf_dir)
    keys, some = {"product": "product_id", "package": "package_ndc"}, everything.filter("cast(product_ndc AS long) % 2 = 0")
    first = versions.publish_together(spark, root, "r1", {"product": some, "package": lines.filter("size > 10")}, keys)
    second = versions.publish_together(spark, root, "r2", {"product": everything, "package": lines}, keys)
    total = second.counts["product"]
    failing = lines.withColumn("package_ndc", F.when(F.col("size") >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col("package_ndc")))
    for run, tables in (("r3", {"product": some, "package": failing}), ("r4", {"product": some, "package": lines})):
        try:
            versions.publish_together(spark, root, run, tables, keys, {"product": lambda n: run == "r3" or publish.product_gate(n, total)[0]})
        except (publish.GateError, PySparkException):
            pass
    shown = [(held, name, versions.read_version(spark, root, name, version)) for held, version in (("first", first), ("now", None)) for name in keys]
    rows = [df.select(F.lit(held).alias("held"), F.lit(name).alias("which"), F.col(keys[name]).alias("key")) for held, name, df in shown]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


PUBLISH_VERSIONS = """
SELECT 'now' AS held, 'product' AS which, 'P' || p_partkey AS key FROM part UNION ALL SELECT 'first', 'product', 'P' || p_partkey FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT 'now', 'package', l_orderkey || '-' || l_linenumber FROM lineitem UNION ALL SELECT 'first', 'package', l_orderkey || '-' || l_linenumber FROM lineitem WHERE l_quantity::BIGINT > 10
"""


def insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders inserted by customer in two goes, customers that are there already skipped."""
    name = f"{new_database(spark)}.first_order"
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    orders.limit(0).write.saveAsTable(name)
    publish.append_new(orders.filter("o_orderkey % 3 = 1"), name, "o_custkey", "o_orderkey")
    publish.append_new(orders, name, "o_custkey", "o_orderkey")
    return spark.read.table(name)


INSERT_NEW = "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 3 = 1 THEN 0 ELSE 1 END, o_orderkey) = 1"


def publish_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that takes the place of another without a backup; a test run after it is not published."""
    name, regions = f"{new_database(spark)}.evidence", table(spark, sf_dir, "nation")
    for run, rows, test in (("a", regions.limit(0), False), ("b", regions.filter("n_regionkey < 3"), False), ("c", regions, True)):
        publish.stage(rows, name, run)
        publish.publish_by_replacement(spark, name, run, test=test)
    return spark.read.table(name).select("n_nationkey", "n_name", F.lit(spark.catalog.tableExists(f"{name}_old")).alias("backup"))


def added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table that gets a column, once; its rows have none in it, rows that come later do."""
    name, suppliers = f"{new_database(spark)}.supplier", table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    suppliers.filter("s_suppkey % 2 = 0").write.saveAsTable(name)
    added = [publish.add_column(spark, name, "rxnorm_id", "string") for _ in range(2)]
    spark.catalog.refreshTable(name)
    publish.append_new(suppliers.withColumn("rxnorm_id", F.concat(F.lit("rx-"), "s_suppkey")), name, "s_suppkey", "s_suppkey")
    return spark.read.table(name).withColumn("added", F.lit(",".join(str(a).lower() for a in added)))


ADDED_COLUMN = "SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 1 THEN 'rx-' || s_suppkey END AS rxnorm_id, 'true,false' AS added FROM supplier"


def laid_out_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages bucketed by product code, joined with products that are bucketed alike: no shuffle of either."""
    db = new_database(spark)
    publish.laid_out(packages(spark, sf_dir).select("product_ndc", "package_ndc"), f"{db}.package", "product_ndc", 16)
    publish.laid_out(products(spark, sf_dir).select("product_ndc", "generic_name"), f"{db}.product", "product_ndc", 16)
    return spark.read.table(f"{db}.package").join(spark.read.table(f"{db}.product").hint("merge"), "product_ndc")


LAID_OUT = "SELECT l_partkey::VARCHAR AS product_ndc, l_orderkey || '-' || l_linenumber AS package_ndc, p_name AS generic_name FROM lineitem JOIN part ON l_partkey = p_partkey"


def ingest_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as records that land in two goes, normalised as they come; the second go repeats some. Published after the gate."""
    base, name = f"{shared_folder(spark)}/ingest-{uuid.uuid4().hex}", f"{new_database(spark)}.product"
    parts, staged = table(spark, sf_dir, "part"), 0
    for go in (parts.filter("p_partkey % 3 <> 0"), parts.filter("p_partkey % 3 <> 1")):
        groups = go.select(F.floor(F.col("p_partkey") / ARCHIVE).alias("g"), F.struct("p_partkey", _parts_as_records().alias("r")).alias("x")).groupBy("g").agg(F.array_sort(F.collect_list("x")).alias("x"))
        groups.select(F.to_json(F.struct(F.transform("x", lambda v: v["r"]).alias("results"))).alias("value")).write.mode("append").option("maxRecordsPerFile", 1).text(f"{base}/in")
        staged = ingest.ingest(ingest.landed_records(spark, f"{base}/in", schemas.PRODUCT_RECORD), product_ops.products, name, "run", "product_id", f"{base}/state")
    ingest.finish(spark, name, "run", "product_id", staged, parts.count())
    return spark.read.table(name).select("product_id", "product_ndc", "generic_name", "short_dosage_form")


def ingest_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as records with packaging, in zip archives that land in two goes, products and packages from one reading of
    each; then both published together.
    """
    base, parts = f"{shared_folder(spark)}/ingest-{uuid.uuid4().hex}", table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    pack = lambda n: F.struct(F.concat_ws("-", key, F.lit(n)).alias("package_ndc"), F.format_string(f"%s TABLET in {n} BOX (1-2-3)", F.col("p_size").cast("string")).alias("description"))
    record = F.struct(F.concat(F.lit("P"), key).alias("product_id"), key.alias("product_ndc"), F.col("p_name").alias("generic_name"), F.lit("TABLET").alias("dosage_form"), F.array(pack("1"), pack("2")).alias("packaging"))
    sinks = {"product": product_ops.products, "package": product_ops.packages}
    for k, go in enumerate((parts.filter("p_partkey % 3 <> 0"), parts.filter("p_partkey % 3 <> 1"))):
        archive_source.write_archives(_zipped(go, record, "p_partkey").withColumn("path", F.concat(F.lit(f"{k}-"), F.substring_index("path", "/", -1))), f"{base}/in").count()
        ingest.ingest_together(ingest.landed_archives(spark, f"{base}/in", schemas.PRODUCT_RECORD), sinks, f"{base}/staged", f"{base}/state")
    keys = {"product": "product_id", "package": "package_ndc"}
    tables = {name: ingest.ingested(spark, f"{base}/staged", name, k) for name, k in keys.items()}
    expected = parts.count()
    versions.publish_together(spark, f"{base}/live", "r1", tables, keys, {"product": lambda n: publish.product_gate(n, expected)[0]})
    live = {name: versions.read_version(spark, f"{base}/live", name) for name in keys}
    return live["product"].select("product_id", "product_ndc", "generic_name").join(live["package"].select("product_ndc", "package_ndc", "packages_number", "package_format"), "product_ndc")


CYCLE_QUERIES = {
    "manifest_partitions": (manifest_partitions, MANIFEST_PARTITIONS),
    "zipped_records": (zipped_records, _ZIPPED),
    "capped_records": (capped_records, f"SELECT archive, pos, product_id FROM ({_ZIPPED}) WHERE archive = 'part-0.json.zip' AND pos < 100"),
    "archive_scan": (archive_scan, f"SELECT archive, pos::BIGINT AS pos, product_id, generic_name, count(*) OVER (PARTITION BY archive) AS expected, count(*) OVER (PARTITION BY archive) AS found FROM ({_ZIPPED})"),
    "archive_caps": (archive_caps, f"SELECT archive, pos::BIGINT AS pos, product_id FROM ({_ZIPPED}) WHERE archive = 'part-0.json.zip' AND pos < 50"),
    "empty_fallback": (empty_fallback, "SELECT s_suppkey, s_name FROM supplier"),
    "publish_cycle": (publish_cycle, PUBLISH_CYCLE),
    "publish_versions": (publish_versions, PUBLISH_VERSIONS),
    "insert_new": (insert_new, INSERT_NEW),
    "publish_replacement": (publish_replacement, "SELECT n_nationkey, n_name, false AS backup FROM nation WHERE n_regionkey < 3"),
    "added_column": (added_column, ADDED_COLUMN),
    "laid_out_packages": (laid_out_packages, LAID_OUT),
    "ingest_archives": (
        ingest_archives,
        """SELECT 'P' || p_partkey AS product_id, p_partkey::VARCHAR AS product_ndc, p_name AS generic_name, CASE WHEN length(p_partkey || '-' || n) < 12 THEN p_partkey || '-' || p_partkey || '-' || n ELSE p_partkey || '-' || n END AS package_ndc,
        n::BIGINT AS packages_number, 'BOX' AS package_format FROM part, (VALUES (1), (2)) AS ns(n)""",
    ),
    "ingest_parts": (ingest_parts, "SELECT 'P' || p_partkey AS product_id, p_partkey::VARCHAR AS product_ndc, p_name AS generic_name, p_type AS short_dosage_form FROM part"),
}
