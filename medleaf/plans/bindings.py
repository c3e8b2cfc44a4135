"""The given tables in the shape that the operators read, and the same as SQL text for the comparison."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; the warehouse if that is unset and all is local."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = spark.conf.get("spark.sql.warehouse.dir")
    return path.rstrip("/")


def new_database(spark: SparkSession) -> str:
    """A database of its own for each run."""
    name = f"medleaf_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part: generic and brand names (own, other, none), RxNorm ids from brand and type."""
    key = F.col("p_partkey")
    brand = F.when(key % 3 == 0, F.upper("p_name")).when(key % 3 == 1, F.col("p_type"))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), key.cast("string")).alias("product_id"), key.cast("string").alias("product_ndc"), F.col("p_name").alias("generic_name"),
        brand.alias("brand_name"), F.col("p_type").alias("dosage_form"), F.col("p_type").alias("short_dosage_form"), F.col("p_brand").alias("labeler_name"),
        F.array("p_brand", "p_type").alias("rxnorm_ids"), F.concat(F.lit("L"), (key % 97).cast("string")).alias("spl_id"),
    )


PRODUCTS = """
product AS (SELECT 'P' || p_partkey AS product_id, p_partkey::VARCHAR AS product_ndc, p_name AS generic_name,
  CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_type END AS brand_name, p_type AS dosage_form,
  p_type AS short_dosage_form, p_brand AS labeler_name, [p_brand, p_type] AS rxnorm_ids, 'L' || (p_partkey % 97) AS spl_id FROM part)"""


def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: one package for each line."""
    code = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        code.alias("package_ndc"), F.col("l_partkey").cast("string").alias("product_ndc"), F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("description"),
        F.col("l_quantity").cast("long").alias("size"), F.col("l_linestatus").alias("size_extra"), F.col("l_linenumber").cast("long").alias("packages_number"),
        F.col("l_returnflag").alias("package_format"),
    )


PACKAGES = """
package AS (SELECT l_orderkey || '-' || l_linenumber AS package_ndc, l_partkey::VARCHAR AS product_ndc,
  l_returnflag || ' ' || l_linestatus AS description, l_quantity::BIGINT AS size, l_linestatus AS size_extra,
  l_linenumber::BIGINT AS packages_number, l_returnflag AS package_format FROM lineitem)"""


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: a run for each user, statuses from event types."""
    kind = F.col("event_type")
    status = F.when(kind == "click", "running").when(kind == "view", "finalizing").when(kind == "signup", "queued").when(kind == "purchase", "succeeded").otherwise("canceling")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"), F.col("event_id").alias("seq"), F.col("ts").alias("at"), status.alias("status"),
        kind.alias("phase"), F.when(kind.isin("click", "purchase"), F.col("props")).alias("metrics"), F.col("value"),
    )


EVENTS = """
ev AS (SELECT 'run-' || user_id AS run_id, event_id AS seq, ts AS happened, CASE event_type WHEN 'click' THEN 'running' WHEN 'view' THEN 'finalizing'
  WHEN 'signup' THEN 'queued' WHEN 'purchase' THEN 'succeeded' ELSE 'canceling' END AS status, event_type AS phase,
  CASE WHEN event_type IN ('click', 'purchase') THEN props END AS metrics, value FROM events)"""


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents: the text is what the label says, the source its product code."""
    key = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("L"), key).alias("id"), F.concat(F.lit("S"), key).alias("set_id"), F.array("source").alias("product_ndc"),
        F.array(F.concat_ws("-", F.col("source"), F.col("lang"))).alias("package_ndc"), F.col("text").alias("indications_and_usage"),
    )


def label_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product for each source, with two RxNorm ids."""
    return table(spark, sf_dir, "documents").select("source").distinct().select(
        F.concat(F.lit("P-"), F.col("source")).alias("product_id"), F.col("source").alias("product_ndc"),
        F.array(F.concat(F.lit("rx-"), F.col("source")), F.lit("rx-all")).alias("rxnorm_ids"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """benchmark: a condition for each item, called by its first two words."""
    words = F.split(F.col("text"), r"\s+")
    return table(spark, sf_dir, "benchmark").select(
        F.lit("BM").alias("code_system"), F.col("item_id").cast("string").alias("code"), F.lit("condition").alias("code_type"),
        F.concat_ws(" ", words[0], words[1]).alias("display_name"), F.lit("catalog").alias("source_attribution"),
    )


def synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split(F.col("text"), r"\s+")
    return table(spark, sf_dir, "benchmark").select(F.lit("BM").alias("code_system"), F.col("item_id").cast("string").alias("code"), F.concat(F.lit("  "), words[2], F.lit("  "), words[3]).alias("synonym"), F.lit("synonym").alias("term_type"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relationship of each item with every source's own id or with the id that all share."""
    item = F.col("item_id")
    kind = F.when(item % 5 == 4, "contraindicated").when(item % 2 == 0, "may_treat").otherwise("may_prevent")
    code = F.when(item % 4 == 0, F.lit("rx-all")).otherwise(F.concat(F.lit("rx-src"), (item % 20).cast("string")))
    return table(spark, sf_dir, "benchmark").select(
        F.lit("RXNORM").alias("from_system"), code.alias("from_code"), F.lit("BM").alias("to_system"), item.cast("string").alias("to_code"), kind.alias("relationship"),
        F.when(item % 3 == 0, F.lit("link")).alias("source_attribution"),
    )


EVIDENCE = r"""
lab AS (SELECT 'L' || doc_id AS id, 'S' || doc_id AS set_id, [source] AS product_ndc, source AS code, [source || '-' || lang] AS package_ndc, text FROM documents),
ids AS (SELECT id, unnest(['rx-' || code, 'rx-all']) AS rxcui FROM lab),
cat AS (SELECT item_id::VARCHAR AS code, regexp_split_to_array(text, '\s+') AS w FROM benchmark),
lnk AS (SELECT CASE WHEN item_id % 4 = 0 THEN 'rx-all' ELSE 'rx-src' || (item_id % 20) END AS rxcui, item_id::VARCHAR AS code,
  CASE WHEN item_id % 2 = 0 THEN 'may_treat' ELSE 'may_prevent' END AS relationship,
  CASE WHEN item_id % 3 = 0 THEN 'link' ELSE 'catalog' END AS source_attribution FROM benchmark WHERE item_id % 5 <> 4),
trm AS (SELECT code, term, max(confidence) AS confidence FROM (
  SELECT code, lower(w[1] || ' ' || w[2]) AS term, 0.9::DOUBLE AS confidence FROM cat UNION ALL SELECT code, lower(w[3] || ' ' || w[4]), 0.8::DOUBLE FROM cat)
  WHERE term <> '' GROUP BY code, term),
per AS (SELECT lab.*, ids.rxcui, lnk.code AS condition_code, relationship, source_attribution FROM lab JOIN ids USING (id) JOIN lnk USING (rxcui)),
rel AS (SELECT sha1(concat_ws('|', set_id, id, rxcui, 'BM', condition_code)) AS evidence_id, set_id, id AS label_id, rxcui, condition_code,
  format('RxNorm {} {} BM:{} via clinical terminology relationship.', rxcui, relationship, condition_code) AS evidence_text,
  'clinical_rxnorm_relationship' AS evidence_source, 0.85::DOUBLE AS confidence, source_attribution, code AS product_code FROM per),
cand AS (SELECT per.*, trm.term, trm.confidence AS conf, trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean FROM per JOIN trm ON trm.code = per.condition_code
  WHERE length(trm.term) >= 4 AND contains(lower(regexp_replace(text, '\s+', ' ', 'g')), trm.term)),
hit AS (SELECT *, strpos(lower(clean), term) - 1 AS pos FROM cand
  WHERE regexp_matches(' ' || lower(clean) || ' ', '[^a-z0-9]' || regexp_escape(term) || '[^a-z0-9]')),
tem AS (SELECT sha1(concat_ws('|', set_id, id, rxcui, 'BM', condition_code, term)) AS evidence_id, set_id, id AS label_id, rxcui, condition_code,
  CASE WHEN pos < 0 THEN clean[1:500] ELSE substring(clean, greatest(pos - 180, 0) + 1, least(pos + length(term) + 320, length(clean)) - greatest(pos - 180, 0)) END AS evidence_text,
  'clinical_synonym_label_match' AS evidence_source, conf AS confidence, source_attribution, code AS product_code FROM hit)"""
