"""Evidence queries: documents as labels, benchmark items as conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.operators import evidence as E
from medleaf.operators import lookups as L
from medleaf.operators import publish
from medleaf.plans.bindings import EVIDENCE, catalog, label_products, labels, links, new_database, synonyms
from medleaf.sources.archives import label_texts

AT = "2024-01-01 00:00:00"
_FLAT = "evidence_id, set_id, label_id, rxcui, 'BM' AS condition_system, condition_code, evidence_text, evidence_source, confidence, source_attribution"


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    rows = label_texts(labels(spark, sf_dir))
    ids = E.label_rxnorm(rows, E.rxnorm_by_product(label_products(spark, sf_dir)))
    return rows, ids, E.relationships(links(spark, sf_dir), catalog(spark, sf_dir)), E.terms(catalog(spark, sf_dir), synonyms(spark, sf_dir))


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select(
        "evidence_id", "set_id", "label_id", F.array_join("product_ndc", ",").alias("products"), F.array_join("package_ndc", ",").alias("packages"), F.array_join("rxnorm_ids", ",").alias("rxnorm"),
        "condition_system", "condition_code", "evidence_text", "evidence_source", "confidence", "source_attribution",
    )


def _sql(name: str) -> str:
    return f"""WITH {EVIDENCE} SELECT evidence_id, set_id, label_id, product_code AS products, product_code || '-' || lang AS packages,
  CASE WHEN 'rx-' || product_code < 'rx-all' THEN 'rx-' || product_code || ',rx-all' ELSE 'rx-all,rx-' || product_code END AS rxnorm, 'BM' AS condition_system, condition_code, evidence_text,
  evidence_source, confidence, source_attribution FROM {name} JOIN documents ON 'L' || doc_id = label_id"""


def relationship_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, ids, known, _ = _inputs(spark, sf_dir)
    return _flat(E.relationship_evidence(rows, ids, known, F.lit(AT)))


def term_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, ids, known, words = _inputs(spark, sf_dir)
    return _flat(E.term_evidence(rows, ids, known, words, F.lit(AT)))


def _of(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Evidence of some labels."""
    _, _, known, words = _inputs(spark, sf_dir)
    return E.evidence(rows, label_products(spark, sf_dir), known, words, F.lit(AT))


def evidence_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = label_texts(labels(spark, sf_dir))
    return E.summary(rows, _of(spark, sf_dir, rows))


def conditions_by_rxnorm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One id: evidence of the labels that have it is derived, not that of all."""
    rows, ids, _, _ = _inputs(spark, sf_dir)
    some = rows.join(ids.filter("rxcui = 'rx-src3'").select("id"), "id", "left_semi")
    return L.evidence_by_rxnorm(_of(spark, sf_dir, some), " rx-src3 ").select("evidence_id", "label_id", "condition_code")


def conditions_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = label_texts(labels(spark, sf_dir)).filter(F.array_contains("product_ndc", "src5"))
    return L.evidence_by_product(_of(spark, sf_dir, some), "src5", limit=9000).select("evidence_id", "label_id", "condition_code")


def conditions_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = label_texts(labels(spark, sf_dir)).filter("set_id = 'S7'")
    return L.evidence_by_label(_of(spark, sf_dir, some), "S7").select("evidence_id", "label_id", "condition_code", "confidence")


def conditions_by_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All evidence is stored once; then every RxNorm id of the labels is looked up (one is in all labels), and every product
    code.
    """
    db = f"{new_database(spark)}."
    rows, ids, _, _ = _inputs(spark, sf_dir)
    publish.store_evidence(spark, _of(spark, sf_dir, rows), "run", db, least=0)
    stored = spark.read.table(f"{db}drug_condition_evidence")
    by_id = L.evidence_by_rxnorm(stored, ids.select(F.concat(F.lit(" "), "rxcui").alias("rxnorm_id")), bridge=spark.read.table(f"{db}evidence_rxnorm"))
    codes = rows.select(F.explode("product_ndc").alias("product_code"))
    by_code = L.evidence_by_product(stored, codes, limit=9000, bridge=spark.read.table(f"{db}evidence_product"))
    shown = ["evidence_id", "label_id", "condition_code", "confidence"]
    return by_id.select(F.col("rxnorm_id").alias("key"), *shown).unionByName(by_code.select(F.col("product_code").alias("key"), *shown))


def clinical_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.terms(catalog(spark, sf_dir), synonyms(spark, sf_dir))


_BOTH = "(SELECT * FROM rel UNION ALL SELECT * FROM tem)"
EVIDENCE_QUERIES = {
    "relationship_evidence": (relationship_evidence, _sql("rel")),
    "term_evidence": (term_evidence, _sql("tem")),
    "evidence_summary": (evidence_summary, f"WITH {EVIDENCE} SELECT (SELECT count(*) FROM documents) AS labels_scanned, count(*) AS evidence_rows, count(*) AS matched_labels FROM {_BOTH}"),
    "conditions_by_rxnorm": (conditions_by_rxnorm, f"WITH {EVIDENCE} SELECT evidence_id, label_id, condition_code FROM {_BOTH} WHERE product_code = 'src3' ORDER BY evidence_id LIMIT 100"),
    "conditions_by_product": (conditions_by_product, f"WITH {EVIDENCE} SELECT evidence_id, label_id, condition_code FROM {_BOTH} WHERE product_code = 'src5' ORDER BY evidence_id LIMIT 500"),
    "conditions_by_label": (conditions_by_label, f"WITH {EVIDENCE} SELECT evidence_id, label_id, condition_code, confidence FROM {_BOTH} WHERE set_id = 'S7'"),
    "conditions_by_keys": (
        conditions_by_keys,
        f"""WITH {EVIDENCE}, both_kinds AS {_BOTH}, ids_of AS (SELECT *, unnest(['rx-' || product_code, 'rx-all']) AS key FROM both_kinds)
SELECT key, evidence_id, label_id, condition_code, confidence FROM (SELECT * FROM ids_of QUALIFY row_number() OVER (PARTITION BY key ORDER BY evidence_id) <= 100)
UNION ALL SELECT product_code, evidence_id, label_id, condition_code, confidence FROM (SELECT * FROM both_kinds QUALIFY row_number() OVER (PARTITION BY product_code ORDER BY evidence_id) <= 500)""",
    ),
    "clinical_terms": (clinical_terms, f"WITH {EVIDENCE} SELECT 'BM' AS condition_system, code AS condition_code, lower(w[1] || ' ' || w[2]) AS term, 'preferred' AS term_type FROM cat UNION ALL SELECT 'BM', code, lower(w[3] || ' ' || w[4]), 'synonym' FROM cat"),
}
