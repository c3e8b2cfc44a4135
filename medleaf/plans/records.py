"""Normalisation, gates, serialisation and scans."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf import schemas
from medleaf.functions.codes import described, eleven_digits, falsy_to_null, full_package_code, over_the_counter, short_form
from medleaf.functions.dates import parsed_date
from medleaf.functions.text import redacted
from medleaf.operators import hygiene, publish
from medleaf.operators import labels as label_ops
from medleaf.operators import products as product_ops
from medleaf.operators.serialize import json_rows
from medleaf.plans.bindings import PRODUCTS, labels, products, shared_folder, table
from medleaf.sources import archives


def _dealt(rows: DataFrame, order: str) -> DataFrame:
    """rows with the number of their document (g), those of one on one task."""
    return rows.withColumn("g", F.floor(F.col(order) / 500)).repartition("g")


def _landed(rows: DataFrame, record, order: str) -> str:
    """Writes records as zipped JSON documents {"results": [...]} of 500 at most to the shared folder; gives the folder. Rows
    that are dealt by document already (_dealt) are not sent again.
    """
    path = f"{shared_folder(rows.sparkSession)}/landed-{uuid.uuid4().hex}"
    groups = (rows if "g" in rows.columns else _dealt(rows, order)).select("g", F.struct(order, record.alias("r")).alias("x"))
    texts = groups.groupBy("g").agg(F.array_sort(F.collect_list("x")).alias("x")).select(F.to_json(F.struct(F.transform("x", lambda v: v["r"]).alias("results"))).alias("value"))
    texts.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)  # the reader takes a file as one document
    return path


def import_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part written as source records, read back and normalised to products; of an id, the record with the
    largest ids stands.
    """
    key = F.col("p_partkey")
    openfda = F.when(key % 4 != 3, F.struct(F.array(key.cast("string"), F.col("p_size").cast("string")).alias("rxcui")))
    record = F.struct(
        F.col("p_brand").alias("product_ndc"), F.concat(F.lit("P"), F.floor(key / 2).cast("string")).alias("product_id"), F.col("p_name").alias("generic_name"),
        F.when(key % 5 == 0, F.lit("")).otherwise(F.col("p_type")).alias("brand_name"), F.concat_ws(", ", "p_type", "p_name").alias("dosage_form"),
        F.when(key % 3 == 0, F.lit("OTC Monograph")).alias("marketing_category"), F.when(key % 3 == 1, F.lit("HUMAN PRESCRIPTION DRUG")).alias("product_type"),
        (key % 2 == 0).alias("finished"), F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size")), "yyyyMMdd").alias("marketing_start_date"), openfda.alias("openfda"),
    )
    path = _landed(table(spark, sf_dir, "part"), record, "p_partkey")
    rows = product_ops.products(archives.read_records(spark, path, schemas.PRODUCT_RECORD)).withColumn("ids", F.array_join("rxnorm_ids", ","))
    rows = product_ops.last_per_key(rows, "product_id", "ids")
    started = F.date_format("marketing_start_date", "yyyy-MM-dd").alias("started")
    return rows.select("product_id", "product_ndc", "generic_name", "brand_name", "finished", "is_otc", "short_dosage_form", started, "ids")


IMPORT_PRODUCTS = """
SELECT 'P' || (p_partkey // 2) AS product_id, p_brand AS product_ndc, p_name AS generic_name, CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS brand_name,
  CASE WHEN p_partkey % 2 = 0 THEN true END AS finished, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_otc, p_type AS short_dosage_form,
  strftime(DATE '2020-01-01' + p_size, '%Y-%m-%d') AS started, CASE WHEN p_partkey % 4 = 3 THEN '' ELSE p_partkey || ',' || p_size END AS ids
FROM part QUALIFY row_number() OVER (PARTITION BY p_partkey // 2 ORDER BY CASE WHEN p_partkey % 4 = 3 THEN '' ELSE p_partkey || ',' || p_size END DESC) = 1
"""


def import_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders' lines written as packaging of source records, read back and normalised to packages."""
    line = F.struct(
        F.concat_ws("-", F.format_string("%05d", "l_orderkey"), F.format_string("%04d", "l_partkey"), F.format_string("%02d", "l_linenumber")).alias("package_ndc"),
        F.format_string("%d TABLET in %d BOTTLE (1-2-%d)", F.col("l_quantity").cast("int"), "l_linenumber", "l_suppkey").alias("description"), (F.col("l_tax") > 0).alias("sample"),
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax")
    rows = _dealt(lines, "l_orderkey").groupBy("g", "l_orderkey").agg(F.collect_list(line).alias("packaging"))
    record = F.struct(F.col("l_orderkey").cast("string").alias("product_ndc"), F.when(F.col("l_orderkey") % 2 == 0, "TABLET").otherwise("CAPSULE").alias("dosage_form"), "packaging")
    path = _landed(rows, record, "l_orderkey")
    out = product_ops.packages(archives.read_records(spark, path, schemas.PRODUCT_RECORD))
    out = product_ops.last_per_key(out, "package_ndc", "size", "size_extra", "packages_number", "description", "sample")
    return out.select("package_ndc", "ndc11", "product_ndc", "size", "size_extra", "packages_number", "package_format", "description")


IMPORT_PACKAGES = """
WITH l AS (SELECT printf('%05d-%04d-%02d', l_orderkey, l_partkey, l_linenumber) AS package_ndc, printf('%05d%04d%02d', l_orderkey, l_partkey, l_linenumber) AS plain,
    l_orderkey::VARCHAR AS product_ndc, l_quantity::INTEGER::BIGINT AS size, CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE 'TABLET' END AS size_extra, l_linenumber::BIGINT AS packages_number,
    'BOTTLE' AS package_format, printf('%d TABLET in %d BOTTLE (1-2-%d)', l_quantity::INTEGER, l_linenumber, l_suppkey) AS description, l_tax > 0 AS sample, l_orderkey, l_partkey FROM lineitem)
SELECT package_ndc, CASE WHEN length(plain) <> 11 AND length(printf('%05d', l_orderkey)) = 4 THEN '0' || plain ELSE plain END AS ndc11, product_ndc, size, size_extra, packages_number, package_format, description FROM l
QUALIFY row_number() OVER (PARTITION BY package_ndc ORDER BY size DESC, description DESC) = 1
"""


def import_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents written as label records, read back and normalised."""
    registry = F.when(F.col("doc_id") % 3 != 0, F.struct(F.array("source").alias("product_ndc")))
    record = F.struct(
        F.concat(F.lit("L"), F.col("doc_id").cast("string")).alias("id"), F.col("source").alias("set_id"), F.lit("").alias("version"),
        F.array(F.lit("  "), F.col("lang"), F.col("source"), F.lit("")).alias("warnings"),
        F.array(F.lit(" "), F.col("text")).alias("indications_and_usage"), F.when(F.col("doc_id") % 2 == 0, F.array().cast("array<string>")).alias("purpose"), registry.alias("openfda"),
    )
    path = _landed(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"), record, "doc_id")
    rows = label_ops.last_labels(label_ops.labels(archives.read_records(spark, path, schemas.LABEL_RECORD)))
    said = F.coalesce("indications_and_usage", F.lit(""))
    return rows.select("id", "set_id", "version", "warnings", "purpose", F.length(said).alias("said"), F.sha2(said, 256).alias("said_hash"), F.array_join("product_ndc", ",").alias("product_codes"), F.size("package_ndc").alias("package_codes"))


_WHITE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
IMPORT_LABELS = rf"""
WITH d AS (SELECT *, regexp_replace(coalesce(text, ''), '^{_WHITE}|{_WHITE}$', '', 'g') AS said FROM documents)
SELECT 'L' || doc_id AS id, source AS set_id, NULL::VARCHAR AS version, lang || chr(10) || source AS warnings, CASE WHEN doc_id % 2 = 0 THEN '' END AS purpose,
  length(said)::INTEGER AS said, sha256(said) AS said_hash, CASE WHEN doc_id % 3 <> 0 THEN source ELSE '' END AS product_codes, 0::INTEGER AS package_codes FROM d
"""


def package_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Package codes in five shapes."""
    key, n = F.col("p_partkey"), F.col("p_partkey").cast("int")
    shape = lambda f, *c: F.format_string(f, *c)
    code = (
        F.when(key % 5 == 0, shape("%04d-%04d-%02d", n % 9000, n % 7000, n % 90)).when(key % 5 == 1, shape("%05d-%03d-%02d", n % 90000, n % 900, n % 90))
        .when(key % 5 == 2, shape("%05d-%04d-%01d", n % 90000, n % 7000, n % 9)).when(key % 5 == 3, shape("%05d-%04d-%02d", n % 90000, n % 7000, n % 90)).otherwise(shape("%02d", n % 90))
    )
    whole = full_package_code(code, shape("%05d-%03d", n % 90000, n % 900))
    return table(spark, sf_dir, "part").select("p_partkey", whole.alias("package_ndc"), eleven_digits(whole).alias("ndc11"))


PACKAGE_CODES = """
WITH c AS (SELECT p_partkey, printf('%05d-%03d', p_partkey % 90000, p_partkey % 900) AS own, CASE p_partkey % 5 WHEN 0 THEN printf('%04d-%04d-%02d', p_partkey % 9000, p_partkey % 7000, p_partkey % 90)
    WHEN 1 THEN printf('%05d-%03d-%02d', p_partkey % 90000, p_partkey % 900, p_partkey % 90) WHEN 2 THEN printf('%05d-%04d-%01d', p_partkey % 90000, p_partkey % 7000, p_partkey % 9)
    WHEN 3 THEN printf('%05d-%04d-%02d', p_partkey % 90000, p_partkey % 7000, p_partkey % 90) ELSE printf('%02d', p_partkey % 90) END AS code FROM part),
  w AS (SELECT p_partkey, CASE WHEN length(code) < 12 THEN own || '-' || code ELSE code END AS package_ndc FROM c),
  s AS (SELECT *, split_part(package_ndc, '-', 1) AS a, split_part(package_ndc, '-', 2) AS b, split_part(package_ndc, '-', 3) AS d, replace(package_ndc, '-', '') AS plain,
    array_to_string(string_split(package_ndc, '-')[4:], '') AS rest FROM w)
SELECT p_partkey, package_ndc, CASE WHEN length(plain) = 11 THEN plain WHEN length(a) = 4 THEN '0' || plain WHEN length(b) = 3 THEN a || '0' || b || d || rest
  WHEN length(d) = 1 THEN a || b || '0' || d || rest ELSE plain END AS ndc11 FROM s
"""


def description_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_orderkey") % 7 == 0, F.format_string("%s of %d", "l_returnflag", "l_linenumber")).otherwise(
        F.format_string("%d TABLET, %s in %d BLISTER PACK (12-%d-9) / more in 1 BOX (1-2-3)", F.col("l_quantity").cast("int"), "l_returnflag", "l_linenumber", "l_suppkey")
    )
    form = F.when(F.col("l_returnflag") == "A", "TABLET, A").otherwise("CAPSULE")
    return lines.select("l_orderkey", "l_linenumber", *[c.alias(k) for k, c in described(text, form).items()])


DESCRIPTION_PARSE = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity::INTEGER::BIGINT END AS size,
  CASE WHEN l_orderkey % 7 <> 0 THEN CASE WHEN l_returnflag = 'A' THEN '' ELSE 'TABLET, ' || l_returnflag END END AS size_extra,
  CASE WHEN l_orderkey % 7 <> 0 THEN l_linenumber::BIGINT END AS packages_number, CASE WHEN l_orderkey % 7 <> 0 THEN 'BLISTER PACK' END AS package_format FROM lineitem
"""


def otc_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    category = F.when(key % 6 == 0, F.lit(" OTC monograph ")).when(key % 6 == 1, F.lit("Rx only")).when(key % 6 == 2, F.lit("")).when(key % 6 == 3, F.lit("sold over the counter")).otherwise(F.col("o_orderpriority"))
    kind = F.when(key % 7 == 0, F.lit("HUMAN PRESCRIPTION DRUG"))
    return table(spark, sf_dir, "orders").select("o_orderkey", over_the_counter(category, kind, F.when(key % 11 == 0, F.array(F.lit("x rx y")))).alias("is_otc"))


OTC_FLAG = """
WITH s AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'otc monograph' WHEN 1 THEN 'rx only' WHEN 2 THEN '' WHEN 3 THEN 'sold over the counter' ELSE lower(o_orderpriority) END
    || ' ' || CASE WHEN o_orderkey % 7 = 0 THEN 'human prescription drug' ELSE '' END || ' ' || CASE WHEN o_orderkey % 11 = 0 THEN 'x rx y' ELSE '' END AS t FROM orders)
SELECT o_orderkey, CASE WHEN trim(t) = '' THEN NULL WHEN contains(t, 'otc') OR contains(t, 'over the counter') OR contains(t, 'over-the-counter') THEN true
  WHEN contains(t, 'prescription') OR contains(' ' || t || ' ', ' rx ') THEN false END AS is_otc FROM s
"""


def falsy_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty texts, zeros and false as null, and the part of a text before its first comma."""
    key, orders = F.col("o_orderkey"), table(spark, sf_dir, "orders")
    text = F.when(key % 3 == 0, F.lit("")).otherwise(F.concat_ws(",", "o_orderstatus", "o_orderpriority"))
    return orders.select(
        "o_orderkey", falsy_to_null(text, schemas.STRING).alias("text"), short_form(text).alias("short"), falsy_to_null(key % 4, schemas.LONG).alias("number"),
        falsy_to_null(F.col("o_orderstatus") == "F", schemas.BOOL).alias("flag"), F.size(F.coalesce(falsy_to_null(F.when(key % 2 == 0, F.array("o_orderstatus")).otherwise(F.array().cast("array<string>")), schemas.STRINGS), F.array(F.lit("a"), F.lit("b")))).alias("items"),
    )


FALSY_FIELDS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus || ',' || o_orderpriority END AS text, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS short,
  nullif(o_orderkey % 4, 0) AS number, CASE WHEN o_orderstatus = 'F' THEN true END AS flag, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END::INTEGER AS items FROM orders
"""


def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, kind = F.col("l_shipdate"), F.col("l_orderkey") % 5
    text = (
        F.when(kind == 0, F.date_format(day, "yyyyMMdd")).when(kind == 1, F.date_format(day, " yyyy-MM-dd ")).when(kind == 2, F.date_format(day, "MM/dd/yyyy"))
        .when(kind == 3, F.concat(F.date_format(day, "yyyyMM"), F.lit("99"))).otherwise(F.date_format(day, "MMMM d, yyyy"))
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.date_format(parsed_date(text), "yyyy-MM-dd").alias("day"))


DATE_PARSE = "SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 <> 3 THEN strftime(l_shipdate, '%Y-%m-%d') END AS day FROM lineitem"


#: Forms of a day in l_shipdate: Spark's date pattern around literal text, and whether the day is read.
DATE_FORMS = (
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", 1), ("d MMM yyyy", 1), ("'effective 'MMMM d, yyyy 'at' HH:mm", 1), ("M/d/yyyy h:mm a", 1), ("dd-MMM-yy", 1), ("'the 'd'th of 'MMMM', 'yyyy", 1), ("yyyy.M.d", 1),
    ("MMM'. 'd yyyy", 1), ("yyyyMMddHHmm", 1), ("M-d-yy", 1), ("MMMM yyyy", 2), ("'no date, code 'd", 0), ("yyyy'-13-32'", 0), ("yyyy/MM/dd", 1),
)


def date_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship dates in many shapes, with words and times around them; of those without a day it is today's."""
    day, kind, text = F.col("l_shipdate"), (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % len(DATE_FORMS), F.lit(None).cast("string")
    for k, (form, _) in enumerate(DATE_FORMS):
        text = F.when(kind == k, F.date_format(day, form)).otherwise(text)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.date_format(parsed_date(text, F.lit("2024-01-31").cast("date")), "yyyy-MM-dd").alias("day"))


_FORM_OF = " ".join(f"WHEN {k} THEN {('NULL', 'l_shipdate::DATE', 'last_day(l_shipdate)')[kind]}" for k, (_, kind) in enumerate(DATE_FORMS))
DATE_FORMS_SQL = f"SELECT l_orderkey, l_linenumber, strftime(CASE (l_orderkey * 7 + l_linenumber) % {len(DATE_FORMS)} {_FORM_OF} END, '%Y-%m-%d') AS day FROM lineitem"


def dedupe_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_ops.last_per_key(table(spark, sf_dir, "events"), "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


def gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether there are enough rows to publish: parts that lines name of all parts (as products), customers that order of
    all customers (as labels), and documents (as evidence).
    """
    parts, customers, orders = (table(spark, sf_dir, t) for t in ("part", "customer", "orders"))
    used = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product_id")).distinct()
    buyers = orders.select(F.col("o_custkey").alias("id")).distinct()
    gates = {
        "product": publish.gate(used, "product_id", parts.count()), "label": publish.gate_labels(buyers, "id", customers.count()),
        "all labels": publish.gate_labels(buyers, "id", buyers.count()), "evidence": publish.gate_evidence(table(spark, sf_dir, "documents"), "doc_id", least=201),
    }
    return functools.reduce(DataFrame.unionByName, [rows.withColumn("gate", F.lit(name)) for name, rows in gates.items()])


GATE_COUNTS = """
WITH p AS (SELECT count(DISTINCT l_partkey) AS staged, (SELECT count(*) FROM part) AS expected FROM lineitem),
  b AS (SELECT count(DISTINCT o_custkey) AS staged, (SELECT count(*) FROM customer) AS expected FROM orders)
SELECT 'product' AS gate, staged, expected, staged > 0 AND staged >= floor(expected * 0.95) AS publish, staged > 0 AND staged >= floor(expected * 0.95) AND staged <> expected AS warn FROM p
UNION ALL SELECT 'label', staged, expected, expected > 0 AND staged = expected, false FROM b
UNION ALL SELECT 'all labels', staged, staged, staged > 0, false FROM b
UNION ALL SELECT 'evidence', count(doc_id), 201, count(doc_id) >= 201, false FROM documents
"""


def bridge_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.product_bridge(products(spark, sf_dir))


def bridge_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.label_bridge(labels(spark, sf_dir))


def json_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("seen", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate").cast("date")))
    return json_rows(rows, exclude=("o_totalprice", "o_custkey"), computed={"cents": F.round(F.col("o_totalprice") * 100).cast("long")}).select("o_orderkey", "json")


JSON_ORDERS = """
SELECT o_orderkey, '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '","o_orderpriority":"' || o_orderpriority
  || '","seen":' || CASE WHEN o_orderkey % 3 = 0 THEN '"' || strftime(o_orderdate, '%Y-%m-%dZ') || '"' ELSE 'null' END || ',"cents":' || round(o_totalprice * 100)::BIGINT || '}' AS json FROM orders
"""


def url_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", redacted(F.col("url")).alias("label"))


URL_REDACT = r"""
WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '^.*/', '') AS tail, url FROM pages)
SELECT page_id, CASE WHEN host = '' THEN substring(url, 1, 256) WHEN tail = '' THEN host ELSE host || '/' || tail END AS label FROM p
"""

#: Besides the library's own patterns, three that occur in the given tables.
SCAN = {**hygiene.PATTERNS, "license-line": r"(?i)\blicensed under\b", "mail-address": r"\b[a-z0-9.]+@[a-z0-9.-]+\.[a-z]{2,}\b", "long-number": r"\b\d{9,}\b"}


def pattern_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hygiene.scan_texts(table(spark, sf_dir, "documents"), "doc_id", "text", SCAN, needed={**hygiene.NEEDED, "license-line": ("licensed under",), "mail-address": ("@",)})


PATTERN_SCAN = "\nUNION ALL ".join(f"SELECT '{label}' AS label, doc_id FROM documents WHERE regexp_matches(text, '{p.replace(chr(39), chr(39) * 2)}')" for label, p in SCAN.items())


def name_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "pages").select(F.try_parse_url("url", F.lit("PATH")).alias("path"))
    return hygiene.scan_paths(paths, "path", parts=("fr", "de", ".codex"), names=("7424.html", "4033.html", "AGENTS.md"))


NAME_SCAN = r"""
WITH p AS (SELECT regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages)
SELECT 'forbidden path component' AS problem, path FROM p WHERE list_has_any(string_split(path, '/'), ['fr', 'de', '.codex'])
UNION ALL SELECT 'forbidden instruction file', path FROM p WHERE string_split(path, '/')[-1] IN ('7424.html', '4033.html', 'AGENTS.md')
"""


RECORD_QUERIES = {
    "import_products": (import_products, IMPORT_PRODUCTS),
    "import_packages": (import_packages, IMPORT_PACKAGES),
    "import_labels": (import_labels, IMPORT_LABELS),
    "package_codes": (package_codes, PACKAGE_CODES),
    "description_parse": (description_parse, DESCRIPTION_PARSE),
    "otc_flag": (otc_flag, OTC_FLAG),
    "falsy_fields": (falsy_fields, FALSY_FIELDS),
    "date_parse": (date_parse, DATE_PARSE),
    "date_forms": (date_forms, DATE_FORMS_SQL),
    "dedupe_last": (dedupe_last, "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"),
    "gate_counts": (gate_counts, GATE_COUNTS),
    "bridge_products": (bridge_products, f"WITH {PRODUCTS} SELECT DISTINCT unnest(rxnorm_ids) AS rxcui, product_ndc FROM product"),
    "bridge_labels": (bridge_labels, "SELECT DISTINCT source AS product_ndc, 'L' || doc_id AS label_id FROM documents"),
    "json_orders": (json_orders, JSON_ORDERS),
    "url_redact": (url_redact, URL_REDACT),
    "pattern_scan": (pattern_scan, PATTERN_SCAN),
    "name_scan": (name_scan, NAME_SCAN),
}
