"""Lookup and listing queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.functions.text import display_name
from medleaf.operators import lookups as L
from medleaf.operators import names as N
from medleaf.operators import pages
from medleaf.plans.bindings import PACKAGES, PRODUCTS, new_database, packages, products, shared_folder, table

NAME = "Red%20WIDGET"
_MATCH = """
m AS (SELECT DISTINCT generic_name FROM product WHERE brand_name ILIKE 'red widget' OR generic_name ILIKE 'red widget'),
c AS (SELECT DISTINCT product_ndc, CASE WHEN lower(generic_name) = lower(brand_name) OR brand_name IS NULL THEN 'generic' ELSE 'brand' END AS match_group
  FROM product WHERE generic_name IN (SELECT generic_name FROM m))"""


def name_search_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.search(products(spark, sf_dir), None, NAME)


def name_search_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.search(products(spark, sf_dir), None, NAME, groups=("brand",))


def name_search_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.search(products(spark, sf_dir), packages(spark, sf_dir), NAME)


def _patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that part asks for: its own, some letters of them with wildcards before, within and behind, and its types."""
    name, like = F.col("p_name"), lambda *c: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in c])
    asked = F.array(
        name, like("%", F.split_part(name, F.lit(" "), F.lit(2))), like(F.substring(name, 1, 1), "%"), like("_", F.substring(name, 2, 100)), like("%", F.right(name, F.lit(2))),
        like(F.substring(name, 1, 2), "%", F.right(name, F.lit(1))), F.initcap("p_type"), like(F.substring("p_type", 1, 3), "____"), like("%", F.substring(name, 3, 2), "_", F.substring(name, 6, 1), "%"), F.lit("________"),
    )
    rows = table(spark, sf_dir, "part").select("p_name", "p_type").distinct().select(F.explode(asked).alias("pattern")).distinct()
    return rows.select(F.replace(F.replace("pattern", F.lit("%"), F.lit("%25")), F.lit(" "), F.lit("%20")).alias("name"))


def name_search_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of a table of names, by a stored index of name grams."""
    rows, index = products(spark, sf_dir), f"{new_database(spark)}.name_grams"
    N.store_name_grams(spark, rows, index, 16)
    found = N.search_names(rows, None, _patterns(spark, sf_dir), grams=spark.read.table(index), counts=spark.read.table(f"{index}_counts"))
    return found.select("name", "product_ndc", "generic_name", "brand_name", "match_group")


_PATTERNS = """
pat AS (SELECT DISTINCT unnest([p_name, '%' || split_part(p_name, ' ', 2), p_name[1] || '%', '_' || p_name[2:], '%' || right(p_name, 2), p_name[1:2] || '%' || right(p_name, 1),
  upper(p_type[1]) || lower(p_type[2:]), p_type[1:3] || '____', '%' || p_name[3:4] || '_' || p_name[6] || '%', '________']) AS pattern FROM part),
pm AS (SELECT DISTINCT pattern, generic_name FROM pat JOIN (SELECT DISTINCT generic_name, brand_name FROM product) ON brand_name ILIKE pattern OR generic_name ILIKE pattern),
pc AS (SELECT DISTINCT pattern, product_ndc, CASE WHEN lower(generic_name) = lower(brand_name) OR brand_name IS NULL THEN 'generic' ELSE 'brand' END AS match_group FROM pm JOIN product USING (generic_name))"""


def matching_generic_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.matching_generic_names(products(spark, sf_dir), "%w_dget")


def list_all_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same page of all products, found by the last row of the page before."""
    rows = products(spark, sf_dir)
    last = L.list_products(rows, size=1, page=119).select("generic_name", "brand_name", "product_ndc").first()
    return L.list_products_after(rows, tuple(last), size=40).select("product_ndc", "generic_name", "brand_name", "display_name")


def list_all_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.list_products(products(spark, sf_dir), size=40, page=3).select("product_ndc", "generic_name", "brand_name", "display_name")


def stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pages of a stored listing of all packages by product name: the first, one in the middle and the last."""
    folder = f"{shared_folder(spark)}/listing-{uuid.uuid4().hex}"
    names = products(spark, sf_dir).select("product_ndc", "generic_name", "brand_name")
    rows = packages(spark, sf_dir).select("package_ndc", "product_ndc").join(names, "product_ndc")
    order = ["generic_name", "brand_name", "package_ndc"]
    pages.store_listing(rows, folder, *order, ranges=32)
    last = (rows.count() - 1) // 700
    found = [pages.stored_page(spark, folder, order, 700, k).select(F.lit(name).alias("page"), *order) for name, k in (("first", -1), ("middle", last // 2), ("last", last))]
    return found[0].unionByName(found[1]).unionByName(found[2])


STORED_PAGES = f"""
WITH {PRODUCTS}, {PACKAGES}, o AS (SELECT generic_name, brand_name, package_ndc, row_number() OVER (ORDER BY generic_name NULLS LAST, brand_name NULLS LAST, package_ndc) - 1 AS place FROM package JOIN product USING (product_ndc)),
n AS (SELECT (count(*) - 1) // 700 AS last FROM o)
SELECT p.page, generic_name, brand_name, package_ndc FROM o, n, (VALUES ('first'), ('middle'), ('last')) AS p(page) WHERE place // 700 = CASE page WHEN 'first' THEN 0 WHEN 'middle' THEN last // 2 ELSE last END"""


def list_by_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.list_products_by_letter(products(spark, sf_dir), "B", size=25, page=-1).select("product_ndc", "generic_name", "brand_name")


def display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir).select("product_id", display_name(F.col("brand_name"), F.col("generic_name")).alias("display_name"))


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.counts(products(spark, sf_dir), packages(spark, sf_dir))


def product_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product for every code that lines ask for."""
    return L.product_of(products(spark, sf_dir), packages(spark, sf_dir)).select("product_ndc", "product_id", "generic_name")


def product_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages of all products."""
    return L.packages_of(packages(spark, sf_dir), products(spark, sf_dir)).select("product_ndc", "package_ndc", "size")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as labels: ids for the even ones only, set ids for all."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(key % 2 == 0, F.concat(F.lit("L"), key.cast("string"))).alias("id"), F.concat(F.lit("L"), (key % 90).cast("string")).alias("set_id"), F.col("c_name").alias("title")
    )


def package_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every package with its product and that product's label."""
    rows = L.package_details(packages(spark, sf_dir), products(spark, sf_dir), _labels(spark, sf_dir), L.ALL)
    return rows.select("package_ndc", F.col("product.generic_name").alias("generic_name"), F.col("product.spl_id").alias("spl_id"), F.col("label.title").alias("title"))


def product_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = L.product_details(products(spark, sf_dir), _labels(spark, sf_dir), L.ALL)
    return rows.select("product_ndc", "spl_id", F.col("label.id").alias("label_id"), F.col("label.title").alias("title"))


_LABELS = """
lab AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'L' || c_custkey END AS id, 'L' || (c_custkey % 90) AS set_id, c_name AS title FROM customer),
one AS (SELECT * FROM lab WHERE id IS NOT NULL),
sets AS (SELECT * FROM lab QUALIFY row_number() OVER (PARTITION BY set_id ORDER BY id NULLS LAST) = 1)"""


def array_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.products_by_rxnorm(products(spark, sf_dir), " Brand#3 ").select("product_id", "product_ndc", "labeler_name")


def array_lookup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of every brand and type that lines' parts have, one row for each id."""
    keys = table(spark, sf_dir, "part").select(F.explode(F.array("p_brand", "p_type")).alias("rxnorm_id"))
    return L.products_by_rxnorm(products(spark, sf_dir), keys).select("product_id", "rxnorm_id")


def array_lookup_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.packages_by_rxnorm(products(spark, sf_dir), packages(spark, sf_dir), "Brand#3").select("package_ndc", "product_ndc", "size")


LOOKUP_QUERIES = {
    "name_search_products": (name_search_products, f"WITH {PRODUCTS}, {_MATCH} SELECT generic_name, brand_name, dosage_form, product_ndc, labeler_name, match_group FROM product JOIN c USING (product_ndc)"),
    "name_search_brand": (name_search_brand, f"WITH {PRODUCTS}, {_MATCH} SELECT generic_name, brand_name, dosage_form, product_ndc, labeler_name, match_group FROM product JOIN c USING (product_ndc) WHERE match_group = 'brand'"),
    "name_search_packages": (
        name_search_packages,
        f"WITH {PRODUCTS}, {PACKAGES}, {_MATCH} SELECT generic_name, brand_name, dosage_form, short_dosage_form, package_ndc, description AS package_description, size, size_extra, "
        "packages_number, package_format, match_group FROM product JOIN c USING (product_ndc) JOIN package USING (product_ndc)",
    ),
    "name_search_table": (
        name_search_table,
        f"WITH {PRODUCTS}, {_PATTERNS} SELECT replace(replace(pattern, '%', '%25'), ' ', '%20') AS name, product_ndc, generic_name, brand_name, match_group FROM product JOIN pc USING (product_ndc)",
    ),
    "matching_generic_names": (matching_generic_names, f"WITH {PRODUCTS} SELECT DISTINCT generic_name FROM product WHERE brand_name ILIKE '%w_dget' OR generic_name ILIKE '%w_dget'"),
    "list_all_page": (
        list_all_page,
        f"WITH {PRODUCTS} SELECT product_ndc, generic_name, brand_name, CASE WHEN lower(brand_name) <> lower(generic_name) THEN brand_name ELSE generic_name END AS display_name "
        "FROM product ORDER BY generic_name NULLS LAST, brand_name NULLS LAST, product_ndc NULLS LAST LIMIT 40 OFFSET 120",
    ),
    "list_all_after": (
        list_all_after,
        f"WITH {PRODUCTS} SELECT product_ndc, generic_name, brand_name, CASE WHEN lower(brand_name) <> lower(generic_name) THEN brand_name ELSE generic_name END AS display_name "
        "FROM product ORDER BY generic_name NULLS LAST, brand_name NULLS LAST, product_ndc NULLS LAST LIMIT 40 OFFSET 120",
    ),
    "stored_pages": (stored_pages, STORED_PAGES),
    "list_by_letter": (list_by_letter, f"WITH {PRODUCTS} SELECT product_ndc, generic_name, brand_name FROM product WHERE generic_name ILIKE 'b%' ORDER BY generic_name, brand_name NULLS LAST, product_ndc LIMIT 25"),
    "display_names": (display_names, f"WITH {PRODUCTS} SELECT product_id, CASE WHEN lower(brand_name) <> lower(generic_name) THEN brand_name ELSE generic_name END AS display_name FROM product"),
    "status_counts": (status_counts, "SELECT (SELECT count(*) FROM part) AS products, (SELECT count(*) FROM lineitem) AS packages"),
    "product_lookup": (product_lookup, f"WITH {PRODUCTS} SELECT product_ndc, product_id, generic_name FROM product WHERE product_ndc IN (SELECT l_partkey::VARCHAR FROM lineitem)"),
    "product_packages": (product_packages, f"WITH {PRODUCTS}, {PACKAGES} SELECT product_ndc, package_ndc, size FROM package WHERE product_ndc IN (SELECT product_ndc FROM product)"),
    "package_details": (
        package_details,
        f"WITH {PRODUCTS}, {PACKAGES}, {_LABELS} SELECT package_ndc, generic_name, spl_id, CASE WHEN one.id IS NOT NULL THEN one.title ELSE sets.title END AS title "
        "FROM package LEFT JOIN product USING (product_ndc) LEFT JOIN one ON one.id = spl_id LEFT JOIN sets ON sets.set_id = spl_id",
    ),
    "product_labels": (
        product_labels,
        f"WITH {PRODUCTS}, {_LABELS} SELECT product_ndc, spl_id, CASE WHEN one.id IS NOT NULL THEN one.id ELSE sets.id END AS label_id, CASE WHEN one.id IS NOT NULL THEN one.title ELSE sets.title END AS title "
        "FROM product LEFT JOIN one ON one.id = spl_id LEFT JOIN sets ON sets.set_id = spl_id",
    ),
    "array_lookup": (array_lookup, f"WITH {PRODUCTS} SELECT product_id, product_ndc, labeler_name FROM product WHERE list_contains(rxnorm_ids, 'Brand#3')"),
    "array_lookup_keys": (array_lookup_keys, f"WITH {PRODUCTS} SELECT product_id, unnest(rxnorm_ids) AS rxnorm_id FROM product"),
    "array_lookup_packages": (array_lookup_packages, f"WITH {PRODUCTS}, {PACKAGES} SELECT package_ndc, product_ndc, size FROM package WHERE product_ndc IN (SELECT product_ndc FROM product WHERE list_contains(rxnorm_ids, 'Brand#3'))"),
}
