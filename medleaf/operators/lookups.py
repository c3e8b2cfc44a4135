"""Lookups and listings, for one key or for a table of keys.

Functions that take `keys` accept a single value or a DataFrame with one column of the key's name; ALL stands for every
row that has a key. Orders follow the
convention that nulls come last upwards and first downwards; every limit stands behind a total order. No match gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from medleaf.functions.text import blank_to_null, display_name

PRODUCT_FIELDS = ["generic_name", "brand_name", "dosage_form", "product_ndc", "labeler_name"]
PACKAGE_FIELDS = ["generic_name", "brand_name", "dosage_form", "short_dosage_form", "package_ndc", "package_description", "size", "size_extra", "packages_number", "package_format"]
PAGE, LETTER_PAGE, EVIDENCE_ROWS, MOST_EVIDENCE = 49_999, 100, 100, 500


ALL = object()


def keyed(df: DataFrame, keys: object, key: str) -> DataFrame:
    """Rows of df whose key is the given one, or is among those of a table of keys; with ALL, those that have one."""
    if keys is ALL:
        return df.filter(F.col(key).isNotNull())
    if isinstance(keys, DataFrame):
        return df.join(keys.select(key).distinct(), key, "left_semi")
    return df.filter(F.col(key) == keys)


def first_per(df: DataFrame, key: str, *order: str) -> DataFrame:
    by = W.partitionBy(key).orderBy(*[F.asc_nulls_last(c) for c in order])
    return df.withColumn("__n", F.row_number().over(by)).filter("__n = 1").drop("__n")


def counts(products: DataFrame, packages: DataFrame, product_key: str = "product_id", package_key: str = "package_ndc") -> DataFrame:
    """(products, packages): keys of both tables, one row."""
    return products.agg(F.count(product_key).alias("products")).join(packages.agg(F.count(package_key).alias("packages")))


def product_of(products: DataFrame, keys: object, key: str = "product_ndc", order: str = "product_id") -> DataFrame:
    """One product for every code: the one with the smallest id."""
    return first_per(keyed(products, keys, key), key, order)


def packages_of(packages: DataFrame, keys: object, key: str = "product_ndc") -> DataFrame:
    return keyed(packages, keys, key)


def nested(rows: DataFrame, other: DataFrame, key: str, name: str, order: str) -> DataFrame:
    """rows with one row of other as a struct, null if there is none."""
    one = first_per(other, key, order)
    return rows.join(one.select(F.col(key), F.struct("*").alias(name)), key, "left")


def with_label(rows: DataFrame, labels: DataFrame, spl: str = "spl_id", label_id: str = "id", set_id: str = "set_id", name: str = "label") -> DataFrame:
    """rows with a label: the one whose id is the row's spl id, else one whose set id is; none if the spl id is empty."""
    key = blank_to_null(F.col(spl).cast("string"))
    by_id = first_per(labels.filter(F.col(label_id).isNotNull()), label_id, label_id).select(F.col(label_id).cast("string").alias("__id"), F.struct("*").alias("__by_id"))
    by_set = first_per(labels.filter(F.col(set_id).isNotNull()), set_id, label_id).select(F.col(set_id).cast("string").alias("__set"), F.struct("*").alias("__by_set"))
    out = rows.withColumn("__key", key)
    out = out.join(by_id, out["__key"] == by_id["__id"], "left").join(by_set, out["__key"] == by_set["__set"], "left")
    return out.withColumn(name, F.coalesce("__by_id", "__by_set")).drop("__key", "__id", "__by_id", "__set", "__by_set")


def package_details(packages: DataFrame, products: DataFrame, labels: DataFrame | None, keys: object) -> DataFrame:
    """Packages by code with their product nested and, if labels are given, the product's label."""
    rows = nested(keyed(packages, keys, "package_ndc"), products, "product_ndc", "product", "product_id")
    return rows if labels is None else with_label(rows.withColumn("spl_id", F.col("product.spl_id")), labels).drop("spl_id")


def product_details(products: DataFrame, labels: DataFrame, keys: object) -> DataFrame:
    return with_label(product_of(products, keys), labels)


def _page(rows: DataFrame, order: list[Column], size: int, page: int | None) -> DataFrame:
    if size < 0:
        raise ValueError("page size must not be negative")
    return rows.orderBy(*order).offset(size * max(page or 0, 0)).limit(size)


def _listing_order(products: DataFrame, generic: str, brand: str, key: str) -> list[Column]:
    same = ["product_id"] if "product_id" in products.columns else []
    return [F.asc_nulls_last(c) for c in (generic, brand, key, *same)]


def list_products(products: DataFrame, size: int = PAGE, page: int | None = None, generic: str = "generic_name", brand: str = "brand_name", key: str = "product_ndc") -> DataFrame:
    """A page of all products by generic and brand name, with their display names. Pages count from 0."""
    return _page(products, _listing_order(products, generic, brand, key), size, page).withColumn("display_name", display_name(F.col(brand), F.col(generic)))


def list_products_after(products: DataFrame, after: tuple[str | None, str | None, str | None] | None, size: int = PAGE, generic: str = "generic_name", brand: str = "brand_name", key: str = "product_ndc") -> DataFrame:
    """The page of list_products that follows a row (its generic name, brand name and code); the first page for None. For
    long listings: rows before it are filtered out where they lie, and not sorted again for every page. Codes must be
    unique.
    """
    if after is not None:
        # in the listing's order nulls come last
        place = F.struct(*[x for c in (generic, brand, key) for x in (F.col(c).isNull().alias(f"no_{c}"), F.coalesce(c, F.lit("")).alias(c))])
        there = F.struct(*[x for c, v in zip((generic, brand, key), after, strict=True) for x in (F.lit(v is None).alias(f"no_{c}"), F.lit(v or "").alias(c))])
        products = products.filter(place > there)
    return list_products(products, size, 0, generic, brand, key)


def list_products_by_letter(products: DataFrame, letter: str, size: int = LETTER_PAGE, page: int | None = None, generic: str = "generic_name", brand: str = "brand_name", key: str = "product_ndc", literal: bool = False) -> DataFrame:
    """A page of the products whose generic name starts with a letter of either case."""
    if len(letter) != 1:
        raise ValueError("one letter is expected")
    wanted = F.lower(F.substring(F.col(generic), 1, 1)) == letter.lower() if literal else F.col(generic).ilike(f"{letter}%")
    return _page(products.filter(wanted), _listing_order(products, generic, brand, key), size, page)


def _likes(c: Column, name: str, literal: bool) -> Column:
    if literal:
        return F.lower(c) == name.lower()
    return c.ilike(name)


def matching_generic_names(products: DataFrame, name: str, literal: bool = False) -> DataFrame:
    """Generic names of products whose brand or generic name is the given one, whatever its case. `%` and `_` are wild
    unless literal is set.
    """
    return products.filter(_likes(F.col("brand_name"), name, literal) | _likes(F.col("generic_name"), name, literal)).select("generic_name").distinct()


def codes_by_name(products: DataFrame, name: str, group: str, literal: bool = False) -> DataFrame:
    """Codes of the products with a matching generic name: sold under it (generic) or under another name (brand)."""
    same = F.lower("generic_name") == F.lower("brand_name")
    rows = products.join(matching_generic_names(products, name, literal), "generic_name", "left_semi")
    rows = rows.filter(same | F.col("brand_name").isNull()) if group == "generic" else rows.filter(~same & F.col("brand_name").isNotNull())
    return rows.select("product_ndc").distinct()


def products_by_name(products: DataFrame, name: str, group: str, literal: bool = False) -> DataFrame:
    order = F.desc_nulls_first("product_ndc" if group == "generic" else "brand_name")
    return products.join(codes_by_name(products, name, group, literal), "product_ndc", "left_semi").select(*PRODUCT_FIELDS).orderBy(order)


def packages_by_name(products: DataFrame, packages: DataFrame, name: str, group: str, literal: bool = False) -> DataFrame:
    wanted = products.join(codes_by_name(products, name, group, literal), "product_ndc", "left_semi")
    return wanted.select("product_ndc", *PACKAGE_FIELDS[:4]).join(packages.withColumnRenamed("description", "package_description"), "product_ndc").select(*PACKAGE_FIELDS)


def grouped_codes(products: DataFrame, name: str, groups: tuple[str, ...], literal: bool = False) -> DataFrame:
    """(product_ndc, match_group): the codes of several groups in one pass."""
    same, branded = F.lower("generic_name") == F.lower("brand_name"), F.col("brand_name").isNotNull()
    of = {"generic": F.coalesce(same, F.lit(False)) | ~branded, "brand": F.coalesce(~same, F.lit(False)) & branded}
    rows = products.join(matching_generic_names(products, name, literal), "generic_name", "left_semi")
    rows = rows.groupBy("product_ndc").agg(*[F.max(of[g]).alias(g) for g in groups])
    return rows.select("product_ndc", F.explode(F.array_compact(F.array(*[F.when(F.col(g), F.lit(g)) for g in groups]))).alias("match_group"))


def search(products: DataFrame, packages: DataFrame | None, name: str, groups: tuple[str, ...] = ("generic", "brand"), literal: bool = False) -> DataFrame:
    """Products, or packages if given, by a URL-encoded name; match_group says which group a row is of."""
    from urllib.parse import unquote

    if not groups:
        raise ValueError("at least one group is expected")
    rows = products.join(grouped_codes(products, unquote(name).lower(), groups, literal), "product_ndc")
    if packages is None:
        order = F.when(F.col("match_group") == "generic", F.col("product_ndc")).otherwise(F.col("brand_name"))
        rank = F.array_position(F.array(*[F.lit(g) for g in groups]), F.col("match_group"))
        return rows.orderBy(rank, F.desc_nulls_first(order)).select(*PRODUCT_FIELDS, "match_group")
    wanted = rows.select("product_ndc", *PACKAGE_FIELDS[:4], "match_group")
    return wanted.join(packages.withColumnRenamed("description", "package_description"), "product_ndc").select(*PACKAGE_FIELDS, "match_group")


def products_by_rxnorm(products: DataFrame, keys: object, ids: str = "rxnorm_ids") -> DataFrame:
    """Products that hold an RxNorm id; with a table of keys (rxnorm_id), one row for each product and id."""
    if isinstance(keys, DataFrame):
        wanted = keys.select(F.trim("rxnorm_id").alias("rxnorm_id")).distinct()
        return products.withColumn("rxnorm_id", F.explode(F.array_distinct(ids))).join(wanted, "rxnorm_id", "left_semi")
    return products.filter(F.array_contains(ids, str(keys).strip()))


def packages_by_rxnorm(products: DataFrame, packages: DataFrame, keys: object, ids: str = "rxnorm_ids", code: str = "product_ndc") -> DataFrame:
    codes = products_by_rxnorm(products, keys, ids).select(code).filter(F.coalesce(F.col(code).cast("string"), F.lit("")) != "")
    return packages.join(codes.distinct(), code, "left_semi")


SALTS = 64


def first_rows_per_key(rows: DataFrame, key: str, order: str, limit: int, salts: int = SALTS, keys: DataFrame | None = None) -> DataFrame:
    """The first `limit` rows of every key in the order of a column of distinct values; with a table of distinct keys, of
    those keys only.

    In two steps: of the rows of a key and a salt, then of what is left of the key. Spark cuts both before their shuffles
    too, so that no task gets more than salts * limit rows of a key, however many there are of it. Keys are looked up between
    the steps, by an inner join: Spark would do a semi join before them, which sends all rows of a key to one task.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(order), F.lit(salts)))
    some = salted.withColumn("__n", F.row_number().over(W.partitionBy(key, "__salt").orderBy(order))).filter(F.col("__n") <= limit)
    some = some if keys is None else some.join(keys, key)
    return some.withColumn("__n", F.row_number().over(W.partitionBy(key).orderBy(order))).filter(F.col("__n") <= limit).drop("__n", "__salt")


def evidence_bridge(evidence: DataFrame, ids: str, key: str) -> DataFrame:
    """(key, evidence_id) of every id in an array column: narrow rows to look keys up in."""
    return evidence.select(F.explode(F.array_distinct(ids)).alias(key), "evidence_id").filter(F.col(key).isNotNull())


def _limited(limit: int) -> int:
    if limit < 0:
        raise ValueError("limit must not be negative")
    return min(limit, MOST_EVIDENCE)


def _some(rows: DataFrame, limit: int) -> DataFrame:
    most = _limited(limit)
    return rows.orderBy("evidence_id").limit(most)


def _evidence_of_keys(evidence: DataFrame, bridge: DataFrame, keys: DataFrame, key: str, limit: int) -> DataFrame:
    """Evidence of every key of a table, with the key: at most `limit` rows of each by evidence id. Ids alone are ranked; the
    rest of a row is fetched for those that are left.
    """
    wanted = keys.select(F.trim(F.col(key)).alias(key)).distinct()
    pairs = first_rows_per_key(bridge, key, "evidence_id", _limited(limit), keys=wanted)
    return evidence.withColumn("__id", F.col("evidence_id")).drop("evidence_id", key).join(pairs, F.col("__id") == F.col("evidence_id")).drop("__id")


def evidence_by_rxnorm(evidence: DataFrame, keys: object, limit: int = EVIDENCE_ROWS, bridge: DataFrame | None = None) -> DataFrame:
    """Evidence of an RxNorm id; with a table of keys (rxnorm_id), at most `limit` rows of each, with the key. `bridge` is a
    stored evidence_bridge, if there is one.
    """
    if isinstance(keys, DataFrame):
        return _evidence_of_keys(evidence, evidence_bridge(evidence, "rxnorm_ids", "rxnorm_id") if bridge is None else bridge, keys, "rxnorm_id", limit)
    return _some(evidence.filter(F.array_contains("rxnorm_ids", str(keys).strip())), limit)


def evidence_by_product(evidence: DataFrame, keys: object, limit: int = EVIDENCE_ROWS, bridge: DataFrame | None = None) -> DataFrame:
    """The same by product code; a table of keys has the column product_code."""
    if isinstance(keys, DataFrame):
        return _evidence_of_keys(evidence, evidence_bridge(evidence, "product_ndc", "product_code") if bridge is None else bridge, keys, "product_code", limit)
    return _some(evidence.filter(F.array_contains("product_ndc", str(keys).strip())), limit)


def evidence_by_label(evidence: DataFrame, set_id: object) -> DataFrame:
    return keyed(evidence, set_id.strip() if isinstance(set_id, str) else set_id, "set_id")
