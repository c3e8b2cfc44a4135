"""Products by a table of names, without a scan of all products for each.

Names are indexed by their grams: pieces of one to three letters of the lower-case name between a mark for its beginning
and one for its end. A pattern's literal parts, cut at its wildcards, have grams too, and every name that the pattern
matches has all of them. The pattern's rarest gram is looked up, an equal join, and what it finds is held against the
pattern itself. Short names have grams like others, thanks to the marks; a pattern without any literal part finds all names
by the mark of their beginning.

Null and repeated names of either table are left out, an empty name is a name. A pattern that ends in half an escape
matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.operators.lookups import PACKAGE_FIELDS, PRODUCT_FIELDS
from medleaf.operators.publish import laid_out

BEGIN, END, LONGEST_GRAM = "\x02", "\x03", 3
SALTS = 16


def _pieces(c: Column) -> Column:
    """Distinct pieces of one to LONGEST_GRAM letters."""
    at = lambda n: F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*[at(n) for n in range(1, LONGEST_GRAM + 1)]))


def _marked(c: Column) -> Column:
    return F.concat(F.lit(BEGIN), F.lower(c), F.lit(END))


def name_grams(products: DataFrame) -> DataFrame:
    """(gram, name) of all brand and generic names."""
    names = products.select(F.explode(F.array("generic_name", "brand_name")).alias("name")).filter("name is not null").distinct()
    return names.select(F.explode(_pieces(_marked(F.col("name")))).alias("gram"), "name")


def store_name_grams(spark: SparkSession, products: DataFrame, table: str, buckets: int = 64) -> None:
    """Stores the index bucketed by gram, and the number of names of each gram under the name with `_counts`."""
    laid_out(name_grams(products), table, "gram", buckets)
    laid_out(spark.read.table(table).groupBy("gram").agg(F.count("*").alias("names")), f"{table}_counts", "gram", buckets)


def pattern_grams(pattern: Column) -> Column:
    """Grams that every name has which the pattern matches. Escaped letters count as wildcards here."""
    parts = F.split(_marked(pattern), r"\\.|[%_]")
    return F.array_distinct(F.concat(F.array(F.lit(BEGIN)), F.flatten(F.transform(F.filter(parts, lambda p: p != ""), _pieces))))


def decoded(c: Column) -> Column:
    """A URL-encoded name in lower case; percent signs that encode nothing stand for themselves."""
    kept = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.lower(F.url_decode(kept))


def matching_names(patterns: DataFrame, grams: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """(pattern, name) of names that match patterns (pattern), whatever their case. grams and counts: what store_name_grams
    stores.
    """
    counts = grams.groupBy("gram").agg(F.count("*").alias("names")) if counts is None else counts
    wanted = patterns.select("pattern").filter(F.col("pattern").rlike(r"^(?s:[^\\]|\\[\\%_])*$")).distinct()
    wanted = wanted.select("pattern", F.explode(pattern_grams(F.col("pattern"))).alias("gram"))
    # a gram that no name has rules its pattern out
    rarest = wanted.join(counts, "gram", "left").groupBy("pattern").agg(F.min(F.struct(F.coalesce("names", F.lit(0)).alias("names"), "gram")).alias("g"))
    rarest = rarest.filter("g.names > 0").select("pattern", F.col("g.gram").alias("gram"))
    return rarest.join(grams, "gram").filter(F.ilike("name", F.col("pattern"))).select("pattern", "name")


def matching_generic_names_of(products: DataFrame, patterns: DataFrame, grams: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """(pattern, generic_name): for each pattern, the generic names of products whose brand or generic name matches it."""
    found = matching_names(patterns, name_grams(products) if grams is None else grams, counts)
    names = products.select("generic_name", F.explode(F.array("generic_name", "brand_name")).alias("name")).filter("name is not null").distinct()
    return found.join(names, "name").select("pattern", "generic_name").distinct()


def search_names(products: DataFrame, packages: DataFrame | None, names: DataFrame, groups: tuple[str, ...] = ("generic", "brand"), grams: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Products, or packages if given, of every name of a table (name: URL-encoded), with the name and the group that a row is
    of: sold under its generic name, or under another one.

    Names are matched with what codes are sold as, each such set at most SALTS times; rows get their names last, by a join
    after which nothing is sorted, grouped or sent.
    """
    if not groups:
        raise ValueError("at least one group is expected")
    asked = names.filter("name is not null").select("name").distinct().withColumn("pattern", decoded(F.col("name")))
    generic = matching_generic_names_of(products, asked, grams, counts).join(asked, "pattern").select("name", "generic_name")
    same, branded = F.coalesce(F.lower("generic_name") == F.lower("brand_name"), F.lit(False)), F.col("brand_name").isNotNull()
    of = F.when(same | ~branded, F.lit("generic")).otherwise(F.lit("brand"))
    coded = products.filter("product_ndc is not null").withColumn("__salt", F.pmod(F.xxhash64("product_ndc"), F.lit(SALTS)))
    sold = coded.select("product_ndc", "__salt", F.struct("generic_name", of.alias("match_group")).alias("s")).filter(F.col("s.generic_name").isNotNull() & F.col("s.match_group").isin(*groups))
    sold = sold.groupBy("product_ndc", "__salt").agg(F.sort_array(F.collect_set("s")).alias("__sold"))
    found = sold.select("__sold", "__salt").distinct().select("__sold", "__salt", F.inline("__sold")).join(generic, "generic_name").select("__sold", "__salt", "name", "match_group").distinct()
    rows = coded.join(sold, ["product_ndc", "__salt"])
    # few bytes become very many rows: the number of partitions is given, and neither side is small enough to be broadcast
    partitions = int(products.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = lambda df: df.repartition(partitions, "__sold", "__salt").hint("merge").join(found, ["__sold", "__salt"])
    if packages is None:
        return named(rows).select("name", *PRODUCT_FIELDS, "match_group")
    wanted = rows.select("product_ndc", *PACKAGE_FIELDS[:4], "__sold", "__salt").join(packages.withColumnRenamed("description", "package_description"), "product_ndc")
    return named(wanted).select("name", *PACKAGE_FIELDS, "match_group")
