"""Products and packages from source records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from medleaf import schemas
from medleaf.functions.codes import described, eleven_digits, falsy_to_null, full_package_code, over_the_counter, short_form
from medleaf.functions.dates import parsed_date


def _field(c: Column, name: str, kind, falsy: bool) -> Column:
    if "_date" in name:
        return parsed_date(c)
    return falsy_to_null(c, kind) if falsy else c


def products(records: DataFrame, falsy: bool = True) -> DataFrame:
    """Product rows, with archive and pos, from (archive, pos, record). With falsy, empty values and false are null."""
    record = F.col("record")
    openfda = F.from_json("record.openfda", schemas.OPENFDA)
    columns = {f.name: _field(record[f.name], f.name, f.dataType, falsy) for f in schemas.PRODUCT_RECORD if f.name != "packaging"}
    columns["openfda"] = F.when(F.regexp_like("record.openfda", F.lit(r"^\s*(\{\s*\})?\s*$")), None).otherwise(record["openfda"])
    columns["rxnorm_ids"] = F.coalesce(openfda["rxcui"], F.array().cast("array<string>"))
    columns["is_otc"] = over_the_counter(record["marketing_category"], record["product_type"], openfda["product_type"])
    columns["short_dosage_form"] = short_form(columns["dosage_form"])
    return records.select("archive", "pos", *[columns[c].alias(c) for c in schemas.PRODUCT.names])


def packages(records: DataFrame, falsy: bool = True) -> DataFrame:
    """Package rows, with archive and pos, from (archive, pos, record). Records without packaging give none."""
    code, form = F.col("record.product_ndc"), F.col("record.dosage_form")
    rows = records.select("archive", "pos", falsy_to_null(code, schemas.STRING).alias("product_ndc"), falsy_to_null(form, schemas.STRING).alias("form"), F.posexplode("record.packaging").alias("at", "pack"))
    raw = {f.name: _field(F.col("pack")[f.name], f.name, f.dataType, falsy) for f in schemas.PACKAGING}
    whole = full_package_code(F.col("pack.package_ndc"), F.col("product_ndc"))
    columns = {**raw, "package_ndc": whole, "ndc11": eleven_digits(whole), "product_ndc": F.col("product_ndc"), **described(raw["description"], F.col("form"))}
    return rows.select("archive", (F.col("pos") * 100_000 + F.col("at")).alias("pos"), *[columns[c].alias(c) for c in schemas.PACKAGE.names])


def last_per_key(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of every key in the given order; rows without a key are dropped."""
    by = W.partitionBy(key).orderBy(*[F.desc_nulls_last(c) for c in order])
    return rows.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").withColumn("__n", F.row_number().over(by)).filter("__n = 1").drop("__n")
