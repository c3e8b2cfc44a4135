"""Rules for product and package fields as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medleaf.functions.text import blank_to_null, trimmed

#: Fixed value: how packages are described.
DESCRIPTION = r"^(\d+) (.*?) in (\d+) (.*?) \(\d+-\d+-\d+\)"


def falsy_to_null(c: Column, kind: T.DataType) -> Column:
    """Empty texts and arrays, zeros, false and empty JSON objects as null."""
    if isinstance(kind, T.StringType):
        return blank_to_null(c)
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.when(F.size(c) > 0, c)
    if isinstance(kind, T.BooleanType):
        return F.when(c, c)
    if isinstance(kind, T.NumericType):
        return F.nullif(c, F.lit(0).cast(kind))
    return c


def over_the_counter(category: Column, product_type: Column, source_types: Column) -> Column:
    """True, false or null (not said) from the marketing category, the product type and the source's own types."""
    own = F.array_join(F.coalesce(source_types, F.array().cast("array<string>")), " ")
    parts = [blank_to_null(F.lower(trimmed(F.coalesce(p, F.lit(""))))) for p in (category, product_type, own)]
    said = F.concat_ws(" ", *parts)
    return (
        F.when(said == "", None)
        .when(said.contains("otc") | said.contains("over-the-counter") | said.contains("over the counter"), True)
        .when(said.contains("prescription") | F.concat(F.lit(" "), said, F.lit(" ")).contains(" rx "), False)
    )


def short_form(dosage_form: Column) -> Column:
    return F.split_part(dosage_form, F.lit(","), F.lit(1))


def full_package_code(code: Column, product_code: Column) -> Column:
    return F.when(F.length(code) < 12, F.concat(product_code, F.lit("-"), code)).otherwise(code)


def eleven_digits(code: Column) -> Column:
    """The code without hyphens; if these are not 11 digits, one segment that is short by one gets a zero: the first of
    a first segment of 4, a second of 3, a third of 1.
    """
    part = F.split(code, "-")
    first, second, third = (F.try_element_at(part, F.lit(k)) for k in (1, 2, 3))
    plain = F.array_join(part, "")
    rest = F.array_join(F.slice(part, 4, 1000), "")
    padded = (
        F.when(F.length(first) == 4, F.concat(F.lit("0"), plain))
        .when(F.length(second) == 3, F.concat(first, F.lit("0"), second, F.coalesce(third, F.lit("")), rest))
        .when(F.length(third) == 1, F.concat(first, second, F.lit("0"), third, rest))
        .otherwise(plain)
    )
    return F.when(F.length(plain) == 11, plain).otherwise(padded)


def described(description: Column, dosage_form: Column) -> dict[str, Column]:
    """size, size_extra, packages_number and package_format of a description; all null if it reads otherwise."""
    parts = F.split(F.regexp_replace(description, DESCRIPTION + r"[\s\S]*$", "$1\0$2\0$3\0$4"), "\0")
    found = (F.size(parts) == 4) & F.substring(parts[0], 1, 1).between("0", "9")
    size, extra, number, form = (parts[k] for k in range(4))
    return {
        "size": F.when(found, size.try_cast("long")),
        "size_extra": F.when(found, F.when(extra == dosage_form, F.lit("")).otherwise(extra)),
        "packages_number": F.when(found, number.try_cast("long")),
        "package_format": F.when(found, form),
    }
