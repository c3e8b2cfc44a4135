"""Rows as JSON texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def temporal_to_text(c: Column, kind: T.DataType) -> Column:
    """Dates and timestamps in ISO form with a Z, at any depth; microseconds only where there are some."""
    if isinstance(kind, T.DateType):
        return F.concat(F.date_format(c, "yyyy-MM-dd"), F.lit("Z"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        fraction = F.date_format(c, "SSSSSS")
        return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction == "000000", "").otherwise(F.concat(F.lit("."), fraction)), F.lit("Z"))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: temporal_to_text(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, x: temporal_to_text(x, kind.valueType))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[temporal_to_text(c[f.name], f.dataType).alias(f.name) for f in kind]))
    return c


def json_rows(df: DataFrame, exclude: tuple[str, ...] = (), computed: dict[str, Column] | None = None, name: str = "json") -> DataFrame:
    """One JSON text for each row, with all columns but the excluded ones, and computed ones added. Nulls are written."""
    fields = {f.name: temporal_to_text(F.col(f"`{f.name}`"), f.dataType) for f in df.schema} | (computed or {})
    row = F.struct(*[c.alias(k) for k, c in fields.items() if k not in exclude])
    return df.select("*", F.to_json(row, {"ignoreNullFields": "false"}).alias(name))
