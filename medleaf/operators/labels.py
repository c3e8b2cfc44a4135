"""Labels from source records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medleaf import schemas
from medleaf.functions.text import blank_to_null, trimmed
from medleaf.operators.products import last_per_key


def labels(records: DataFrame) -> DataFrame:
    """Label rows, with archive and pos, from (archive, pos, record).

    Sections are joined by newlines and trimmed; an empty list gives an empty text. The code arrays come from the
    record's registry part and are empty if it has none.
    """
    registry, none = F.from_json("record.openfda", schemas.OPENFDA), F.array().cast("array<string>")
    columns = {c: trimmed(F.array_join(F.col("record")[c], "\n")) for c in schemas.LABEL_TEXTS}
    columns |= {c: blank_to_null(F.col("record")[c]) for c in [*schemas.LABEL_KEYS, "openfda"]}
    columns |= {c: F.coalesce(registry[c], none) for c in ("product_ndc", "package_ndc")}
    return records.select("archive", "pos", *[columns[c].alias(c) for c in schemas.LABEL.names])


def last_labels(rows: DataFrame) -> DataFrame:
    """One label of every id: the last in the order of archives and positions."""
    return last_per_key(rows, "id", "archive", "pos").drop("archive", "pos")
