"""Text rules as column functions. White space means Unicode white space throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE, EDGES = r"(?U)\s+", r"(?U)^\s+|\s+$"
SHORTEST_TERM, BEFORE, AFTER, WHOLE = 4, 180, 320, 500


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, EDGES, "")


def squeezed(c: Column) -> Column:
    """Trimmed, runs of white space as one space."""
    return trimmed(F.regexp_replace(c, SPACE, " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normal_term(c: Column) -> Column:
    return F.regexp_replace(F.lower(trimmed(F.coalesce(c, F.lit("")))), SPACE, " ")


def search_text(c: Column) -> Column:
    """Text to look terms up in: lower case, runs of white space as one space."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), SPACE, " ")


def holds_term(text: Column, term: Column) -> Column:
    """Whether a normal term stands in a search text with no letter or digit beside it; short terms never do.

    The plain search comes first, so that few rows reach the pattern.
    """
    quoted = F.concat(F.lit(r"(?<![a-z0-9])\Q"), F.replace(term, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![a-z0-9])"))
    return (F.length(term) >= SHORTEST_TERM) & F.contains(text, term) & F.regexp_like(text, quoted)


def excerpt(text: Column, needle: Column) -> Column:
    """What stands around the first occurrence of needle, whatever its case; the start of the text if there is none."""
    clean = squeezed(F.coalesce(text, F.lit("")))
    at = F.instr(F.lower(clean), F.lower(needle)) - 1
    start = F.greatest(at - BEFORE, F.lit(0))
    end = F.least(at + F.length(needle) + AFTER, F.length(clean))
    return F.when(at < 0, F.substring(clean, F.lit(1), F.lit(WHOLE))).otherwise(F.substring(clean, start + 1, end - start))


def joined_hash(*parts: Column) -> Column:
    """SHA-1 of the parts joined by bars, nulls as empty."""
    return F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def redacted(c: Column) -> Column:
    """A URL as its host and last path part; other texts cut at 256 characters."""
    host = F.try_parse_url(c, F.lit("HOST"))
    tail = F.element_at(F.split(F.coalesce(F.try_parse_url(c, F.lit("PATH")), F.lit("")), "/"), -1)
    return F.when(host.isNull(), F.substring(c, 1, 256)).when(tail == "", host).otherwise(F.concat_ws("/", host, tail))


def display_name(brand: Column, generic: Column) -> Column:
    """The brand if both names are there and differ; else the generic name, else the brand, else empty."""
    both = (F.coalesce(brand, F.lit("")) != "") & (F.coalesce(generic, F.lit("")) != "")
    return F.when(both & (F.lower(brand) != F.lower(generic)), brand).otherwise(F.coalesce(blank_to_null(generic), blank_to_null(brand), F.lit("")))
