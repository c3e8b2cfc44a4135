"""Dates in free text, as column functions: the shapes that people write, with other words around them.

Month comes before day where both orders are possible. What stands first in this list decides:

    20240105 (also with a time behind it), 240105      2024-1-5, 2024/01/05, 2024.1.5, 2024-Jan-5
    5 Jan 2024, 5th of January, 2024, 05-JAN-24        Jan. 5th, 2024, January 5 24
    1/5/2024, 1-5-24, 13.5.2024 (day first, as 13 is no month), 99-1-5
    January 2024, 1/2024, 2024-01                      Jan 5, 5 Jan       2024

Times of day are passed over. Parts that are not given are those of `today`, a day beyond the month's end is its last one;
without a `today`, such texts give null. So do texts with none of these shapes and dates that do not exist.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

MISSING = -1
NAME = r"(?<![a-z])(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)(?![a-z])\.?"
TIME = r"(?:(?<=\d)t|\bat\b)?\s*(?<![\d.])\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?\s*(?:[ap]\.?m\b\.?)?(?:\s*(?:z|utc|gmt)\b|\s*[+-]\d{2}:?\d{2}\b)?"
DAY, YEAR, GAP = r"(?<!\d)(\d{1,2})(?:st|nd|rd|th)?(?!\d)", r"'?(?<!\d)(\d{4}|\d{2})(?!\d)", r"[\s,./-]*"

#: (pattern, its parts as `year|month|day`, where none is a part that is not given and M the month that is named).
SHAPES = (
    (r"(?<!\d)(\d{4})(\d{2})(\d{2})(?:\d{4}|\d{6})?(?!\d)", "$1|$2|$3"),
    (r"(?<!\d)(\d{2})(\d{2})(\d{2})(?!\d)", "$1|$2|$3"),
    (rf"(?<!\d)(\d{{4}}){GAP}{NAME}{GAP}{DAY}", "$1|M|$2"),
    (rf"(?<!\d)(\d{{4}})(?:-(\d{{1,2}})-|/(\d{{1,2}})/|\.(\d{{1,2}})\.|\s(\d{{1,2}})\s){DAY}", "$1|$2$3$4$5|$6"),
    (rf"{DAY}{GAP}(?:of\s+)?{NAME}{GAP}{YEAR}", "$2|M|$1"),
    (rf"{NAME}{GAP}{DAY}[\s,./-]+{YEAR}", "$2|M|$1"),
    (r"(?<!\d)(3[2-9]|[4-9]\d)([-/.])(\d{1,2})\2(\d{1,2})(?!\d)", "$1|$3|$4"),
    (rf"(?<!\d)(\d{{1,2}})(?:-(\d{{1,2}})-|/(\d{{1,2}})/|\.(\d{{1,2}})\.|\s(\d{{1,2}})\s){YEAR}", "$6|$1|$2$3$4$5"),
    (rf"{NAME}{GAP}(?<!\d)(\d{{4}})(?!\d)", "$1|M|none"),
    (rf"(?<!\d)(\d{{4}}){GAP}{NAME}", "$1|M|none"),
    (r"(?<!\d)(\d{1,2})[-/.](\d{4})(?!\d)", "$2|$1|none"),
    (r"(?<!\d)(\d{4})[-/.](\d{1,2})(?!\d)", "$1|$2|none"),
    (rf"{NAME}{GAP}{DAY}", "none|M|$1"),
    (rf"{DAY}{GAP}(?:of\s+)?{NAME}", "none|M|$1"),
    (r"(?<!\d)(\d{4})(?!\d)", "$1|none|none"),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def parsed_date(c: Column, today: Column | None = None) -> Column:
    """The date that a text names; null if it names none."""
    named = _let(F.regexp_replace(F.lower(c), TIME, " "), lambda text: _let(F.split(_found(text), r"\|"), lambda parts: _from_parts(text, parts, today)))
    return F.when(c.rlike(r"^\d{8}$"), F.try_to_date(c, "yyyyMMdd")).otherwise(named)


def _found(text: Column) -> Column:
    """The parts of the first shape that a text has."""
    out = F.lit(None).cast("string")
    for shape, parts in reversed(SHAPES):
        out = F.when(text.rlike(shape), F.regexp_replace(text, f"(?s)^.*?(?:{shape}).*$", parts)).otherwise(out)
    return out


def _from_parts(text: Column, parts: Column, today: Column | None) -> Column:
    part = lambda k: F.try_element_at(parts, F.lit(k))
    number = lambda k: F.when(part(k) == "none", MISSING).otherwise(part(k).try_cast("int"))
    named = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(F.regexp_extract(text, NAME, 0), 1, 3)).cast("int")
    month = F.when(part(2) == "M", named).otherwise(number(2))
    read = F.struct(number(1).alias("year"), month.alias("month"), number(3).alias("day"), (F.length(part(1)) <= 2).alias("short"))

    def ordered(d: Column) -> Column:
        # 99-1-5: what cannot be a month or a day is the year; 13.5.2024: what cannot be a month is the day
        moved = F.struct(d["month"].alias("year"), d["day"].alias("month"), d["year"].alias("day"), F.lit(True).alias("short"))
        swapped = F.struct(d["year"].alias("year"), d["day"].alias("month"), d["month"].alias("day"), d["short"].alias("short"))
        return F.when((d["month"] > 31) & d["year"].between(0, 31), moved).when((d["month"] > 12) & d["day"].between(1, 12), swapped).otherwise(d)

    return _let(_let(read, ordered), lambda d: _date(d["year"], d["month"], d["day"], d["short"], today))


def _date(year: Column, month: Column, day: Column, short: Column, today: Column | None) -> Column:
    now = F.lit(None).cast("date") if today is None else today
    if today is None:
        full = F.when(year < 69, 2000 + year).otherwise(1900 + year)
    else:  # the year of that ending within 50 years of today
        near = F.floor(F.year(now) / 100) * 100 + year
        full = F.when(near >= F.year(now) + 50, near - 100).when(near < F.year(now) - 50, near + 100).otherwise(near)
    year = F.when(year == MISSING, F.year(now)).when(short, full).otherwise(year).cast("int")
    month = F.when(month == MISSING, F.month(now)).otherwise(month)
    text = lambda y, m, d: F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))

    def made(d: Column) -> Column:
        start = F.try_to_date(text(d["y"], d["m"], F.lit(1)), "yyyy-MM-dd")
        part = F.when(now.isNotNull(), F.date_add(start, F.least(F.day(now), F.day(F.last_day(start))) - 1))
        return F.when(d["y"].isNull() | d["m"].isNull(), None).when(d["d"] == MISSING, part).otherwise(F.try_to_date(text(d["y"], d["m"], d["d"]), "yyyy-MM-dd"))

    return _let(F.struct(year.alias("y"), month.alias("m"), day.alias("d")), made)
