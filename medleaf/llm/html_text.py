"""Main text of web pages by the distribution of line blocks.

Markup is stripped so that every block element becomes one line. Menus, headers, footers, sidebars, notices, adverts, forms,
comments, scripts and styles are markup and leave blank lines. The text lengths of three neighbouring lines are summed
along the page: the sum surges where the main text begins and dives to zero where it ends, and what lies between is
kept, short lines included. The sums decide on every line of the page, within articles or not. Blank lines are left only
outside an article, so that an advert within one does not cut it (outside, an advert leaves one line, which no window
takes for a dive); lines of a page's only article count double. A line that is all links counts as a menu's if the line
before or behind it is one, too.

Nulls and empty pages give an empty text, pages of any length are read whole (by one task each), rows that repeat give equal
texts, an empty table gives an empty table; columns other than page_id, url and html are not looked at. Markup is
read as browsers do, broken markup too, but a `<` behind a letter that only looks like a one-letter tag is text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.llm.common import table

WINDOW = 3
LINKS = -1  # in place of a region: a line that is all links
SURGE = 86
RAW = frozenset("script style template noscript svg math textarea title iframe object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav footer aside form button select dialog menu fieldset head".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul option".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What the start of one ends another that is open, as its end tag may be left out.
ENDED_BY = {"p": BLOCKS, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "option": frozenset(("option",))}
ADVERTS = frozenset("ad ads adbox adslot advert advertisement advertising promo promoted sponsor sponsored".split())
#: Parts of class, id and role that mark what is not the main text.
MARKS = frozenset(
    "ad ads adbox adslot alert advert advertisement advertising advertorial banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright "
    "disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices paywall popup promo promoted "
    "recommended related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())


def boilerplate(name: str, attrs: str, in_main: bool) -> bool:
    """Whether an element is not main text, by its name, class, id and role."""
    if name in DROPPED or (name == "header" and not in_main):
        return True
    if name in ("html", "body") or not attrs:
        return False
    if in_main and name in HEADINGS:
        return any(key.lower() == "hidden" for key, *_ in ATTRIBUTE.findall(attrs))
    for key, *values in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "role" and value in ROLES:
            return True
        if key in ("class", "id"):
            if name in MAIN:  # "comment" or "teaser related-item", but not "post has-ads"
                if any(re.split("[_-]", word)[0] in MARKS for word in value.split()):
                    return True
                continue
            parts = [value.strip()] if key == "id" and in_main else re.split(r"[\s_-]+", value)
            if any(part in MARKS for part in parts) or (not in_main and "header" in parts):
                return True
    return False


def advert(attrs: str) -> bool:
    return any(part in ADVERTS for key, *values in ATTRIBUTE.findall(attrs) if key.lower() in ("class", "id") for part in re.split(r"[\s_-]+", "".join(values).lower()))


def closes(page: str, at: int, name: str, depth: int) -> bool:
    """Whether `depth` open elements of a name are closed in the rest of the page."""
    for found in TOKEN.finditer(page, at):
        if (found["name"] or found["name2"] or "").lower() == name:
            depth += -1 if found["close"] or found["close2"] else 1
            if depth <= 0:
                return True
    return False


def lines_of(page: str) -> list[tuple[str, int]]:
    """(text, number of the outermost article or main, 0 outside) of every line; outside of articles, markup that is left
    out gives blank lines.
    """
    out: list[tuple[str, int]] = []
    text: list[str] = []
    main = links = 0
    linked = plain = 0
    skipping, depth, inner, whole, region = "", 0, 0, False, 0
    closed: dict[str, bool] = {}
    opened: dict[str, int] = {}  # within what is skipped

    def end_line() -> None:
        nonlocal linked, plain
        line = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if line:
            out.append((line, LINKS if not main and linked > plain else region if main else 0))
        linked = plain = 0

    def blank(lines: int = WINDOW) -> None:
        if not main:
            out.extend([("", 0)] * lines)

    at, end = 0, len(page)
    lower = None
    while at < end:
        found = TOKEN.search(page, at)
        while found and found["attrs"] and len(found["name"]) == 1 and "=" not in found["attrs"] and found.start() and page[found.start() - 1].isalnum():
            found = TOKEN.search(page, found.start() + 1)
        stop = found.start() if found else end
        if stop > at and not skipping:
            piece = page[at:stop]
            text.append(piece)
            if links:
                linked += len(piece.strip())
            else:
                plain += len(piece.strip())
        if not found:
            break
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        close = bool(found["close"] or found["close2"])
        attrs = found["attrs"] or found["attrs2"] or ""
        if name in RAW and not close and not attrs.endswith("/"):
            if lower is None:
                lower = page.lower()
                if len(lower) != end:  # a few letters change their length; keep places
                    lower = re.sub("[A-Z]", lambda m: m[0].lower(), page)
            shut = lower.find(f"</{name}", at)
            at = end if shut < 0 else shut
            continue
        if skipping:
            ended = not close and name in ENDED_BY.get(skipping, ()) or close and name != skipping and name in BLOCKS and skipping in ENDED_BY and opened.get(name, 0) <= 0
            if close and name in MAIN and main and not inner and skipping not in MAIN:
                ended = True  # the article's end ends what is open in it
            opened[name] = opened.get(name, 0) + (-1 if close else 1)
            if ended and depth == 1:
                depth = 0
                skipping = ""
            elif name == skipping:
                depth += -1 if close else 1
            if skipping and depth > 0:
                if name not in MAIN or skipping in MAIN:
                    continue
                if close and inner:
                    inner -= 1
                    continue
                # an article in a menu, sidebar or footer that is closed behind it belongs to that
                if not close and (main or whole or (skipping in DROPPED and closes(page, at, skipping, depth))):
                    inner, whole = inner + 1, True
                    continue
            if skipping:
                skipping = ""
                if depth <= 0:
                    continue
        if close:
            if name in BLOCKS:
                end_line()
            if name == "a":
                links = max(0, links - 1)
            if name in MAIN and main:
                main -= 1
                blank()
            continue
        if name not in VOID and boilerplate(name, attrs, main > 0):
            if name in MAIN and closed.get(name, True):
                closed[name] = closes(page, at, name, 1)
            if name not in MAIN or closed[name]:
                end_line()
                blank(1 if advert(attrs) else WINDOW)
                skipping, depth, inner, whole = name, 1, 0, False
                opened.clear()
                continue
        if name in BLOCKS:
            end_line()
            links = 0
        if name in MAIN:
            blank()
            region += main == 0
            main += 1
        elif name == "a":
            links += 1
        elif name == "br":
            text.append(" ")
    end_line()
    return without_menus(out)


def without_menus(lines: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Lines of links blanked, but for one alone between lines of text."""
    texts = [k for k, (t, _) in enumerate(lines) if t]
    out: list[tuple[str, int]] = []
    lone = {k for before, k, after in zip(texts, texts[1:], texts[2:], strict=False) if lines[k][1] == LINKS and lines[before][1] != LINKS != lines[after][1] and (before, after) == (k - 1, k + 1)}
    for k, (t, region) in enumerate(lines):
        if region != LINKS:
            out.append((t, region))
        elif k in lone:
            out.append((t, 0))
        else:
            out.extend([("", 0)] * WINDOW)
    return out


def main_text(page: str | None) -> str:
    """The blocks of the main text, joined by blank lines; empty if there is none.

    Lines of the only article or main count double: several are as often teasers or comments. A page whose sums never
    reach SURGE is cut at its highest sum instead.
    """
    lines = lines_of(page or "")
    double = len({region for _, region in lines if region}) == 1
    lengths = [len(t) * (2 if double and region else 1) for t, region in lines]
    sums = [sum(lengths[k : k + WINDOW]) for k in range(len(lengths))]
    surge = min(SURGE, max(sums, default=0))
    kept: list[str] = []
    k = 0
    while k < len(lines):
        if not sums[k]:
            k += 1
            continue
        dive = k
        while dive < len(lines) and sums[dive]:
            dive += 1
        if max(sums[k:dive]) >= surge:
            kept += [t for t, _ in lines[k:dive] if t]
        k = dive
    return "\n\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row; null html gives an empty text, other columns are not looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(t) for t in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op9_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))
