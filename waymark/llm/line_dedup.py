"""Line dedup by site-relative frequency.

Lines that many pages of one site share are its boilerplate: menus, footers, notices. Per
host, the number of pages that hold a line is divided by the number of the host's pages, and
lines above a ratio are dropped from that host's pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.shared import ascii_lower, stored

RATIO = 0.2
# A line is boilerplate only if at least this many pages of the host hold it.
LEAST_PAGES = 3

# How markup becomes lines of text. Scripts, styles and comments go, tags that
# begin or end a block become line ends, the other tags go.
HIDDEN = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
BLOCK_TAGS = (
    r"(?i)</?(title|head|body|html|nav|ul|ol|li|div|p|h[1-6]|article|header|footer|section|"
    r"table|tr|td|th|br|main|aside|form|blockquote|pre)\b[^>]*>"
)
OTHER_TAGS = r"<[^>]*>"
# The same parts, tried only where a tag begins.
_HIDDEN = r"(?is)<(?:script.*?</script>|style.*?</style>|!--.*?-->)"
# Runs of white space but for a single space.
WHITE = r"\x20[\x20\x09\x0B-\x0D]+|[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)"


def host_of(url: Column) -> Column:
    """The host in lower case, empty where the address has none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


# What opens a hidden part and what closes it. An opening after the last closing of its kind
# opens nothing, but a pattern would look for the closing from each such opening to the end of
# the page; so they are set apart by a character that is never in a text, while patterns run.
_HIDDEN_ENDS = (("<!--", "-->"), ("<script", "</script>"), ("<style", "</style>"))
_APART = "\uFFFF"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _set_apart(opening: str, closing: str) -> Callable[[Column], Column]:
    def apart(t: Column) -> Column:
        tail = F.length(F.substring_index(ascii_lower(t), closing, -1))
        marked = F.regexp_replace(F.right(t, tail), f"(?i)<(?={opening[1:]})", f"<{_APART}")
        return F.when(
            F.contains(F.right(ascii_lower(t), tail), F.lit(opening)),
            F.concat(F.left(t, F.length(t) - tail), marked),
        ).otherwise(t)

    return apart


def _without_hidden(text: Column) -> Column:
    """Scripts, styles and comments taken out, in time that grows with the text alone."""
    for opening, closing in _HIDDEN_ENDS:
        text = _once(text, _set_apart(opening, closing))
    hidden = F.regexp_replace(text, _HIDDEN, "")
    return _once(hidden, lambda t: F.when(
        F.contains(t, F.lit(f"<{_APART}")), F.replace(t, F.lit(f"<{_APART}"), F.lit("<"))
    ).otherwise(t))


def _without_tags(text: Column) -> Column:
    """Tags taken out; what stands after the last end of a tag holds none."""
    def plainly(t: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(t, BLOCK_TAGS, "\n"), OTHER_TAGS, "")

    def cut(t: Column) -> Column:
        tail = F.length(F.substring_index(t, ">", -1))
        return F.concat(plainly(F.left(t, F.length(t) - tail)), F.right(t, tail))

    open_tail = lambda t: F.contains(F.substring_index(t, ">", -1), F.lit("<"))
    return _once(text, lambda t: F.when(open_tail(t), cut(t)).otherwise(plainly(t)))


def html_lines(html: Column) -> Column:
    """The lines of text of a page: white space closed up, empty lines left out."""
    page = F.coalesce(html, F.lit(""))
    lowered = F.lower(page)
    # Whether anything may be opened and not closed; most pages are spared the closer look.
    broken = F.lit(False)
    for opening, closing in _HIDDEN_ENDS:
        broken = broken | F.contains(F.substring_index(lowered, closing, -1), F.lit(opening))
    text = _without_tags(
        F.when(broken, _without_hidden(page)).otherwise(F.regexp_replace(page, _HIDDEN, ""))
    )
    # A lone space is left as it is, and the spaces beside a line end go with the trimming.
    lines = F.split(F.regexp_replace(text, WHITE, " "), "\n")
    return F.array_remove(F.transform(lines, lambda line: F.trim(line)), "")


def dedup_lines(
    pages: DataFrame,
    lines: Column | None = None,
    host: Column | None = None,
    key: str = "page_id",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """``key, host, lines, kept``: each page's lines before and after.

    ``lines`` and ``host`` are expressions over ``pages``; by default the lines of ``html``
    and the host of ``url``. A page counts once per line however often it repeats it, and rows
    that repeat in key, host and lines are one page in the counts but are each returned. Pages
    without a host form a site of their own. Null pages have no lines. Other columns are
    ignored.
    """
    lines = html_lines(F.col("html")) if lines is None else lines
    host = host_of(F.col("url")) if host is None else host
    cut = pages.select(
        F.col(key).alias("page"), F.coalesce(host, F.lit("")).alias("host"),
        F.explode(F.array(F.coalesce(lines, F.array().cast("array<string>")))).alias("lines"),
    )
    cut = cut.select(
        "*", F.xxhash64("lines").alias("k1"), F.xxhash64("page", "host", F.lit("page")).alias("k2")
    )
    cut = stored(cut, "lines")
    totals = cut.select("host", "k1", "k2").distinct().groupBy("host").agg(
        F.count(F.lit(1)).alias("pages")
    )
    # 128 bits of hash stand for a line; each page names each of its lines once.
    mark = F.transform(
        "lines", lambda x: F.struct(F.xxhash64(x).alias("h1"), F.hash(x).alias("h2"),
                                    F.length(x).alias("h3"))
    )
    named = cut.select("host", "k1", "k2", F.explode(F.array_distinct(mark)).alias("line"))
    # Pages first, lines second: a line of every page of a large site is spread by page.
    held = (
        named.distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_pages)
    )
    boilerplate = held.join(totals, "host").where(F.col("n") > ratio * F.col("pages"))
    dropped = (
        named.join(boilerplate.select("host", "line"), ["host", "line"])
        .groupBy("k1", "k2").agg(F.collect_set("line").alias("dropped"))
    )
    found = cut.join(dropped, ["k1", "k2"], "left").withColumn("mark", mark)
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(
        F.transform(
            F.filter(
                F.arrays_zip("lines", "mark"),
                lambda x: ~F.array_contains("dropped", x["mark"]),
            ),
            lambda x: x["lines"],
        )
    )
    return found.select(F.col("page").alias(key), "host", "lines", kept.alias("kept"))
