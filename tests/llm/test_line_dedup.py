import random
import time
from collections import defaultdict

import plain
import pytest
from pyspark.sql import functions as F

from waymark.llm.line_dedup import (
    BLOCK_TAGS,
    HIDDEN,
    OTHER_TAGS,
    dedup_lines,
    host_of,
    html_lines,
)

PAGES = "page_id long, url string, html string, host string, lines string"


def test_lines_and_hosts(spark):
    page = (
        "<html><head><title>T &amp; x</title><script>a\nb</script></head><body><!-- c\nd -->"
        "<p>one <b>two</b>\tthree</p><DIV class='x'>four<br/>five\n  \nsix</DIV></body></html>"
    )
    df = spark.createDataFrame(
        [(page, "HTTPS://Www.Example.com:80/x?y"), (None, None), ("", "no address"), ("a", "ftp://h")],
        "html string, url string",
    )
    found = df.select(html_lines(F.col("html")).alias("l"), host_of(F.col("url")).alias("h"))
    assert [tuple(r) for r in found.collect()] == [
        (["T &amp; x", "one two three", "four", "five", "six"], "www.example.com"),
        ([], ""), ([], ""), (["a"], "h"),
    ]


def expected(rows, ratio, least):
    pages, holding = defaultdict(set), defaultdict(set)
    for page, host, lines in rows:
        pages[host].add((page, tuple(lines)))
        for line in lines:
            holding[host, line].add((page, tuple(lines)))
    gone = {
        (h, line) for (h, line), held in holding.items()
        if len(held) >= least and len(held) > ratio * len(pages[h])
    }
    return sorted(str((p, h, lines, [x for x in lines if (h, x) not in gone]))
                  for p, h, lines in rows)


def test_equals_brute_force(spark):
    rows = [(n, "a.org", ["menu", f"text {n}", "menu", "rare" if n % 9 == 0 else "", "foot"])
            for n in range(40)]
    rows += [(n, f"b{n % 2}.org", ["menu", f"text {n}"]) for n in range(5)]
    rows += [(1, "c.org", ["x"]), (1, "c.org", ["x"]), (None, "c.org", ["x"]), (2, "", [])]
    df = spark.createDataFrame(rows, "page_id long, host string, lines array<string>")
    for ratio, least in ((0.2, 3), (0.0, 1), (0.5, 2)):
        found = dedup_lines(df, F.col("lines"), F.col("host"), ratio=ratio, least_pages=least)
        assert plain.as_text(found) == expected(rows, ratio, least)


def test_odd_pages(spark):
    rows = [(1, None, None, "x", "x"), (None, "http://h/", "<p>a", "x", "x"),
            (3, "http://h/", "", "x", "x"), (3, "http://h/", "", "x", "x"), (4, "?", "<p>a", "x", "x")]
    found = dedup_lines(spark.createDataFrame(rows, PAGES))
    assert [r.kept for r in found.orderBy("page_id").collect()] == [["a"], [], [], [], ["a"]]
    assert dedup_lines(spark.createDataFrame([], PAGES)).count() == 0


def test_broken_markup_reads_as_the_patterns_say(spark):
    dice = random.Random(4)
    parts = ["<!--", "-->", "<script", "</script>", "<STYLE>", "</Style>", "<p>", "a", " b\n", ">",
             "<", "<div", "</sCript>", "<Script x>", "<!-->", "é", "İ", "<br/>"]
    pages = ["".join(dice.choices(parts, k=dice.randrange(14))) for _ in range(1_500)]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    plainly = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        "html", HIDDEN, ""), BLOCK_TAGS, "\n"), OTHER_TAGS, "")
    lines = F.split(F.regexp_replace(plainly, r"[\x20\x09\x0B-\x0D]+", " "), r"\x20?\n\x20?")
    wanted = F.array_remove(F.transform(lines, lambda line: F.trim(line)), "")
    for r in df.select("html", html_lines(F.col("html")).alias("own"), wanted.alias("wanted")).collect():
        assert r.own == r.wanted, r.html


@pytest.mark.parametrize("part", ["<!-- open ", "<script> x ", "<style ", "<div ", "< ", "<!-->"])
def test_megabytes_of_what_is_never_closed(spark, part):
    page = "<p>start</p>" + part * (1_000_000 // len(part))
    begin = time.monotonic()
    found = spark.createDataFrame([(page,)], "html string").select(
        F.get(html_lines(F.col("html")), F.lit(0)).alias("first")).first()
    assert found.first == "start" and time.monotonic() - begin < 10


def test_white_space_is_closed_up_without_touching_single_spaces(spark):
    """A lone space, the most frequent of all, is no match; the lines are those of closing up
    every run and cutting at line ends with their spaces."""
    from waymark.llm.line_dedup import WHITE

    dice = random.Random(6)
    texts = ["".join(dice.choices("ab \t\n\r\x0b\x0c ", k=40)) for _ in range(300)]
    texts += ["one two three", " \n \n ", "", "\n", " a  b \n c"]
    page = F.col("t")
    plainly = F.split(F.regexp_replace(page, r"[\x20\x09\x0B-\x0D]+", " "), r"\x20?\n\x20?")
    plainly = F.array_remove(F.transform(plainly, lambda x: F.trim(x)), "")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(~html_lines(page).eqNullSafe(plainly)).count() == 0
    one = spark.createDataFrame([("one two three",)], "t string")
    assert one.select(F.regexp_count(page, F.lit(WHITE))).first()[0] == 0
