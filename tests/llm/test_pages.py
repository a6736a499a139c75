"""Main text of whole pages, and the longest common subsequence against plain dynamic programming."""

import os
import random
import re
from collections import Counter

import pytest
from conftest import SF
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from tablecontract.llm.pages import common_lines, extract, main_text, parse
from tablecontract.llm.urls import host_of, path_of


@settings(max_examples=300, deadline=None)
@given(*[st.lists(st.sampled_from("abcde"), max_size=14)] * 2)
def test_common_lines(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    kept = common_lines(a, b)
    assert len(kept) == best[-1][-1]
    rest = iter(b)
    assert all(any(y == a[i] for y in rest) for i in sorted(kept))


BODY = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>x</article>";</script></head><body>
<header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies</div><div class=ad>Buy</div>
<article class="post"><h1>Head &amp; line</h1><p><b>First   <i>wo</i>rd<br>&lt;tag&gt; &eacute;&#233;&nbsp;x<p>Second 1 < 2<ul><li>item<li>other</ul>
<aside>Related</aside><form><input value="x">Search</form><div id="comments"><p>Reader says</p></div><svg><text>v</text></svg></article>
<div class="sidebar"><p>Side</p></div><section class="comments"><article>Comment</article></section><footer>&copy; x</footer></body></html>"""


def test_what_a_page_is_made_of():
    assert main_text(parse(BODY), None) == "Head & line First word <tag> éé x Second 1 < 2 item other"


def test_without_an_article_shared_lines_go():
    one, two = (parse(f"<body><p>Welcome</p><div>{x}</div><p>text {x}</p><p>All rights</p><nav>menu {x}</nav></body>") for x in "ab")
    assert main_text(one, two) == "a text a" and main_text(one, None) == "Welcome a text a All rights"


@pytest.mark.parametrize("source", ["", "<", "<p", "<p title='x", "</div></p>", "<script>", "<!--", "a<b", "&;&#0;&#xFFFFFFF;", "<article>" * 3000 + "x", "<" * 20_000, "<p a='" * 3000])
def test_broken_pages_end(source):
    assert isinstance(main_text(parse(source), parse(BODY)), str)


def test_rows(spark):
    rows = [(1, "http://A.org/y/1", BODY), (2, "http://a.org/x/2", "<p>Welcome<p>two"), (3, "http://a.org/x/3", "<p>Welcome<p>three"), (3, "http://a.org/x/3", "<p>Welcome<p>three"),
            (4, None, None), (5, "no scheme", ""), (None, "http://b.org", "<p>alone"), (6, "http://c.org/", "<main>" + "<p>long text</p>" * 100_000 + "</main>")]
    frame = spark.createDataFrame([(i, u, h, 5) for i, u, h in rows], "page_id long, url string, html string, N_CHARS int")
    out = extract(frame).collect()
    assert len(out) == len(rows) and out[0].asDict().keys() == {"page_id", "url", "text", "n_chars"} and all(r.n_chars == len(r.text) for r in out)
    text = {r.page_id: r.text for r in out}
    assert text[2] == "two" and text[3] == "three" and text[4] == text[5] == "" and text[None] == "alone" and text[6] == " ".join(["long text"] * 100_000)
    assert extract(frame.limit(0)).count() == 0


def test_given_pages(spark):
    """Every page of the given table has one article."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = {r.page_id: r.text for r in extract(pages).collect()}
    import html

    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<(?!/?(b|a|i)\b)[^>]*>", " ", re.sub(r"</?(b|a|i)\b[^>]*>", "", article))).split())
        assert out[r.page_id] == want
    assert len(out) == pages.count()


def test_random_markup_never_loses_the_row(spark):
    r = random.Random(4)
    parts = ["<p>", "</p>", "<div class='ad'>", "</div>", "<article>", "</article>", "text ", "&amp;", "<!--", "-->", "<br/>", "<b", ">", "'", '"']
    rows = [(i, f"http://h{i % 3}.org/{i}", "".join(r.choice(parts) for _ in range(40))) for i in range(200)]
    assert extract(spark.createDataFrame(rows, "page_id long, url string, html string")).count() == 200


@pytest.mark.parametrize("inside, text", [
    ('<p class="notice">no</p><p>yes</p>', "yes"),
    ('<p>a</p><p hidden>no<p>b', "a b"),
    ('<p class="notice">no<div>yes</div>', "yes"),
    ('<ul><li class="comment"><p>no</p>no<li>yes</ul>', "yes"),
    ('<ul><li class="ad">no<ul><li>no</li></ul>no</li><li>yes</li></ul>', "yes"),
    ('<ul><li class="ad">no</ul>yes', "yes"),
    ('<table><tr><td class="sidebar">no<td>yes<tr><td>more</table>', "yes more"),
    ('<table><tr class="ad"><td>no<td>no<tr><td>yes</table>', "yes"),
    ('yes<article class="related"><p>other story</p></article> more', "yes more"),
])
def test_flat_elements_and_other_stories_inside_an_article(inside, text):
    assert main_text(parse(f"<body><article>{inside}</article><p>out</p></body>"), None) == text


ALONE, TEASER = "<article><h1>News</h1><p>alone {}</p></article>", "<article><h2>Our offer</h2><p>Buy</p></article>"


@pytest.mark.parametrize("page, near, other, text", [
    (ALONE.format(1) + TEASER, ALONE.format(2) + TEASER, None, "News alone 1"),
    ("<main><h1>Blog</h1>" + ALONE.format(1) + "</main>", "<main><h1>Blog</h1>" + ALONE.format(2) + "</main>", None, "News alone 1"),
    (ALONE.format(1) + TEASER, None, None, "News alone 1 Our offer Buy"),
    (ALONE.format(1), "<nav>menu</nav>" + ALONE.format(1), None, "News alone 1"),
    (ALONE.format(1) + TEASER, "<nav>menu</nav>" + ALONE.format(1) + TEASER, ALONE.format(2) + TEASER, "News alone 1"),
    ("<p>Welcome<p>one", "<nav>menu</nav><p>Welcome<p>one", "<p>Welcome<p>two", "one"),
    ("<p>Welcome<p>one", "<nav>menu</nav><p>Welcome<p>one", None, "Welcome one"),
    ("<p>Welcome", "<p>Welcome<p>one", "<p>two", ""),
    ("<p>own" + ALONE.format(1), ALONE.format(2), None, "News alone 1"),
])
def test_the_difference_decides_and_the_markup_checks(page, near, other, text):
    assert main_text(parse(page), near and parse(near), other and parse(other)) == text


def test_articles_that_the_nearest_page_shares_go(spark):
    pages = [(i, f"http://a.org/{i}", ALONE.format(i) + TEASER) for i in range(9)] + [(9, "http://a.org/8/print", "<nav>Print</nav>" + ALONE.format(8) + TEASER)]
    out = {r.page_id: r.text for r in extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    # The last page has only a copy on its host beside it.
    assert out == {i: f"News alone {i}" for i in range(9)} | {9: "News alone 8 Our offer Buy"}


def plain(rows):
    """Text of each row by one walk over all pages in order."""
    keyed = sorted(rows, key=lambda r: r[:4])
    runs = []
    for host, path, tie, hash, html in keyed:
        if not runs or runs[-1][0] != (host, html):
            runs.append(((host, html), []))
        runs[-1][1].append((path, tie))
    out = []
    for i, ((host, html), members) in enumerate(runs):
        for path, tie in members:
            near, depth = None, -1
            for j, k in ((i - 1, -1), (i + 1, 0)):
                if 0 <= j < len(runs) and runs[j][0][0] == host:
                    d = len(os.path.commonprefix([runs[j][1][k][0], path]))
                    if d > depth:
                        near, depth = runs[j][0][1], d
            out.append((tie, main_text(parse(html), near and parse(near))))
    return sorted(out)


def test_hot_keys_and_long_runs_of_copies_are_cut_without_changing_results(spark):
    r = random.Random(9)
    same = "<p>Welcome<p>shared<p>copy"
    rows = [(None, None, "<p>Welcome<p>null")] * 400 + [(i, f"http://a.org/{i:04d}", same) for i in range(300)]
    rows += [(1000 + i, f"http://a.org/{r.randrange(300):04d}/{i}", f"<p>Welcome<p>{r.choice('abc')}<p>own {i % 50}") for i in range(150)]
    rows += [(7, "http://a.org/0100", same)] * 200 + [(9000 + i, f"http://b.org/{i // 9}", f"<p>{i % 4}<p>Welcome") for i in range(60)] + [(8, None, "<p>Welcome<p>other")] * 5
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    keyed = frame.select(
        host_of(F.col("url")), path_of(F.col("url")), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.xxhash64("html"), "html")
    want = plain([tuple(x) for x in keyed.collect()])
    for most in (1, 7, 40):
        out = extract(frame, most_ranges=most, range_bytes=100)
        got = out.withColumn("part", F.spark_partition_id()).collect()
        assert sorted(("" if x.page_id is None else str(x.page_id), x.text) for x in got) == want
        if most == 40:
            assert max(Counter(x.part for x in got).values()) <= 4 * len(rows) / 40
