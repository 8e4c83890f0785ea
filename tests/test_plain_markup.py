"""The parser's path for plain markup; visits of the early stop computed once."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from leadforge.operators import dom
from leadforge.operators.emails import site_emails

BITS = ['<a href="x">', '<A HREF="/q" Class="a b">', "</a>", "<p>", "</P>", "text", "&amp;", "a &lt b", "&", "&#1;", "<br>", "<br/>", "<br />", "<script>", "</script>",
        'var a="&amp;";', "<style>", "</style>", "<title>", "</title>", "<textarea>", "</textarea>", "<!-- x -->", "<!--a-b-->", "<!---->", "<!DOCTYPE html>",
        "<?pi>", "<![CDATA[x]]>", "< ", "<", ">", '"', "<i a='1'>", "<i a=1>", '<i a="x&amp;y">', '<i a b="1" a="2">', "<pre>", " \n ", "</pre>", "<template>",
        "</template>", "<li", '<b x="1"y="2">', "é ", "</ p>", "<svg:x>", "<x-y>", '<i data-v-1 class="q">', '<i\ta="1"\n>', "\x00", "<xmp>", "</xmp>", "<span>", "</span>"]


def _slowly(html):
    plain, dom._plain_tokens = dom._plain_tokens, lambda _: None
    try:
        return dom.parse_html(html)
    finally:
        dom._plain_tokens = plain


def test_plain_markup_is_read_as_the_tokenizer_reads_it():
    r, plain = random.Random(5), 0
    for _ in range(20_000):
        html = "".join(r.choice(BITS) for _ in range(r.randint(1, 9)))
        plain += dom._plain_tokens(html) is not None
        assert dom.parse_html(html) == _slowly(html), html
    assert plain > 1000


def test_plain_page_does_not_go_through_the_tokenizer(monkeypatch):
    monkeypatch.setattr(dom._TreeBuilder, "feed", None)
    text, stext, elems = dom.parse_html('<!DOCTYPE html>\n<html><head><title>A &amp; b</title></head><body><a class="x y" href="/c">C</a></body></html>')
    assert stext == "A & bC" and [e["tag"] for e in elems] == ["html", "head", "title", "body", "a"] and elems[-1]["cls"] == ["x", "y"]


def test_visits_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [("s", r, f"{r}{i}@x.com") for r in range(4) for i in range(3)] + [("t", 0, None), ("t", 1, "a@x.com")]
    visits = spark.createDataFrame(rows, "site string, rank int, email string").mapInArrow(counted, "site string, rank int, email string")
    got = site_emails(visits, ["site"]).orderBy("site", "first_rank", F.col("email").asc_nulls_first()).collect()
    assert [tuple(x) for x in got if x.site == "s"] == [("s", f"{r}{i}@x.com", r) for r in range(2) for i in range(3)]
    assert [tuple(x) for x in got if x.site == "t"] == [("t", None, 0), ("t", "a@x.com", 1)]
    assert seen.value == len(rows)
