"""H2 selector records against hand-written expectations."""

import pytest
from pyspark.sql import functions as F

from leadforge.functions.select import css, raw_text, sel, select
from leadforge.operators.dom import parse_pages

HTML = """<html><body>
<div class="pagination"><a rel="next" href="/p2">More</a><span class="next" href="/p3">n</span></div>
<span data-v class="vis-flag de"></span><span data-v>Deutschland</span>
<i class="vis-flag"></i><b>x</b><span>Espa&ntilde;a</span>
<a href="/companies/x.html" class="card-title">Cat</a><a href="/companies/pg-2.html">Next page</a>
<ul><li><a href="/a">A</a></li></ul>
</body></html>"""


@pytest.fixture(scope="module")
def dom(spark):
    return parse_pages(spark.createDataFrame([("u", HTML)], "url string, html string")).cache()


def ids(dom, s):
    return dom.select(F.transform(select(s), lambda e: e["id"])).first()[0]


def texts(dom, s):
    return dom.select(F.transform(select(s), lambda e: raw_text(e))).first()[0]


def test_descendant_and_attr(dom):
    assert texts(dom, sel("a", attrs=[("rel", "=", "next")], inside=sel(cls="pagination"))) == ["More"]
    assert texts(dom, sel(cls="next", inside=sel(cls="pagination"))) == ["n"]
    assert texts(dom, sel("a", inside=sel("li", inside=sel("ul")))) == ["A"]


def test_adjacent_sibling_and_not(dom):
    assert texts(dom, sel("span", attrs=[("data-v",)], after=sel("span", attrs=[("data-v",)]))) == ["Deutschland"]
    assert texts(dom, sel("span", after=sel(cls="vis-flag"))) == ["Deutschland"]   # <i> is followed by <b>
    assert texts(dom, sel("span", attrs=[("data-v",)], nots=[sel(attrs=[("class", "*=", "flag")])])) == ["Deutschland"]


def test_contains_prefix_suffix(dom):
    assert texts(dom, sel("a", contains="Next")) == ["Next page"]
    assert texts(dom, sel("a", attrs=[("href", "^=", "/companies/"), ("href", "$=", ".html")])) == ["Cat", "Next page"]
    assert texts(dom, sel("a", attrs=[("href", "*=", "pg-")])) == ["Next page"]


def test_union_is_document_order_and_distinct(dom):
    s = (sel("a", cls="card-title"), sel("a"), sel("span", contains="Espa"))
    got = texts(dom, s)
    assert got == ["More", "España", "Cat", "Next page", "A"]


def test_css_render():
    s = (sel("a", attrs=[("href", "*=", "/companies/")], inside=sel(cls="card")), sel("a", cls="x"))
    assert css(s) == '.card a[href*="/companies/"], a.x'


def test_nested_descendant_chain(spark):
    html = "<div class='a'><div class='b'><p><i>1</i></p></div></div><div class='b'><i>2</i></div><p><i>3</i></p>"
    dom = parse_pages(spark.createDataFrame([("u", html)], "url string, html string"))
    s = sel("i", inside=sel("p", inside=sel(cls="b", inside=sel(cls="a"))))
    assert texts(dom, s) == ["1"]
    assert texts(dom, (sel("i", inside=sel(cls="b")), sel("i", inside=sel("p")))) == ["1", "2", "3"]


def test_deep_unclosed_nesting_stays_linear(spark):
    html = "<div>" + "<p>x" * 3000 + "<a href='/z'>z</a>"
    dom = parse_pages(spark.createDataFrame([("u", html)], "url string, html string"))
    assert texts(dom, sel("a", inside=sel("div"))) == ["z"]


def test_shared_inner_selector_in_comma_list(spark):
    html = "<div class='card'><h3><a href='/x'>h3</a></h3><h2><a href='/y'>h2</a></h2></div><h2><a href='/z'>out</a></h2>"
    dom = parse_pages(spark.createDataFrame([("u", html)], "url string, html string"))
    card = sel(cls="card")
    s = (sel("a", inside=sel(cls="card-header")), sel("a", inside=sel("h3", inside=card)), sel("a", inside=sel("h2", inside=card)))
    assert texts(dom, s) == ["h3", "h2"]


def test_many_selectors_at_once_equal_one_by_one(spark):
    from leadforge.functions.select import select_many
    from leadforge.operators.audit import AUDIT_SELECTORS, PAGINATION_PROBES

    html = ('<main class="content"><div class="card"><h2><a href="/companies/x.html">X</a></h2><a class="card-title" href="/companies/pg-2.html">Next</a></div>'
            '<ul class="listing"><li><a href="https://www.europages.co.uk/companies/y.html" data-company="1">Y</a></li></ul></main>'
            '<div id="content"><a href="/companies/z.html">Z</a><span class="next">n</span></div><a rel="next" href="/page/3">3</a>')
    dom = parse_pages(spark.createDataFrame([("u", html), ("v", ""), ("w", None)], "url string, html string"))
    sels = [s for _, s in AUDIT_SELECTORS] + PAGINATION_PROBES + [sel("a", contains="Next"), sel("a", contains="none"), (sel("a"), sel("span"))]
    ids = lambda hits: None if hits is None else [e["id"] for e in hits]
    many = {r["url"]: r["h"] and [ids(x) for x in r["h"]] for r in dom.select("url", select_many(sels).alias("h")).collect()}
    single = {r["url"]: [ids(x) for x in r[1:]] for r in dom.select("url", *(select(s) for s in sels)).collect()}
    assert many["u"] == single["u"] and sum(map(bool, many["u"])) >= 15 and many["v"] == single["v"]
    passes = lambda *cols: dom.select(*cols)._jdf.queryExecution().optimizedPlan().toString().count("filter(elems#")
    audit = [s for _, s in AUDIT_SELECTORS]
    # One list of anchors for 21 selectors; flags of enclosing matches stand once.
    assert 2 * passes(select_many(audit).alias("h")) < passes(*(select(s).alias(f"s{i}") for i, s in enumerate(audit)))
