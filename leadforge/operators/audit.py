"""Q1-Q7: selector coverage audit of listing pages, one projection per page.

All 21 audit selectors are evaluated on the same DOM row, in buckets by tag
(``select_many``): a page's elements are read once, its anchors by the selectors
of anchors.  Results are unpivoted with their place in the list as ``sel_pos``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.select import Selector, css, sel, select, select_many, strip_text, within

L = sel("a", attrs=[("href", "*=", "/companies/")])


def _in(s: Selector, outer: Selector) -> Selector:
    from dataclasses import replace

    return replace(s, inside=outer)


def _a_in_or_with(cls: str) -> tuple:
    return (sel("a", inside=sel(cls=cls)), sel("a", cls=cls))


AUDIT_SELECTORS: list[tuple[str, Selector]] = [
    ("original", sel("a", attrs=[("href", "*=", "/companies/"), ("href", "*=", ".html")],
                     nots=[sel(attrs=[("href", "*=", "pg-")])])),
    ("company_title", (sel("a", cls="company-title"), sel("a", inside=sel(cls="company-title")))),
    ("company_name", _a_in_or_with("company-name")),
    ("business_name", _a_in_or_with("business-name")),
    ("listing_title", _a_in_or_with("listing-title")),
    ("search_results", (_in(L, sel(cls="search-result")), _in(L, sel(cls="result-item")))),
    ("result_links", (_in(L, sel(cls="result")), _in(L, sel(cls="results")))),
    ("card_title", _a_in_or_with("card-title")),
    ("card_header", (sel("a", inside=sel(cls="card-header")), sel("a", inside=sel("h3", inside=sel(cls="card"))),
                     sel("a", inside=sel("h2", inside=sel(cls="card"))))),
    ("card_link", _in(L, sel(cls="card"))),
    ("all_company_links", L),
    ("html_company_links", sel("a", attrs=[("href", "*=", "/companies/"), ("href", "$=", ".html")])),
    ("europages_companies", sel("a", attrs=[("href", "^=", "https://www.europages.co.uk/companies/")])),
    ("main_links", (_in(L, sel("main")), _in(L, sel(id="main")))),
    ("content_links", (_in(L, sel(cls="content")), _in(L, sel(id="content")))),
    ("list_item_links", (_in(L, sel("li")), _in(L, sel(cls="list-item")))),
    ("listing_links", (_in(L, sel(cls="listing")), _in(L, sel(cls="listings")))),
    ("data_company", (sel("a", inside=sel(attrs=[("data-company",)])), sel("a", attrs=[("data-company",)]))),
    ("data_business", (sel("a", inside=sel(attrs=[("data-business",)])), sel("a", attrs=[("data-business",)]))),
    ("h_tag_links", (_in(L, sel("h1")), _in(L, sel("h2")), _in(L, sel("h3")))),
    ("div_company_links", sel("a", attrs=[("href", "*=", "/companies/"), ("href", "*=", ".html")], inside=sel("div"))),
]

CONTAINERS: list[Selector] = [
    sel("div", attrs=[("class", "*=", "company")]),
    sel("div", attrs=[("class", "*=", "business")]),
    sel("div", attrs=[("class", "*=", "result")]),
    sel("div", attrs=[("class", "*=", "listing")]),
    sel("div", attrs=[("class", "*=", "card")]),
    (sel(cls="search-results"), sel(cls="results"), sel(cls="listings")),
    (sel("main"), sel(id="main"), sel(cls="main-content"), sel(cls="content")),
]

PAGINATION_PROBES: list[Selector] = [
    sel(cls="pagination"), sel(cls="pager"), sel(cls="page-nav"),
    sel("a", attrs=[("href", "*=", "pg-")]), sel("a", attrs=[("href", "*=", "page")]),
    sel(cls="next"), sel(cls="next-page"), sel(attrs=[("rel", "=", "next")]),
]


def is_profile_url(href: Column) -> Column:
    """Q3: contains ``/companies/``, ends with ``.html``, no ``pg-``."""
    return F.coalesce(href.contains("/companies/") & href.endswith(".html") & ~href.contains("pg-"), F.lit(False))


def _examples(hits: Column) -> Column:
    """Q2: of the first 3 hits, those with a profile URL; text cut to 40."""
    first = F.slice(hits, 1, params.AUDIT_EXAMPLES)
    ex = F.transform(first, lambda e: F.struct(
        F.substr(strip_text(e), F.lit(1), F.lit(params.AUDIT_EXAMPLE_CHARS)).alias("text"),
        F.coalesce(e["attrs"]["href"], F.lit("")).alias("url")))
    return F.filter(ex, lambda x: is_profile_url(x["url"]))


def selector_results(dom: DataFrame, selectors=None, keep: list[str] | None = None) -> DataFrame:
    """Q1/Q2 as rows: ``keep..., sel_pos, selector_name, selector, n, examples``."""
    selectors = AUDIT_SELECTORS if selectors is None else selectors
    keep = list(keep or ["url"])
    items = []
    many = dom.select(*keep, *[c for c in ("bstext",) if c not in keep], select_many([s for _, s in selectors]).alias("_hits"))
    for pos, (name, s) in enumerate(selectors, start=1):
        hits = F.get("_hits", F.lit(pos - 1))
        items.append(F.struct(F.lit(pos).alias("sel_pos"), F.lit(name).alias("selector_name"),
                              F.lit(css(s)).alias("selector"), F.size(hits).alias("n"),
                              _examples(hits).alias("examples")))
    return many.select(*keep, F.explode(F.array(*items)).alias("r")).select(*keep, "r.*")


def best_selector(results: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Q4: largest count among selectors with a hit and an example; ties go to
    the earlier selector of the list."""
    keep = list(keep or ["url"])
    ok = results.filter((F.col("n") > 0) & (F.size("examples") > 0))
    return ok.groupBy(*keep).agg(
        F.max_by(F.struct("selector_name", "n"), F.struct(F.col("n"), -F.col("sel_pos"))).alias("b")
    ).select(*keep, F.col("b.selector_name").alias("best_selector"), F.col("b.n").cast("int").alias("best_count"))


def container_analysis(dom: DataFrame, containers=None, keep: list[str] | None = None) -> DataFrame:
    """Q5: per container selector the hit count and, for the first two hits,
    the number of company links inside."""
    containers = CONTAINERS if containers is None else containers
    keep = list(keep or ["url"])
    links = F.col("_links")
    items = []
    for pos, s in enumerate(containers, start=1):
        hits = select(s)
        items.append(F.struct(
            F.lit(pos).alias("sel_pos"), F.lit(css(s)).alias("container"), F.size(hits).alias("n"),
            F.when(F.size(hits) > 0, F.size(within(F.get(hits, 0), links))).alias("links_first"),
            F.when(F.size(hits) > 1, F.size(within(F.get(hits, 1), links))).alias("links_second")))
    d = dom.select(*keep, "elems", select(L).alias("_links"))
    return d.select(*keep, F.explode(F.array(*items)).alias("r")).select(*keep, "r.*")


def pagination_analysis(dom: DataFrame, probes=None, keep: list[str] | None = None) -> DataFrame:
    """Q6: pagination probes with at least one hit."""
    probes = PAGINATION_PROBES if probes is None else probes
    keep = list(keep or ["url"])
    items = [F.struct(F.lit(i).alias("sel_pos"), F.lit(css(s)).alias("selector"), F.size(F.get("_hits", F.lit(i - 1))).alias("n"))
             for i, s in enumerate(probes, start=1)]
    r = dom.select(*keep, select_many(probes).alias("_hits")).select(*keep, F.explode(F.array(*items)).alias("r")).select(*keep, "r.*")
    return r.filter(F.col("n") > 0)
