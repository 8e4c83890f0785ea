"""Contact-page discovery on company homepages.

Page-local steps (regions, link filtering, the "fewer than 3 links" count) are
expressions on the DOM row.  Link resolution (H6) needs the Arrow UDF, which
cannot run inside a higher-order function, so the candidates are exploded
first, generated ones and the homepage itself among them, so that a page is
parsed once; dedup and the top-5 cut are then a small aggregation per site
over candidate links only (never over page content), with a partial limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.select import css, raw_text, select, sel, within
from leadforge.functions.text import any_contains, pystrip
from leadforge.functions.urls import urljoin
from leadforge.operators.links import anchor_list

# Region selectors as records (P1), in priority order.
REGION_SELECTORS = [
    ("nav", (sel("nav"), sel(cls="nav"), sel(cls="navigation"), sel(cls="navbar"), sel(cls="menu"))),
    ("header", (sel("header"), sel(cls="header"))),
    ("footer", (sel("footer"), sel(cls="footer"))),
    ("main_menu", (sel(cls="menu"), sel(cls="main-menu"), sel(id="menu"))),
    ("sidebar", (sel(cls="sidebar"), sel(cls="side-nav"))),
]
CONTENT_AREA = "content"


def _keywords() -> list[str]:
    return list(dict.fromkeys(k for ks in params.CONTACT_KEYWORDS.values() for k in ks))


def _link(area: str, prio: int, region_id: Column, a: Column, i: Column) -> Column:
    href = pystrip(F.coalesce(a["attrs"]["href"], F.lit("")))
    text = F.lower(pystrip(raw_text(a)))
    return F.struct(
        F.lit(area).alias("area"),
        F.lit(prio).alias("area_prio"),
        region_id.alias("region_id"),
        (i + 1).alias("link_ord"),
        a["id"].alias("elem_id"),
        href.alias("href"),
        text.alias("link_text"),
    )


def outermost(regions: Column) -> Column:
    """Regions (in document order) that lie in no other one: those inside
    another hold no further anchors."""
    start = F.struct(F.lit(0).alias("end"), F.slice(regions, 1, 0).alias("kept"))
    return F.aggregate(
        regions, start,
        lambda acc, r: F.when(r["id"] <= acc["end"], acc).otherwise(F.struct(r["end"].alias("end"), F.array_append(acc["kept"], r).alias("kept"))),
        lambda acc: acc["kept"])


def _region_pairs(area: str, prio: int, s, anchors: Column) -> Column:
    return F.flatten(F.transform(
        outermost(select(s)), lambda r: F.transform(within(r, anchors), lambda a, i: _link(area, prio, r["id"], a, i))))


def region_link_array(regions=None) -> Column:
    """The anchors of every area, in priority order, as an array: an anchor
    once per area that holds it, under the outermost region around it (unclosed
    menus nest; pairs with every region would be quadratic in the page)."""
    regions = REGION_SELECTORS if regions is None else regions
    anchors = anchor_list()
    parts = []
    for prio, (area, s) in enumerate(regions, start=1):
        parts.append(_region_pairs(area, prio, s, anchors))
    parts.append(F.transform(anchors, lambda a, i: _link(CONTENT_AREA, len(regions) + 1, F.lit(0), a, i)))
    return F.concat(*parts)


def is_contact_link(link: Column, keywords: list[str] | None = None, patterns: list[str] | None = None) -> Column:
    """P2 (link text has a keyword) or P3 (lower href has a URL pattern)."""
    keywords = _keywords() if keywords is None else keywords
    patterns = params.CONTACT_PAGE_PATTERNS if patterns is None else patterns
    return any_contains(link["link_text"], keywords) | any_contains(F.lower(link["href"]), patterns)


def _usable_href(link: Column) -> Column:
    h = link["href"]
    return (h != F.lit("")) & ~h.startswith("javascript:") & ~h.startswith("#")


def region_links(dom: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P1 as a relation: one row per usable (area, link), with ``is_contact``
    (P2/P3)."""
    keep = list(keep or ["url"])
    arr = F.filter(region_link_array(), _usable_href)
    arr = F.transform(arr, lambda l: l.withField("is_contact", is_contact_link(l)))
    return dom.select(*keep, F.explode(arr).alias("l")).select(*keep, "l.*")


def page_label(link_text: Column) -> Column:
    """P7."""
    return F.when(link_text == F.lit(""), F.lit("Contact Page")).otherwise(
        F.concat(F.lit("Contact ("), F.substr(link_text, F.lit(1), F.lit(params.PAGE_LABEL_CHARS)), F.lit(")"))
    )


def _generated_array() -> Column:
    pats = params.CONTACT_PAGE_PATTERNS[: params.GENERATED_PATTERN_COUNT]
    return F.array(*[
        F.struct(F.lit(p).alias("pattern"),
                 F.lit("Contact " + p.replace("/", "").replace("-", " ").title()).alias("page_name"))
        for p in pats
    ])


def generated_urls(sites: DataFrame, site_col: str = "site_url") -> DataFrame:
    """Site URL without trailing ``/`` + the first six patterns."""
    base = F.rtrim(F.col(site_col), F.lit("/"))
    return sites.select(
        "*", F.posexplode(_generated_array()).alias("_i", "_g")
    ).select(
        *[F.col(c) for c in sites.columns],
        (F.col("_i") + 1).alias("rank"),
        F.col("_g.page_name").alias("page_name"),
        F.concat(base, F.col("_g.pattern")).alias("page_url"),
    )


def _n_found() -> Column:
    """Contact links before dedup, one for the page and one for every region
    element around them, counted up to where it matters: with three links
    or more there are enough, so the regions count for two at most."""
    contact = F.filter(anchor_list(), lambda a: _usable_href(_link(CONTENT_AREA, 0, F.lit(0), a, F.lit(0)))
                       & is_contact_link(_link(CONTENT_AREA, 0, F.lit(0), a, F.lit(0))))
    around = lambda a: sum((F.size(F.filter(select(s), lambda r: (r["id"] < a["id"]) & (a["id"] <= r["end"])))
                            for _, s in REGION_SELECTORS), F.lit(1))
    few = F.slice(contact, 1, params.MIN_FOUND_LINKS - 1)
    return F.when(F.size(contact) >= params.MIN_FOUND_LINKS, F.size(contact)).otherwise(
        F.aggregate(F.transform(few, around), F.lit(0), lambda acc, n: acc + n))


def discovery_exprs() -> list[Column]:
    """Page-local part of P5 as columns of the homepage row: ``_missing``,
    ``_n_found`` (contact links before dedup) and ``_links`` (href, label)."""
    contact = F.filter(region_link_array(), lambda l: _usable_href(l) & is_contact_link(l))
    return [
        F.col("elems").isNull().alias("_missing"),
        _n_found().alias("_n_found"),
        F.transform(contact, lambda l: F.struct(l["href"].alias("href"), page_label(l["link_text"]).alias("page_name"))).alias("_links"),
    ]


def discover_contact_pages(homes: DataFrame, site_col: str = "site_url") -> DataFrame:
    """P5 on parsed homepages ``homes(site_col, text, stext, elems)`` (DOM
    columns NULL when the homepage is missing).

    Returns ``(site_col, rank, page_name, page_url)``, rank 1..5 (1..6 when the
    homepage is missing: the six generated URLs, untruncated).
    """
    return discover_from(homes.select(F.col(site_col), *discovery_exprs()), site_col)


def discover_from(cands: DataFrame, site_col: str = "site_url", max_pages: int | None = params.MAX_CONTACT_PAGES) -> DataFrame:
    """P5 after the page-local part (``discovery_exprs`` columns);
    ``max_pages=None`` keeps every discovered page."""
    return _ranked(cands, site_col, max_pages, homepage=False)


def _ranked(cands: DataFrame, site_col: str, max_pages: int | None, homepage: bool) -> DataFrame:
    """P5, and with ``homepage`` P6: the homepage takes rank 0 and may come
    again.  Rows of one site are ranked after the first candidate a URL."""
    found = F.transform("_links", lambda l, i: F.struct(F.lit(1).alias("kind"), i.cast("long").alias("cand_ord"), l["page_name"].alias("page_name"), l["href"].alias("href")))
    # P4 appended when fewer than 3 links were found (before dedup), or alone
    # when the homepage is missing.
    first = F.when(F.col("_missing"), F.lit(0)).otherwise(F.col("_n_found"))
    generated = F.transform(_generated_array(), lambda g, i: F.struct(F.lit(2).alias("kind"), (first + i).cast("long").alias("cand_ord"),
                                                                      g["page_name"].alias("page_name"), g["pattern"].alias("href")))
    own = F.array(F.struct(F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("cand_ord"), F.lit("Homepage").alias("page_name"), F.lit("").alias("href")))
    none = lambda a: F.slice(a, 1, 0)
    few = F.col("_missing") | (F.col("_n_found") < params.MIN_FOUND_LINKS)
    every = F.concat(own if homepage else none(own), F.when(F.col("_missing"), none(generated)).otherwise(found), F.when(few, generated).otherwise(none(generated)))
    rows = cands.select(site_col, "_missing", F.explode(every).alias("_c")).select(site_col, "_missing", "_c.*")
    base = F.rtrim(F.col(site_col), F.lit("/"))
    rows = rows.withColumn("page_url", F.when(F.col("kind") == 0, F.col(site_col)).when(F.col("kind") == 2, F.concat(base, F.col("href")))
                           .otherwise(urljoin(F.col(site_col), F.col("href"))))
    # keep the first candidate per (site, page_url), then rank per site
    firsts = rows.groupBy(site_col, "page_url", (F.col("kind") == 0).alias("_own")).agg(F.min(F.struct("cand_ord", "page_name", "_missing")).alias("_f"))
    w = Window.partitionBy(site_col).orderBy("cand_ord")
    shift = 1 if homepage else 0
    ranked = firsts.select(site_col, "page_url", "_f.*").withColumn("_place", F.row_number().over(w))
    if max_pages is not None:
        # The plain bound lets Spark cut every site's rows before the shuffle.
        ranked = ranked.filter(F.col("_place") <= max(max_pages, params.GENERATED_PATTERN_COUNT) + shift)
        ranked = ranked.filter(F.col("_missing") | (F.col("_place") <= max_pages + shift))
    return ranked.select(site_col, (F.col("_place") - shift).alias("rank"), "page_name", "page_url")


def pages_to_check(homes: DataFrame, site_col: str = "site_url") -> DataFrame:
    """The homepage (rank 0, ``Homepage``) then the discovered pages."""
    return pages_to_check_from(homes.select(F.col(site_col), *discovery_exprs()), site_col)


def pages_to_check_from(cands: DataFrame, site_col: str = "site_url", max_pages: int | None = params.MAX_CONTACT_PAGES) -> DataFrame:
    """P6 after the page-local part."""
    return _ranked(cands, site_col, max_pages, homepage=True)


__all__ = ["region_links", "discover_contact_pages", "pages_to_check", "generated_urls", "page_label", "css"]
