"""Directory listing pages -> companies.

Listing pages are parsed once; per page the company links (D1, D2) and the
next-page href (D5) are expressions on the DOM row.  The page walk (D4) is a
bounded reachability over ``(url -> next_url)`` computed by pointer doubling:
``log2(max_pages)`` self-joins instead of one join per page.  Deduplication
(D6 within a sector, D3 across sectors) keeps the first occurrence with a
partial-aggregate ``min(struct)``; the per-sector limit (D7) is a ranked
window whose ``<= n`` filter Spark turns into a partial top-n before the
shuffle, so a hot sector never lands whole in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.select import Selector, sel, select, select_by, select_one, strip_text
from leadforge.functions.text import pystrip, title_case
from leadforge.functions.urls import urljoin
from leadforge.operators.dedup import first_by
from leadforge.session import cut_lineage
from leadforge.sources.config import SELECTOR

# Selector records for the config's CSS and the D5 fallbacks (in order).
LINK_SELECTOR = sel("a", attrs=[("data-test", "=", "company-name")])
PAGINATION_SELECTOR = sel("a", attrs=[("aria-label", "=", "Next page")])
NEXT_FALLBACKS: list[Selector] = [
    sel("a", attrs=[("aria-label", "=", "Next page")]),
    sel("a", attrs=[("rel", "=", "next")], inside=sel(cls="pagination")),
    sel(cls="next", inside=sel(cls="pagination")),
    sel("a", contains="Next"),
    sel("a", attrs=[("href", "*=", "pg-")]),
]


_SEP = "\x01"  # between selectors and URL in a walk's node


def default_link_selector() -> Column:
    """``LINK_SELECTOR`` as a record, for sectors without one of their own."""
    attrs = ", ".join(f"named_struct('name', '{a}', 'op', '{op}', 'value', '{v}')" for a, op, v in LINK_SELECTOR.attrs)
    none = {f: "NULL" for f in ("id", "classes", "contains", "inside")}
    fields = {"tag": f"'{LINK_SELECTOR.tag}'", "attrs": f"array({attrs})"} | none
    return F.expr("named_struct(" + ", ".join(f"'{f}', {fields[f]}" for f in ("tag", "id", "classes", "attrs", "contains", "inside")) + ")").cast(SELECTOR)


# -- D2 ------------------------------------------------------------------------------

def slug_name(href: Column) -> Column:
    """D2 rule 6: first path part, extension and ``-<digit>...`` tail removed,
    ``-``/``_`` -> space, spaces collapsed, Python title case."""
    part = F.get(F.split(F.btrim(href, F.lit("/")), "/"), 0)
    part = F.regexp_replace(part, r"(?U)\.\w+$", "")
    part = F.regexp_replace(part, r"(?U)-\d+.*$", "")
    part = pystrip(F.regexp_replace(F.translate(part, "-_", "  "), r"(?U)\s+", " "))
    return F.when(F.length(part) > 1, title_case(part))


def company_name(link: Column) -> Column:
    """D2 on an anchor element struct.

    Rules 2 (first span) and 3 (first nested element) are left out: their
    text is part of the link's stripped text, so when rule 1 fails (length
    <= 1) they fail too.
    """
    def ok(c: Column) -> Column:
        return F.when(F.length(c) > 1, c)

    text = strip_text(link)
    title = pystrip(link["attrs"]["title"])
    aria = pystrip(link["attrs"]["aria-label"])
    return F.coalesce(ok(text), ok(title), ok(aria), slug_name(link["attrs"]["href"]))


def name_source(link: Column) -> Column:
    text = strip_text(link)
    return (
        F.when(F.length(text) > 1, F.lit("text"))
        .when(F.length(pystrip(link["attrs"]["title"])) > 1, F.lit("title"))
        .when(F.length(pystrip(link["attrs"]["aria-label"])) > 1, F.lit("aria-label"))
        .when(slug_name(link["attrs"]["href"]).isNotNull(), F.lit("slug"))
    )


# -- D1 ------------------------------------------------------------------------------

def company_links(listing_dom: DataFrame, link_selector: Selector = LINK_SELECTOR,
                  keep: list[str] | None = None) -> DataFrame:
    """``keep..., link_pos, href, name, name_source, company_url`` for every
    selected anchor with a non-empty href, in document order."""
    keep = list(keep or ["url"])
    hits = F.filter(select(link_selector), lambda a: F.coalesce(a["attrs"]["href"] != F.lit(""), F.lit(False)))
    arr = F.transform(hits, lambda a: F.struct(
        a["attrs"]["href"].alias("href"), company_name(a).alias("name"), name_source(a).alias("name_source")))
    rows = listing_dom.select(*keep, F.col("url").alias("_page_url"), F.posexplode(arr).alias("_i", "_l"))
    return rows.select(
        *keep, (F.col("_i") + 1).alias("link_pos"), "_l.href", "_l.name", "_l.name_source",
        urljoin(F.col("_page_url"), F.col("_l.href")).alias("company_url"),
    )


# -- D5 ------------------------------------------------------------------------------

def next_href(pagination_selector: Selector | None = PAGINATION_SELECTOR,
              fallbacks: list[Selector] | None = None) -> Column:
    """Href of the configured selector's first hit, else of the first
    fallback whose first hit has an href (a first hit without href moves on
    to the next selector).  Without a configured selector there is no
    pagination: NULL on every page."""
    if pagination_selector is None:
        return F.lit(None).cast("string")
    fallbacks = NEXT_FALLBACKS if fallbacks is None else fallbacks
    chain = [pagination_selector, *fallbacks]
    hrefs = []
    for s in chain:
        h = select_one(s)["attrs"]["href"]
        hrefs.append(F.when(h != F.lit(""), h))
    return F.coalesce(*hrefs)


def next_pages(listing_dom: DataFrame, pagination_selector: Selector | None = PAGINATION_SELECTOR,
               keep: list[str] | None = None) -> DataFrame:
    """``keep..., url, next_url`` per listing page (NULL when none)."""
    keep = [c for c in (keep or []) if c != "url"]
    h = listing_dom.select(*keep, "url", next_href(pagination_selector).alias("_h"))
    return h.select(*keep, "url", urljoin(F.col("url"), F.col("_h")).alias("next_url"))


# -- D4 ------------------------------------------------------------------------------

def _materialise_pair(jump: DataFrame, walks: DataFrame) -> tuple[DataFrame, DataFrame]:
    both = jump.select(F.lit(0).alias("_t"), "src", "dst", F.lit(None).cast("string").alias("sector"),
                       F.lit(None).cast("int").alias("max_pages"), F.lit(None).cast("int").alias("step"),
                       F.lit(None).cast("string").alias("node")).unionByName(
        walks.select(F.lit(1).alias("_t"), F.lit(None).cast("string").alias("src"), F.lit(None).cast("string").alias("dst"),
                     "sector", F.col("max_pages").cast("int").alias("max_pages"), F.col("step").cast("int").alias("step"),
                     "node"))
    both = cut_lineage(both)
    return (both.filter(F.col("_t") == 0).select("src", "dst"),
            both.filter(F.col("_t") == 1).select("sector", "max_pages", "step", "node"))


def follow_pagination(starts: DataFrame, nexts: DataFrame, max_pages_bound: int) -> DataFrame:
    """Pages visited from each start.

    ``starts(sector, url, max_pages)``; ``nexts(url, next_url)`` for every
    listing page in the snapshot (a URL absent from ``nexts`` is a page that
    could not be fetched).  A walk visits the start, then follows ``next_url``
    while the step count stays below ``max_pages``, the next page exists in
    the snapshot and differs from the current one.  There is no cycle guard
    (A -> B -> A runs to ``max_pages``).

    Pointer doubling: ``J_0(u) = next(u)``; ``J_{j+1}(u) = J_j(J_j(u))``; the
    positions ``[0, 2^j)`` of every walk are extended to ``[0, 2^(j+1))`` by
    one join with ``J_j``.  Returns ``(sector, page_no, url)``.
    """
    present = nexts.select("url").distinct()
    edges = (
        nexts.filter(F.col("next_url").isNotNull() & (F.col("next_url") != F.col("url")))
        .join(present.withColumnRenamed("url", "next_url"), "next_url", "left_semi")
        .select(F.col("url").alias("src"), F.col("next_url").alias("dst"))
    )
    walks = starts.join(present, "url", "left_semi").select(
        "sector", "max_pages", F.lit(0).alias("step"), F.col("url").alias("node"))
    rounds = max(0, math.ceil(math.log2(max(max_pages_bound, 1))))
    jump = edges
    for j in range(rounds):
        span = 2 ** j
        moved = walks.join(jump, walks["node"] == jump["src"]).select(
            "sector", "max_pages", (F.col("step") + span).alias("step"), F.col("dst").alias("node"))
        walks = walks.unionByName(moved.filter(F.col("step") < F.col("max_pages")))
        if j + 1 < rounds:
            a, b = jump.alias("a"), jump.alias("b")
            jump = a.join(b, F.col("a.dst") == F.col("b.src")).select(F.col("a.src").alias("src"), F.col("b.dst").alias("dst"))
            if j % 2 == 1:
                # both tables appear twice in the next round's plan: cut the
                # lineage every second round (one checkpoint for both), so the
                # plan never holds more than four copies of a materialised table
                jump, walks = _materialise_pair(jump, walks)
                # every walk still growing has 2^(j+1) positions; if the
                # longest is shorter, all walks have ended
                longest = walks.agg(F.max("step")).first()[0]
                if longest is None or longest < 2 ** (j + 1) - 1:
                    break
    return walks.filter(F.col("step") < F.col("max_pages")).select(
        "sector", (F.col("step") + 1).alias("page_no"), F.col("node").alias("url"))


# -- D3 / D6 / D7 ------------------------------------------------------------------

def dedup_companies(links: DataFrame, group: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """D6 (``group=['sector']``) or D3 (``group=[]``, order starting with the
    sector's run order): first occurrence of each company URL."""
    return first_by(links, [*group, "company_url"], order, payload)


def limit_per_group(df: DataFrame, group: list[str], order: list[str], n: int | None) -> DataFrame:
    """First ``n`` rows per group; ``0``/``None`` keeps everything."""
    if not n:
        return df
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def selector_key() -> Column:
    """What a sector's selectors are known by in the feature tables and in every
    node of the walks: a digest, a tenth of the records' length."""
    return F.md5(F.to_json(F.struct("link_selector", "pagination_selector")).cast("binary"))


def _host(url: Column) -> Column:
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))


def _features(listing_dom: DataFrame, index: DataFrame) -> DataFrame:
    """A page under the selector pairs that ``index(host, sel_key,
    link_selector, pagination_selector)`` has for its host.  The index, no larger
    than the config, goes to the pages: joined by host, all pages of a directory
    (one host) would meet in one task."""
    dom = listing_dom.withColumn("_host", _host(F.col("url"))).join(F.broadcast(index.withColumnRenamed("host", "_host")), "_host")
    links = F.transform(F.filter(select_by("link_selector"), lambda a: F.coalesce(a["attrs"]["href"] != F.lit(""), F.lit(False))),
                        lambda a: F.struct(a["attrs"]["href"].alias("href"), company_name(a).alias("name"), name_source(a).alias("name_source")))
    hits = [F.get(select_by("pagination_selector"), 0), *map(select_one, NEXT_FALLBACKS)]
    href = F.when(F.col("pagination_selector").isNotNull(), F.coalesce(*(F.when(h["attrs"]["href"] != F.lit(""), h["attrs"]["href"]) for h in hits)))
    f = dom.select("sel_key", "url", href.alias("h"), links.alias("links"))
    return cut_lineage(f.select("sel_key", "url", urljoin(F.col("url"), F.col("h")).alias("next_url"), "links"))


def listing_features(listing_dom: DataFrame, config: DataFrame) -> DataFrame:
    """The parsed listing pages under their selectors: ``sel_key, url, next_url,
    links`` where ``links`` is the D1 array (href, name, name_source) in
    document order.

    A page does not know its sector before the walk, but its host: it meets the
    selector pairs of the sectors that start there, as records joined to the
    page, so neither the plan nor a page's cost grows with the number of pairs
    elsewhere.  Where pagination leads a pair to another host, that host's
    pages are read under it too, until no pair finds a new host.  Materialised,
    so the Python parse runs once however many consumers follow.
    """
    pairs = config.select(selector_key().alias("sel_key"), F.coalesce("link_selector", default_link_selector()).alias("link_selector"), "pagination_selector", "url")
    start = pairs.select(_host(F.col("url")).alias("host"), "sel_key", "link_selector", "pagination_selector").dropDuplicates(["host", "sel_key"])
    features = _features(listing_dom, start)
    known = start.select("host", "sel_key")
    while True:
        reached = features.filter("next_url IS NOT NULL").select(_host(F.col("next_url")).alias("host"), "sel_key").distinct()
        fresh = cut_lineage(reached.join(known, ["host", "sel_key"], "left_anti"))
        if fresh.isEmpty():
            return features
        by_key = pairs.dropDuplicates(["sel_key"]).drop("url")
        features = features.unionByName(_features(listing_dom, fresh.join(by_key, "sel_key")))
        known = known.unionByName(fresh)


def feature_links(features: DataFrame) -> DataFrame:
    """D1 rows from ``listing_features``."""
    rows = features.select("sel_key", "url", F.posexplode("links").alias("_i", "_l"))
    return rows.select("sel_key", "url", (F.col("_i") + 1).alias("link_pos"), "_l.href", "_l.name", "_l.name_source",
                       urljoin(F.col("url"), F.col("_l.href")).alias("company_url"))


def walk_bound(config: DataFrame) -> int:
    """Rounds needed: no walk is longer than the largest ``max_pages`` (one
    scalar of the small config table); walks that end sooner stop the
    doubling early."""
    max_pages = config.agg(F.max(F.coalesce("max_pages", F.lit(params.DEFAULT_MAX_PAGES)))).first()[0] or 1
    return max(1, int(max_pages))


def visited_pages(features: DataFrame, config: DataFrame) -> DataFrame:
    """D4 for every configured sector: ``(sector, page_no, url, sel_key)``; a
    walk follows the links that the sector's own selectors find."""
    node = lambda key, url: F.concat(key, F.lit(_SEP), url)
    starts = config.select("sector", node(selector_key(), F.col("url")).alias("url"), F.coalesce("max_pages", F.lit(params.DEFAULT_MAX_PAGES)).alias("max_pages"))
    nexts = features.select(node(F.col("sel_key"), F.col("url")).alias("url"), node(F.col("sel_key"), F.col("next_url")).alias("next_url"))
    walks = follow_pagination(starts, nexts, walk_bound(config))
    return walks.select("sector", "page_no", F.substring_index("url", _SEP, -1).alias("url"), F.substring_index("url", _SEP, 1).alias("sel_key"))


def directory_companies(features: DataFrame, config: DataFrame, group: list[str] | None = None) -> DataFrame:
    """D1-D4 + D3 (default) or D6 (``group=['sector']``) for all sectors at once.

    ``features`` from ``listing_features``; ``config(sector, sector_ord, url,
    max_pages)``.  Returns ``sector, sector_ord, page_no, link_pos, name,
    company_url``; with D3 each URL is kept only at its first occurrence
    across sectors (run order ``sector_ord``), as a pipeline that shares its
    seen-URL set does.
    """
    visited = visited_pages(features, config)
    links = feature_links(features)
    occ = visited.join(links, ["sel_key", "url"]).join(config.select("sector", "sector_ord"), "sector")
    group = [] if group is None else group
    # run order: sector_ord, then the sector name (deterministic when a
    # config leaves sector_ord unset), then page and link position
    return dedup_companies(
        occ, group, ["sector_ord", "sector", "page_no", "link_pos"],
        ["sector", "sector_ord", "page_no", "link_pos", "name"],
    )
