"""Selector audit (Q1-Q7), sector config (S2), JSON sink rows (S8) and
attribute selectors (H2) on the synthesised listing pages, plus T variants
of the audit on ``pages``."""

from __future__ import annotations


from pyspark.sql import functions as F

from leadforge.functions.select import count, css, sel
from leadforge.operators import audit as Q
from leadforge.operators.dom import parse_pages
from leadforge.plans.fixture_sql import LISTING_URL, with_base
from leadforge.sources import fixtures as FX
from leadforge.sources.pages import lookup_pages, read_pages


def _listing_dom(spark, sf_dir):
    return parse_pages(FX.crawl(spark, sf_dir)[0], keep=["sector", "page_no", "url"])


def selector_coverage(spark, sf_dir):
    """Q1: hits of the 21 audit selectors on every listing page."""
    r = Q.selector_results(_listing_dom(spark, sf_dir))
    return r.select("url", "selector_name", F.col("n").cast("int").alias("n"))


def selector_examples(spark, sf_dir):
    """Q2: up to 3 examples (profile URLs only) per selector and page."""
    r = Q.selector_results(_listing_dom(spark, sf_dir))
    return r.select("url", "selector_name", F.posexplode("examples").alias("ex_pos", "ex")).select(
        "url", "selector_name", (F.col("ex_pos") + 1).cast("int").alias("ex_pos"), "ex.text", F.col("ex.url").alias("href"))


def profile_url_filter(spark, sf_dir):
    """Q3 on every anchor with an href of the listing pages."""
    from leadforge.operators.links import anchors

    a = anchors(_listing_dom(spark, sf_dir))
    return a.select("url", F.col("pos").cast("int").alias("pos"), "href", Q.is_profile_url(F.col("href")).alias("is_profile"))


def best_selector(spark, sf_dir):
    """Q4 per listing page."""
    return Q.best_selector(Q.selector_results(_listing_dom(spark, sf_dir)))


def container_analysis(spark, sf_dir):
    """Q5 per listing page."""
    c = Q.container_analysis(_listing_dom(spark, sf_dir))
    return c.select("url", "container", F.col("n").cast("int").alias("n"),
                    F.col("links_first").cast("int").alias("links_first"),
                    F.col("links_second").cast("int").alias("links_second"))


def pagination_analysis(spark, sf_dir):
    """Q6 per listing page (probes with hits only)."""
    return Q.pagination_analysis(_listing_dom(spark, sf_dir)).select("url", "selector", F.col("n").cast("int").alias("n"))


def selector_coverage_by_url(spark, sf_dir):
    """Q7: the audit over a URL list -- every listing page plus, per sector, a
    page 0 that does not exist; a URL that cannot be fetched is skipped."""
    cfg = FX.fixture_sector_config(spark, sf_dir)
    listings = FX.crawl(spark, sf_dir)[0].select("url", "html")
    urls = listings.select("url").unionByName(
        cfg.select(F.regexp_replace("url", r"\.html$", "/pg-0.html").alias("url")))
    found = lookup_pages(urls, listings).filter(F.col("html").isNotNull())
    dom = parse_pages(found)
    r = Q.selector_results(dom)
    hit = r.filter(F.col("n") > 0).groupBy("url").agg(F.count("*").alias("n_selectors_hit"))
    return Q.best_selector(r).join(hit, "url", "left").select(
        "url", "best_selector", "best_count", F.coalesce("n_selectors_hit", F.lit(0)).alias("n_selectors_hit"))


def selector_results_json(spark, sf_dir):
    """The JSON record of every selector result of every listing page."""
    r = Q.selector_results(_listing_dom(spark, sf_dir))
    return r.select("url", "selector_name",
                    F.to_json(F.struct(F.col("n").alias("count"), "selector", "examples")).alias("result_json"))


def sector_config(spark, sf_dir):
    """Sector configuration with defaults (NULL keywords = empty list;
    missing ``max_pages`` = 2) and required-field validation."""
    cfg = FX.fixture_sector_config(spark, sf_dir)
    from leadforge.sources.config import validate_config

    v = validate_config(cfg)
    return v.select("sector", "sector_ord", "url", "max_pages",
                    F.array_join("business_domain_keywords", ",").alias("keywords"))


def css_select_attrs(spark, sf_dir):
    """H2 attribute selectors on the listing pages."""
    dom = _listing_dom(spark, sf_dir)
    link = sel("a", attrs=[("data-test", "=", "company-name")])
    return dom.select(
        "url",
        count(link).cast("int").alias("company_anchors"),
        count(sel("a", attrs=[("data-test", "=", "company-name"), ("href",)])).cast("int").alias("with_href"),
        count(sel("a", attrs=[("href", "^=", "/pl/")])).cast("int").alias("pl_links"),
        count(sel("a", attrs=[("data-test", "=", "company-name"), ("title",)])).cast("int").alias("titled"),
        count(sel("span", inside=link)).cast("int").alias("span_in_link"),
    )


def selector_coverage_pages(spark, sf_dir):
    """Q1 (T variant) on ``pages`` with nav/footer/list/div selectors."""
    dom = parse_pages(read_pages(spark, sf_dir), keep=["page_id", "url"])
    sels = [("nav_links", sel("a", inside=sel("nav"))), ("footer", sel("footer")),
            ("li_links", sel("a", inside=sel("li"))), ("div_links", sel("a", inside=sel("div")))]
    r = Q.selector_results(dom, sels, keep=["page_id"])
    return r.select("page_id", "selector_name", F.col("n").cast("int").alias("n"))


def container_analysis_pages(spark, sf_dir):
    """Q5 (T variant) on ``pages``: ``main, .content, article``."""
    dom = parse_pages(read_pages(spark, sf_dir), keep=["page_id", "url"])
    c = Q.container_analysis(dom, [(sel("main"), sel(cls="content"), sel("article"))], keep=["page_id"])
    return c.select("page_id", F.col("n").cast("int").alias("n"), F.col("links_first").cast("int").alias("links_first"))


QUERIES = {
    "selector_coverage": selector_coverage,
    "selector_examples": selector_examples,
    "profile_url_filter": profile_url_filter,
    "best_selector": best_selector,
    "container_analysis": container_analysis,
    "pagination_analysis": pagination_analysis,
    "selector_coverage_by_url": selector_coverage_by_url,
    "selector_results_json": selector_results_json,
    "sector_config": sector_config,
    "css_select_attrs": css_select_attrs,
    "selector_coverage_pages": selector_coverage_pages,
    "container_analysis_pages": container_analysis_pages,
}

# -- oracles: per listing page, from the fixture layout ---------------------------

_PAGES = """
lp AS (
  SELECT n.sector, p.page_no, n.n_pages,
         (p.page_no < n.n_pages OR (n.sector = 'machinery' AND p.page_no > 1)) AS nl,
         upper(substr(n.sector, 1, 1)) || substr(n.sector, 2) || ' suppliers' AS cat_text,
         '/companies/' || n.sector || '.html' AS cat_href
  FROM npages n, LATERAL (SELECT CAST(unnest(range(1, n.n_pages + 1)) AS INTEGER) AS page_no) p),
lpu AS (SELECT *, """ + LISTING_URL.format(p="page_no", s="sector") + """ AS url FROM lp),
cov AS (
  SELECT url, sector, page_no, nl, cat_text, cat_href, s.sel_pos, s.selector_name,
         CAST(CASE s.selector_name
           WHEN 'original' THEN 1 WHEN 'card_title' THEN 1 WHEN 'main_links' THEN 1
           WHEN 'list_item_links' THEN 1 WHEN 'listing_links' THEN 1
           WHEN 'all_company_links' THEN 1 + CAST(nl AS INTEGER)
           WHEN 'html_company_links' THEN 1 + CAST(nl AS INTEGER)
           WHEN 'div_company_links' THEN CAST(nl AND sector IN ('automobile', 'furniture') AS INTEGER)
           ELSE 0 END AS INTEGER) AS n,
         s.selector_name IN ('original', 'card_title', 'main_links', 'list_item_links', 'listing_links',
                             'all_company_links', 'html_company_links') AS has_example
  FROM lpu, (VALUES {sel_values}) s(sel_pos, selector_name, selector))
"""


def _sel_values() -> str:
    return ", ".join(f"({i}, '{n}', '{css(s).replace(chr(39), chr(39) * 2)}')" for i, (n, s) in enumerate(Q.AUDIT_SELECTORS, start=1))


_AUDIT = _PAGES.replace("{sel_values}", _sel_values())

_BEST = """
  SELECT url, arg_max(selector_name, (n, -sel_pos)) AS best_selector, CAST(max(n) AS INTEGER) AS best_count
  FROM cov WHERE n > 0 AND has_example GROUP BY url
"""

_CONT = [css(c) for c in Q.CONTAINERS]
_PROBES = [css(p) for p in Q.PAGINATION_PROBES]

ORACLES = {
    "selector_coverage": with_base("SELECT url, selector_name, n FROM cov", _AUDIT),
    "selector_examples": with_base("""
        SELECT url, selector_name, 1 AS ex_pos, cat_text AS text, cat_href AS href FROM cov WHERE has_example
    """, _AUDIT),
    "profile_url_filter": with_base("""
        SELECT url, CAST(1 AS INTEGER) AS pos, cat_href AS href, true AS is_profile FROM lpu
        UNION ALL
        SELECT u.url, CAST(l.link_pos + 1 AS INTEGER), l.href, false
        FROM links l JOIN lpu u ON u.sector = l.sector AND u.page_no = l.page_no
        UNION ALL
        SELECT url, CAST(c.cnt + 2 AS INTEGER),
               CASE WHEN page_no < n_pages THEN regexp_replace(""" + LISTING_URL.format(p="page_no + 1", s="sector") + """, '^https://dir.test', '')
                    ELSE regexp_replace(url, '^https://dir.test', '') END, false
        FROM lpu JOIN (SELECT sector, page_no, count(*) AS cnt FROM links GROUP BY sector, page_no) c USING (sector, page_no)
        WHERE nl
    """, _AUDIT),
    "best_selector": with_base(_BEST, _AUDIT),
    "container_analysis": with_base(f"""
        SELECT url, c.container, CAST(c.n AS INTEGER) AS n, CAST(c.lf AS INTEGER) AS links_first,
               CAST(NULL AS INTEGER) AS links_second
        FROM lpu, (VALUES ('{_CONT[0]}', 0, NULL), ('{_CONT[1]}', 0, NULL), ('{_CONT[2]}', 1, 0),
                          ('{_CONT[3]}', 0, NULL), ('{_CONT[4]}', 0, NULL), ('{_CONT[5]}', 1, 0),
                          ('{_CONT[6]}', 1, 1)) c(container, n, lf)
    """.replace("'{", "'").replace("}'", "'"), _AUDIT),
    "pagination_analysis": with_base(f"""
        SELECT url, selector, CAST(1 AS INTEGER) AS n FROM (
          SELECT url, '{_PROBES[0]}' AS selector FROM lpu WHERE nl AND sector IN ('automobile', 'furniture')
          UNION ALL SELECT url, '{_PROBES[3]}' FROM lpu WHERE nl
          UNION ALL SELECT url, '{_PROBES[5]}' FROM lpu WHERE nl AND sector = 'furniture'
          UNION ALL SELECT url, '{_PROBES[7]}' FROM lpu WHERE nl AND sector = 'automobile')
    """, _AUDIT),
    "selector_coverage_by_url": with_base(f"""
        SELECT b.url, b.best_selector, b.best_count, h.n_selectors_hit
        FROM ({_BEST}) b JOIN (SELECT url, count(*) AS n_selectors_hit FROM cov WHERE n > 0 GROUP BY url) h USING (url)
    """, _AUDIT),
    "selector_results_json": with_base("""
        SELECT url, selector_name,
               to_json({'count': n, 'selector': s.selector,
                        'examples': CASE WHEN has_example THEN [{'text': cat_text, 'url': cat_href}] ELSE [] END})::VARCHAR AS result_json
        FROM cov JOIN (VALUES {sel_values}) s(sel_pos, selector_name, selector) USING (sel_pos, selector_name)
    """.replace("{sel_values}", _sel_values()), _AUDIT),
    "sector_config": with_base("""
        SELECT s.sector, s.sector_ord, 'https://dir.test/companies/' || s.sector || '.html' AS url,
               CAST(n.n_pages AS INTEGER) AS max_pages,
               CASE s.sector WHEN 'automobile' THEN 'motors,automotive' WHEN 'machinery' THEN 'cnc,machining,yahoo.com'
                             ELSE '' END AS keywords
        FROM sec s JOIN npages n ON n.sector = s.sector
    """),
    "css_select_attrs": with_base("""
        SELECT u.url, CAST(count(*) + 1 AS INTEGER) AS company_anchors, CAST(count(*) AS INTEGER) AS with_href,
               CAST(count(*) FILTER (WHERE l.k % 12 = 3) AS INTEGER) AS pl_links,
               CAST(count(*) FILTER (WHERE l.k % 6 IN (2, 5)) AS INTEGER) AS titled,
               CAST(count(*) FILTER (WHERE l.k % 6 = 1) AS INTEGER) AS span_in_link
        FROM links l JOIN lpu u ON u.sector = l.sector AND u.page_no = l.page_no
        GROUP BY u.url
    """, _AUDIT),
    "selector_coverage_pages": """
        SELECT page_id, s.selector_name,
               CAST(CASE s.selector_name WHEN 'footer' THEN 1 WHEN 'div_links' THEN 0
                    ELSE len(regexp_extract_all(html, '<a href=')) END AS INTEGER) AS n
        FROM pages, (VALUES ('nav_links'), ('footer'), ('li_links'), ('div_links')) s(selector_name)
    """,
    "container_analysis_pages": """
        SELECT page_id, CAST(1 AS INTEGER) AS n, CAST(0 AS INTEGER) AS links_first FROM pages
    """,
}
