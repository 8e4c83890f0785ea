"""S-fixtures: directory, profile and company-site pages synthesised from
``customer`` rows with Spark expressions (no Python per row).

``k = c_custkey``.  Expected answers are functions of ``k`` alone, so the
DuckDB oracles (``leadforge.plans.fixture_sql``) never read HTML.

F1 ``listing_pages(sector, page_no, url, html)``
    25 companies per page in ``k`` order per sector; page ``n > 1`` starts with
    the last company of page ``n-1``; companies with ``k % 50 = 0`` are also
    listed on machinery page ``(k div 50) % n_machinery_pages + 1`` (after its
    own companies).  Each page also has a ``main`` block with one category link
    ``/companies/<sector>.html`` (for the selector audit).  Next-link form per sector: see ``SECTOR_FIXTURE``.
F2 ``profile_pages(url, html)``: country markup by ``k % 12`` and website
    markup by ``(k div 10) % 5``.
F3 ``site_pages(url, html)``: homepage ``https://www.<w>.com`` (absent when
    ``k % 20 = 15``) and contact pages, emails by ``k % 10``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadforge.sources.pages import read_table

DIR_ORIGIN = "https://dir.test"
PER_PAGE = 25

# Fixture parameters: (sector, next-link form, bounded max_pages).  Sector
# order is alphabetical; machinery runs last.  The bounds hold only where the
# bound is the feature (D4); elsewhere every page of a sector is read.
SECTOR_FIXTURE = [
    ("automobile", "rel_next", 3),
    ("building", "aria_label", 2),
    ("furniture", "pagination_next", 4),
    ("household", "text_next", None),
    ("machinery", "href_pg", 1000),
]


def _sector_table(spark: SparkSession) -> DataFrame:
    rows = [(s, i, form, mp) for i, (s, form, mp) in enumerate(SECTOR_FIXTURE, start=1)]
    return spark.createDataFrame(rows, "sector string, sector_ord int, next_form string, max_pages int")


def w_label(k: Column) -> Column:
    """Company word: 'co' + the digits of k spelled a..j (letters only)."""
    return F.concat(F.lit("co"), F.translate(k.cast("string"), "0123456789", "abcdefghij"))


def listing_url(sector: Column, page_no: Column) -> Column:
    return F.when(page_no == 1, F.concat(F.lit(DIR_ORIGIN + "/companies/"), sector, F.lit(".html"))).otherwise(
        F.concat(F.lit(DIR_ORIGIN + "/companies/"), sector, F.lit("/pg-"), page_no.cast("string"), F.lit(".html"))
    )


def listing_path(sector: Column, page_no: Column) -> Column:
    return F.regexp_replace(listing_url(sector, page_no), "^" + DIR_ORIGIN, "")


def profile_href(k: Column) -> Column:
    ks = k.cast("string")
    base = F.when(k % 6 == 4, F.concat(F.lit("/ACME-TOOLS-"), ks)).otherwise(F.concat(F.lit("/CO-"), ks))
    path = F.concat(base, F.lit("/"), ks, F.lit("-001.html"))
    return F.when(k % 12 == 3, F.concat(F.lit("/pl"), path)).otherwise(path)


RANK_BUCKET = 4096


def with_rank(df: DataFrame, group: str, key: str, out: str) -> DataFrame:
    """``df`` plus ``out`` = 1-based rank of ``key`` inside ``group`` (keys
    unique within a group), without a window over a whole group (a sector
    may hold a third of all rows).

    Keys are cut into buckets of ``RANK_BUCKET`` consecutive values; rows are
    counted per (group, bucket) with a partial aggregate, the counts of the
    earlier buckets are summed over that small table, and the rank inside a
    bucket is a window over at most ``RANK_BUCKET`` rows."""
    b = df.withColumn("_bucket", F.floor(F.col(key) / RANK_BUCKET))
    counts = b.groupBy(group, "_bucket").agg(F.count("*").alias("_n"))
    wb = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(wb), F.lit(0))).drop("_n")
    wr = Window.partitionBy(group, "_bucket").orderBy(key)
    ranked = b.withColumn("_r", F.row_number().over(wr))
    return ranked.join(offsets, [group, "_bucket"]).withColumn(out, F.col("_before") + F.col("_r")).drop(
        "_bucket", "_before", "_r")


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with its fixture coordinates."""
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), "c_name", F.lower("c_mktsegment").alias("sector"))
    co = cust.join(F.broadcast(_sector_table(spark)), "sector")
    co = with_rank(co, "sector", "k", "pos").withColumn("pos", F.col("pos") - 1)
    return co.select(
        "*",
        (F.floor(F.col("pos") / PER_PAGE) + 1).cast("int").alias("own_page"),
        w_label(F.col("k")).alias("w"),
        profile_href(F.col("k")).alias("href"),
        F.concat(F.lit(DIR_ORIGIN), profile_href(F.col("k"))).alias("profile_url"),
    )


# -- F1 ---------------------------------------------------------------------------

def _anchor(k: Column, name: Column, href: Column) -> Column:
    v = k % 6
    attrs = F.concat(F.lit('<a data-test="company-name" href="'), href, F.lit('"'))
    return (
        F.when(v == 0, F.concat(attrs, F.lit(">"), name, F.lit("</a>")))
        .when(v == 1, F.concat(attrs, F.lit("><span>"), name, F.lit("</span></a>")))
        .when(v == 2, F.concat(attrs, F.lit(' title="'), name, F.lit('"></a>')))
        .when(v == 3, F.concat(attrs, F.lit(' aria-label="'), name, F.lit('"></a>')))
        .when(v == 4, F.concat(attrs, F.lit("></a>")))
        .otherwise(F.concat(attrs, F.lit(' title="'), name, F.lit('">X</a>')))
    )


def _next_markup(form: Column, path: Column) -> Column:
    return (
        F.when(form == "rel_next", F.concat(F.lit('<div class="pagination"><a rel="next" href="'), path, F.lit('">More</a></div>')))
        .when(form == "aria_label", F.concat(F.lit('<a aria-label="Next page" href="'), path, F.lit('">&rsaquo;</a>')))
        .when(form == "pagination_next", F.concat(F.lit('<div class="pagination"><a class="next" href="'), path, F.lit('">&rsaquo;</a></div>')))
        .when(form == "text_next", F.concat(F.lit('<a href="'), path, F.lit('">Next</a>')))
        .otherwise(F.concat(F.lit('<a href="'), path, F.lit('">&rsaquo;</a>')))
    )


def listing_placements(spark: SparkSession, sf_dir: str, co: DataFrame | None = None) -> DataFrame:
    """``(sector, page_no, sort_key struct, k, c_name, href)``: every anchor
    of every listing page (own, carried-over, appended)."""
    co = companies(spark, sf_dir) if co is None else co
    n_pages = co.groupBy("sector").agg(F.max("own_page").alias("n_pages"))
    own = co.select("sector", F.col("own_page").alias("page_no"),
                    F.struct(F.lit(1).alias("g"), F.col("pos").cast("long").alias("o")).alias("sort_key"),
                    "k", "c_name", "href")
    carried = co.join(n_pages, "sector").filter(
        (F.col("pos") % PER_PAGE == PER_PAGE - 1) & (F.col("own_page") < F.col("n_pages"))
    ).select("sector", (F.col("own_page") + 1).alias("page_no"),
             F.struct(F.lit(0).alias("g"), F.col("pos").cast("long").alias("o")).alias("sort_key"),
             "k", "c_name", "href")
    # number of machinery pages: one scalar of a per-sector aggregate
    m_pages = n_pages.filter(F.col("sector") == "machinery").first()
    m_pages = int(m_pages["n_pages"]) if m_pages else 1
    appended = co.filter(F.col("k") % 50 == 0).select(
        F.lit("machinery").alias("sector"),
        ((F.floor(F.col("k") / 50) % F.lit(m_pages)) + 1).cast("int").alias("page_no"),
        F.struct(F.lit(2).alias("g"), F.col("k").cast("long").alias("o")).alias("sort_key"),
        "k", "c_name", "href",
    )
    return own.unionByName(carried).unionByName(appended)


def listing_pages(spark: SparkSession, sf_dir: str, co: DataFrame | None = None) -> DataFrame:
    """``(sector, page_no, url, html)``."""
    co = companies(spark, sf_dir) if co is None else co
    pl = listing_placements(spark, sf_dir, co)
    n_pages = co.groupBy("sector").agg(F.max("own_page").alias("n_pages"))
    pages = pl.groupBy("sector", "page_no").agg(
        F.array_sort(F.collect_list(F.struct("sort_key", _anchor(F.col("k"), F.col("c_name"), F.col("href")).alias("a")))).alias("items")
    )
    pages = pages.join(n_pages, "sector").join(F.broadcast(_sector_table(spark)), "sector")
    is_last = F.col("page_no") == F.col("n_pages")
    nxt = (
        F.when(~is_last, _next_markup(F.col("next_form"), listing_path(F.col("sector"), F.col("page_no") + 1)))
        .when((F.col("next_form") == "href_pg") & (F.col("page_no") > 1),
              _next_markup(F.col("next_form"), listing_path(F.col("sector"), F.col("page_no"))))
        .otherwise(F.lit(""))
    )
    html = F.concat(
        F.lit("<!DOCTYPE html>\n<html><head><title>"), F.initcap("sector"), F.lit(" suppliers - page "),
        F.col("page_no").cast("string"), F.lit("</title></head>\n<body>\n"),
        F.lit('<main><ul class="listing"><li class="list-item"><a class="card-title" href="/companies/'), F.col("sector"),
        F.lit('.html">'), F.initcap("sector"), F.lit(' suppliers</a></li></ul></main>\n<div class="results">\n'),
        F.array_join(F.transform("items", lambda i: i["a"]), "\n"),
        F.lit('\n<a data-test="company-name">Unlisted</a>\n</div>\n'), nxt, F.lit("\n</body></html>"),
    )
    return pages.select("sector", "page_no", listing_url(F.col("sector"), F.col("page_no")).alias("url"), html.alias("html"))


# -- F2 ---------------------------------------------------------------------------

FILLER_500 = "abc " * 130


def _country_markup(k: Column) -> Column:
    v = k % 12
    return (
        F.when(v == 0, F.lit('<span data-v-fc5493f1 class="vis-flag de"></span><span data-v-fc5493f1>Deutschland</span>'))
        .when(v == 1, F.lit('<i class="vis-flag"></i><b>x</b><span>España</span>'))
        .when(v == 2, F.lit('<div class="company-address">12 Rue X, France</div>'))
        .when(v == 4, F.lit('<div class="company-address">exports to Italy</div>'))
        .when(v == 7, F.lit("<p>we are based in Portugal</p>"))
        .when(v == 8, F.lit(f'<div class="address">{FILLER_500}Italy</div>'))
        .when(v == 9, F.lit('<span data-v-fc5493f1 class="vis-flag tr"></span><span data-v-fc5493f1>Turkey</span>'))
        .when(v == 11, F.lit('<div class="address">Kyiv, Ukraine</div>'))
        .otherwise(F.lit(""))
    )


def _head_markup(k: Column) -> Column:
    ld = '{"@type":"Organization","address":{"addressCountry":"UK"}}'
    return (
        F.when(k % 24 == 17, F.lit(f'<script type="application/ld+json">[{ld}]</script>'))
        .when(k % 12 == 5, F.lit(f'<script type="application/ld+json">{ld}</script>'))
        .when(k % 12 == 6, F.lit('<meta name="geo.country" content="&Ouml;sterreich">'))
        .otherwise(F.lit(""))
    )


def site_url(k: Column) -> Column:
    return F.concat(F.lit("https://www."), w_label(k), F.lit(".com"))


def _website_markup(k: Column) -> Column:
    v = F.floor(k / 10) % 5
    site = site_url(k)
    return (
        F.when(v == 0, F.concat(F.lit('<a class="website-button" href="'), site, F.lit('">Website</a>')))
        .when(v == 1, F.concat(F.lit('<a class="x website-button-lg" href="'), site, F.lit('">Website</a>')))
        .when(v == 2, F.concat(F.lit('<a class="website-button" href="https://www.dropbox.com/x">Open</a>\n<a href="'),
                               site, F.lit('">Visit us</a>')))
        .when(v == 3, F.concat(F.lit('<a href="https://other.test">Partner</a>\n<a href="'), site, F.lit('">Homepage</a>')))
        .otherwise(F.lit(""))
    )


def profile_pages(spark: SparkSession, sf_dir: str, co: DataFrame | None = None) -> DataFrame:
    """``(url, html)``; the profiles of ``k % 40 = 39`` could not be fetched."""
    co = (companies(spark, sf_dir) if co is None else co).filter(F.col("k") % 40 != 39)
    k = F.col("k")
    html = F.concat(
        F.lit("<!DOCTYPE html>\n<html><head><title>Company profile</title>"), _head_markup(k),
        F.lit("</head>\n<body>\n<h1>"), F.col("c_name"), F.lit("</h1>\n<div class=\"profile\">\n"),
        _country_markup(k), F.lit("\n</div>\n<div class=\"links\">\n"), _website_markup(k),
        F.lit("\n</div>\n</body></html>"),
    )
    return co.select(F.col("profile_url").alias("url"), html.alias("html"))


# -- F3 ---------------------------------------------------------------------------

def _nav(k: Column) -> Column:
    v = k % 10
    base = '<li><a href="/contact">Contact</a></li><li><a href="/ueber">&Uuml;ber uns</a></li>'
    return (
        F.when((v == 0) | (v == 7), F.lit(f"<nav><ul>{base}</ul></nav>"))
        .when(v == 8, F.lit(f'<nav><ul>{base}<li><a href="/team">Team</a></li><li><a href="/extra">Info</a></li></ul></nav>'))
        .otherwise(F.lit(""))
    )


def _addr(local: str, k: Column) -> Column:
    return F.concat(F.lit(local + "@"), w_label(k), F.lit(".com"))


def _home_content(k: Column) -> Column:
    v = k % 10
    wl = w_label(k)
    six = F.concat_ws(" ", *[_addr(x, k) for x in ("aa", "bb", "cc", "dd", "ee", "ff")])
    return (
        F.when(v == 1, F.concat(F.lit("<p>Write to "), _addr("office", k), F.lit(" today.</p>")))
        .when(v == 2, F.concat(F.lit("<p>Write to office&#64;"), wl, F.lit(".com today.</p>")))
        .when(v == 4, F.concat(F.lit("<p>Write to joe.doe@"), wl, F.lit(".com today.</p>")))
        .when(v == 5, F.lit("<p>Write to abc@yahoo.com today.</p>"))
        .when(v == 6, F.lit("<p>Write to sales@group.com today.</p>"))
        .when(v == 7, F.concat(F.lit("<p> "), six, F.lit(" </p>")))
        .when(v == 8, F.concat(F.lit("<p> "), _addr("aa", k), F.lit(" "), _addr("bb", k), F.lit(" </p>")))
        .when(v == 9, F.concat(F.lit("<p>Write to office@"), wl, F.lit(".info or noreply@"), wl, F.lit(".com today.</p>")))
        .otherwise(F.lit("<p>Quality products since 1990.</p>"))
    )


def _page(head: Column, body: Column) -> Column:
    return F.concat(F.lit("<!DOCTYPE html>\n<html><head><title>Home</title>"), head, F.lit("</head>\n<body>\n"),
                    body, F.lit("\n<footer><p>All rights reserved.</p></footer>\n</body></html>"))


def site_pages(spark: SparkSession, sf_dir: str, co: DataFrame | None = None) -> DataFrame:
    """company homepages and their contact pages."""
    co = (companies(spark, sf_dir) if co is None else co).filter(F.floor(F.col("k") / 10) % 5 != 4)
    k = F.col("k")
    site = site_url(k)
    v = k % 10
    script = F.when(v == 3, F.concat(F.lit('<script>var m="office @ '), w_label(k), F.lit('.com";</script>'))).otherwise(F.lit(""))
    home = co.filter(k % 20 != 15).select(
        site.alias("url"),
        _page(script, F.concat(_nav(k), F.lit("\n<div class=\"intro\"><p>Welcome to our company.</p></div>\n"), _home_content(k))).alias("html"),
    )
    contact_body = (
        F.when(v == 0, F.concat(F.lit('<p><a href="mailto:sales@'), w_label(k), F.lit('.com?subject=Hi">Mail us</a></p>')))
        .when(v == 8, F.concat(F.lit('<div class="contact-info">\n<p> '), _addr("cc", k), F.lit(" </p>\n<p> "),
                               _addr("dd", k), F.lit(" </p>\n</div>")))
        .otherwise(F.lit("<p>Reach us by phone.</p>"))
    )
    contact_head = F.when(v == 7, F.concat(F.lit('<script>var c="mailto:gg@'), w_label(k), F.lit('.com";</script>'))).otherwise(F.lit(""))
    contact = co.filter(v.isin(0, 7, 8)).select(
        F.concat(site, F.lit("/contact")).alias("url"), _page(contact_head, contact_body).alias("html"))
    ueber = co.filter(v == 8).select(
        F.concat(site, F.lit("/ueber")).alias("url"),
        _page(F.lit(""), F.concat(F.lit("<p> "), _addr("ee", k), F.lit(" "), _addr("ff", k), F.lit(" </p>"))).alias("html"))
    team = co.filter(v == 8).select(
        F.concat(site, F.lit("/team")).alias("url"),
        _page(F.lit(""), F.concat(F.lit("<p> "), _addr("gg", k), F.lit(" </p>"))).alias("html"))
    return home.unionByName(contact).unionByName(ueber).unionByName(team)


_CRAWLS: dict = {}


def crawl(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The synthesised crawl, written once per session to the checkpoint
    folder (it plays the stored crawl table; generating it is not pipeline
    work): ``(listings(sector, page_no, url, html), profiles(url, html),
    sites(url, html))``."""
    from leadforge.session import cut_lineage

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CRAWLS:
        # stored like a crawl that arrives in many files: one part per core
        n = spark.sparkContext.defaultParallelism
        co = cut_lineage(companies(spark, sf_dir))
        _CRAWLS[key] = (
            cut_lineage(listing_pages(spark, sf_dir, co).repartition(n, "url")),
            cut_lineage(profile_pages(spark, sf_dir, co).repartition(n, "url")),
            cut_lineage(site_pages(spark, sf_dir, co).repartition(n, "url")),
            co,
        )
    return _CRAWLS[key][:3]


def crawl_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture company table the crawl was generated from (memoised with it)."""
    crawl(spark, sf_dir)
    return _CRAWLS[(spark.sparkContext.applicationId, sf_dir)][3]


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole synthesised crawl: ``(url, html)``."""
    lp = listing_pages(spark, sf_dir).select("url", "html")
    return lp.unionByName(profile_pages(spark, sf_dir)).unionByName(site_pages(spark, sf_dir))


# -- S2 ---------------------------------------------------------------------------

def _record(tag: str, attrs=(), classes=(), inside: dict | None = None) -> dict:
    return {"tag": tag, "classes": list(classes), "attrs": [dict(zip(("name", "op", "value"), a)) for a in attrs], "inside": inside}


# The sectors' own selectors.  Building names its links by their block,
# automobile its next link by the pagination block, all others alike.
_LINK = _record("a", [("data-test", "=", "company-name")])
_NEXT = _record("a", [("aria-label", "=", "Next page")])
SECTOR_SELECTORS = {
    "automobile": (_LINK, _record("a", [("rel", "=", "next")], inside=_record("div", classes=["pagination"]))),
    "building": (_record("a", inside=_record("div", classes=["results"])), _NEXT),
}


def fixture_sector_config(spark: SparkSession, sf_dir: str, bounded: bool = False) -> DataFrame:
    """S2 for the synthesised directory: the sectors present in ``customer``,
    their first listing page, ``max_pages`` and keyword list (NULL for
    building/household: quirk K3, NULL means empty).  ``max_pages`` is the
    sector's number of listing pages, or with ``bounded`` the fixture's bound
    (NULL for household: the default holds)."""
    present = (read_table(spark, sf_dir, "customer").groupBy(F.lower("c_mktsegment").alias("sector"))
               .agg(F.ceil(F.count("*") / PER_PAGE).cast("int").alias("n_pages")))
    cfg = _sector_table(spark).join(present, "sector")
    if not bounded:
        cfg = cfg.withColumn("max_pages", F.col("n_pages"))
    kw = (
        F.when(F.col("sector") == "automobile", F.array(F.lit("motors"), F.lit("automotive")))
        .when(F.col("sector") == "machinery", F.array(F.lit("cnc"), F.lit("machining"), F.lit("yahoo.com")))
        .when(F.col("sector") == "furniture", F.array().cast("array<string>"))
    )
    from leadforge.sources.config import SELECTOR

    selectors = [(s, *SECTOR_SELECTORS.get(s, (_LINK, _NEXT))) for s, _, _ in SECTOR_FIXTURE]
    if bounded:  # furniture has no pagination selector: its walk ends on page one
        selectors = [(s, a, None if s == "furniture" else b) for s, a, b in selectors]
    records = spark.createDataFrame(selectors, f"sector string, link_selector {SELECTOR}, pagination_selector {SELECTOR}")
    return cfg.join(records, "sector").select(
        "sector", "sector_ord", listing_url(F.col("sector"), F.lit(1)).alias("url"), "max_pages",
        kw.alias("business_domain_keywords"), "link_selector", "pagination_selector",
    )
