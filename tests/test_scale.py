"""Page-local work is linear in the page, lookups match what a fetcher would."""

import time

from pyspark.sql import functions as F

from leadforge.operators import country as C
from leadforge.operators import directory as D
from leadforge.operators import discovery as P
from leadforge.operators.dom import parse_pages
from leadforge.functions.select import sel, select, select_by
from leadforge.sources.config import CONFIG_SCHEMA, SELECTOR, read_config
from conftest import SF_SMALL
from leadforge.sources.fixtures import fixture_sector_config
from leadforge.sources.pages import lookup_pages, url_key


def _page(n):
    spans = "".join(f"<span>plain {i}</span>" for i in range(n))
    flags = "".join(f'<i class="vis-flag"></i><span data-v-fc5493f1>nowhere {i}</span>' for i in range(n))
    menus = "".join(f'<div class="menu"><a href="/contact-{i}">Contact</a>' for i in range(n // 8))
    return f"<body>{spans}{flags}{menus}</body>"


def _seconds(spark, n):
    dom = parse_pages(spark.createDataFrame([("https://a.test/x.html", _page(n))], "url string, html string")).cache()
    dom.count()
    t0 = time.time()
    row = C.country_columns(dom).select("country").first()
    links = P.region_links(dom).count()
    n_found = dom.select(*P.discovery_exprs()).first()["_n_found"]
    t = time.time() - t0
    dom.unpersist()
    assert row["country"] == "" and links == 3 * (n // 8) and n_found == n // 8  # nav, main menu, content: no pairs
    return t


def test_time_follows_the_page(spark):
    _seconds(spark, 100)  # compiles
    small, large = _seconds(spark, 1000), _seconds(spark, 8000)
    assert large < 16 * max(small, 0.5), (small, large)


def test_lookup_by_normalised_url(spark):
    pages = spark.createDataFrame([
        ("https://a.test/contact", "c"), ("https://a.test/about/", "a"), ("https://b.test", "b1"), ("https://b.test/", "b2"),
        ("https://c.test/x", None), ("https://c.test/x", "x2"), ("https://c.test/x", "x1"), ("https://d.test/Y", "Y")], "url string, html string")
    wanted = ["https://a.test/contact#form", "https://A.test/contact", "HTTPS://a.test/about", "https://b.test/", "https://b.test",
              "https://c.test/x", "https://d.test/y", "https://e.test/"]
    got = dict(map(tuple, lookup_pages(spark.createDataFrame([(u,) for u in wanted], "url string"), pages).collect()))
    assert got == {wanted[0]: "c", wanted[1]: "c", wanted[2]: "a", wanted[3]: "b2", wanted[4]: "b1", wanted[5]: "x1", wanted[6]: None, wanted[7]: None}
    keys = spark.range(1).select(url_key(F.lit("HTTP://X.Test/A/#b")).alias("k"), url_key(F.lit("/rel/")).alias("r")).first()
    assert tuple(keys) == ("http://x.test/A", "/rel")


def test_walk_without_start_page_is_empty(spark):
    starts = spark.createDataFrame([("s", "https://nowhere.test/", 64)], "sector string, url string, max_pages int")
    nexts = spark.createDataFrame([("https://a.test/1", "https://a.test/2"), ("https://a.test/2", None)], "url string, next_url string")
    assert D.follow_pagination(starts, nexts, 64).count() == 0


def test_sectors_use_their_own_selectors(spark, tmp_path):
    (tmp_path / "cfg.json").write_text("\n".join([
        '{"sector": "a", "sector_ord": 1, "url": "https://d.test/a", "max_pages": 5, "link_selector": {"tag": "a", "classes": ["co"]},'
        ' "pagination_selector": {"tag": "a", "attrs": [{"name": "rel", "op": "=", "value": "next"}], "inside": {"tag": "nav"}}}',
        '{"sector": "b", "sector_ord": 2, "url": "https://d.test/b", "max_pages": 5, "link_selector": {"tag": "a", "attrs": [{"name": "data-b"}]}}',
        '{"sector": "c", "url": "https://d.test/c", "pagination_selector": {"id": "more"}}']))
    cfg = read_config(spark, str(tmp_path / "cfg.json"))
    both = '<a class="co" href="/{0}-co">Co firm</a><a data-b href="/{0}-b">B firm</a><a data-test="company-name" href="/{0}-d">D firm</a>'
    page = lambda name, rest: (f"https://d.test/{name}", both.format(name) + rest)
    pages = spark.createDataFrame([
        page("a", '<a rel="next" href="/b">x</a><nav><a rel="next" href="/a2">x</a></nav>'), page("a2", ""),
        page("b", '<a href="/a2">Next</a>'), page("c", '<a id="more" href="/c2">x</a>'), page("c2", '<a id="more" href="/c3">x</a>'), page("c3", "")],
        "url string, html string")
    got = D.directory_companies(D.listing_features(parse_pages(pages), cfg), cfg)
    urls = sorted((r["sector"], r["page_no"], r["company_url"].rsplit("/", 1)[1]) for r in got.collect())
    assert urls == [("a", 1, "a-co"), ("a", 2, "a2-co"), ("b", 1, "b-b"), ("c", 1, "c-d"), ("c", 2, "c2-d")]  # c: two pages by default


def test_no_pagination_selector_means_no_next_page(spark):
    dom = parse_pages(spark.createDataFrame([("https://a.test/", '<a href="/pg-2.html">Next</a>')], "url string, html string"))
    assert [r["next_url"] for r in D.next_pages(dom, None).collect()] == [None]
    assert [r["next_url"] for r in D.next_pages(dom).collect()] == ["https://a.test/pg-2.html"]


def test_plan_and_page_cost_do_not_grow_with_the_selector_pairs(spark):
    schema = CONFIG_SCHEMA
    def cfg(n):  # noqa: E306
        rows = [(f"s{i:04d}", i, f"https://h{i}.test/", 2, None, {"tag": "a", "id": None, "classes": [f"c{i}"], "attrs": None, "contains": None, "inside": None},
                 {"tag": "a", "id": f"n{i}", "classes": None, "attrs": None, "contains": None, "inside": None}) for i in range(n)]
        return spark.createDataFrame(rows, schema)

    pages = spark.createDataFrame([(f"https://h{i}.test/", f'<a class="c{i}" href="/co{i}">Firm {i}</a><a class="c{i + 1}" href="/x">Other</a><a id="n{i}" href="https://h{i + 1}.test/p">x</a>')
                                   for i in range(30)] + [(f"https://h{i + 1}.test/p", f'<a class="c{i}" href="/next{i}">More {i}</a>') for i in range(30)], "url string, html string").cache()
    dom = parse_pages(pages)
    plans = [len(D._features(dom, cfg(n).select(F.lit("h").alias("host"), D.selector_key().alias("sel_key"), "link_selector", "pagination_selector"))
                 ._jdf.queryExecution().optimizedPlan().toString()) for n in (1, 1000)]
    assert plans[1] < 1.5 * plans[0]
    t0 = time.time()
    got = D.directory_companies(D.listing_features(dom, cfg(1000)), cfg(1000))
    urls = sorted((r["sector"], r["page_no"], r["company_url"]) for r in got.collect())
    assert urls == sorted([(f"s{i:04d}", 1, f"https://h{i}.test/co{i}") for i in range(30)] + [(f"s{i:04d}", 2, f"https://h{i + 1}.test/next{i}") for i in range(30)])
    assert time.time() - t0 < 120
    pages.unpersist()


def test_selector_records_match_as_selectors_do(spark):
    html = ('<div id="m" class="x y"><a class="b" href="/p-1" data-k="v">Next one</a><span class="x">t</span></div><a href="">e</a>'
            '<p class="x"><a class="b c" href="/q.html" rel="next">two</a></p><a class="">three</a>')
    dom = parse_pages(spark.createDataFrame([("u", html)], "url string, html string"))
    at = lambda n, o=None, v=None: {"name": n, "op": o, "value": v}
    rec = lambda tag=None, id=None, classes=None, attrs=None, contains=None, inside=None: {"tag": tag, "id": id, "classes": classes, "attrs": attrs, "contains": contains, "inside": inside}
    cases = [(rec("a"), sel("a")), (rec(id="m"), sel(id="m")), (rec(classes=["b", "c"]), sel(cls=("b", "c"))), (rec("a", attrs=[at("href")]), sel("a", attrs=[("href",)])),
             (rec("a", attrs=[at("href", "*=", "-1")]), sel("a", attrs=[("href", "*=", "-1")])), (rec(attrs=[at("href", "$=", ".html"), at("rel", "=", "next")]), sel(attrs=[("href", "$=", ".html"), ("rel", "=", "next")])),
             (rec(attrs=[at("href", "^=", "")]), sel(attrs=[("href", "^=", "")])), (rec(attrs=[at("class", "*=", "b")]), sel(attrs=[("class", "*=", "b")])), (rec(attrs=[at("class", "has")]), sel(attrs=[("class",)])),
             (rec("a", contains="Next"), sel("a", contains="Next")), (rec("a", inside=rec(classes=["x"])), sel("a", inside=sel(cls="x"))), (rec("a", inside=rec("p", attrs=[at("class", "=", "x")])), sel("a", inside=sel("p", attrs=[("class", "=", "x")])))]
    records = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(cases)], f"i int, r {SELECTOR}")
    got = {r["i"]: [e["id"] for e in r["hits"]] for r in dom.join(records).select("i", select_by("r").alias("hits")).collect()}
    want = {i: [e["id"] for e in dom.select(select(s).alias("h")).first()["h"]] for i, (_, s) in enumerate(cases)}
    assert got == want and sum(map(bool, want.values())) >= 10


def test_pages_of_a_lookup_stay_dealt_over_all_parts(spark):
    """AQE joins parts by their bytes; the parse behind a lookup must not run in one."""
    pages = spark.createDataFrame([(f"http://x/{i}", "<p>x</p>") for i in range(400)], "url string, html string")
    out = lookup_pages(spark.createDataFrame([(f"http://x/{i}",) for i in range(400)], "url string"), pages)
    parts = out.groupBy(F.spark_partition_id().alias("p")).count().count()
    assert parts == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_key_of_a_page_is_computed_once(spark):
    pages = spark.createDataFrame([("http://x/1", "<p>x</p>")], "url string, html string")
    out = lookup_pages(spark.createDataFrame([("http://x/1",)], "url string"), pages)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "getbit" in line]
    assert filters and not any("regexp_extract" in line for line in filters)


def test_listing_pages_of_one_host_stay_where_they_are(spark):
    """One directory is one host: a shuffle by host sends all its pages to a task."""
    html = '<html><body><a data-test="company-name" href="/c">Company</a></body></html>'
    listings = spark.createDataFrame([(f"http://dir/{i}", html) for i in range(64)], "url string, html string").repartition(8)
    config = fixture_sector_config(spark, SF_SMALL).withColumn("url", F.lit("http://dir/0"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        features = D.listing_features(parse_pages(listings), config)
        assert features.count() == 64 * config.select(D.selector_key()).distinct().count()
        assert features.rdd.getNumPartitions() == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
