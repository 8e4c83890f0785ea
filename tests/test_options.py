"""Options of the jobs (K2, K5, K7, caps), run accounting, and the plans that
lookups, discovery and descendant tests are to have."""

import random
import re
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from leadforge import params
from leadforge.functions.email import is_business
from leadforge.functions.select import count, sel, select
from leadforge.operators import discovery as P
from leadforge.operators import emails as E
from leadforge.operators import stats as A
from leadforge.operators.dom import parse_pages
from leadforge.plans import cli, pipeline
from leadforge.plans.q_contacts import fixture_run
from leadforge.sources import fixtures as FX
from leadforge.sources.config import CONFIG_SCHEMA, shipped_keywords
from leadforge.sources.pages import lookup_pages


def test_keywords_match_exactly_or_as_parts(spark):
    df = spark.createDataFrame([("a@winery-x.com", ["winery"]), ("a@gmail.com", ["mail"]), ("a@gmail.com", ["", None]), ("a@GMAIL.com", ["GMAIL.com"]),
                                ("a@gmail.com", None), ("a", ["a"])], "e string, k array<string>")
    get = lambda match: [r[0] for r in df.select(is_business(F.col("e"), F.col("k"), match=match)).collect()]
    assert get("exact") == [True, False, False, False, False, False]
    assert get("contains") == [True, True, False, True, False, False]


def test_text_pattern_and_separator(spark):
    df = spark.createDataFrame([("u", "<p>first.last@shop-y.co.uk</p><p>bb@acme.com</p><p>cc@acme.com</p><b> é </b>x")], "url string, html string")
    hits = lambda **o: E.page_candidates(df, **o).select("text_hits").first()[0]
    assert hits() == ["last@shop-y.co", "cc@acme.com"] or "bb@acme.com" not in hits()
    assert hits(sep="\n") == ["last@shop-y.co", "bb@acme.com", "cc@acme.com"]
    assert "first.last@shop-y.co.uk" in hits(sep="\n", text_pattern=params.EMAIL_FLEXIBLE_PATTERN)
    row = parse_pages(df, sep="|").select("text", "stext").first()
    assert row["text"] == "first.last@shop-y.co.uk|bb@acme.com|cc@acme.com| é |x" and row["stext"] == "first.last@shop-y.co.ukbb@acme.comcc@acme.coméx"


def test_flags_reach_the_run(spark, tmp_path):
    a = cli.parse_args("contacts --config c --listings l --pages p --out o".split())
    assert (a.max_contact_pages, a.stop_at, a.match, a.sep) == (params.MAX_CONTACT_PAGES, params.EARLY_STOP_EMAILS, "exact", "")
    a = cli.parse_args("contacts --config c --listings l --pages p --out o --contact-pages all --stop-at all --match contains --text-pattern flexible --shipped-keywords".split())
    assert (a.max_contact_pages, a.stop_at, a.match, a.text_pattern, a.shipped_keywords) == (None, None, "contains", params.EMAIL_FLEXIBLE_PATTERN, True)

    listings, profiles, sites = FX.crawl(spark, SF_SMALL)
    listings.select("url", "html").write.parquet(f"{tmp_path}/listings")
    profiles.unionByName(sites).write.parquet(f"{tmp_path}/pages")
    FX.fixture_sector_config(spark, SF_SMALL).write.json(f"{tmp_path}/config")
    r = cli.contacts(spark, *(f"{tmp_path}/{x}" for x in ("config", "listings", "pages", "out")), max_contact_pages=None, stop_at=None)
    every = spark.read.option("header", True).csv(f"{tmp_path}/out/emails").count()
    assert every == fixture_run(spark, SF_SMALL, max_contact_pages=None, stop_at=None).contacts.count() > 210
    stats = spark.read.json(f"{tmp_path}/out/stats").collect()
    assert all(s["processing_time_seconds"] > 0 and s["rejected"] == 0 for s in stats)
    assert all(m["processing_time_seconds"] > 0 for m in spark.read.json(f"{tmp_path}/out/manifest").collect())
    seen = r.observed()
    assert seen["listings"]["pages"] == listings.count() and seen["listings"]["rejected"] == 0 and seen["homepages"]["missing"] > 0


def test_rejected_profiles_are_counted(spark):
    cfg = spark.createDataFrame([("s", 1, "http://d/list", 1, None, None, None)], CONFIG_SCHEMA)
    listing = '<a data-test="company-name" href="http://d/a">Aa</a><a data-test="company-name" href="http://d/b">Bb</a><a data-test="company-name" href="http://d/c">Cc</a>'
    pages = spark.createDataFrame([("http://d/a", "<p>fine</p>"), ("http://d/b", "<![if"), ("http://d/x", None)], "url string, html string")
    r = pipeline.run(cfg, spark.createDataFrame([("http://d/list", listing)], "url string, html string"), pages)
    s = A.scraping_stats(r).first()
    bad = parse_pages(pages).filter("url = 'http://d/b' AND elems IS NULL").count()
    assert (s["companies_found"], s["companies_processed"], s["errors"], s["rejected"]) == (3, 2 - bad, 1 + bad, bad)
    assert r.observed()["listings"] == {"pages": 1, "missing": 0, "rejected": 0} and r.seconds() > 0


def test_shipped_keywords_fill_what_the_config_leaves_out(spark):
    cfg = spark.createDataFrame([("wine", 1, "u", 1, None, None, None), ("wine", 2, "u", 1, ["x"], None, None), ("other", 3, "u", 1, None, None, None)], CONFIG_SCHEMA)
    got = {(r["sector"], r["sector_ord"]): r["business_domain_keywords"] for r in shipped_keywords(cfg).collect()}
    assert "winery" in got["wine", 1] and got["wine", 2] == ["x"] and got["other", 3] is None


def test_lookup_moves_no_html_of_unwanted_pages(spark):
    pages = spark.range(20_000).selectExpr("concat('http://h/', id) AS url", "repeat('x', 50) AS html")
    wanted = spark.range(0, 20_000, 200).selectExpr("concat('http://H/', id, '/#top') AS url").unionByName(spark.createDataFrame([("http://h/none",)], "url string"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = lookup_pages(wanted, pages)
    plan = out._jdf.queryExecution().executedPlan().toString()
    got = {r["url"]: r["html"] for r in out.collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(got) == 101 and got["http://h/none"] is None and sum(h is not None for h in got.values()) == 100
    # Below every exchange that carries html stands the filter, in the scan's own stage.
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and "html" in "".join(lines[i + 1:i + 3]):
            below = "".join(lines[i + 1:i + 6])
            assert "getbit" in below or "bit_get" in below or "SortMergeJoin" in below
    filtered = pages.filter("true")
    from leadforge.functions.bloom import bloom, maybe_in
    from leadforge.sources.pages import url_key
    passed = filtered.filter(maybe_in(bloom(wanted.select(url_key(F.col("url")).alias("k")), "k"), url_key(F.col("url")))).count()
    assert 100 <= passed <= 120


def test_discovery_parses_once_with_a_partial_limit(spark):
    homes = parse_pages(spark.createDataFrame([("http://s/", "<a href='/contact'>Contact</a>"), ("http://t", None)], "site_url string, html string"), keep=["site_url"])
    for out in (P.discover_contact_pages(homes), P.pages_to_check(homes)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and len(re.findall(r"WindowGroupLimit.*Partial", plan)) == 1
    got = sorted((r["site_url"], r["rank"], r["page_url"]) for r in P.pages_to_check(homes).collect())
    assert [g for g in got if g[0] == "http://t"] == [("http://t", 0, "http://t"), *(("http://t", i, f"http://t{p}") for i, p in enumerate(params.CONTACT_PAGE_PATTERNS[:6], 1))]
    assert [g[1:] for g in got if g[0] == "http://s/"][:2] == [(0, "http://s/"), (1, "http://s/contact")] and len([g for g in got if g[0] == "http://s/"]) == 6


def test_inside_on_random_nesting(spark):
    rng = random.Random(11)

    def tree(depth):
        if depth == 0:
            return "<b></b>"
        return "".join(f"<{t} class='{c}'>{tree(depth - 1)}</{t}>" for t, c in ((rng.choice(["div", "p", "b"]), rng.choice(["x", "y", "z"])) for _ in range(rng.randint(0, 3))))

    pages = spark.createDataFrame([(str(i), tree(5)) for i in range(60)], "url string, html string")
    dom = parse_pages(pages)
    elems = {r["url"]: r["elems"] for r in dom.select("url", "elems").collect()}

    def brute(es):
        x = [e for e in es if "x" in e["cls"]]
        xy = [e for e in es if "y" in e["cls"] and any(a["id"] < e["id"] <= a["end"] for a in x)]
        return [e["id"] for e in es if e["tag"] == "b" and any(a["id"] < e["id"] <= a["end"] for a in xy)]

    s = sel("b", inside=sel(cls="y", inside=sel(cls="x")))
    got = {r["url"]: [e["id"] for e in r["hits"]] for r in dom.select("url", select(s).alias("hits")).collect()}
    assert got == {u: brute(es) for u, es in elems.items()} and any(got.values())


def test_inside_is_not_elements_times_matches(spark):
    def took(n):
        html = "<div class='x'><i></i><i></i><i></i></div>" * n
        dom = parse_pages(spark.createDataFrame([("u", html)], "url string, html string")).select("url", "elems", "btext", "text")
        rows = dom.cache()
        rows.count()
        q = rows.select(count(sel("i", inside=sel(cls="x"))).alias("n"))
        assert q.first()[0] == 3 * n
        t = time.time()
        q.first()
        rows.unpersist()
        return time.time() - t

    assert took(4000) < 6 * took(1000) + 1.0
