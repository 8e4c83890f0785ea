"""Golden rows (G) for the list-like predicates and string helpers."""

from urllib.parse import urljoin

from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.country import context_ok, normalize_country
from leadforge.functions.email import classify_email, is_business, is_valid_format, strip_email
from leadforge.functions.text import pystrip, title_case
from leadforge.functions.urls import is_valid_website, urljoin as sp_urljoin
from leadforge.operators.directory import slug_name


def one(spark, col, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(col).collect()]


def test_email_strict_vs_format(spark):
    cases = {"a@b.info": ("format_ok", False), "x+y@b.com": (None, True), "sales@acme.co.uk": (None, True),
             "info@acme.museum": (None, False)}
    strict = one(spark, F.col("x").rlike(params.EMAIL_STRICT_PATTERN), list(cases))
    fmt = one(spark, is_valid_format(F.col("x")), list(cases))
    assert strict == [True, False, True, True]
    assert fmt == [False, True, True, False]


def test_strip_set(spark):
    assert one(spark, strip_email(F.col("x")), ['<(A@B.com);', "info@a.fr "]) == ["a@b.com", "info@a.fr "]


def test_classify_reasons(spark):
    got = one(spark, classify_email(F.col("x"))["reason"],
              ["", "info@a.fr ", "a@b.info", "abc@gmail.com", "noreply@acme.com", "sales@acme.com"])
    assert got == ["empty", "format", "tld", "personal", "spam", None]


def test_personal_domains_and_custom(spark):
    addrs = [f"x@{d}" for d in params.PERSONAL_DOMAINS]
    assert one(spark, is_business(F.col("x")), addrs) == [False] * len(addrs)
    custom = F.array(F.lit("gmail.com"))
    assert one(spark, is_business(F.col("x"), custom), ["x@gmail.com", "x@yahoo.com"]) == [True, False]


def test_every_spam_entry(spark):
    addrs = [f"{p.replace('@', '')}x@acme.com" if "@" not in p else p + "acme.com" for p in params.SPAM_PATTERNS]
    reasons = one(spark, classify_email(F.col("x"))["reason"], addrs)
    assert all(r in ("spam", "format", "tld") for r in reasons)


def test_text_pattern_edges(spark):
    df = spark.createDataFrame([("first.last@x-y.com",), ("info@acme.co.uk",), ("éinfo@acme.fr",),
                                ("<p>bb@x.com</p><p>cc@x.com</p>",)], "x string")
    from leadforge.operators.emails import UI

    got = [r[0] for r in df.select(F.regexp_extract_all("x", F.lit(UI + params.EMAIL_TEXT_PATTERN), 0)).collect()]
    assert got[0] == ["last@x-y.com"]
    assert got[1] == ["info@acme.co"]
    assert got[2] == []


def test_glued_text_k7(spark):
    from leadforge.operators.dom import parse_html
    from leadforge.operators.emails import UI

    import re

    text, _, _ = parse_html("<p>bb@x.com</p><p>cc@x.com</p>")
    assert text == "bb@x.comcc@x.com"  # blocks glued with no separator
    df = spark.createDataFrame([(text,)], "x string")
    got = df.select(F.regexp_extract_all("x", F.lit(UI + params.EMAIL_TEXT_PATTERN), 0)).first()[0]
    assert got == re.findall(params.EMAIL_TEXT_PATTERN, text, re.IGNORECASE) == ["bb@x.comcc"]


def test_normalize_country_golden(spark):
    keys = [k for k, _ in params.COUNTRY_ALIASES] + params.COUNTRY_PROPER_NAMES + ["Turkey", " uk ", "Narnia"]
    want = [v for _, v in params.COUNTRY_ALIASES] + params.COUNTRY_PROPER_NAMES + ["", "United Kingdom", ""]
    assert one(spark, normalize_country(F.col("x")), keys) == want


def test_context_negative_phrases(spark):
    texts = [f"we {p} france" for p in params.COUNTRY_NEGATIVE_PHRASES] + ["based in france", "x" * 300]
    assert one(spark, context_ok(F.col("x")), texts) == [False] * 7 + [True, True]


def test_valid_website(spark):
    urls = [f"https://{u}/x" for u in params.UNWANTED_WEBSITE_PARTS] + ["ftp://x", "HTTP://x", "https://acme.com"]
    assert one(spark, is_valid_website(F.col("x")), urls) == [False] * 12 + [True]


def test_title_case_and_strip(spark):
    assert one(spark, title_case(F.col("x")), ["o'neil 3d-print", "ACME TOOLS"]) == ["O'Neil 3D-Print", "Acme Tools"]
    assert one(spark, pystrip(F.col("x")), ["  a b\t\n"]) == ["a b"]


def test_slug_rule(spark):
    assert one(spark, slug_name(F.col("x")), ["/CANARY-ISLAND-WORLDWIDE-SL/00000005425544-763896001.html", "/x"]) == \
        ["Canary Island Worldwide Sl", None]


def test_urljoin_matches_stdlib(spark):
    base = "https://a.test/dir/page.html?q=1"
    from leadforge.functions.urls import _join_one

    hrefs = ["/x", "x/y", "../z", "//cdn.test/a", "https://b.test/", "mailto:a@b.c", "?p=2", "#top", "/a/./b", "/x?",
             "https://b.test/x?y=1#z", "https://b.test/x?", "http://b.test/a;p", "https://b.test/a/../b", "https://[::1/x"]
    rows = spark.createDataFrame([(base, h) for h in hrefs], "b string, h string")
    got = [r[0] for r in rows.select(sp_urljoin(F.col("b"), F.col("h"))).collect()]
    assert got == [_join_one(base, h) for h in hrefs]
    assert got[:10] == [urljoin(base, h) for h in hrefs[:10]]
    assert got[-1] is None  # malformed host: the link is dropped, the job goes on


def test_published_sample_rows(spark):
    """The three addresses of the published emails sample pass E7-E10, and the
    two websites of the links sample are valid (W3)."""
    emails = ["direccion@canaryislandworldwide.com", "info@canaryislandworldwide.com", "enoteca@bocopa.com"]
    assert one(spark, classify_email(F.col("x"))["email"], emails) == emails
    sites = ["https://www.burgondie.info/", "https://www.canaryislandworldwide.es"]
    assert one(spark, is_valid_website(F.col("x")), sites) == [True, True]


def test_sector_config_validation(spark):
    import pytest

    from leadforge.sources.config import validate_config
    from leadforge.sources.config import CONFIG_SCHEMA

    good = spark.createDataFrame([("wines", 1, "https://d.test/w.html", None, None, None, None)], CONFIG_SCHEMA)
    row = validate_config(good).first()
    assert row.max_pages == 2 and row.business_domain_keywords == []  # defaults; NULL keywords = empty (K3)
    bad = spark.createDataFrame([("wines", 1, "  ", 2, ["wine"], None, None)], CONFIG_SCHEMA)
    with pytest.raises(Exception, match="required field is empty"):
        validate_config(bad).collect()
