"""Property checks: Spark expressions against Python's own semantics on
seeded random inputs (one DataFrame per property, not one job per case)."""

import random
import re
from urllib.parse import urljoin

from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.email import classify_email
from leadforge.functions.text import pystrip, title_case
from leadforge.functions.urls import _CLEAN_ABSOLUTE

RNG = random.Random(20261202)
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZéÉüÜñßøÅ"


def _strings(alphabet, n=3000, max_len=14):
    return [("".join(RNG.choice(alphabet) for _ in range(RNG.randint(0, max_len))),) for _ in range(n)]


def test_title_case_matches_python(spark):
    rows = _strings(LETTERS + "0123456789 -_'.,/", max_len=12)
    rows = [r for r in rows if "ß" not in r[0]]  # upper('ß') is 'SS' in both, title() gives 'Ss'
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(title_case(F.col("x"))).collect()]
    assert got == [r[0].title() for r in rows]


def test_pystrip_matches_python(spark):
    rows = _strings("ab \t\n\r\x0b\x0c\xa0 　\x1c", max_len=10)
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(pystrip(F.col("x"))).collect()]
    assert got == [r[0].strip() for r in rows]


def _py_classify(raw):
    """E7-E10 written with Python's re and the same fixed values."""
    if not raw:
        return None, "empty"
    e = raw.replace("&#64;", "@").replace("&amp;", "&").strip(params.EMAIL_STRIP_CHARS).lower()
    if not re.match(params.EMAIL_STRICT_PATTERN, e):
        return None, "format"
    if not re.match(params.EMAIL_FORMAT_PATTERN, e):
        return None, "tld"
    if "@" not in e or e.split("@")[1].lower() in params.PERSONAL_DOMAINS:
        return None, "personal"
    if any(p in e for p in params.SPAM_PATTERNS):
        return None, "spam"
    return e, None


def test_classify_matches_python(spark):
    parts = ["info", "sales", "a.b", "x-y", "noreply", "gmail.com", "acme", "co", "uk", "fr", "museum", "&#64;",
             "@", ".", "<", ">", ";", " ", "(", ")", "\"", "&amp;", "Z", "9"]
    rows = [("".join(RNG.choice(parts) for _ in range(RNG.randint(1, 7))),) for _ in range(4000)]
    df = spark.createDataFrame(rows, "x string").select(classify_email(F.col("x")).alias("r"))
    got = [(r.r.email, r.r.reason) for r in df.collect()]
    assert got == [_py_classify(r[0]) for r in rows]


def test_absolute_url_fast_path_is_identity():
    pat = re.compile(_CLEAN_ABSOLUTE)
    alpha = "ab/?#.:%;=&@[]!$'()*+,~-_ \t\\é"
    for base in ("https://a.test/d/p.html?q=1", "http://a.test/"):
        for _ in range(20000):
            href = RNG.choice(["https://", "http://"]) + RNG.choice(["h", "H", "u@h", "h:80"]) + \
                "".join(RNG.choice(alpha) for _ in range(RNG.randint(0, 10)))
            if pat.match(href):
                assert urljoin(base, href) == href, href
