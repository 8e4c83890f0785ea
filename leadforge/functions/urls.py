"""H6 URL resolution, W3 website check, C6 country from URL."""

from __future__ import annotations

from urllib.parse import urljoin as _urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge import params
from leadforge.functions.text import any_contains


def _join_one(b: str | None, h: str | None) -> str | None:
    if b is None or h is None:
        return None
    try:
        return _urljoin(b, h)
    except ValueError:  # e.g. an unbalanced "[" in the host: the link is unusable
        return None


@F.pandas_udf(T.StringType())
def _urljoin_udf(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([_join_one(b, h) for b, h in zip(base, href)], dtype=object)


# Root-relative href whose resolution is plain concatenation: no "//" start, no
# dot segments, no query/fragment markers (urljoin drops empty ones).
_SIMPLE_ROOT_REL = r"^/(?!/)[^?#]*$"
_HAS_DOT_SEGMENT = r"(^|/)\.\.?(/|$)"
_HTTP_ORIGIN = r"^(https?://[^/?#]*)"
# Absolute http(s) URL (lower-case scheme, with a host) that urljoin returns
# unchanged: no whitespace or control characters (urlsplit strips them), no
# ';' (path parameters are re-serialised), no backslash or bracket, and no empty
# query/fragment marker at the end (urlunsplit drops those).
_CLEAN_ABSOLUTE = r"^(?!.*(\?#|[?#]$))https?://[^/?#;\[\]\s\x00-\x1f\x7f\\]+[^;\[\]\s\x00-\x1f\x7f\\]*$"


def urljoin(base: Column, href: Column) -> Column:
    """RFC 3986 resolution of ``href`` against ``base`` (``urllib.parse.urljoin``).

    Root-relative hrefs against an http(s) base (origin || href) and clean
    absolute http(s) URLs (unchanged) are resolved natively; every other row
    goes through one Arrow-batched ``pandas_udf``.  Rows on the native path
    reach the UDF as NULLs.
    """
    origin = F.regexp_extract(base, _HTTP_ORIGIN, 1)
    root_rel = F.coalesce(
        href.rlike(_SIMPLE_ROOT_REL) & ~href.rlike(_HAS_DOT_SEGMENT) & (origin != F.lit("")), F.lit(False))
    absolute = F.coalesce(href.rlike(_CLEAN_ABSOLUTE) & (origin != F.lit("")), F.lit(False))
    fast = root_rel | absolute
    slow = _urljoin_udf(F.when(~fast, base), F.when(~fast, href))
    return (F.when(href.isNull() | base.isNull(), F.lit(None))
            .when(root_rel, F.concat(origin, href))
            .when(absolute, href)
            .otherwise(slow))


def is_valid_website(url: Column, unwanted: list[str] | None = None) -> Column:
    """http(s) scheme (case-sensitive) and none of the unwanted hosts."""
    unwanted = params.UNWANTED_WEBSITE_PARTS if unwanted is None else unwanted
    ok_scheme = url.startswith("http://") | url.startswith("https://")
    return F.coalesce(ok_scheme & ~any_contains(F.lower(url), unwanted), F.lit(False))


def country_from_url(url: Column, segments: list[tuple[str, str]] | None = None) -> Column:
    """First URL segment of the list contained in the lower-cased URL, else NULL."""
    segments = params.URL_COUNTRY_SEGMENTS if segments is None else segments
    low = F.lower(url)
    out = None
    for seg, country in segments:
        out = F.when(low.contains(seg), F.lit(country)) if out is None else out.when(low.contains(seg), F.lit(country))
    return out
