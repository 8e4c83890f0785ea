"""Country of a company profile page, as one expression per page.

The cascade (first method with a result wins): flag patterns (C1, C2) ->
location selectors (C4) -> URL (C6) -> JSON-LD (C7) -> meta tags (C8) ->
full text (C9) -> ''.  Every step is a Column over the DOM row, so the whole
cascade costs one projection; ``coalesce`` stops at the first non-NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.country import dictionary_country, normalize_country
from leadforge.functions.select import Selector, attr, raw_text, sel, select, select_many, strip_text
from leadforge.functions.urls import country_from_url

V = params.FLAG_SPAN_ATTR
FLAG_SPAN = sel("span", attrs=[(V,)])
FLAG_SIBLING_SELECTORS: list[Selector] = [
    sel(cls="vis-flag"),
    sel(attrs=[("class", "*=", "flag")]),
    sel(attrs=[("class", "*=", "country")]),
]


def _location_selectors() -> list[Selector]:
    """C4 selectors in priority order (records of the documented list)."""
    out: list[Selector] = [
        sel("span", attrs=[(V,)], after=sel("span", attrs=[(V,)])),
        sel("span", after=sel("span", cls="vis-flag")),
        sel("span", attrs=[(V,)], nots=[sel(attrs=[("class", "*=", "flag")])]),
        sel("span", after=sel(cls="vis-flag")),
    ]
    out += [sel("span", contains=name) for name in params.COUNTRY_SPAN_NAMES]
    out += [
        sel(attrs=[("data-test", "=", "company-address")]),
        sel(attrs=[("data-testid", "=", "company-address")]),
    ]
    out += [sel(cls=c) for c in ("company-address", "company-location", "address-details", "location-info",
                                 "address", "location", "country")]
    out += [sel(cls="address", inside=sel(cls="company-info"))]
    out += [sel(cls=c) for c in ("profile-address", "contact-address", "contact-info", "company-details",
                                 "profile-info", "company-profile")]
    out += [sel(attrs=[("class", "*=", c)]) for c in ("address", "location", "country", "contact")]
    return out


LOCATION_SELECTORS = _location_selectors()


def _first(arr: Column) -> Column:
    return F.get(F.filter(arr, lambda x: x.isNotNull()), 0)


def _normalised_span(span: Column) -> Column:
    t = strip_text(span)
    n = normalize_country(t)
    return F.when((F.length(t) > 2) & (n != F.lit("")), n)


def flag_pattern(spans_col: str = "_flag_spans") -> Column:
    """Among ``span[data-v-..]`` (document order), a span whose class
    string contains ``flag`` or ``vis-`` is a flag; the next span of that list
    holds the country.  Needs the span list as column ``spans_col``."""
    spans = F.col(spans_col)

    def at(s: Column, i: Column) -> Column:
        cls = F.lower(F.coalesce(attr(s, "class"), F.lit("")))
        is_flag = cls.contains("flag") | cls.contains("vis-")
        return F.when(is_flag, _normalised_span(F.get(spans, i + 1)))

    return _first(F.transform(spans, at))


def flag_sibling(selectors: list[Selector] | None = None) -> Column:
    """Each hit's first following sibling ``span`` (hits of the selectors
    in order, each in document order)."""
    selectors = FLAG_SIBLING_SELECTORS if selectors is None else selectors
    elems = F.col("elems")
    hits = F.concat(*[select(s) for s in selectors])

    def sibling_country(h: Column) -> Column:
        return F.when(h["nspan"] > 0, _normalised_span(F.get(elems, h["nspan"] - 1)))

    return _first(F.transform(hits, sibling_country))


def by_selectors(selectors: list[Selector] | None = None) -> Column:
    """C4: per selector in priority order, per element in document order, the
    first dictionary key in the stripped lower-cased text (at most 500
    characters) with a valid context.

    The candidate texts of all selectors are gathered into one array in
    (selector, document) order and the dictionary runs once over it."""
    selectors = LOCATION_SELECTORS if selectors is None else selectors
    texts = F.transform(F.flatten(select_many(selectors)), lambda e: F.lower(strip_text(e)))
    found = F.transform(texts, lambda t: F.when(F.length(t) <= params.COUNTRY_TEXT_MAX, dictionary_country(t)))
    return _first(found)


def from_json_ld() -> Column:
    """``script[type=application/ld+json]`` in order; an array means its
    first item; top-level ``address.addressCountry`` must normalise.  A script
    that does not parse, or has another shape, is skipped."""
    scripts = F.filter(F.col("elems"), lambda e: (e["tag"] == "script") & F.coalesce(
        e["attrs"]["type"] == F.lit("application/ld+json"), F.lit(False)))

    def country(e: Column) -> Column:
        raw = e["raw"]
        c = F.coalesce(F.get_json_object(raw, "$.address.addressCountry"),
                       F.get_json_object(raw, "$[0].address.addressCountry"))
        n = normalize_country(c)
        return F.when(n != F.lit(""), n)

    return _first(F.transform(scripts, country))


def from_meta(names: list[str] | None = None) -> Column:
    """The first ``meta`` of each name in order; its content must normalise."""
    names = params.GEO_META_NAMES if names is None else names
    out = []
    for name in names:
        m = F.get(F.filter(F.col("elems"), lambda e: (e["tag"] == "meta") & F.coalesce(
            e["attrs"]["name"] == F.lit(name), F.lit(False))), 0)
        n = normalize_country(F.coalesce(m["attrs"]["content"], F.lit("")))
        out.append(F.when(n != F.lit(""), n))
    return F.coalesce(*out)


def from_full_text(lower_col: str = "_lt") -> Column:
    """C9 (needs the lower-cased page text as column ``lower_col``)."""
    return dictionary_country(F.col(lower_col))


def country_columns(dom: DataFrame, keep: list[str] | None = None, url_col: str = "url",
                    extra: list[Column] | None = None) -> DataFrame:
    """Every method's answer as a column: ``flag_pattern, flag_sibling,
    selectors, url_country, json_ld, meta, full_text`` and the cascade result
    ``country`` ('' when nothing is found or the page is missing).  ``extra``
    columns are computed in the same projection (one pass over the page)."""
    keep = list(keep or [url_col])
    d = dom.select(*keep, *[c for c in ("text", "stext", "btext", "bstext", "elems") if c not in keep],
                   select(FLAG_SPAN).alias("_flag_spans"), F.lower(F.col("text")).alias("_lt"))
    cols = d.select(
        *keep,
        F.col("elems").isNotNull().alias("_fetched"),
        flag_pattern().alias("flag_pattern"),
        flag_sibling().alias("flag_sibling"),
        by_selectors().alias("selectors"),
        country_from_url(F.col(url_col)).alias("url_country"),
        from_json_ld().alias("json_ld"),
        from_meta().alias("meta"),
        from_full_text().alias("full_text"),
        *(extra or []),
    )
    cascade = F.when(
        F.col("_fetched"),
        F.coalesce("flag_pattern", "flag_sibling", "selectors", "url_country", "json_ld", "meta", "full_text", F.lit("")),
    ).otherwise(F.lit(""))
    return cols.withColumn("country", cascade).drop("_fetched")


__all__ = ["country_columns", "LOCATION_SELECTORS", "raw_text"]
