"""Email cleaning and classification as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.text import any_contains, first_contained, str_array


def strip_email(raw: Column) -> Column:
    """E7 first half: decode ``&#64;``/``&amp;``, strip the punctuation set, lower."""
    decoded = F.replace(F.replace(raw, F.lit("&#64;"), F.lit("@")), F.lit("&amp;"), F.lit("&"))
    return F.lower(F.btrim(decoded, F.lit(params.EMAIL_STRIP_CHARS)))


def email_domain(email: Column) -> Column:
    """Text between the first and the second ``@``, lower-cased."""
    return F.lower(F.get(F.split(email, "@"), 1))


def is_valid_format(email: Column) -> Column:
    """E8."""
    return F.coalesce(email.rlike(params.EMAIL_FORMAT_PATTERN), F.lit(False))


def is_business(email: Column, custom_domains: Column | None = None,
                personal: list[str] | None = None, match: str = "exact") -> Column:
    """Domain equals a custom entry -> True; else not a personal domain.

    ``custom_domains`` is an ``array<string>`` column (e.g. the sector's
    keyword list); NULL means empty.  ``match="contains"`` takes its entries as
    keywords: a domain that contains one is accepted (empty ones match nothing).
    """
    if match not in ("exact", "contains"):
        raise ValueError(f"match is exact or contains, not {match!r}")
    personal = params.PERSONAL_DOMAINS if personal is None else personal
    dom = email_domain(email)
    if custom_domains is None:
        custom = F.lit(False)
    elif match == "exact":
        custom = F.coalesce(F.array_contains(custom_domains, dom), F.lit(False))
    else:
        custom = F.coalesce(F.exists(custom_domains, lambda k: F.coalesce((k != F.lit("")) & F.contains(dom, F.lower(k)), F.lit(False))), F.lit(False))
    return F.when(~email.contains("@"), F.lit(False)).when(custom, F.lit(True)).otherwise(
        F.coalesce(~F.array_contains(str_array(personal), dom), F.lit(True))
    )


def spam_hit(email: Column, spam: list[str] | None = None) -> Column:
    """The first spam pattern contained in the address (NULL if none)."""
    spam = params.SPAM_PATTERNS if spam is None else spam
    return first_contained(email, spam)


def classify_email(raw: Column, custom_domains: Column | None = None, spam: list[str] | None = None, match: str = "exact") -> Column:
    """E7-E10 with the reason kept: ``struct(email, reason)``.

    ``email`` is the cleaned address when every check passes, else NULL;
    ``reason`` is one of NULL (accepted), ``empty``, ``format`` (strict
    pattern), ``tld`` (format check, final label 2-3 letters), ``personal``,
    ``spam``.
    """
    cleaned = strip_email(raw)
    reason = (
        F.when(raw.isNull() | (raw == F.lit("")), F.lit("empty"))
        .when(~cleaned.rlike(params.EMAIL_STRICT_PATTERN), F.lit("format"))
        .when(~is_valid_format(cleaned), F.lit("tld"))
        .when(~is_business(cleaned, custom_domains, match=match), F.lit("personal"))
        .when(any_contains(cleaned, params.SPAM_PATTERNS if spam is None else spam), F.lit("spam"))
    )
    return F.struct(F.when(reason.isNull(), cleaned).alias("email"), reason.alias("reason"))


def clean_email(raw: Column, custom_domains: Column | None = None, spam: list[str] | None = None, match: str = "exact") -> Column:
    """Cleaned address or NULL."""
    return classify_email(raw, custom_domains, spam, match)["email"]
