"""C3 country normalisation, C5 context check, C4/C9 dictionary lookup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.text import any_contains, first_pair_value, pystrip, str_map


def _normalise_map() -> Column:
    table = {name.lower(): name for name in params.COUNTRY_PROPER_NAMES}
    table.update(dict(params.COUNTRY_ALIASES))
    return str_map(table)


def normalize_country(text: Column) -> Column:
    """Alias or proper name (case-insensitive, stripped) -> name, else ''."""
    key = F.lower(pystrip(text))
    return F.coalesce(_normalise_map()[key], F.lit(""))


def context_ok(text: Column, negatives: list[str] | None = None, lowered: bool = False) -> Column:
    """No negative phrase in the (lower-cased) text."""
    negatives = params.COUNTRY_NEGATIVE_PHRASES if negatives is None else negatives
    return ~any_contains(text if lowered else F.lower(text), negatives)


def dictionary_country(lower_text: Column, dictionary: list[tuple[str, str]] | None = None) -> Column:
    """First dictionary key contained in the lower-cased text, if the
    context is valid; else NULL.  Pass a column reference or lambda variable:
    the text is read once per key, so an expression here would be recomputed
    for every key (no common-subexpression reuse inside lambdas)."""
    dictionary = params.COUNTRY_DICTIONARY if dictionary is None else dictionary
    return F.when(context_ok(lower_text, lowered=True), first_pair_value(lower_text, dictionary))
