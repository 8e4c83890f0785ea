"""String helpers with Python ``str`` semantics, as native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() characters (what str.strip() removes), as one set.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def pystrip(c: Column) -> Column:
    """``str.strip()``: trims Python whitespace from both ends (Spark's ``trim``
    only trims spaces).  ``btrim`` with the character set is linear; an
    end-anchored whitespace regex would backtrack quadratically on long
    inner runs."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def title_case(c: Column) -> Column:
    """``str.title()``: upper-case the first letter of every run of letters,
    lower-case the rest.  ``initcap`` differs (it only starts words after
    spaces: ``o'neil`` -> ``O'neil``; Python gives ``O'Neil``)."""
    runs = F.regexp_extract_all(c, F.lit(r"(?U)(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substr(r, F.lit(1), F.lit(1))), F.lower(F.substr(r, F.lit(2))))),
        "",
    )


def sql_str(v: str) -> str:
    """A Spark SQL string literal."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


_LITERALS: dict = {}


def _literal(sql: str) -> Column:
    """Parse a literal expression once per SparkContext and reuse the Column
    (large literal lists otherwise dominate plan-building time)."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    key = (sc.applicationId if sc is not None else None, sql)
    col = _LITERALS.get(key)
    if col is None:
        col = _LITERALS[key] = F.expr(sql)
    return col


def str_array(values: list[str]) -> Column:
    """``array<string>`` literal built in one expression."""
    if not values:
        return F.array().cast("array<string>")
    return _literal("array(" + ", ".join(sql_str(v) for v in values) + ")")


def any_contains(c: Column, needles: list[str]) -> Column:
    """True if ``c`` contains any of ``needles`` (NULL-safe: NULL -> False)."""
    return F.coalesce(F.exists(str_array(needles), lambda n: c.contains(n)), F.lit(False))


def first_contained(c: Column, needles: list[str]) -> Column:
    """The first of ``needles`` (in list order) that ``c`` contains, else NULL."""
    return F.get(F.filter(str_array(needles), lambda n: c.contains(n)), 0)


def pairs(items: list[tuple[str, str]]) -> Column:
    """Ordered ``array<struct<key,value>>`` literal (first match is semantic)."""
    body = ", ".join(f"named_struct('key', {sql_str(k)}, 'value', {sql_str(v)})" for k, v in items)
    return _literal(f"array({body})")


def str_map(items: dict[str, str]) -> Column:
    """``map<string,string>`` literal in one expression."""
    body = ", ".join(f"{sql_str(k)}, {sql_str(v)}" for k, v in items.items())
    return _literal(f"map({body})")


def first_pair_value(c: Column, items: list[tuple[str, str]]) -> Column:
    """Value of the first pair whose key ``c`` contains (ordered dictionary lookup)."""
    return F.get(F.filter(pairs(items), lambda p: c.contains(p["key"])), 0)["value"]
