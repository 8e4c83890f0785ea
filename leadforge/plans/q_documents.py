"""Email and country operators over ``documents.text`` (T tests).

Every test address looks like ``word.NN@mailN.example.com``, so the
default spam list rejects all of them: these queries return the
classification (reason, matched pattern), not only survivors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.country import dictionary_country
from leadforge.functions.email import (classify_email, email_domain, is_business, is_valid_format,
                                       spam_hit, strip_email)
from leadforge.operators.emails import find_all
from leadforge.sources.pages import read_table


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def _flexible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_all(_docs(spark, sf_dir), "text", params.EMAIL_FLEXIBLE_PATTERN, keep=["doc_id"])


def emails_flexible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documented flexible pattern, every match with its position."""
    return _flexible(spark, sf_dir).select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("match").alias("email"))


def email_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7 (with E8-E10) on every candidate: cleaned address or the reason."""
    c = _flexible(spark, sf_dir).withColumn("r", classify_email(F.col("match")))
    return c.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("match").alias("raw"),
                    F.col("r.email").alias("email"), F.col("r.reason").alias("reason"))


def email_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8 on the cleaned candidates."""
    c = _flexible(spark, sf_dir).withColumn("email", strip_email(F.col("match")))
    return c.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "email", is_valid_format(F.col("email")).alias("valid"))


def email_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 on the cleaned candidates, no custom list."""
    c = _flexible(spark, sf_dir).withColumn("email", strip_email(F.col("match")))
    return c.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "email",
                    email_domain(F.col("email")).alias("domain"), is_business(F.col("email")).alias("business"))


def email_spam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first spam pattern each cleaned candidate contains."""
    c = _flexible(spark, sf_dir).withColumn("email", strip_email(F.col("match")))
    return c.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "email", spam_hit(F.col("email")).alias("spam_pattern"))


def dedup_document_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E13 on documents: each strictly valid address stays with its first
    document (order doc_id, pos); skew-safe aggregation, not a window."""
    c = _flexible(spark, sf_dir).withColumn("email", strip_email(F.col("match")))
    c = c.filter(F.col("email").rlike(params.EMAIL_STRICT_PATTERN))
    g = c.groupBy("email").agg(F.min(F.struct("doc_id", "pos")).alias("f"), F.count("*").alias("n_hits"))
    return g.select("email", F.col("f.doc_id").alias("first_doc_id"), F.col("f.pos").cast("bigint").alias("first_pos"),
                    "n_hits")


def country_full_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First dictionary key in the lower-cased text, unless a negative
    phrase occurs anywhere in it."""
    d = _docs(spark, sf_dir).select("doc_id", F.lower("text").alias("lt"))
    return d.select("doc_id", dictionary_country(F.col("lt")).alias("country"))


QUERIES = {
    "emails_flexible": emails_flexible,
    "email_clean": email_clean,
    "email_valid": email_valid,
    "email_business": email_business,
    "email_spam": email_spam,
    "dedup_document_emails": dedup_document_emails,
    "country_full_text": country_full_text,
}

# -- oracles ----------------------------------------------------------------------


def _sql_list(items) -> str:
    return "[" + ", ".join("'" + i.replace("'", "''") + "'" for i in items) + "]"


_FLEX = f"""
  SELECT doc_id,
         CAST(generate_subscripts(regexp_extract_all(text, '{params.EMAIL_FLEXIBLE_PATTERN}'), 1) AS BIGINT) AS pos,
         unnest(regexp_extract_all(text, '{params.EMAIL_FLEXIBLE_PATTERN}')) AS raw
  FROM documents
"""
_STRIP_SET = "chr(10) || chr(13) || chr(9) || '<>()[]{}\",;:!?'"
_CLEAN = f"lower(trim(replace(replace(raw, '&#64;', '@'), '&amp;', '&'), {_STRIP_SET}))"
_PERSONAL = _sql_list(params.PERSONAL_DOMAINS)
_SPAM = _sql_list(params.SPAM_PATTERNS)
_SPAM_FIRST = "CASE " + " ".join(
    f"WHEN contains(email, '{p}') THEN '{p}'" for p in params.SPAM_PATTERNS
) + " END"
_DOMAIN = "lower(split_part(email, '@', 2))"

_COUNTRY_CASE = "CASE " + " ".join(
    f"WHEN contains(lt, '{k}') THEN '{v}'" for k, v in params.COUNTRY_DICTIONARY
) + " END"
_NEG = _sql_list(params.COUNTRY_NEGATIVE_PHRASES)

ORACLES = {
    "emails_flexible": f"SELECT doc_id, pos, raw AS email FROM ({_FLEX})",
    "email_clean": f"""
        WITH c AS (SELECT doc_id, pos, raw, {_CLEAN} AS email FROM ({_FLEX})),
        r AS (
          SELECT doc_id, pos, raw, email,
                 CASE WHEN raw IS NULL OR raw = '' THEN 'empty'
                      WHEN NOT regexp_matches(email, '{params.EMAIL_STRICT_PATTERN}') THEN 'format'
                      WHEN NOT regexp_matches(email, '{params.EMAIL_FORMAT_PATTERN}') THEN 'tld'
                      WHEN list_contains({_PERSONAL}, {_DOMAIN}) THEN 'personal'
                      WHEN list_bool_or([contains(email, p) FOR p IN {_SPAM}]) THEN 'spam'
                 END AS reason
          FROM c)
        SELECT doc_id, pos, raw, CASE WHEN reason IS NULL THEN email END AS email, reason FROM r
    """,
    "email_valid": f"""
        SELECT doc_id, pos, email, regexp_matches(email, '{params.EMAIL_FORMAT_PATTERN}') AS valid
        FROM (SELECT doc_id, pos, {_CLEAN} AS email FROM ({_FLEX}))
    """,
    "email_business": f"""
        SELECT doc_id, pos, email, {_DOMAIN} AS domain,
               CASE WHEN NOT contains(email, '@') THEN false ELSE NOT list_contains({_PERSONAL}, {_DOMAIN}) END AS business
        FROM (SELECT doc_id, pos, {_CLEAN} AS email FROM ({_FLEX}))
    """,
    "email_spam": f"""
        SELECT doc_id, pos, email, {_SPAM_FIRST} AS spam_pattern
        FROM (SELECT doc_id, pos, {_CLEAN} AS email FROM ({_FLEX}))
    """,
    "dedup_document_emails": f"""
        SELECT email, arg_min(doc_id, (doc_id, pos)) AS first_doc_id,
               arg_min(pos, (doc_id, pos)) AS first_pos, count(*) AS n_hits
        FROM (SELECT doc_id, pos, {_CLEAN} AS email FROM ({_FLEX}))
        WHERE regexp_matches(email, '{params.EMAIL_STRICT_PATTERN}')
        GROUP BY email
    """,
    "country_full_text": f"""
        SELECT doc_id,
               CASE WHEN list_bool_or([contains(lt, p) FOR p IN {_NEG}]) THEN NULL ELSE {_COUNTRY_CASE} END AS country
        FROM (SELECT doc_id, lower(text) AS lt FROM documents)
    """,
}
