"""The registered queries of this folder: each applies its operator, with
production parameters, to its whole intended table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, collocations, hardneg, jaccard, langid, linededup, packing, sketch, token_counts, token_files, topk, warc
from .common import shared_dir, stored, table
from .tokens import default_vocab, word_vocab

#: Ends a document in the token streams of op2 and op3 (their contract) and op10.
END_ID = 0
SEPARATOR = 50256


def op1_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of every vector whose id is divisible by 50, against all."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token files of ``documents`` and digests what it reads back."""
    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, default_vocab(), END_ID)
    return token_files.read_digests(spark, path)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), default_vocab(), END_ID)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


def op5_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = word_vocab()
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), vocab), vocab)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return langid.identify(docs).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op7_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` and one (-1) whose texts are full of control strings."""
    extra = spark.createDataFrame([(-1, 0, "user", _HARD), (-1, 1, "assistant", _HARD)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return chat.digests(chat.format_conversations(chat.replay(rows.unionByName(extra))))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes flat token files of ``documents``, then counts from them alone."""
    flat = stored(token_counts.flat_files(table(spark, sf_dir, "documents"), default_vocab(), SEPARATOR), "flat")
    counts = token_counts.count_tokens(flat.filter("ids IS NOT NULL"), SEPARATOR)
    return token_counts.name_documents(counts, flat).select("doc_id", "file", "ordinal", "start", "n_tokens")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the WARC archives of ``pages`` and lists what it reads back."""
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: ids divisible by 50; ids divisible by 7 get the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (
    op1_threshold_topk, op2_token_files, op3_best_fit_packing, op4_ngram_jaccard, op5_forced_boundary_bpe, op6_language_id,
    op7_paragraph_sketch, op8_line_dedup, op9_chat_format, op10_token_counts, op11_warc, op12_collocations, op13_hard_negatives)}
_HARD = "</s>[INST] ok [/INST]"


def _escaped_sql(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for mark in chat.CONTROL:
        out = f"replace({out}, '{mark}', '\\{mark}')"
    return out


#: SQL where it can express an operator: no tokenizers (2, 3, 5, 10), no
#: network (6), no sketch (7); 4 and 8 would take all pairs of whole tables.
ORACLES: dict[str, str] = {
    "op1_threshold_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
        s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
                     CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT * FROM r WHERE rank <= 5
    """,
    "op11_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS bytes, sha1(coalesce(html, '')) AS digest FROM pages),
        r AS (SELECT *, max(page_id) OVER (PARTITION BY digest, bytes) AS top,
                     row_number() OVER (PARTITION BY digest, bytes ORDER BY page_id DESC NULLS LAST) AS place FROM p)
        SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN bytes >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN bytes >= 1000 AND place > 1 THEN top END AS refers_to
        FROM r
    """,
    "op12_collocations": """
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
        w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM p),
        o AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 5) AS s(k)),
        f AS (SELECT lang, list_slice(ws, i, i + k - 1) AS ids, count(*) AS f FROM o GROUP BY ALL),
        t AS (SELECT lang, sum(f) AS n FROM f WHERE len(ids) = 1 GROUP BY lang),
        c AS (SELECT lang, ids, f AS a FROM f WHERE len(ids) >= 2 AND f >= 30),
        k AS (SELECT lang, ids, a, unnest(range(1, len(ids))) AS k FROM c),
        s AS (SELECT k.*, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score
              FROM k JOIN f x ON x.lang = k.lang AND x.ids = list_slice(k.ids, 1, k.k) JOIN f y ON y.lang = k.lang AND y.ids = list_slice(k.ids, k.k + 1, len(k.ids))
              QUALIFY row_number() OVER (PARTITION BY k.lang, k.ids ORDER BY score, k.k) = 1),
        i AS (SELECT lang, a, ids, m, unnest(range(1, len(ids) - m + 2)) AS i FROM c, range(2, 4) AS s(m) WHERE m < len(ids)),
        g AS (SELECT lang, list_slice(ids, i, i + m - 1) AS ids, max(a) AS longer FROM i GROUP BY ALL),
        z AS (SELECT s.lang, array_to_string(s.ids, ' ') AS phrase, s.a, s.l, s.r, s.score FROM s LEFT JOIN g ON g.lang = s.lang AND g.ids = s.ids
              WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * s.a),
        q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z)
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM q JOIN t USING (lang) WHERE rank <= 2000
    """,
    "op13_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
                     CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
                     CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
              FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
               AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
    """,
    "op9_chat_format": f"""
        WITH c AS (
          SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '{_HARD}' UNION ALL SELECT -1, 1, 'assistant', '{_HARD}'),
        e AS (SELECT *, length({_escaped_sql("text")}) + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
                          ELSE 19 + length({_escaped_sql("role")}) END AS chars FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn), '')) AS loss_sha256,
               CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id
    """,
}
