"""Registered queries: review-text analytics (X1–X12) over ``documents`` (and reviews)."""
from __future__ import annotations

from pyspark.sql import functions as F

from emporium.functions import text as T
from emporium.operators import text as TX
from emporium.plans.catalog import query

# Fixed glossary for the translation lookup (several sources map to one term).
GLOSSARY = [("der", "the"), ("die", "the"), ("den", "the"), ("les", "the"),
            ("des", "of"), ("von", "of"), ("und", "and")]

_STOP_SQL = ", ".join(f"('{w}')" for w in T.STOPWORDS)
_TR = f"translate(raw, '{T.ACCENTED}', '{T.UNACCENTED}')"


def _tokens_sql(rel: str, col: str, extra: str = "") -> str:
    """DuckDB token rows (review_id, [extra,] pos, term) of ``rel.col``."""
    return f"""
  SELECT review_id, {extra} pos, term FROM (
    SELECT review_id, {extra} {_TR} AS term, pos FROM (
      SELECT review_id, {extra} unnest(toks) AS raw, generate_subscripts(toks, 1) - 1 AS pos
      FROM (SELECT review_id, {extra} regexp_extract_all(lower({col}), '{T.TOKEN_PATTERN}') AS toks
            FROM {rel} WHERE {col} IS NOT NULL)))
  WHERE term NOT IN (SELECT w FROM (VALUES {_STOP_SQL}) s(w))"""


RT = "b_review_texts"
_WS = r"'^\s+|\s+$'"


def _blank(c: str) -> str:
    return f"nullif(regexp_replace({c}, {_WS}, '', 'g'), '')"


_X1 = f"""
, x1 AS (
  SELECT review_id, review_score, {_blank('review_comment_title')} AS title,
         {_blank('review_comment_message')} AS message, review_answer_timestamp AS answer_ts,
         CAST(date_trunc('month', CAST(review_answer_timestamp AS DATE)) AS DATE) AS answer_month
  FROM dim_reviews
  QUALIFY row_number() OVER (PARTITION BY review_id
                             ORDER BY review_answer_timestamp DESC NULLS LAST, id DESC) = 1)
"""
query("x1_review_texts", _X1 + "SELECT * FROM x1")(lambda c: TX.review_texts(c.gold.dim_reviews_current))
query("x1_top_title_words", _X1 + ", tk AS (" + _tokens_sql("x1", "title") + """)
SELECT term, count(*) AS count FROM tk GROUP BY 1 ORDER BY count DESC, term LIMIT 20
""")(lambda c: TX.top_words(TX.review_texts(c.gold.dim_reviews_current), "title", 20))

query("x2_text_field", f"""
SELECT review_id, {_blank("coalesce(title, '') || ' ' || coalesce(message, '')")} AS text,
       {_blank('title')} AS title_only, {_blank('message')} AS message_only
FROM {RT}
""")(lambda c: c.review_texts.select(
    "review_id", T.text_field("title", "message", "both").alias("text"),
    T.text_field("title", "message", "title").alias("title_only"),
    T.text_field("title", "message", "message").alias("message_only")))

query("x3_strip_accents", f"""
SELECT review_id, translate(lower(message), '{T.ACCENTED}', '{T.UNACCENTED}') AS stripped FROM {RT}
""")(lambda c: c.review_texts.select("review_id", T.strip_accents(F.lower("message")).alias("stripped")))

query("x4_tokens", ", tk AS (" + _tokens_sql(RT, "message") + """)
SELECT r.review_id, coalesce(t.tokens, CAST([] AS VARCHAR[])) AS tokens
FROM (SELECT review_id FROM b_review_texts WHERE message IS NOT NULL) r
LEFT JOIN (SELECT review_id, list(term ORDER BY pos) AS tokens FROM tk GROUP BY 1) t ON r.review_id = t.review_id
""")(lambda c: TX.tokens(c.review_texts, "message"))

query("x5_stopword_hits", f"""
, raw AS (SELECT {_TR} AS term FROM (SELECT unnest(regexp_extract_all(lower(message), '{T.TOKEN_PATTERN}')) AS raw
          FROM {RT} WHERE message IS NOT NULL))
SELECT term, count(*) AS count FROM raw
WHERE term IN (SELECT w FROM (VALUES {_STOP_SQL}) s(w)) GROUP BY 1
""")(lambda c: c.review_texts.filter(F.col("message").isNotNull())
     .select(F.explode(T.raw_tokens("message")).alias("term"))
     .join(F.broadcast(TX.stop_table(c.spark)), "term", "left_semi")
     .groupBy("term").agg(F.count(F.lit(1)).alias("count")))

_TF = ", tk AS (" + _tokens_sql(RT, "message") + ")"
query("x6_term_freq", _TF + " SELECT term, count(*) AS count FROM tk GROUP BY 1")(
    lambda c: TX.term_freq(c.review_texts, "message"))
query("x6_top_words", _TF + " SELECT term, count(*) AS count FROM tk GROUP BY 1 "
      "ORDER BY count DESC, term LIMIT 20")(lambda c: TX.top_words(c.review_texts, "message", 20))

_BG = _TF + """
, bg AS (SELECT term || ' ' || nxt AS bigram FROM (
           SELECT term, lead(term) OVER (PARTITION BY review_id ORDER BY pos) AS nxt FROM tk)
         WHERE nxt IS NOT NULL)
"""
query("x7_top_bigrams", _BG + " SELECT bigram, count(*) AS count FROM bg GROUP BY 1 "
      "ORDER BY count DESC, bigram LIMIT 20")(lambda c: TX.top_bigrams(c.review_texts, "message", 20))
query("x7_bigram_freq", _BG + " SELECT bigram, count(*) AS count FROM bg GROUP BY 1")(
    lambda c: TX.bigram_rows(c.review_texts, "message").groupBy("bigram")
    .agg(F.count(F.lit(1)).alias("count")))


def _x8(c):
    m = c.spark.createDataFrame(GLOSSARY, "src string, dst string")
    return TX.translate_freq(TX.term_freq(c.review_texts, "message"), m)


_GL = ", ".join(f"('{a}', '{b}')" for a, b in GLOSSARY)
query("x8_translate_freq", _TF + f"""
, tf AS (SELECT term, count(*) AS count FROM tk GROUP BY 1),
gl AS (SELECT * FROM (VALUES {_GL}) g(src, dst))
SELECT coalesce(gl.dst, tf.term) AS term, CAST(sum(count) AS BIGINT) AS count
FROM tf LEFT JOIN gl ON tf.term = gl.src GROUP BY 1
""")(_x8)

query("x8_translate_bigrams", _BG + f"""
, gl AS (SELECT * FROM (VALUES {_GL}) g(src, dst)),
tb AS (SELECT coalesce(a.dst, split_part(bigram, ' ', 1)) || ' ' || coalesce(b.dst, split_part(bigram, ' ', 2)) AS bigram
       FROM bg LEFT JOIN gl a ON a.src = split_part(bigram, ' ', 1) LEFT JOIN gl b ON b.src = split_part(bigram, ' ', 2))
SELECT bigram, count(*) AS count FROM tb GROUP BY 1 ORDER BY count DESC, bigram LIMIT 50
""")(lambda c: TX.top_translated(TX.bigram_rows(c.review_texts, "message"), dict(GLOSSARY), 50, "bigram"))

query("x9_text_kpis", f"""
SELECT count(*) AS reviews, count(message) AS with_comment, count(title) AS with_title,
       avg(review_score) AS avg_score,
       count(message) / greatest(count(*), 1) AS comment_share,
       count(title) / greatest(count(*), 1) AS title_share
FROM (SELECT review_score, {_blank('title')} AS title, {_blank('message')} AS message FROM {RT})
""")(lambda c: TX.text_kpis(c.review_texts.select(
    "review_score", T.blank_to_null("title").alias("title"),
    T.blank_to_null("message").alias("message"))))

_LEN = f"""
, ln AS (SELECT review_score, CAST(coalesce(length(txt), 0) AS BIGINT) AS length FROM (
   SELECT review_score, {_blank("coalesce(title, '') || ' ' || coalesce(message, '')")} AS txt FROM {RT}))
"""
query("x10_comment_lengths", _LEN + """
SELECT bin, count(*) AS count, CAST(0.0 + bin * 12.5 AS DOUBLE) AS bin_lo,
       CAST(0.0 + (bin + 1) * 12.5 AS DOUBLE) AS bin_hi
FROM (SELECT CAST(least(floor((greatest(least(CAST(length AS DOUBLE), 500.0), 0.0) - 0.0) * 40.0 / 500.0), 39) AS BIGINT) AS bin
      FROM ln WHERE length > 0) GROUP BY 1
""")(lambda c: TX.comment_lengths(c.review_texts))
query("x11_length_by_score", _LEN + """
SELECT review_score, avg(length) AS avg_length, count(*) AS reviews FROM ln WHERE length > 0 GROUP BY 1
""")(lambda c: TX.length_by_score(c.review_texts))

_BANDS = " ".join(f"WHEN review_score IN ({', '.join(map(str, s))}) THEN '{n}'"
                  for n, s in reversed(list(T.SCORE_BANDS.items())))
query("x12_terms_by_band", f"""
, rb AS (SELECT *, CASE {_BANDS} END AS band FROM {RT}),
tk AS ({_tokens_sql("(SELECT * FROM rb WHERE band IS NOT NULL)", "message", "band,")}),
g AS (SELECT band, term, count(*) AS count FROM tk GROUP BY 1, 2)
SELECT band, term, count FROM g
QUALIFY row_number() OVER (PARTITION BY band ORDER BY count DESC, term) <= 20
""")(lambda c: TX.terms_by_band(c.review_texts, "message", 20))

# The same lists by a frequent-items sketch, exact counts of its candidates and a bound.
query("x6_top_words_sketch", _TF + " SELECT term, count(*) AS count FROM tk GROUP BY 1 "
      "ORDER BY count DESC, term LIMIT 20")(
    lambda c: TX.top_by_sketch(TX.token_rows(c.review_texts, "message"), "term", 20))
query("x7_top_bigrams_sketch", _BG + " SELECT bigram, count(*) AS count FROM bg GROUP BY 1 "
      "ORDER BY count DESC, bigram LIMIT 20")(
    lambda c: TX.top_by_sketch(TX.bigram_rows(c.review_texts, "message"), "bigram", 20))
query("x12_terms_by_band_sketch", f"""
, rb AS (SELECT *, CASE {_BANDS} END AS band FROM {RT}),
tk AS ({_tokens_sql("(SELECT * FROM rb WHERE band IS NOT NULL)", "message", "band,")}),
g AS (SELECT band, term, count(*) AS count FROM tk GROUP BY 1, 2)
SELECT band, term, count FROM g
QUALIFY row_number() OVER (PARTITION BY band ORDER BY count DESC, term) <= 20
""")(lambda c: TX.top_by_sketch(TX.band_tokens(c.review_texts, "message"), "term", 20, "band"))
