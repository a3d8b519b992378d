"""The queries of the operators and, where SQL can state them, their SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm import (decontaminate, exact_search, html_text, lexical_search, manifest, mixing, near_dedup,
                          packing, pii, quality, suffix_tree, toxicity, url_filter)
from emporium.llm.common import fold, read


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share 80 % of their 4-word shingles."""
    return near_dedup.groups(read(spark, sf_dir, "documents"), near_dedup.Settings(shingle=4, percent=80))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, from labels outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return (quality.score(docs, model)
            .select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page url judged by the five listed rules."""
    return url_filter.filter_urls(read(spark, sf_dir, "pages"), url_filter.rules_frame(spark),
                                  url_filter.path_lengths())


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds within a fifth of its words."""
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their personal data replaced by keyed pseudonyms."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, count_col="n_replaced")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Where the installed package of public tokenizers keeps a vocabulary."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_file())


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(read(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document, from labels outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).withColumn("held_out", fold("doc_id", 3) == 1)


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, learned outside the held-out fold."""
    return suffix_tree.score_documents(read(spark, sf_dir, "documents"))


def op10_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every vector whose id is divisible by 50."""
    return exact_search.top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often every document is taken for 150 % of all words in the sources' target shares."""
    return mixing.plan(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical_search.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and check of every document; one id in seven is tampered with."""
    return manifest.verify(read(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_quality": op2_quality,
    "op3_url_filter": op3_url_filter,
    "op4_decontamination": op4_decontamination,
    "op5_pii_pseudonyms": op5_pii_pseudonyms,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_html_text": op7_html_text,
    "op8_toxicity": op8_toxicity,
    "op9_suffix_tree": op9_suffix_tree,
    "op10_exact_search": op10_exact_search,
    "op11_source_mix": op11_source_mix,
    "op12_lexical_search": op12_lexical_search,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op3_url_filter": r"""
WITH rules(rhost, rpath, rverdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
       ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (SELECT page_id, row_number() OVER () AS rid,
             translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
      FROM pages),
m AS (SELECT rid, rhost || rpath AS rule, rverdict,
             row_number() OVER (PARTITION BY rid ORDER BY length(rhost || rpath) DESC) AS rn
      FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM m WHERE rn = 1) USING (rid)""",
    "op10_exact_search": r"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
           FROM embeddings
           WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid AS qr, q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.rid <> c.rid AND len(q.e) = len(c.e)),
r AS (SELECT query_id, vec_id, score,
             CAST(row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_source_mix": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')),
                                      1, 13) AS BIGINT) AS draw
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)]
                     AS DOUBLE) AS weight FROM s),
o AS (SELECT *, 2.0::DOUBLE * source_size AS stop,
             row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS rn FROM w),
p AS (SELECT *, coalesce(sum(stop) OVER (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
             sum(weight) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
             sum(source_size) OVER () AS words FROM o),
u AS (SELECT min_by((1.5::DOUBLE * words - held) / free, rn) FILTER (weight * ((1.5::DOUBLE * words - held) / free) <= stop)
             AS unit FROM p),
t AS (SELECT source, source_size, least(weight * unit, stop) AS target,
             coalesce(least(weight * unit, stop) / nullif(source_size, 0), 0) AS rate FROM o, u),
x AS (SELECT source, turn,
             abs(floor(rate) * source_size + coalesce(sum(size) FILTER (
                 (draw + turn * ((4503599627370496 * 89 // 144) | 1)) % 4503599627370496
                 < (rate - floor(rate)) * 4503599627370496::DOUBLE), 0) - target) AS miss
      FROM d JOIN t USING (source), range(16) r(turn) GROUP BY source, turn, rate, source_size, target),
b AS (SELECT source, arg_min(turn, struct_pack(miss := miss, turn := turn)) AS turn FROM x GROUP BY source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN (draw + turn * ((4503599627370496 * 89 // 144) | 1)) % 4503599627370496
                                       < (rate - floor(rate)) * 4503599627370496::DOUBLE THEN 1 ELSE 0 END)
            AS BIGINT) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN b ON d.source IS NOT DISTINCT FROM b.source""",
    "op12_lexical_search": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
i AS (SELECT row_number() OVER () AS iid, item_id,
             regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark),
c AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
q AS (SELECT DISTINCT iid, unnest(t) AS term FROM i),
f AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY rid, term),
g AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
      FROM f, c GROUP BY term, n_docs),
m AS (SELECT rid, 100 - 50 + ((50 * CAST(len(t) AS BIGINT) * n_docs) // n_terms) AS m FROM d, c WHERE len(t) > 0),
p AS (SELECT rid, term, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS impact
      FROM f JOIN g USING (term) JOIN m USING (rid)),
s AS (SELECT iid, rid, CAST(sum(impact) AS BIGINT) AS score FROM q JOIN p USING (term) GROUP BY iid, rid
      HAVING sum(impact) > 0),
r AS (SELECT iid, doc_id, score,
             CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
      FROM s JOIN d USING (rid))
SELECT item_id, rank, doc_id, score FROM r JOIN i USING (iid) WHERE rank <= 50""",
    "op13_merkle_manifest": r"""
WITH RECURSIVE d AS (
    SELECT doc_id, lang, n_chars,
           coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
           coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents),
l AS (SELECT doc_id, lang, n_chars, head, tail,
             sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf FROM d),
crc AS (SELECT doc_id, n_chars, head, tail, leaf, lang,
               list_reduce(list_prepend(4294967295::BIGINT,
                   list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                   lambda c, x: list_reduce(list_prepend(xor(c, x), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]),
                       lambda v, k: xor(v >> 1, (v & 1) * 3988292384))) AS c FROM l),
p AS (SELECT row_number() OVER () AS rid, doc_id, lang, leaf,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
             count(*) OVER (PARTITION BY lang) AS total,
             CASE WHEN doc_id IS NOT NULL AND n_chars IS NOT NULL AND xor(c, 4294967295) % 7 = 0
                  THEN sha256(head || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || tail)
                  ELSE leaf END AS changed FROM crc),
tree(lang, level, idx, total, hash) AS (
    SELECT lang, 0, idx, total, leaf FROM p
    UNION ALL
    SELECT lang, level + 1, idx // 2, (any_value(total) + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
    FROM tree WHERE total > 1 GROUP BY lang, level, idx // 2),
subs AS (SELECT lang, hash, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS total
         FROM tree WHERE total = 1),
top(level, idx, total, hash) AS (
    SELECT 0, idx, total, hash FROM subs
    UNION ALL
    SELECT level + 1, idx // 2, (any_value(total) + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
    FROM top WHERE total > 1 GROUP BY level, idx // 2),
steps AS (
    SELECT p.rid, t.level AS step, (p.idx >> t.level) & 1 AS side, s.hash AS other
    FROM p JOIN (SELECT DISTINCT lang, level FROM tree WHERE total > 1) t ON p.lang IS NOT DISTINCT FROM t.lang
    LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = t.level AND s.idx = xor(p.idx >> t.level, 1)
    UNION ALL
    SELECT p.rid, 100 + t.level, (g.idx >> t.level) & 1, s.hash
    FROM p JOIN subs g ON p.lang IS NOT DISTINCT FROM g.lang
    CROSS JOIN (SELECT DISTINCT level FROM top WHERE total > 1) t
    LEFT JOIN top s ON s.level = t.level AND s.idx = xor(g.idx >> t.level, 1)),
path AS (SELECT rid, list(struct_pack(side := side, other := other) ORDER BY step) AS path,
                coalesce(string_agg(other, '' ORDER BY step), '') AS proof FROM steps GROUP BY rid),
fold AS (SELECT p.rid, list_reduce(
                    list_prepend(struct_pack(side := 0::BIGINT, other := changed),
                                 coalesce(path, CAST([] AS STRUCT(side BIGINT, other VARCHAR)[]))),
                    lambda a, x: struct_pack(side := 0::BIGINT, other := sha256(
                        CASE WHEN x.side = 1 THEN coalesce(x.other, '') || a.other
                             ELSE a.other || coalesce(x.other, '') END))).other AS folded_root
         FROM p LEFT JOIN path USING (rid))
SELECT doc_id, leaf, g.hash AS subroot, r.hash AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root,
       folded_root = r.hash AS verified
FROM p JOIN fold USING (rid) LEFT JOIN path USING (rid) JOIN subs g ON p.lang IS NOT DISTINCT FROM g.lang
CROSS JOIN (SELECT hash FROM top WHERE total = 1) r""",
}
