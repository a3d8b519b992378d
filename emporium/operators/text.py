"""Review-text analytics.

A text is one row: it is tokenised, stripped of stop words (a constant set) and
paired into bigrams in place, then exploded and counted with a partial and a
final aggregation, so the only shuffle is that of the counts.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporium.functions import text as T
from emporium.functions.expr import month
from emporium.operators.metrics import top_k


def stop_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in T.STOPWORDS], "term string")


def review_texts(dim_reviews: DataFrame) -> DataFrame:
    """Latest version per review, blank texts → NULL, answer month."""
    # latest version per review as an aggregate (map-side combined), not a window
    from emporium.operators.staging import dedupe_latest
    latest = dedupe_latest(dim_reviews, ["review_id"],
                           [("review_answer_timestamp", True), ("id", True)], descending=True)
    return latest.select(
        "review_id", "review_score",
        T.blank_to_null("review_comment_title").alias("title"),
        T.blank_to_null("review_comment_message").alias("message"),
        F.col("review_answer_timestamp").alias("answer_ts"),
        month("review_answer_timestamp").alias("answer_month"))


def kept_tokens(text_col: str) -> Column:
    """The tokens of a text that are no stop words, in order (NULL text → NULL)."""
    return F.filter(T.raw_tokens(text_col), lambda t: ~t.isin(list(T.STOPWORDS)))


def tokens(df: DataFrame, text_col: str, key: str = "review_id") -> DataFrame:
    """The kept tokens of each text; a text without any has an empty list."""
    return df.filter(F.col(text_col).isNotNull()).select(key, kept_tokens(text_col).alias("tokens"))


def token_rows(df: DataFrame, text_col: str, key: str = "review_id",
               extra: Sequence[str] = ()) -> DataFrame:
    """X4 exploded: one row per kept token: (key, *extra, term).

    Accents and stop words are handled after the explode, in generated code."""
    rows = df.select(key, *extra, F.explode(T.plain_tokens(text_col)).alias("_t"))
    return (rows.select(key, *extra, T.strip_accents("_t").alias("term"))
            .where(~F.col("term").isin(list(T.STOPWORDS))))


def term_freq(df: DataFrame, text_col: str, key: str = "review_id") -> DataFrame:
    """Term → count over all texts."""
    return token_rows(df, text_col, key).groupBy("term").agg(F.count(F.lit(1)).alias("count"))


def top_words(df: DataFrame, text_col: str, n: int = 20, key: str = "review_id") -> DataFrame:
    """Top-n terms, ties broken by term."""
    return top_k(term_freq(df, text_col, key), [F.col("count").desc(), F.col("term")], n)


#: Items that a frequent-items sketch tracks, and how many of them are counted exactly.
SKETCH_ITEMS, CANDIDATES = 1 << 16, 1000
#: The sketch's error is at most this many times its rows, by its items.
ERROR = 3.5


def top_by_sketch(rows: DataFrame, col: str, n: int, by: str | None = None, items: int = SKETCH_ITEMS,
                  candidates: int = CANDIDATES, top: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The exact top-n of ``col`` (ties by value) without shuffling its vocabulary.

    1. One sketch a task, merged: the most frequent ``candidates`` values with estimates.
    2. The candidates alone are counted exactly, in a second pass.
    3. A value that is no candidate occurs at most as often as the least estimate plus the
       sketch's error.  If the n-th exact count is above that, no other value can enter.
       Else everything is counted, as without a sketch.

    ``by``: one list a group of few groups (score bands).  What reaches the driver is
    ``candidates`` values a group; n must be smaller.  ``top``: how the top-n of given rows is
    counted, with its ``count`` last (default: by ``col``, ties by value).
    """
    if n >= candidates or candidates > items:
        raise ValueError("n < candidates <= items")
    groups = [by] if by else []

    def by_count(own: DataFrame) -> DataFrame:
        g = own.groupBy(*groups, col).agg(F.count(F.lit(1)).alias("count"))
        return top_k(g, [F.col("count").desc(), F.col(col)], n)

    best_of = top or by_count
    found_top = F.expr(f"approx_top_k(`{col}`, {candidates}, {items})").alias("top")
    sketch = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("rows"), found_top).collect()
    found = None
    for r in sketch:
        own = rows.where(F.col(by).eqNullSafe(F.lit(r[by]))) if by else rows
        names = [t["item"] for t in r["top"]]
        counted = best_of(own.where(F.col(col).isin(names)))
        best = counted.collect()  # n rows
        # fewer values than asked for: the sketch lost none above its error
        least = min((t["count"] for t in r["top"]), default=0) if len(names) == candidates else 0
        exact = len(names) < candidates and r["rows"] <= 0.75 * items  # the sketch is not full: it holds all
        certain = exact or (len(best) == n and best[-1]["count"] > least + ERROR / items * r["rows"])
        part = rows.sparkSession.createDataFrame(best, counted.schema) if certain else best_of(own)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.groupBy(*groups, col).agg(F.count(F.lit(1)).alias("count")).limit(0)
    return found


def bigram_rows(df: DataFrame, text_col: str, key: str = "review_id",
                extra: Sequence[str] = ()) -> DataFrame:
    """Adjacent pairs of *kept* tokens within one text, paired in its own row."""
    t = df.select(key, *extra, kept_tokens(text_col).alias("_t"))
    pairs = F.zip_with("_t", F.slice("_t", 2, F.greatest(F.size("_t"), F.lit(1))),
                       lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))
    return t.select(key, *extra, F.explode(pairs).alias("bigram")).filter(F.col("bigram").isNotNull())


def top_bigrams(df: DataFrame, text_col: str, n: int = 20, key: str = "review_id") -> DataFrame:
    """Top-n bigrams, ties broken by bigram."""
    g = bigram_rows(df, text_col, key).groupBy("bigram").agg(F.count(F.lit(1)).alias("count"))
    return top_k(g, [F.col("count").desc(), F.col("bigram")], n)


def translate_freq(freq: DataFrame, mapping: DataFrame, top: int | None = None,
                   label: str = "term") -> DataFrame:
    """Map labels word by word through a (src, dst) lookup and sum collisions.

    ``label`` holds one word or several (a bigram); words without an entry stay.
    ``top`` keeps the most frequent labels of the translated sums.
    """
    words = freq.select(label, "count", F.posexplode(F.split(label, " ")).alias("_i", "_w"))
    moved = words.join(mapping, words["_w"] == mapping["src"], "left").select(
        label, "count", F.struct("_i", F.coalesce("dst", "_w").alias("w")).alias("_x"))
    named = moved.groupBy(label, "count").agg(F.array_sort(F.collect_list("_x")).alias("_x"))
    out = (named.groupBy(F.array_join(F.col("_x.w"), " ").alias(label))
           .agg(F.sum("count").alias("count")))
    return out if top is None else top_k(out, [F.col("count").desc(), F.col(label)], top)


def top_translated(rows: DataFrame, glossary: Mapping[str, str], n: int, label: str, items: int = SKETCH_ITEMS,
                   candidates: int = CANDIDATES) -> DataFrame:
    """The exact top-n of translated labels over one row an occurrence, by ``top_by_sketch``.

    The sketch reads labels translated row by row; only labels that become a candidate are
    counted, and their counts translated.  ``glossary`` is a fixed list of words.
    """
    mapping = rows.sparkSession.createDataFrame([*glossary.items()], "src string, dst string")
    words = F.create_map(*[F.lit(x) for pair in glossary.items() for x in pair])
    to = F.array_join(F.transform(F.split(label, " "), lambda w: F.coalesce(F.try_element_at(words, w), w)), " ")

    def top(own: DataFrame) -> DataFrame:
        return translate_freq(own.groupBy(label).agg(F.count(F.lit(1)).alias("count")), mapping, n, label)

    return top_by_sketch(rows.where(F.col(label).isNotNull()).withColumn("_to", to), "_to", n, None, items, candidates, top)


def text_kpis(df: DataFrame) -> DataFrame:
    """Rows, with comment, with title, average score and the two shares."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("reviews"), F.count("message").alias("with_comment"),
                  F.count("title").alias("with_title"),
                  F.avg("review_score").alias("avg_score")) \
        .withColumn("comment_share", F.col("with_comment") / F.greatest(F.col("reviews"), F.lit(1))) \
        .withColumn("title_share", F.col("with_title") / F.greatest(F.col("reviews"), F.lit(1)))


def with_length(df: DataFrame, field: str = "both") -> DataFrame:
    """Chosen text and its length in characters (0 when absent)."""
    txt = T.text_field("title", "message", field)
    return df.withColumn("text", txt).withColumn(
        "length", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))


def comment_lengths(df: DataFrame, field: str = "both", clip_at: int = 500,
                    bins: int = 40) -> DataFrame:
    """Histogram of comment lengths (commented rows), clipped at ``clip_at``."""
    from emporium.operators.business import histogram
    w = with_length(df, field).filter(F.col("length") > 0)
    return histogram(w, "length", bins, 0.0, float(clip_at))


def length_by_score(df: DataFrame, field: str = "both") -> DataFrame:
    """X11: average comment length by score (commented rows)."""
    return (with_length(df, field).filter(F.col("length") > 0).groupBy("review_score")
            .agg(F.avg("length").alias("avg_length"), F.count(F.lit(1)).alias("reviews")))


def band_tokens(df: DataFrame, text_col: str, bands: Mapping[str, Sequence[int]] | None = None,
                key: str = "review_id") -> DataFrame:
    """One row per kept token of a scored text: (key, band, term)."""
    band = F.lit(None).cast("string")
    for name, scores in (bands or T.SCORE_BANDS).items():
        band = F.when(F.col("review_score").isin(list(scores)), F.lit(name)).otherwise(band)
    b = df.withColumn("band", band).filter(F.col("band").isNotNull())
    return token_rows(b, text_col, key, ["band"])


def terms_by_band(df: DataFrame, text_col: str, n: int = 20,
                  bands: Mapping[str, Sequence[int]] | None = None,
                  key: str = "review_id") -> DataFrame:
    """Top-n terms per score band (rank within band over aggregated counts)."""
    g = band_tokens(df, text_col, bands, key).groupBy("band", "term").agg(F.count(F.lit(1)).alias("count"))
    # One count table; the rank filter is pushed below the exchange, so a task passes on
    # n rows a band, whatever the vocabulary.
    by = Window.partitionBy("band").orderBy(F.desc("count"), "term")
    return g.withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= n).drop("_r")
