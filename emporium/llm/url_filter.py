"""URL filter by a Bloom filter cascade (native: DataFrame functions only).

The keys of the lists are ``host/path-prefix`` strings.  Every url stands for
the candidate keys it could be listed under: each suffix of its host's labels
joined to each path prefix of a listed length.  For one list, level 0 is a
Bloom filter of the listed keys; level 1 encodes those keys of the corpus's
complete key universe that level 0 takes by mistake; level 2 the listed keys
that level 1 takes by mistake, and so on until no mistake is left.  A key of
the universe is listed exactly if the first level that misses it is an odd one
(or none misses it and the number of levels is odd).  Judging a url is then a
handful of bit tests on its own row: no join, no shuffle.

Sizes: the levels hold about ``listed · (log2(universe / listed) + 5)`` bits, so
they are bounded by the list, not by the corpus, and reach the rows as scalar
subqueries.  The universe is a distinct over (host, short path prefix).

Defined results: a null url, or one without ``://``, has empty host and path and
fits no key; empty tables give empty results; repeated rows are judged one by
one; other columns of the input are ignored.
"""
from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm.common import scratch_table

# Fixed values of the url_filter query: (rule, verdict).
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every ``host suffix + path prefix`` that a list could hold for this url."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n),
                           lambda i: F.array_join(F.slice(labels, i, n), "."))
    prefixes = F.array_distinct(F.array(*[F.substring(path, 1, n_) for n_ in lengths]))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


@dataclass(frozen=True)
class Level:
    table: DataFrame  # one row: words array<bigint>
    bits: int
    hashes: int
    salt: int

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.salt), F.lit(i)), F.lit(self.bits))
                for i in range(self.hashes)]

    def takes(self, key: Column, words: Column) -> Column:
        tests = [F.expr("true")] + [
            F.getbit(F.element_at(words, (F.floor(p / 64) + 1).cast("int")),
                     (p % 64).cast("int")) == 1
            for p in self.positions(key)]
        return reduce(lambda a, b: a & b, tests)


def _build_level(keys: DataFrame, n: int, rate: float, salt: int, name: str) -> Level:
    """A Bloom filter of ``keys`` (column key; ``n`` of them) as one row of words."""
    hashes = max(1, round(math.log2(1 / rate)))
    bits = max(64, 64 * math.ceil(n * hashes / math.log(2) / 64))
    level = Level(keys, bits, hashes, salt)
    spark = keys.sparkSession
    hits = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("p"))
    ones = hits.select(F.floor(F.col("p") / 64).alias("w"),
                       F.expr("shiftleft(1L, cast(p % 64 as int))").alias("b"))
    empty = spark.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b"))
    filled = ones.union(empty).groupBy("w").agg(F.bit_or("b").alias("b"))
    row = filled.agg(F.array_sort(F.collect_list(F.struct("w", "b"))).alias("x"))
    return Level(scratch_table(row.select(F.col("x.b").alias("words")), name), bits, hashes, salt)


class Cascade:
    """Exact membership of universe keys in one list."""

    def __init__(self, universe: DataFrame, listed: DataFrame, name: str):
        universe = universe.select("key")
        member = listed.select("key").distinct().join(universe, "key", "left_semi")
        other = universe.join(listed.select("key").distinct(), "key", "left_anti")
        member, other = scratch_table(member, f"{name}-in"), scratch_table(other, f"{name}-out")
        self.levels: list[Level] = []
        yes, no = member, other
        n_yes, n_no = yes.count(), no.count()
        while n_yes:
            # Level 0 is the sharper the rarer listed keys are; later ones halve.
            rate = 0.5 if self.levels else min(0.5, math.sqrt(0.5) * n_yes / max(1, n_no))
            level = _build_level(yes, n_yes, rate, len(self.levels), f"{name}-bits")
            self.levels.append(level)
            wrong = no.where(level.takes(F.col("key"), level.table.scalar()))
            yes, no = scratch_table(wrong, f"{name}-level"), yes
            n_yes, n_no = yes.count(), n_yes

    def with_words(self, df: DataFrame, prefix: str) -> DataFrame:
        """Attach the levels as constant columns ``{prefix}0``, ``{prefix}1``, ..."""
        return df.withColumns({f"{prefix}{i}": level.table.scalar()
                               for i, level in enumerate(self.levels)})

    def holds(self, key: Column, prefix: str) -> Column:
        verdict = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            taken = self.levels[i].takes(key, F.col(f"{prefix}{i}"))
            verdict = F.when(~taken, F.lit(i % 2 == 1)).otherwise(verdict)
        return verdict


def filter_urls(pages: DataFrame, rules: DataFrame, path_lengths: list[int],
                default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Judge every url by the listed keys (``rules``: key, verdict allow/block).

    ``path_lengths`` are the lengths of the listed path parts.  The longest
    fitting key wins; of keys of one length the greater string, and block
    before allow if both lists hold it.  Urls that fit none get ``default``.
    """
    lengths = sorted(set(path_lengths))
    judged = pages.select(id_col, host_of(F.col(url_col)).alias("host"),
                          path_of(F.col(url_col)).alias("path"))
    short = judged.select("host", F.substring("path", 1, max(lengths, default=0)).alias("path")).distinct()
    universe = scratch_table(
        short.select(F.explode(candidate_keys(F.col("host"), F.col("path"), lengths)).alias("key"))
        .distinct(), "url-keys")
    lists = {v: Cascade(universe, rules.where(F.col("verdict") == v), f"url-{v}")
             for v in ("allow", "block")}
    df = judged.withColumn("_keys", candidate_keys(F.col("host"), F.col("path"), lengths))
    for v, cascade in lists.items():
        df = cascade.with_words(df, f"_{v}")

    def held(v: str) -> Column:
        """The candidate keys that list ``v`` holds, as (length, rule, verdict)."""
        keys = F.filter("_keys", lambda k: lists[v].holds(k, f"_{v}"))
        return F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("rule"),
                                                    F.lit(v).alias("verdict")))

    df = df.withColumn("_best", F.array_max(F.concat(held("allow"), held("block"))))
    return df.select(id_col, "host", "path", F.col("_best.rule").alias("rule"),
                     F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"))


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "key string, verdict string")


def path_lengths(rules=RULES) -> list[int]:
    return [len(key) - key.index("/") for key, _ in rules]
