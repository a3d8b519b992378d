import math

import numpy as np
from pyspark.sql import functions as F

from emporium.llm import exact_search, url_filter


def brute_top(rows, k):
    use = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
           if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in use:
        if i % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), j) for n, (j, w) in enumerate(use)
                       if j != i and len(w) == len(v))
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # ties: many copies of one vector
    rows += [(2000, None), (2050, [1.0, None] * 4), (2100, [float("nan")] * 8), (2150, [float("inf")] * 8),
             (3000, [0.5, 0.5]), (3001, [0.25, 0.5]), (4000, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = exact_search.top_k(df, F.col("id") % 50 == 0, data_block=64, query_block=4, cell_bits=3)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 5)


def test_rows_that_share_an_id(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6)]) for i in range(40)]
    rows += [(50, rows[3][1]), (50, rows[4][1]), (50, rows[4][1]), (7, rows[9][1]), (9, rows[3][1]), (5, [1e30] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    use = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v[0] < 1e9]
    want = []
    for n, (i, v) in enumerate(use):
        if i % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, (j, w) in enumerate(use) if m != n)
            want += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s[:5])]
    got = exact_search.top_k(df, F.col("id") % 50 == 0, data_block=16, query_block=2, cell_bits=3)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_top_k_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert exact_search.top_k(df, F.col("id") % 50 == 0).collect() == []


def brute_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fit = []
    for rule, verdict in url_filter.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fit.append((len(rule), rule, verdict))
    best = max(fit, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_urls_equal_brute_force(spark):
    urls = [None, "", "no scheme", "http://", "http://EXAMPLE.org/es/1", "http://example.org/en/15", "x://a.example.org/en/1#t",
            "http://a.example.com/fr/3?q=/de/", "http://b.com/de/", "http://b.com/de", "http://example.org", "http://org/",
            "http://notexample.org/es/", "https://u:p@h.org:80/es/x", "http://x.org?a=://y.com/de/", "a://b://c.org/",
            "http://example.org./es/", "http://É.org/ñ\n/x", "http://b.com/de/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit(1))
    got = url_filter.filter_urls(df, url_filter.rules_frame(spark), url_filter.path_lengths()).collect()
    assert {r.page_id: tuple(r)[1:] for r in got} == {i: brute_rule(u) for i, u in enumerate(urls)}
    assert url_filter.filter_urls(df.limit(0), url_filter.rules_frame(spark), url_filter.path_lengths()).collect() == []


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("cast(substring(key, 2) as int) % 7 = 0")
    cascade = url_filter.Cascade(universe, listed, "t")
    assert len(cascade.levels) > 2
    got = cascade.with_words(universe, "w").where(cascade.holds(F.col("key"), "w")).select("key")
    assert {r.key for r in got.collect()} == {r.key for r in listed.collect()}
