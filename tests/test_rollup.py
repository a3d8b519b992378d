"""Rollups and person bitmaps: equal to the datasets they stand for, and all that is read."""
import itertools

import pytest
from pyspark.sql import functions as F

from emporium.operators import persons as P
from emporium.plans import queries_semantic as Q
from emporium.plans import rollup as R
from emporium.plans import semantic as S
from emporium.session import scratch_path


@pytest.fixture(scope="module")
def orders(spark, shared_context):
    return S.v_orders(shared_context.enriched).cache()


@pytest.fixture(scope="module")
def rollup(spark, orders):
    return R.open_rollup(spark, "v_orders", scratch_path(spark, "t").rsplit("-", 1)[1], lambda: orders)


def rows(df):
    return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()], key=str)


FILTERS = [[], ["customer_state = 'SP'"], R.filter_sql("1994-01-01", "1996-12-01", ["SP", "RJ", "it's"]),
           ["is_delivered", "review_bucket <> 'x' OR review_bucket IS NULL"], ["delivery_bucket LIKE '%late%'"]]


@pytest.mark.parametrize("dims", [(), ("order_month",), ("customer_state", "is_repeat_order"),
                                  ("review_bucket", "delivery_bucket"), ("is_delivered",)])
def test_any_grouping_and_filter_equals_the_dataset(orders, rollup, dims):
    metrics = list(S.METRICS["v_orders"])
    for filters in FILTERS:
        want = S.metric_query(orders, "v_orders", metrics, dims, filters)
        got = rollup.frame(metrics, dims, filters)
        assert got is not None and rows(got) == rows(want), (dims, filters)


def test_every_chart_reads_only_its_rollup(spark, shared_context):
    for name, ds, metrics, dims, filters, order_by, desc, limit in Q._CHARTS:
        own = shared_context.rollup(ds, lambda ds=ds: Q._SRC[ds][2](shared_context))
        called = []
        got = R.metric_query(own, lambda: called.append(1), metrics, dims, filters, order_by, desc, limit) \
            if name != "m6_orders_of_one_item" else None
        if got is not None:
            assert not called and got.inputFiles() and all(own.folder.split(":")[-1] in f for f in got.inputFiles()), name
    assert own.route(["gmv_total"], ["order_month"], ["n_items = 1"]) is None


def test_the_router_takes_the_smallest_covering_set(rollup):
    assert rollup.route(["gmv_total"], [], []) == ()
    assert rollup.route(["gmv_total"], ["order_month"], []) == ("order_month",)
    assert rollup.route(["aov"], ["review_bucket"], R.filter_sql("1994-01-01")) == (
        "order_month", "customer_state", "review_bucket")
    assert rollup.route(["aov"], ["review_bucket"], ["is_delivered"]) == rollup.spec.dims
    assert rollup.route(["aov"], ["payment_type"], []) is None and rollup.route(["other"], [], []) is None
    sizes = [rollup.rows[rollup.spec.number(s)] for s in ((), ("order_month",), rollup.spec.dims)]
    assert sizes == sorted(sizes) and sizes[0] == 1


def test_a_rollup_is_built_once_for_a_state_of_its_sources(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(3).write.parquet(src)
    state = R.fingerprint(spark, [src])
    assert state == R.fingerprint(spark, [src])
    built = []

    def source():
        built.append(1)
        return spark.createDataFrame([("2024-01-01", "SP", "c", 1.5, 2)], "order_month string, customer_state string, "
                                     "product_category string, gmv double, n_items long")

    first = R.open_rollup(spark, "v_category", f"{state}-{tmp_path.name}", source)
    again = R.open_rollup(spark, "v_category", f"{state}-{tmp_path.name}", source)
    assert len(built) == 1 and first.folder == again.folder
    spark.range(1).write.mode("append").parquet(src)
    assert R.fingerprint(spark, [src]) != state


def test_an_empty_dataset(spark, orders):
    own = R.open_rollup(spark, "v_orders", scratch_path(spark, "e").rsplit("-", 1)[1], lambda: orders.limit(0))
    for dims in ((), ("order_month",)):
        want = S.metric_query(orders.limit(0), "v_orders", list(S.METRICS["v_orders"]), dims)
        assert rows(own.frame(list(S.METRICS["v_orders"]), dims, [])) == rows(want)


# ---------------------------------------------------------------- bitmaps --
def history(spark):
    import random
    rng = random.Random(3)
    out, seen = [], {}
    who = ["hot"] * 900 + [f"p{i}" for i in range(700) for _ in range(rng.choice([1, 1, 2, 7]))] + [None] * 20
    rng.shuffle(who)
    for i, p in enumerate(who):
        seen[p] = seen.get(p, 0) + 1
        n = None if p is None else seen[p]
        out.append((str(i), p, f"2024-{1 + i * 12 // len(who):02}-01", rng.choice(["SP", "RJ", None]), n,
                    n is not None and n > 1))
    return spark.createDataFrame(out, "order_id string, customer_unique_id string, order_month string, "
                                 "customer_state string, order_seq long, is_repeat_order boolean")


def test_merged_months_and_states_equal_count_distinct(spark):
    df = history(spark).cache()
    sets = P.bitmaps(df)
    known = df.where("customer_unique_id IS NOT NULL")
    for by, where in itertools.product([[], ["order_month"], ["customer_state"], ["is_repeat_order", "customer_state"]],
                                       [[], ["customer_state = 'SP'"], ["order_month >= '2024-03-01'", "is_repeat_order"]]):
        want = known
        for f in where:
            want = want.filter(F.expr(f))
        count = F.count_distinct("customer_unique_id").alias("persons")
        want = want.groupBy(*by).agg(count) if by else want.agg(count)
        assert rows(P.count_persons(sets, by, where)) == rows(want)


def test_numbers_are_dense_and_bitmaps_reach_over_buckets(spark):
    people = spark.range(70_000).select(
        F.col("id").cast("string").alias("order_id"), F.concat(F.lit("p"), "id").alias("customer_unique_id"),
        F.lit("2024-01-01").alias("order_month"), F.lit("SP").alias("customer_state"), F.lit(1).alias("order_seq"),
        F.lit(False).alias("is_repeat_order"))
    nr = P.numbered(people).agg(F.min("nr"), F.max("nr"), F.count_distinct("nr")).first()
    assert tuple(nr) == (1, 70_000, 70_000)
    sets = P.bitmaps(people.union(people))
    assert sets.count() == 3 and P.count_persons(sets).first().persons == 70_000


def test_frequency_measures_equal_counts_per_person(spark):
    df = history(spark)
    sets = P.bitmaps(df)
    per = df.where("customer_unique_id IS NOT NULL").groupBy("customer_unique_id").count()
    rate = P.repeat_customer_rate(sets).first()
    assert (rate.customers, rate.repeat_customers) == (per.count(), per.where("count > 1").count())
    want = per.groupBy(F.least("count", F.lit(5)).alias("n")).agg(F.count(F.lit(1)).alias("m"))
    assert {r.orders_placed: r.customers for r in P.orders_per_customer(sets).collect()} == {
        r.n: r.m for r in want.collect()}
    empty = P.bitmaps(df.limit(0))
    assert P.count_persons(empty).first().persons == 0 and P.count_persons(empty, ["order_month"]).collect() == []
