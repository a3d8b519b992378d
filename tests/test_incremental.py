"""Order grain and enriched orders kept by increments equal a full rebuild."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from emporium.operators import gold as G
from emporium.operators import incremental as I
from emporium.operators import orders as O
from emporium.operators import staging
from emporium.sources import binding
from emporium.sources.keyed_table import ROWS, KeyedTable

DDL = {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
              "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
              "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    "order_items": "order_id string, order_item_id long, product_id string, seller_id string, "
                   "shipping_limit_date timestamp_ntz, price double, freight_value double",
    "order_payments": "order_id string, payment_sequential long, payment_type string, payment_installments long, "
                      "payment_value double",
    "order_reviews": "review_id string, order_id string, review_score long, review_comment_title string, "
                     "review_comment_message string, review_creation_date timestamp_ntz, "
                     "review_answer_timestamp timestamp_ntz",
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                 "customer_city string, customer_state string",
}


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def loads(seed=1):
    """Three loads with a hot person, orders without a person or items, moved reviews, moved customers."""
    rng = random.Random(seed)
    out = []
    for n in range(3):
        ids = [f"o{rng.randrange(60 if n else 40)}" for _ in range(40 if n == 0 else 6)]
        out.append({
            "orders": [(o, f"c{int(o[1:]) % 25}", rng.choice(["delivered", "shipped"]), day(rng.randrange(90)), None, None,
                        day(100 + n), day(99)) for o in ids],
            "order_items": [(rng.choice(ids), i, f"p{rng.randrange(5)}", "s1", day(n), float(rng.randrange(1, 50)), 1.5)
                            for i in range(1, 20 if n == 0 else 4)],
            "order_payments": [(rng.choice(ids), rng.randrange(1, 3), "boleto", 1, float(rng.randrange(1, 90)))
                               for _ in range(15 if n == 0 else 3)],
            "order_reviews": [(f"r{rng.randrange(15)}", rng.choice([*ids, None]), rng.randrange(1, 6), None, None, day(n),
                               day(110 + 10 * n + k)) for k in range(12 if n == 0 else 4)],
            "customers": [(f"c{i}", rng.choice(["hot", "hot", f"u{i}", None]), "1", "x", rng.choice(["SP", "RJ"]))
                          for i in (range(25) if n == 0 else rng.sample(range(25), 2))]})
    out[2] = {k: out[2][k] for k in ("order_reviews", "customers")}  # a load without orders
    return out


def full(spark, rows):
    """The grain and the enriched orders by a full build over all rows ever loaded."""
    frames = {n: spark.createDataFrame(rows[n], DDL[n]) for n in DDL}
    staged = {n: staging.dedupe_latest(frames[n], *I.STAGED[n][:2], descending=I.STAGED[n][2]) for n in DDL}
    fact = G.build_fact_orders(staged["orders"], staged["order_items"], staged["order_payments"], binding.AS_OF_ORDERS,
                               binding.HIGH_VALUE)
    grain = O.orders(fact, G.build_dim_customers(staged["customers"]), G.current_reviews(staged["order_reviews"]))
    return grain, O.enrich(grain)


def content(df, cols):
    return sorted(map(str, df.select(*cols).collect()))


@pytest.fixture(scope="module")
def schemas(spark):
    return {n: spark.createDataFrame([], d).schema for n, d in DDL.items()}


def frames(spark, load):
    return {n: spark.createDataFrame(r, DDL[n]) for n, r in load.items()}


def files(t):
    return {e.bucket: e.folder for e in t.entries() if e.part == ROWS}


def test_loads_equal_a_full_rebuild_and_a_failed_one_goes_on(spark, schemas, monkeypatch):
    store = I.new_store(spark, schemas, buckets=8)
    seen = {n: [] for n in DDL}
    for n, load in enumerate(loads()):
        for t, r in load.items():
            seen[t] += r
        batch = frames(spark, load)
        if n == 1:  # lost after the loaded tables and the grain, before the enriched orders
            real = KeyedTable.replace

            def lost(self, *a, **k):
                if self is store.enriched:
                    raise RuntimeError("lost")
                return real(self, *a, **k)

            with monkeypatch.context() as m:
                m.setattr(KeyedTable, "replace", lost)
                with pytest.raises(RuntimeError):
                    store.load(batch, f"w{n}")
        assert store.load(batch, f"w{n}")
        assert not store.load(batch, f"w{n}")
        grain, enriched = full(spark, seen)
        assert content(store.grain.read(), grain.columns) == content(grain, grain.columns)
        assert content(store.enriched.read(), enriched.columns) == content(enriched, enriched.columns)


def test_a_load_touches_only_the_buckets_of_its_orders_and_persons(spark, schemas):
    store = I.new_store(spark, schemas, buckets=32)
    base = {"orders": [(f"o{i}", f"c{i}", "delivered", day(i % 50), None, None, None, None) for i in range(200)],
            "customers": [(f"c{i}", f"u{i}", "1", "x", "SP") for i in range(200)],
            "order_items": [(f"o{i}", 1, "p", "s", None, 2.0, 1.0) for i in range(200)]}
    store.load(frames(spark, base), "w0")
    before = {t: files(t) for t in (store.grain, store.enriched, store.raw["orders"], store.raw["order_items"])}
    store.load(frames(spark, {"order_items": [("o5", 2, "p", "s", None, 7.0, 1.0)]}), "w1")
    changed = {t: {b for b, f in files(t).items() if before[t].get(b) != f} for t in before}
    one = spark.createDataFrame([("o5", "u5")], "order_id string, customer_unique_id string")
    assert changed[store.grain] == set(store.grain.touched(one))
    assert changed[store.enriched] == set(store.enriched.touched(one))
    assert changed[store.raw["orders"]] == set() and len(changed[store.raw["order_items"]]) == 1
    assert store.grain.read().where("order_id = 'o5'").first().gmv == 9.0
    read = store._rows_of(one.select("order_id"))
    assert len(read["orders"].inputFiles()) == 1 and len(read["order_items"].inputFiles()) <= 2
    assert store.enriched.read().agg(F.count(F.lit(1))).first()[0] == 200
