"""Per-call build context: bound sources → gold → order-grain frames (all lazy)."""
from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from emporium.operators import gold as G
from emporium.operators import orders as O
from emporium.plans.rollup import Rollup, fingerprint, open_rollup
from emporium.session import fit_shuffles
from emporium.sources import binding
from emporium.sources.io import materialize
from emporium.sources.versioned import children, size


class Ctx:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        fit_shuffles(spark, size(spark, sf_dir))
        self.src = binding.load_sources(spark, sf_dir)
        self.gold = G.Gold(self.src)
        self.fact_written = False

    @cached_property
    def fact(self) -> DataFrame:
        return self.gold.fact_orders

    @cached_property
    def orders(self) -> DataFrame:
        g = self.gold
        if self.fact_written:
            return O.orders(self.fact, g.dim_customers, g.dim_reviews_current)
        return O.orders_from_staging(*[g.stage(f"stg_{n}") for n in ("orders", "order_items", "order_payments")],
                                     g.dim_customers, g.dim_reviews_current)

    @cached_property
    def enriched(self) -> DataFrame:
        return O.enrich(self.orders)

    @cached_property
    def category(self) -> DataFrame:
        return O.category(self.fact, self.gold.dim_products, self.gold.dim_customers)

    def rollup(self, dataset: str, source: Callable[[], DataFrame]) -> Rollup:
        """The dataset's rollup, shared by all contexts of the same state of the source files."""
        state = fingerprint(self.spark, [f"{self.sf_dir}/{t}" for t in children(self.spark, self.sf_dir)])
        return open_rollup(self.spark, dataset, state, source)

    @cached_property
    def review_texts(self) -> DataFrame:
        return binding.review_texts(self.src.read)


STAGING = ["stg_customers", "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews",
           "stg_products", "stg_category_translation", "stg_sellers", "stg_geolocation"]


def materialize_gold(c: Ctx, base: str, watch: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None) -> Ctx:
    """Write staging, gold and order grain once each and re-point the context at them.

    This is the nightly shape: each layer is built from the written one below, tables of
    a layer side by side, and checks and marts read written tables, which also cuts the
    lineage (a lost executor re-reads parquet instead of recomputing the whole build).
    ``watch`` maps a table to what is attached to its frame, to be measured by the write.
    """
    g, watch = c.gold, watch or {}

    def written(tables: Mapping[str, Callable[[], DataFrame]], layer: str) -> dict[str, DataFrame]:
        def one(name: str) -> DataFrame:
            return materialize(watch.get(name, lambda df: df)(tables[name]()), name, "gold", f"{base}/{layer}")
        with ThreadPoolExecutor(len(tables)) as pool:
            return dict(zip(tables, pool.map(one, tables)))

    g.staged.update(written({n: lambda n=n: g.stage(n) for n in STAGING}, "staging"))
    gold = written({"fact_orders": lambda: c.fact, "dim_customers": lambda: g.dim_customers,
                    "dim_sellers": lambda: g.dim_sellers, "dim_products": lambda: g.dim_products,
                    "dim_reviews": lambda: g.dim_reviews, "dim_geolocation": lambda: g.dim_geolocation}, "gold")
    c.__dict__["fact"], c.fact_written = gold["fact_orders"], True
    g._cache.update({"fact": gold["fact_orders"], "cust": gold["dim_customers"], "sell": gold["dim_sellers"],
                     "prod": gold["dim_products"], "rev": gold["dim_reviews"], "geo": gold["dim_geolocation"]})
    g._cache["rev_cur"] = G.current_reviews(g.stage("stg_order_reviews"))
    c.__dict__["orders"] = written({"orders_grain": lambda: c.orders}, "mart")["orders_grain"]
    c.__dict__["enriched"] = written({"orders": lambda: c.enriched}, "mart")["orders"]
    return c
