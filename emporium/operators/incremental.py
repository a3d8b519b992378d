"""A1, V2–V4 kept up to date by increments (after S4): only what a load meets is recomputed.

The loaded tables, the order grain and the enriched orders are keyed tables.  A load
gives the orders that it can have changed: those named by its orders, items, payments
and reviews, those that its reviews belonged to before, and those of its customers.
Their rows alone are read, from the buckets that they lie in, and built anew by the
same functions as a full build.  Sequence, totals and cohort are per person, so the
persons that these orders belong to, or belonged to, are enriched anew, from the
enriched table's own rows and the new ones.

Two small tables find orders by review and by customer.  They only grow: an order too
many is built again to the same rows.

A load is named by its writer.  What it met is written before any table changes, and
each table commits the writer's name, so a load that failed half-way is repeated from
where it stopped and a load that is done is not done twice.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.functions import expr as X
from emporium.operators import gold as G
from emporium.operators import orders as O
from emporium.session import scratch_path
from emporium.sources import binding, versioned
from emporium.sources.keyed_table import KeyedTable

PERSON = "customer_unique_id"
#: How staging picks a key's row: keys, order, direction of the remaining columns.
STAGED = {
    "orders": (["order_id"], [("order_purchase_timestamp", True)], True),
    "order_items": (["order_id", "order_item_id"], [], False),
    "order_payments": (["order_id", "payment_sequential"], [], False),
    "order_reviews": (["review_id"], [("review_answer_timestamp", True)], True),
    "customers": (["customer_id"], [], False),
}
BY_ORDER = ("orders", "order_items", "order_payments")


def _person_key() -> Column:
    """An order without a person stands for itself."""
    return F.coalesce(F.col(PERSON), F.concat(F.lit("\u0000"), F.col("order_id")))


class OrderStore:
    """Loaded tables, order grain and enriched orders under ``path``; ``schemas`` of the loaded ones."""

    def __init__(self, spark: SparkSession, path: str, schemas: Mapping[str, object], buckets: int = 64,
                 as_of: str = binding.AS_OF_ORDERS, high_value: float = binding.HIGH_VALUE, keep: int = 2):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        self._build = (as_of, high_value)
        order = X.norm_key("order_id")
        self.raw = {n: KeyedTable(spark, f"{self.path}/{n}", schemas[n], STAGED[n][0], buckets,
                                  order if n in BY_ORDER else None) for n in STAGED}
        self.of_review = KeyedTable(spark, f"{self.path}/orders_of_review", self._schema("order_id string, review_id string"),
                                    ["order_id", "review_id"], buckets, F.col("order_id"))
        self.of_customer = KeyedTable(spark, f"{self.path}/orders_of_customer",
                                      self._schema("customer_id string, order_id string"),
                                      ["customer_id", "order_id"], buckets, F.col("customer_id"))
        empty = {n: t.read(buckets=[]) for n, t in self.raw.items()}
        grain = self._grain(empty).schema
        self.grain = KeyedTable(spark, f"{self.path}/grain", grain, ["order_id"], buckets)
        self.enriched = KeyedTable(spark, f"{self.path}/enriched", self._enriched_schema(grain), [PERSON, "order_id"],
                                   buckets, _person_key())

    def _schema(self, ddl: str):
        return self.spark.createDataFrame([], ddl).schema

    def _enriched_schema(self, grain):
        return O.enrich(self.spark.createDataFrame([], grain)).schema

    def _grain(self, raw: Mapping[str, DataFrame]) -> DataFrame:
        """A1 over staged rows: the functions of a full build."""
        fact = G.build_fact_orders(raw["orders"], raw["order_items"], raw["order_payments"], *self._build)
        return O.orders(fact, G.build_dim_customers(raw["customers"]), G.current_reviews(raw["order_reviews"]))

    # ---------------------------------------------------------------- steps --
    def _noted(self, name: str, writer: str, build: Callable[[], DataFrame]) -> DataFrame:
        """What ``build`` gives, written once for this writer."""
        target = f"{self.path}/noted/{name}"
        done = [folder for _, w, folder in versioned.versions(self.spark, target) if w == writer]
        folder = done[-1] if done else versioned.write_version(build(), target, writer)
        return self.spark.read.parquet(folder)

    @staticmethod
    def _within(table: KeyedTable, ids: DataFrame, key: Column, id_col: str) -> DataFrame:
        """The rows of a table whose ``key`` is among ``ids``: only their buckets are read."""
        rows = table.read(buckets=table.touched(ids, F.col(id_col)))
        return rows.join(ids.select(F.col(id_col).alias("_id")).distinct(), key == F.col("_id"), "left_semi")

    def _met(self, batch: Mapping[str, DataFrame]) -> DataFrame:
        """(order_id): the orders that a load can change."""
        parts = [batch[n].select(X.norm_key("order_id").alias("order_id")) for n in (*BY_ORDER, "order_reviews")
                 if n in batch]
        if "order_reviews" in batch:
            ids = batch["order_reviews"].select("review_id")
            parts.append(self._within(self.raw["order_reviews"], ids, F.col("review_id"), "review_id")
                         .select(X.norm_key("order_id").alias("order_id")))
        if "customers" in batch:
            ids = batch["customers"].select(X.norm_key("customer_id").alias("customer_id"))
            parts.append(self._within(self.of_customer, ids, F.col("customer_id"), "customer_id").select("order_id"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.where("order_id IS NOT NULL").distinct()

    def _load_raw(self, batch: Mapping[str, DataFrame], writer: str) -> None:
        work = [lambda n=n: self.raw[n].upsert(batch[n], writer, *STAGED[n][1:], batch_wins=False) for n in batch]
        if "order_reviews" in batch:
            links = batch["order_reviews"].select(X.norm_key("order_id").alias("order_id"), "review_id")
            reviewed = links.where("order_id IS NOT NULL AND review_id IS NOT NULL").distinct()
            work.append(lambda: self.of_review.upsert(reviewed, writer))
        if "orders" in batch:
            links = batch["orders"].select(X.norm_key("customer_id").alias("customer_id"),
                                           X.norm_key("order_id").alias("order_id"))
            bought = links.where("order_id IS NOT NULL AND customer_id IS NOT NULL").distinct()
            work.append(lambda: self.of_customer.upsert(bought, writer))
        self._at_once(work)

    @staticmethod
    def _at_once(work: Sequence[Callable[[], object]]) -> None:
        """Jobs of different tables side by side; the first failure is raised."""
        with ThreadPoolExecutor(len(work)) as pool:
            for done in [pool.submit(w) for w in work]:
                done.result()

    def _rows_of(self, met: DataFrame) -> dict[str, DataFrame]:
        """The staged rows that the orders ``met`` are built from."""
        raw = {n: self._within(self.raw[n], met, X.norm_key("order_id"), "order_id") for n in BY_ORDER}
        reviews = self._within(self.of_review, met, F.col("order_id"), "order_id").select("review_id")
        rows = self._within(self.raw["order_reviews"], reviews, F.col("review_id"), "review_id")
        raw["order_reviews"] = rows.join(met, X.norm_key(rows["order_id"]) == met["order_id"], "left_semi")
        customers = raw["orders"].select(X.norm_key("customer_id").alias("customer_id"))
        raw["customers"] = self._within(self.raw["customers"], customers, F.col("customer_id"), "customer_id")
        return raw

    def load(self, batch: Mapping[str, DataFrame], writer: str) -> bool:
        """Load increments of any of the tables; False if ``writer`` had been done before."""
        if self.enriched.committed(writer):
            return False
        if not batch:
            raise ValueError("a load needs rows of at least one table")
        met = self._noted("met", writer, lambda: self._met(batch))
        self._load_raw(batch, writer)
        new = self._noted("new", writer, lambda: self._grain(self._rows_of(met)))

        def persons() -> DataFrame:  # before and after
            old = self._within(self.grain, met, F.col("order_id"), "order_id")
            return old.select(_person_key().alias("person")).unionByName(new.select(_person_key().alias("person"))).distinct()

        changed = self._noted("persons", writer, persons)
        if not self.grain.committed(writer):
            buckets = self.grain.touched(met, F.col("order_id"))
            rest = self.grain.read(buckets=buckets).join(met, "order_id", "left_anti")
            self.grain.replace(rest.unionByName(new), buckets, writer)
        buckets = self.enriched.touched(changed, F.col("person"))
        there = self.enriched.read(buckets=buckets)
        kept = there.join(changed, _person_key() == changed["person"], "left_anti")
        own = (there.join(changed, _person_key() == changed["person"], "left_semi")
               .join(met, "order_id", "left_anti").select(*new.columns))
        again = O.enrich(own.unionByName(new))
        self.enriched.replace(kept.unionByName(again), buckets, writer, files=4)
        self._at_once([lambda t=t: t.vacuum(self.keep) for t in (
            *self.raw.values(), self.of_review, self.of_customer, self.grain, self.enriched)])
        for n in ("met", "new", "persons"):
            versioned.drop_versions(self.spark, f"{self.path}/noted/{n}", self.keep)
        return True


def new_store(spark: SparkSession, schemas: Mapping[str, object], buckets: int = 16) -> OrderStore:
    """A store in a fresh folder of the session's shared checkpoint folder."""
    return OrderStore(spark, scratch_path(spark, "order-store"), schemas, buckets)
