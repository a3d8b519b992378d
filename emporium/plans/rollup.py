"""M6, P25 over a rollup: additive partials by GROUPING SETS and a router.

A metric is kept as partials that add up (sums, counts), not as its value, so every
coarser grouping and every filter on a dimension follows from any set of dimensions
that holds them.  A rollup is built in one pass: the dataset is aggregated to all its
dimensions, and the listed sets come from that small table by GROUPING SETS.  Each set
lies in a folder of its own.  A metric query is routed to the smallest set that covers
its dimensions and filters, and reads nothing else; what no set covers is computed from
the dataset as before.

A rollup is written once for a state of the source files (see ``fingerprint``) under the
shared checkpoint folder, as a committed version: charts of the same state share it.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.plans import semantic as S
from emporium.session import ensure_checkpoint_dir
from emporium.sources import versioned

GSET = "gset"


@dataclass(frozen=True)
class Spec:
    """Dimensions, the sets of them that are kept, partials and metrics of a dataset.

    ``partials``: name → aggregate over the dataset's rows; all are merged by SUM.
    ``metrics``: name → expression over merged partials, equal to the metric's definition."""
    dims: tuple[str, ...]
    sets: tuple[tuple[str, ...], ...]
    partials: dict[str, str]
    metrics: dict[str, str]

    def number(self, dims: Sequence[str]) -> int:
        """grouping_id() of a set: a bit for each dimension that it lacks, the first one highest."""
        return sum(1 << (len(self.dims) - 1 - i) for i, d in enumerate(self.dims) if d not in dims)

    def all_sets(self) -> list[tuple[str, ...]]:
        return list(dict.fromkeys([self.dims, *self.sets, ()]))


_MS = ("order_month", "customer_state")
_MONEY = "CAST({} AS DOUBLE)"
SPECS: dict[str, Spec] = {
    # one row an order, so distinct orders are rows
    "v_orders": Spec(
        (*_MS, "is_repeat_order", "review_bucket", "delivery_bucket", "is_delivered"),
        ((*_MS, "is_repeat_order"), (*_MS, "review_bucket"), (*_MS, "delivery_bucket"), (*_MS, "is_delivered"), _MS,
         ("order_month", "is_repeat_order"), ("order_month",), ("customer_state",), ("review_bucket",),
         ("delivery_bucket",), ("is_delivered",)),
        {"orders": "COUNT(order_id)", "gmv_s": "SUM(CAST(gmv AS DECIMAL(18,2)))",
         "review_s": "SUM(review_score)", "review_n": "COUNT(review_score)",
         "lead_s": "SUM(delivery_days)", "lead_n": "COUNT(delivery_days)",
         "late_s": "COUNT_IF(days_vs_estimate > 0)", "timed_n": "COUNT(days_vs_estimate)",
         "reorder_s": "COUNT_IF(has_subsequent_order)", "reorder_n": "COUNT(has_subsequent_order)",
         "repeat_s": "COUNT_IF(is_repeat_order)", "repeat_n": "COUNT(is_repeat_order)"},
        {"gmv_total": _MONEY.format("gmv_s"), "order_count": "orders",
         "aov": "CAST(gmv_s AS DOUBLE) / NULLIF(orders, 0)", "avg_review": "review_s / NULLIF(review_n, 0)",
         "avg_lead_days": "lead_s / NULLIF(lead_n, 0)", "on_time_rate": "(timed_n - late_s) / NULLIF(timed_n, 0)",
         "late_rate": "late_s / NULLIF(timed_n, 0)", "reorder_rate": "reorder_s / NULLIF(reorder_n, 0)",
         "repeat_order_share": "repeat_s / NULLIF(repeat_n, 0)"}),
    # one row a person
    "v_customers": Spec(
        ("orders_placed_bucket", "segment", "customer_state", "cohort_month"),
        (("orders_placed_bucket",), ("segment",), ("customer_state",), ("cohort_month",), ("segment", "customer_state")),
        {"persons": "COUNT(customer_unique_id)", "repeat_s": "COUNT_IF(is_repeat_customer)",
         "repeat_n": "COUNT(is_repeat_customer)", "monetary_s": "SUM(CAST(monetary AS DECIMAL(18,2)))"},
        {"customer_count": "persons", "repeat_customer_rate": "repeat_s / NULLIF(repeat_n, 0)",
         "total_monetary": _MONEY.format("monetary_s")}),
    # one row a cohort and month
    "v_cohort_retention": Spec(
        ("cohort_month", "months_since"), (("cohort_month",), ("months_since",)),
        {"retention_s": "SUM(retention)", "retention_n": "COUNT(retention)"},
        {"avg_retention": "retention_s / NULLIF(retention_n, 0)"}),
    "v_category": Spec(
        (*_MS, "product_category"),
        (("order_month", "product_category"), ("customer_state", "product_category"), ("product_category",), _MS,
         ("order_month",), ("customer_state",)),
        {"gmv_s": "SUM(CAST(gmv AS DECIMAL(18,2)))", "items_s": "SUM(n_items)"},
        {"gmv_total": _MONEY.format("gmv_s"), "items": "items_s"}),
}


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """State of source files and folders: bytes, number of files and time of change."""
    seen = []
    for path in sorted(paths):
        p, fs = versioned.hadoop_path(spark, path)
        total = fs.getContentSummary(p)
        seen.append((path, total.getLength(), total.getFileCount(), fs.getFileStatus(p).getModificationTime()))
    return hashlib.md5(repr(seen).encode()).hexdigest()[:16]


def filter_sql(start: str | None = None, end: str | None = None, states: Sequence[str] | None = None) -> list[str]:
    """P25 as filters of a metric query: months from, months to, states."""
    out = [f"order_month >= DATE '{start}'"] if start is not None else []
    out += [f"order_month <= DATE '{end}'"] if end is not None else []
    if states:
        quoted = ", ".join("'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'" for s in states)
        out.append(f"customer_state IN ({quoted})")
    return out


class Rollup:
    """A written rollup of one dataset."""

    def __init__(self, spark: SparkSession, dataset: str, folder: str, source: Callable[[], DataFrame]):
        self.spark, self.dataset, self.spec, self.folder = spark, dataset, SPECS[dataset], folder
        empty = not any(c.startswith(GSET) for c in versioned.children(spark, folder))
        whole = build(source(), dataset).limit(0) if empty else spark.read.parquet(folder)
        self.schema = T.StructType([f for f in whole.schema.fields if f.name != GSET])
        self.rows = {r[GSET]: r["count"] for r in whole.groupBy(GSET).count().collect()}  # one row a set

    def _frame(self, dims: Sequence[str]) -> DataFrame:
        if self.spec.number(dims) not in self.rows:  # an empty dataset has no row in sets with dimensions
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/{GSET}={self.spec.number(dims)}")

    def _needed(self, dims: Sequence[str], filters: Sequence[str]) -> set[str] | None:
        """The dimensions that a query names; None if its filters need more than dimensions."""
        probe = self.spark.createDataFrame([], T.StructType([f for f in self.schema.fields if f.name in self.spec.dims]))
        try:
            for f in filters:
                probe = probe.filter(F.expr(f))
            probe.schema
        except AnalysisException:
            return None
        words = {w.lower() for f in filters for w in re.findall(r"\w+", f)}  # some may be no columns: that is safe
        return set(dims) | {d for d in self.spec.dims if d.lower() in words}

    def route(self, metrics: Sequence[str], dims: Sequence[str], filters: Sequence[str]) -> tuple[str, ...] | None:
        """The smallest set that answers a query, or None."""
        if not set(metrics) <= set(self.spec.metrics) or not set(dims) <= set(self.spec.dims):
            return None
        needed = self._needed(dims, filters)
        fit = [s for s in self.spec.all_sets() if needed is not None and needed <= set(s)]
        return min(fit, key=lambda s: (self.rows.get(self.spec.number(s), 0), len(s)), default=None)

    def frame(self, metrics: Sequence[str], dims: Sequence[str], filters: Sequence[str]) -> DataFrame | None:
        """Metrics by dimensions under filters; None where no set covers them."""
        chosen = self.route(metrics, dims, filters)
        if chosen is None:
            return None
        d = self._frame(chosen)
        for f in filters:
            d = d.filter(F.expr(f))
        # counts of nothing are 0, sums are null, as over the dataset
        merged = [F.coalesce(F.sum(p), F.lit(0)).alias(p) if e.startswith("COUNT") else F.sum(p).alias(p)
                  for p, e in self.spec.partials.items()]
        g = d.groupBy(*dims).agg(*merged) if dims else d.agg(*merged)
        return g.select(*dims, *[F.expr(self.spec.metrics[m]).alias(m) for m in metrics])


def build(ds: DataFrame, dataset: str) -> DataFrame:
    """All sets of a dataset: dimensions (null where a set lacks one), partials, set number."""
    spec = SPECS[dataset]
    fine = ds.groupBy(*spec.dims).agg(*[F.expr(e).alias(p) for p, e in spec.partials.items()])
    sets = fine.groupingSets([[F.col(d) for d in s] for s in spec.all_sets()], *[F.col(d) for d in spec.dims])
    return sets.agg(F.grouping_id().cast("int").alias(GSET), *[F.sum(p).alias(p) for p in spec.partials])


def open_rollup(spark: SparkSession, dataset: str, state: str, source: Callable[[], DataFrame]) -> Rollup:
    """The rollup of a dataset in a ``state`` of its sources, built if it has not been."""
    target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rollup/{dataset}-{state}"
    folder = versioned.newest(spark, target)
    if folder is None:
        folder = versioned.write_version(build(source(), dataset), target, partition_by=[GSET])
    return Rollup(spark, dataset, folder, source)


def metric_query(rollup: Rollup, source: Callable[[], DataFrame], metrics: Sequence[str], dims: Sequence[str] = (),
                 filters: Sequence[str] = (), order_by: str | None = None, desc: bool = True,
                 limit: int | None = None) -> DataFrame:
    """M6 by the rollup, or from the dataset (``source``) where no set covers the query."""
    if limit is not None and order_by is None:
        raise ValueError("a limit needs a metric to order by")
    out = rollup.frame(metrics, dims, filters)
    if out is None:
        return S.metric_query(source(), rollup.dataset, metrics, dims, filters, order_by, desc, limit)
    return S.ordered(out, dims, order_by, desc, limit)
