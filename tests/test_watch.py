"""Checks measured by the write of a table equal the same checks over the written table."""
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from emporium.operators import quality as Q
from emporium.session import scratch_path
from emporium.sources import io

def checks():
    return [Q.Check("not_null", "t", "a", F.col("a").isNull()), Q.type_check("t", "b", "double", "error"),
            Q.Check("between", "t", "b", F.coalesce(F.col("b") < 2, F.lit(False)), "warn"),
            Q.Check("unknown", "t", "b", F.col("b") < 2)]


def table(spark, rows):
    return spark.createDataFrame(rows, "a string, b double, c long").repartition(5)


ROWS = [(str(i) if i % 7 else None, float(i) if i % 5 else None, i) for i in range(200)]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], []])
def test_measured_checks_equal_a_scan(spark, rows):
    w = Q.Watch("t", checks(), ["b", "c"], F.col("c") < 150, {"b": F.col("b")})
    done = io.materialize(w.on(table(spark, rows)), "t", "gold", scratch_path(spark, "watch"))
    got = w.report(spark)
    want = Q.run_checks(done, "t", checks())
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    kept = done.where("c < 150")
    profile = {r.column: tuple(r) for r in w.profiled(spark).collect()}
    if kept.isEmpty():
        assert all(p[1] is None for p in profile.values())
    else:
        assert profile == {r.column: tuple(r) for r in Q.profile(kept, ["b", "c"]).collect()}
    total = done.agg(F.sum(F.col("b").cast("decimal(18,2)"))).first()[0]
    assert w.total("b") == (total or Decimal(0))


def test_totals_that_differ_fail(spark):
    rows = [Q.reconciled(spark, Decimal(a), Decimal(b), "x", "a=b").first().status
            for a, b in (("10.00", "10.00"), ("10.00", "10.01"), ("10.00", "10.02"))]
    assert rows == ["pass", "pass", "fail"]


def test_the_suite_scans_its_tables_for_keys_only(spark, sf_dir):
    """Predicates, totals and profile come from the writes: no scan reads a measured column."""
    from emporium.plans import catalog
    plan = catalog.all_queries()["c15_run_suite"](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert 0 < len(scans) <= 34
    for column in ("price", "freight_value", "payment_value", "delivery_days", "order_status", "payment_type"):
        assert not [s for s in scans if f"{column}#" in s.split("Batched")[0]], column


def test_tasks_stay_small_as_the_input_grows(spark, tmp_path):
    """Shuffles begin with partitions by the size of the source; scans and shuffles give a task 16 MB at most."""
    from emporium.operators.windows import SLICE, sliced
    from emporium.plans.context import Ctx
    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        spark.conf.set(names[1], "64MB")
        spark.conf.set(names[2], "1000")  # finer than ours: stays
        with open(tmp_path / "lineitem.parquet", "wb") as f:
            f.truncate(100 << 20)
        Ctx(spark, str(tmp_path))
        assert [spark.conf.get(n) for n in names] == ["25", str(16 << 20), "1000"]
        Ctx(spark, str(tmp_path / "none"))
        assert spark.conf.get(names[0]) == "25"
        rows = spark.range(5000).selectExpr("id % 3 AS k", "id")
        assert sliced(rows, "k", ["id"]).select(SLICE).distinct().count() == 25
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
