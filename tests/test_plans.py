"""Plan guards: no cross/nested-loop joins and no Python UDFs in any registered query."""
from emporium.plans import catalog

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "PythonUDF"]
# queries that write under the checkpoint folder while being built
WRITES = ("s1_", "s2_", "s7_", "s11_", "s12_", "s13_", "s14_", "s15_", "s16_", "s6_", "r1_", "c15_", "s5_upsert", "s9_", "h1_", "a1_orders_incremental",
          "m1_v_orders_incremental", "h2_scd2_check_idempotent", "h2_scd2_check_history_table")


def test_no_cross_joins_or_python_udfs(spark, sf_dir, shared_context):
    flagged = {}
    for name, fn in sorted(catalog.all_queries().items()):
        if name.startswith(WRITES):
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        hits = [k for k in FORBIDDEN if k in plan]
        if hits:
            flagged[name] = hits
    assert not flagged, flagged


def test_fact_scan_prunes_columns(spark, sf_dir):
    df = catalog.all_queries()["a21_biz_monthly_revenue"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the lineitem scan reads only the columns the binding uses
    assert "l_discount" not in plan and "l_tax" not in plan and "l_returnflag" not in plan


def test_metrics_read_the_written_order_grain(spark, sf_dir, shared_context):
    """Scans and exchanges of the metrics stay near those of the order-grain dataset."""
    import re

    def size(name):
        plan = catalog.all_queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        return len(re.findall(r"FileScan", plan)), len(re.findall(r"Exchange hashpartitioning", plan))

    scans, exchanges = size("m1_v_orders_dataset")
    assert scans <= 4
    for name in ("a2_kpis", "a7_rfm", "m2_v_customers", "a49_headline_ratios"):
        s, x = size(name)
        assert s <= 5 * scans and x <= 25, (name, s, x)


def test_bigrams_need_one_exchange(spark, sf_dir):
    plan = catalog.all_queries()["x7_bigram_freq"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(bigram") == 1
