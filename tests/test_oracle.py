"""Spark queries vs their DuckDB oracle on the smallest scale factor."""
import pytest

from emporium.plans import catalog
from emporium.plans.verify import compare, duck_connect

# A representative slice; the full registry is run by ``python -m emporium.plans.verify``.
NAMES = [
    "t4_stg_order_items", "g1_fact_orders", "g4_dim_products", "h1_scd2_timestamp_geolocation",
    "h5_version_ranges", "a1_orders", "m1_v_orders", "a2_kpis", "a3_gmv_monthly",
    "a5_cohort_matrix", "a7_rfm", "a8_rfm_customers", "a12_review_by_delivery_bucket",
    "a19_category_state_matrix", "a23_biz_categories", "a31_revenue_by_purchase_type",
    "a34_top_n_others", "a39_corr_matrix", "a42_box_stats", "a45_repeat_by_review",
    "p_scalar_expressions", "x4_tokens", "x7_top_bigrams", "x8_translate_freq",
    "x12_terms_by_band", "c15_run_suite", "m6_late_rate_by_state", "g8_customer_360",
    "s5_upsert", "s5_late_rows", "s5_composite_key", "r1_stream_upsert", "r1_stream_composite_key",
    "o2_volume_anomalies", "a50_sample_pairs", "s2_infer_schema", "m6_reorder_by_delivery_bucket",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    return duck_connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, sf_dir, shared_context, name):
    qs, orc = catalog.all_queries(), catalog.all_oracles()
    ok, msg = compare(spark, duck, name, qs[name], orc[name], sf_dir)
    assert ok, msg


def test_every_oracle_has_a_query():
    qs, orc = catalog.all_queries(), catalog.all_oracles()
    assert set(orc) <= set(qs)
    assert len(qs) >= 150


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
