"""Property tests (hypothesis) for the stateful and ordering operators."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from emporium.operators import staging
from emporium.operators.windows import seq_number
from emporium.sources import io

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.sampled_from(["a", "b", "c", None])
rows = st.lists(st.tuples(keys, st.integers(0, 5) | st.none(), st.text("xyz", max_size=2)),
                min_size=0, max_size=25)


@SETTINGS
@given(rows)
def test_dedupe_one_row_per_key_and_idempotent(spark, data):
    df = spark.createDataFrame(data, "k string, v int, s string")
    once = staging.dedupe_latest(df, ["k"], [("v", True)], descending=True)
    got = once.collect()
    assert len(got) == len({r[0] for r in data})
    twice = staging.dedupe_latest(once, ["k"], [("v", True)], descending=True)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, twice.collect()), key=str)
    # the survivor has the largest v of its key (NULLs last)
    for r in got:
        vs = [v for k, v, _ in data if k == r.k and v is not None]
        assert r.v == (max(vs) if vs else None)


@SETTINGS
@given(rows, rows)
def test_upsert_twice_equals_once(spark, a, b):
    schema = "k string, v int, s string"
    tgt = staging.dedupe_latest(spark.createDataFrame(a, schema), ["k"])
    delta = spark.createDataFrame(b, schema)
    once = io.upsert(tgt, delta, ["k"], [("v", True)])
    twice = io.upsert(once, delta, ["k"], [("v", True)])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["h", "h", "h", "p", "q"]),
                          st.integers(0, 400), st.integers(0, 10_000)),
                min_size=1, max_size=60, unique_by=lambda t: t[2]))
def test_seq_number_equals_row_number(spark, data):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, base + dt.timedelta(minutes=m), str(i)) for k, m, i in data],
                               "p string, t timestamp_ntz, id string")
    exp = df.withColumn("s", F.row_number().over(
        Window.partitionBy("p").orderBy("t", "id")).cast("long"))
    got = seq_number(df, "p", ["t", "id"], "s")
    assert sorted(got.select("p", "t", "id", "s").collect()) == sorted(exp.collect())
