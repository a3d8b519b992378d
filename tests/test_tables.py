"""Keyed tables, history tables and versioned folders: what is written, what stays untouched."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from emporium.operators import scd2
from emporium.session import scratch_path
from emporium.sources import io, versioned
from emporium.sources.history_table import CLOSED, HistoryTable
from emporium.sources.keyed_table import ROWS, KeyedTable

SCHEMA = "k string, j int, v int, u timestamp_ntz"
ORDER = [("u", True)]


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, *rows):
    return spark.createDataFrame([(k, j, v, day(u)) for k, j, v, u in rows], SCHEMA)


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def table(spark, keys=("k",), buckets=8, name="keyed"):
    return KeyedTable(spark, scratch_path(spark, name), schema(spark), list(keys), buckets)


def files(spark, t):
    """{bucket: names of its files} of the newest version."""
    return {e.bucket: (e.folder, tuple(n for n in versioned.children(spark, e.folder) if n.startswith("part")))
            for e in t.entries() if e.part == ROWS}


def content(df):
    return sorted(map(str, df.collect()))


def test_a_batch_rewrites_only_the_buckets_it_touches(spark):
    t = table(spark, buckets=16)
    t.upsert(frame(spark, *[(f"k{i}", 0, i, 0) for i in range(400)]), "b0", ORDER)
    before = files(spark, t)
    assert len(before) == 16
    delta = frame(spark, ("k7", 0, -7, 1), ("new", 0, 1, 1))
    touched = set(t.touched(delta))
    assert t.upsert(delta, "b1", ORDER)
    after = files(spark, t)
    assert {b for b in after if after[b] != before[b]} == touched and len(touched) <= 2
    rows = {r.k: r.v for r in t.read().collect()}
    assert len(rows) == 401 and rows["k7"] == -7 and rows["k8"] == 8 and rows["new"] == 1
    # the reader of the older version still finds it
    assert {r.k: r.v for r in t.read(0).collect()}["k7"] == 7


def test_a_batch_reads_only_the_buckets_it_touches(spark):
    t = table(spark, buckets=16)
    t.upsert(frame(spark, *[(f"k{i}", 0, i, 0) for i in range(400)]), "b0", ORDER)
    touched = t.touched(frame(spark, ("k7", 0, -7, 1)))
    read = {f.rsplit("/", 2)[0].split("/data/")[1] + "/" + f.rsplit("/", 2)[1]
            for f in t.read(buckets=touched).inputFiles()}
    assert len(read) == 1 and len(t.read().inputFiles()) == 16


def test_replay_and_crash_before_the_commit_change_nothing(spark, monkeypatch):
    t = table(spark)
    t.upsert(frame(spark, ("a", 0, 1, 0), ("b", 0, 1, 0)), "b0", ORDER)
    delta = frame(spark, ("a", 0, 2, 1), ("c", 0, 3, 1))

    def crash(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "commit", crash)
        with pytest.raises(RuntimeError):
            t.upsert(delta, "b1", ORDER)
    assert {r.k: r.v for r in t.read().collect()} == {"a": 1, "b": 1} and len(t.versions()) == 1
    with monkeypatch.context() as m:  # a crash while the manifest is written
        m.setattr(versioned, "write_version", crash)
        with pytest.raises(RuntimeError):
            t.upsert(delta, "b1", ORDER)
    assert {r.k: r.v for r in t.read().collect()} == {"a": 1, "b": 1}
    assert t.upsert(delta, "b1", ORDER)
    want = content(t.read())
    assert not t.upsert(delta, "b1", ORDER) and content(t.read()) == want and len(t.versions()) == 2
    assert {r.k: r.v for r in t.read().collect()} == {"a": 2, "b": 1, "c": 3}
    gone = t.vacuum(1)  # what the crashes left goes, too
    assert len(gone) >= 3 and content(t.read()) == want
    used = {e.folder for e in t.entries()}
    left = {f"{t.path}/data/{d}/{b}" for d in versioned.children(spark, f"{t.path}/data")
            for b in versioned.children(spark, f"{t.path}/data/{d}") if b.startswith("_bucket")}
    assert left == used and len(t.versions()) == 1


@pytest.mark.parametrize("keys", [["k"], ["k", "j"]])
def test_upsert_equals_a_rewrite_of_the_whole(spark, keys):
    import random
    rng = random.Random(len(keys))
    t, whole = table(spark, keys), frame(spark).limit(0)
    for n in range(3):
        hot = [("hot", 1, rng.randrange(50), rng.randrange(9)) for _ in range(60)]
        batch = frame(spark, *hot, *[(rng.choice([None, "a", "b", "c", "d"]), rng.choice([1, 2]), rng.randrange(50),
                                      rng.randrange(9)) for _ in range(40)])
        t.upsert(batch, f"b{n}", ORDER)
        whole = io.upsert(whole, batch, keys, ORDER)
        t.vacuum(1)
    assert content(t.read()) == content(whole)


def test_empty_batches_and_other_types_of_the_same_key(spark):
    t = table(spark, ["j"])
    assert t.upsert(frame(spark).limit(0), "b0", ORDER) and t.read().count() == 0
    t.upsert(frame(spark, ("a", 1, 1, 0)), "b1", ORDER)
    t.upsert(frame(spark, ("b", 1, 2, 1)).withColumn("j", F.col("j").cast("long")), "b2", ORDER)
    assert [tuple(r)[:3] for r in t.read().collect()] == [("b", 1, 2)]
    again = KeyedTable(spark, t.path, schema(spark), ["j"], buckets=99)
    assert again.buckets == 8  # as the table was made
    with pytest.raises(ValueError, match="own columns"):
        KeyedTable(spark, t.path, spark.createDataFrame([], "_bucket int").schema, ["_bucket"])


def test_versions_are_dropped_but_for_the_newest(spark):
    target = scratch_path(spark, "versions")
    folders = [versioned.write_version(spark.range(n), target) for n in (1, 2, 3)]
    assert versioned.newest(spark, target) == folders[2]
    versioned.remove(spark, f"{folders[2]}/_SUCCESS")  # not committed: the one before counts
    assert versioned.newest(spark, target) == folders[1]
    assert versioned.drop_versions(spark, target, 1) == [folders[0]]
    again = versioned.write_version(spark.range(7), target)
    assert spark.read.parquet(again).count() == 7 and versioned.newest(spark, target) == again
    with pytest.raises(ValueError):
        versioned.drop_versions(spark, target, 0)


def test_a_failed_load_or_build_leaves_the_last_good_one(spark):
    base = scratch_path(spark, "loads")
    bad = spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    io.load_all({"t": spark.range(3)}, base)
    io.materialize(spark.range(3), "t", "gold", base)
    io.cached(spark, "t", lambda: spark.range(3), base)
    for attempt in (lambda: io.load_all({"t": bad}, base), lambda: io.materialize(bad, "t", "gold", base),
                    lambda: io.cached(spark, "t", lambda: bad, base, force=True)):
        with pytest.raises(Exception, match="broken"):
            attempt()
    for folder in (f"{base}/t", f"{base}/gold/t", f"{base}/cache/t"):
        assert spark.read.parquet(versioned.newest(spark, folder)).count() == 3
    held = io.materialize(spark.range(4), "t", "gold", base)
    io.materialize(spark.range(9), "t", "gold", base)
    assert held.count() == 4  # its reader began before


def test_a_load_in_batches_cuts_files(spark):
    path = io.load_all({"t": spark.range(1000).coalesce(1)}, scratch_path(spark, "cut"), max_records_per_file=300)["t"]
    per = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(per) == 4 and max(r["count"] for r in per) == 300


# ---------------------------------------------------------------- history --
def states(spark):
    """Three snapshots with null and composite keys, late rows and repeated ones."""
    one = frame(spark, ("a", 1, 1, 0), ("b", 1, 1, 0), (None, 1, 1, 0), ("c", None, 1, 0))
    two = frame(spark, ("a", 1, 2, 1), ("b", 1, 1, 0), (None, 1, 5, 2), ("d", 1, 1, 1))
    three = frame(spark, ("a", 1, 2, 1), ("a", 2, 7, 3), ("b", 1, 9, 0), (None, 1, 6, 3), ("c", None, None, 4))
    return one, two, three


def test_history_by_timestamp_equals_the_whole_rebuild(spark):
    t = HistoryTable(spark, scratch_path(spark, "hist"), schema(spark), ["k", "j"], buckets=8)
    want = None
    for n, s in enumerate(states(spark)):
        want = scd2.scd2_timestamp(want, s, ["k", "j"], "u")
        assert t.run_timestamp(s, "u", f"r{n}")
    assert content(t.read()) == content(want.select(*t.read().columns))
    assert t.open_rows().where("valid_to IS NOT NULL").isEmpty()


def test_history_by_check_equals_the_whole_rebuild(spark):
    t = HistoryTable(spark, scratch_path(spark, "hist"), schema(spark), ["k", "j"], buckets=8)
    want = None
    for n, s in enumerate(states(spark)):
        want = scd2.scd2_check(want, s, ["k", "j"], ["v"], f"2024-02-0{n + 1} 00:00:00")
        assert t.run_check(s, ["v"], f"2024-02-0{n + 1} 00:00:00", f"r{n}")
    assert content(t.read()) == content(want.select(*t.read().columns))
    last = states(spark)[2]
    assert not t.run_check(last, ["v"], "2024-03-01 00:00:00", "r9")  # nothing changed
    assert not t.run_check(states(spark)[0], ["v"], "2024-03-01 00:00:00", "r2")  # committed before
    assert len(t.table.versions()) == 3


def test_a_run_touches_neither_closed_rows_nor_other_buckets(spark):
    t = HistoryTable(spark, scratch_path(spark, "hist"), schema(spark), ["k"], buckets=16)
    rows = [(f"k{i}", 0, i, 0) for i in range(300)]
    t.run_check(frame(spark, *rows), ["v"], "2024-01-01 00:00:00", "r0")
    t.run_check(frame(spark, ("k1", 0, -1, 1), *rows[2:]), ["v"], "2024-01-02 00:00:00", "r1")
    closed = [e for e in t.table.entries() if e.part == CLOSED]
    names = {e.folder: versioned.children(spark, e.folder) for e in closed}
    before = files(spark, t.table)
    t.run_check(frame(spark, ("k5", 0, -5, 2)), ["v"], "2024-01-03 00:00:00", "r2")
    now = [e for e in t.table.entries() if e.part == CLOSED]
    assert now[:len(closed)] == closed and len(now) == len(closed) + 1
    assert all(versioned.children(spark, f) == n for f, n in names.items())
    after = files(spark, t.table)
    assert {b for b in after if after[b] != before[b]} == set(t.table.touched(frame(spark, ("k5", 0, 0, 0))))
    assert t.read().count() == 302 and t.open_rows().count() == 300
    t.table.vacuum(1)
    assert t.read().count() == 302


def test_duplicate_keys_in_a_snapshot_raise(spark):
    t = HistoryTable(spark, scratch_path(spark, "hist"), schema(spark), ["k"])
    with pytest.raises(Exception, match="duplicate keys"):
        t.run_check(frame(spark, ("a", 1, 1, 0), ("a", 2, 1, 0)), ["v"], "2024-01-01 00:00:00")
    assert t.read().isEmpty()


# ---------------------------------------------------------- reconciliation --
def test_differing_rows_are_named(spark):
    from emporium.sources import reconcile as C
    cols = "k string, j int, v double"
    src = spark.createDataFrame([("a", 1, 1.0), ("b", 1, None), ("b", 2, 2.0), (None, 1, 3.0), ("dup", 1, 1.0),
                                 ("dup", 1, 1.0), ("gone", 1, 1.0)] + [(f"x{i}", 1, float(i)) for i in range(300)], cols)
    same = src.repartition(7, "v").withColumn("j", F.col("j").cast("long"))
    assert C.differing_rows(src, same, ["k", "j"]).collect() == []
    other = src.where("k IS NULL OR k NOT IN ('gone', 'dup', 'b')").unionByName(spark.createDataFrame(
        [("dup", 1, 1.0), ("b", 1, 0.0), ("b", 2, 2.0), ("new", None, 1.0)], cols))
    got = {(r.k, r.j): (r.kind, r.source_rows, r.loaded_rows) for r in C.differing_rows(src, other, ["k", "j"]).collect()}
    assert got == {("gone", 1): ("missing", 1, 0), ("dup", 1): ("changed", 2, 1), ("b", 1): ("changed", 1, 1),
                   ("new", None): ("extra", 0, 1)}
    report = C.reconcile_rows({"t": src, "u": src, "e": src.limit(0)}, {"t": other, "e": src.limit(0)},
                              {"t": ["k", "j"], "u": ["k", "j"], "e": ["k"]})
    assert {r.table: r.status for r in report.collect()} == {"t": "changed", "u": "missing", "e": "exact"}


def test_swapped_values_and_nulls_change_the_checksum(spark):
    from emporium.sources import reconcile as C
    a = spark.createDataFrame([(1, "x", None), (2, None, "x"), (3, "y", "z")], "k int, s string, t string")
    b = spark.createDataFrame([(1, None, "x"), (2, "x", None), (3, "z", "y")], "k int, s string, t string")
    assert sorted(r.k for r in C.differing_rows(a, b, ["k"]).collect()) == [1, 2, 3]
