"""CSV with quoted newlines read in splits: the rows and types of a reader that takes a file whole."""
import random

import pytest

from emporium.session import scratch_path
from emporium.sources import io
from emporium.sources.csv_split import infer_schema_split, read_csv_split, records

SCHEMA = "id int, text string, n double"


def write(folder, name, rows, eol="\n", bom=True):
    folder.mkdir(exist_ok=True)
    body = eol.join(["id,text,n", *[f'{i},"{t}",{n}' for i, t, n in rows]]) + eol
    (folder / name).write_bytes((("﻿" if bom else "") + body).encode())


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    parts = ["plain", "two\nlines", '""quoted""', "a,b", "\n\n", 'é\n""\n,', "", "x" * 300, '""', "\n,\n", " sp "]
    return [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 6))), i / 2) for i in range(n)]


@pytest.fixture
def small_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_splits_give_the_rows_of_a_whole_read(spark, tmp_path, small_splits, eol):
    folder = tmp_path / "csv"
    write(folder, "a.csv", odd_texts(300), eol)
    write(folder, "b.csv", odd_texts(40, 2), eol, bom=False)
    write(folder, "c.csv", [], eol)
    lines = spark.read.option("lineSep", "\n").text(str(folder / "a.csv"))
    assert lines.rdd.getNumPartitions() > 10  # one file, several tasks
    got, want = read_csv_split(spark, str(folder), SCHEMA), io.read_csv(spark, str(folder), SCHEMA)
    assert got.schema == want.schema and rows(got) == rows(want) and got.count() == 340


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    folder = tmp_path / "csv"
    long = "\n".join(f"line {i}" for i in range(3000))  # some 30 kB: over a dozen splits
    write(folder, "a.csv", [(1, "x", 1.0), (2, long, 2.0), (3, "y\nz", 3.0)])
    got = {r.id: r.text for r in read_csv_split(spark, str(folder), SCHEMA).collect()}
    assert got == {1: "x", 2: long, 3: "y\nz"}


def test_types_equal_those_of_a_whole_read(spark, tmp_path, small_splits):
    folder = tmp_path / "csv"
    folder.mkdir()
    head = "i,l,d,day,ts,b,s,none,mix,late"
    body = [f"{i},{i * 10**10},{i}.5,2024-01-{1 + i % 28:02},2024-01-01 10:00:{i % 60:02},"
            f"{'true' if i % 2 else 'FALSE'},t{i},,{'x' if i == 150 else i},{'2.5' if i == 199 else i}" for i in range(200)]
    (folder / "a.csv").write_text("\n".join([head, *body]) + "\n")
    got, want = infer_schema_split(spark, str(folder)), io.infer_schema(spark, str(folder))
    assert {f.name: f.dataType for f in got} == {f.name: f.dataType for f in want}


def test_text_only_files_keep_their_header(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text('﻿"k ey","other, name"\na,b\n')
    got = infer_schema_split(spark, str(folder))
    assert [(f.name, f.dataType.simpleString()) for f in got] == [("k ey", "string"), ("other, name", "string")]
    (folder / "a.csv").write_text("")
    assert records(spark, str(folder)).count() == 0
    with pytest.raises(ValueError, match="no header"):
        infer_schema_split(spark, str(folder))


def test_a_written_table_comes_back(spark, shared_context):
    df = shared_context.review_texts
    path = io.write_csv(df, scratch_path(spark, "csv"))
    got = read_csv_split(spark, path, df.schema)
    assert rows(got.select("review_id", "review_score")) == rows(df.select("review_id", "review_score"))


def test_texts_are_written_by_several_tasks(spark, tmp_path):
    from emporium.plans import catalog
    docs = [(i, f'text "{i}"\nline {i}, end', "web") for i in range(400)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality long").write.parquet(
        str(tmp_path / "labels.parquet"))
    got = catalog.all_queries()["s1_csv_split_texts"](spark, str(tmp_path))
    assert len(got.inputFiles()) > 1
    assert sorted((int(r.review_id), r.message) for r in got.collect()) == [(i, t) for i, t, _ in docs]
