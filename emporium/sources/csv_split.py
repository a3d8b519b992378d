"""S1, S2 for large files: CSV with quoted newlines, read in splits.

A newline ends a record only outside quotes, so a reader that starts in the middle of a
file can't tell.  The number of quotes before a line can: it is even at the start of a
record (a quote within a field is doubled).  So

1. the file is read as lines, split by split; a line knows its file, split and place;
2. each split adds up its quotes, and a prefix sum over the splits of a file (one small
   row a split) says whether a split begins within quotes;
3. within a split a running sum marks the lines that begin a record and those that end
   one.  Most lines do both and are records already; only the others are put together,
   by the record that they began in, be it in an earlier split.

The records are then parsed by ``from_csv``.  Rows cross the network once, by split.
Types are inferred over all rows by one aggregate of a lattice of types.

Files have a header and quotes are doubled within quoted fields; a quote within a field
that is not quoted is no CSV and breaks the count.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PARSE = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(f, b, at, value, q): lines with file, split, place and parity of their quotes."""
    raw = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return raw.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                      F.monotonically_increasing_id().alias("at"), "value", (quotes % 2).alias("q"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record, header): the records of all files as text; blank ones are left out."""
    lines = _lines(spark, path)
    splits = lines.groupBy("f", "b").agg(F.sum("q").alias("n"))
    before = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("f", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("opened"))
    own = Window.partitionBy("f", "b").orderBy("at")
    seen = F.col("opened") + F.coalesce(F.sum("q").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = (lines.join(splits, ["f", "b"])
              .withColumn("seen", seen)
              .withColumns({"begins": F.col("seen") % 2 == 0, "ends": (F.col("seen") + F.col("q")) % 2 == 0,
                            "header": (F.col("b") == 0) & (F.row_number().over(own) == 1)}))
    start = F.when(F.col("begins"), F.struct("b", "at", "header"))
    marked = marked.withColumn("start", F.last(start, ignorenulls=True).over(
        own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = marked.where("begins AND ends").select("value", "header")
    pieces = marked.where("NOT (begins AND ends)").select("f", "b", "at", "value", "start")
    # A piece without a start in its split belongs to the last record begun in an earlier one.
    begun = marked.where("begins").groupBy("f", "b").agg(F.max(F.struct("b", "at", "header")).alias("s"))
    last = splits.select("f", "b").join(begun, ["f", "b"], "left").select(
        "f", "b", F.last("s", ignorenulls=True).over(before).alias("earlier"))
    pieces = pieces.join(last, ["f", "b"]).withColumn("start", F.coalesce("start", "earlier"))
    joined = pieces.groupBy("f", "start").agg(F.array_sort(F.collect_list(F.struct("b", "at", "value"))).alias("p"))
    joined = joined.select(F.array_join(F.transform("p", lambda x: F.regexp_replace(x["value"], "\r$", "")), "\n")
                           .alias("value"), F.col("start.header").alias("header"))
    out = whole.unionByName(joined).select(F.regexp_replace("value", "\r$", "").alias("record"), "header")
    return out.where(F.trim("record") != "")


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names: those of the first file's header."""
    row = records(spark, path).where("header").select(F.min("record").alias("r")).first()
    if row.r is None:
        raise ValueError(f"no header in {path}")
    text = row.r.removeprefix("﻿")
    n = text.count(",") + 1
    parsed = spark.range(1).select(F.from_csv(F.lit(text), ", ".join(f"c{i} string" for i in range(n)), _PARSE).alias("h"))
    return [v for v in parsed.select("h.*").first() if v is not None]


def read_csv_split(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Rows of CSV files with header, quoted newlines and doubled quotes, by any number of tasks.

    Without ``schema`` names come from the header and types from all rows (S2)."""
    if schema is None:
        schema = infer_schema_split(spark, path)
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    body = records(spark, path).where("NOT header")
    return body.select(F.from_csv("record", ddl, _PARSE).alias("r")).select("r.*")


#: Bits of the lattice: a column's type is the least one that holds all of its values.
_BITS = ((1, "int"), (2, "bigint"), (4, "double"), (8, "date"), (16, "timestamp"), (32, "boolean"), (64, "string"))
_JOINS = (({1}, T.IntegerType()), ({1, 2}, T.LongType()), ({1, 2, 4}, T.DoubleType()), ({8}, T.DateType()),
          ({8, 16}, T.TimestampType()), ({32}, T.BooleanType()))


def _class(v: Column) -> Column:
    """The bit of a value's least type; null has none."""
    return (F.when(v.isNull() | (v == ""), 0)
            .when(v.rlike(r"^[+-]?\d+$") & v.try_cast("int").isNotNull(), 1)
            .when(v.rlike(r"^[+-]?\d+$") & v.try_cast("bigint").isNotNull(), 2)
            .when(v.rlike(r"^(?i)[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^-?Inf$|^NaN$") & v.try_cast("double").isNotNull(), 4)
            .when(v.rlike(r"^\d{4}-\d{2}-\d{2}$") & v.try_cast("date").isNotNull(), 8)
            .when(v.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}") & v.try_cast("timestamp").isNotNull(), 16)
            .when(F.lower(v).isin("true", "false"), 32).otherwise(64))


def infer_schema_split(spark: SparkSession, path: str) -> T.StructType:
    """Names from the header, each column's least type over all rows; a column without values is text."""
    names = header(spark, path)
    rows = read_csv_split(spark, path, T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]))
    found = rows.agg(*[F.bit_or(_class(F.col(c))).alias(c) for c in rows.columns]).first()
    fields = []
    for name, bits in zip(names, found):
        held = {bit for bit, _ in _BITS if (bits or 0) & bit}
        kind = next((t for wide, t in _JOINS if held and held <= wide), T.StringType())
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)
