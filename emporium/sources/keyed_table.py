"""A table in key-hash buckets, of which a batch rewrites only those it touches.

    <path>/data/<name>/bucket=<b>/*.parquet     rows, written once and never changed
    <path>/manifest/v=<number>,<writer>/        one small table a version: part, bucket, folder

A row's bucket is a hash of its key.  A batch reads the buckets that its keys fall
into, merges, writes them to a new folder and commits a manifest that points to the
new folder for these buckets and to the old ones for all others.  So the work of a
batch follows the rows it meets, not the size of the table.  The manifest is the
commit: before it the new folder is invisible, and a replay writes another one.

Besides the buckets a version may hold parts that only grow (``append``): folders
that later versions keep in their list and never read.

The manifest has one row a bucket and one an appended folder; both numbers are
chosen by the owner (buckets of a few hundred MB), so it is read by the driver.
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.operators.staging import dedupe_latest
from emporium.session import scratch_path
from emporium.sources import versioned

BUCKET = "_bucket"
ROWS = "rows"  # the part that lies in buckets
MANIFEST = "part string, bucket int, buckets int, folder string"


@dataclass(frozen=True)
class Entry:
    part: str
    bucket: int | None
    folder: str


class KeyedTable:
    """The table at ``path``; ``buckets`` holds for a new one, later the number it was made with.

    ``bucket_by``: what decides a row's bucket, a function of its key (default: the whole key)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64,
                 bucket_by: Column | None = None):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)
        self.bucket_by = [F.col(k) for k in self.keys] if bucket_by is None else [bucket_by]
        if {BUCKET, "_new"} & set(schema.names):
            raise ValueError(f"{BUCKET} and _new are names of the table's own columns")
        self._manifest_of: dict[str, list] = {}  # a committed manifest never changes
        rows = self._manifest_rows()
        self.buckets = rows[0].buckets if rows else buckets

    # ---------------------------------------------------------------- state --
    @property
    def _manifests(self) -> str:
        return f"{self.path}/manifest"

    def versions(self) -> list[tuple[int, str, str]]:
        return versioned.versions(self.spark, self._manifests)

    def committed(self, writer: str) -> bool:
        return any(w == writer for _, w, _ in self.versions())

    def _manifest_rows(self, number: int | None = None) -> list:
        done = [folder for n, _, folder in self.versions() if number is None or n == number]
        if not done:
            if number is not None:
                raise ValueError(f"there is no version {number} of {self.path}")
            return []
        if done[-1] not in self._manifest_of:
            self._manifest_of[done[-1]] = self.spark.read.schema(MANIFEST).parquet(done[-1]).collect()
        return self._manifest_of[done[-1]]

    def entries(self, number: int | None = None) -> list[Entry]:
        """What a version consists of; the newest one without a number."""
        return [Entry(r.part, r.bucket, r.folder) for r in self._manifest_rows(number) if r.folder is not None]

    def _read(self, entries: Sequence[Entry], schema: T.StructType) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[e.folder for e in entries])

    def read(self, number: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version, or of some of its buckets."""
        wanted = None if buckets is None else set(buckets)
        return self._read([e for e in self.entries(number)
                           if e.part == ROWS and (wanted is None or e.bucket in wanted)], self.schema)

    def read_part(self, part: str, schema: T.StructType, number: int | None = None) -> DataFrame:
        """An appended part of a version."""
        return self._read([e for e in self.entries(number) if e.part == part], schema)

    # ---------------------------------------------------------------- writes --
    def bucket_of(self, *values: Column) -> Column:
        """The bucket of a row, or of given values of what decides it."""
        return F.pmod(F.xxhash64(*(values or self.bucket_by)), F.lit(self.buckets)).cast("int")

    def conform(self, rows: DataFrame) -> DataFrame:
        """``rows`` in the columns and types of the table: equal keys hash alike."""
        return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def touched(self, rows: DataFrame, *values: Column) -> list[int]:
        """The buckets that ``rows`` (or ``values`` over them) fall into, at most all of them."""
        return sorted(r[0] for r in rows.select(self.bucket_of(*values)).distinct().collect())

    def stage(self, rows: DataFrame, files: int = 1) -> str:
        """Write ``rows`` to a new data folder; ``files``: by how many tasks a bucket is written,
        where one key may hold most of it."""
        folder = f"{self.path}/data/{ROWS}-{uuid.uuid4().hex[:12]}"
        placed = self.conform(rows).withColumn(BUCKET, self.bucket_of())
        part = F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(files))
        placed.repartition(BUCKET, *([part] if files > 1 else [])).write.partitionBy(BUCKET).parquet(folder)
        return folder

    def append(self, rows: DataFrame, part: str) -> Entry:
        """Write ``rows`` as a folder that a version may list under ``part``."""
        folder = f"{self.path}/data/{part}-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(folder)
        return Entry(part, None, folder)

    def commit(self, writer: str, folder: str, buckets: Sequence[int], appended: Sequence[Entry] = ()) -> int:
        """Make a version: ``buckets`` as in ``folder``, all else as before, and what is appended."""
        gone = set(buckets)
        there = set(versioned.children(self.spark, folder))
        entries = [e for e in self.entries() if e.part != ROWS or e.bucket not in gone]
        entries += [Entry(ROWS, b, f"{folder}/{BUCKET}={b}") for b in sorted(gone) if f"{BUCKET}={b}" in there]
        entries += appended
        rows = [(e.part, e.bucket, self.buckets, e.folder) for e in entries] or [(ROWS, None, self.buckets, None)]
        made = self.spark.createDataFrame(rows, MANIFEST).coalesce(1)
        folder = versioned.write_version(made, self._manifests, writer)
        self._manifest_of[folder] = [Row(part=p, bucket=b, buckets=n, folder=f) for p, b, n, f in rows]
        return self.versions()[-1][0]

    def upsert(self, batch: DataFrame, writer: str | None = None,
               order_by: Sequence[str | tuple[str, bool]] | None = None, descending: bool = True,
               batch_wins: bool = True) -> bool:
        """Merge ``batch`` by key: of a key's rows in table and batch the first by ``order_by``
        stays, of equal ones that of the batch; without ``order_by`` the batch wins.

        Without ``batch_wins`` the rest of the columns decide also between table and batch:
        the table then is what ``dedupe_latest`` makes of all rows ever loaded.

        Of equal rows by ``order_by`` within a batch the rest of the columns decide, in the
        direction of ``descending``.  False if ``writer`` had been committed before.
        """
        writer = writer or uuid.uuid4().hex[:12]
        if self.committed(writer):
            return False
        path = scratch_path(self.spark, "batch")
        # One row a key leaves each task, however many rows the key has.
        (dedupe_latest(self.conform(batch), self.keys, order_by, descending=descending).write.parquet(path))
        fresh = self.spark.read.schema(self.schema).parquet(path)
        buckets = self.touched(fresh)
        both = (self.read(buckets=buckets).withColumn("_new", F.lit(0))
                .unionByName(fresh.withColumn("_new", F.lit(1))).withColumn(BUCKET, self.bucket_of()))
        # By bucket once: the ranking and the files need no further exchange.
        ranked = dedupe_latest(both.repartition(BUCKET), [BUCKET, *self.keys], [*(order_by or []), *([("_new", True)] if batch_wins else [])],
                               descending=descending).drop("_new")
        folder = f"{self.path}/data/{ROWS}-{uuid.uuid4().hex[:12]}"
        ranked.write.partitionBy(BUCKET).parquet(folder)
        self.commit(writer, folder, buckets)
        return True

    def replace(self, rows: DataFrame, buckets: Sequence[int], writer: str, files: int = 1) -> bool:
        """Make ``rows`` the whole content of ``buckets``; False if ``writer`` had been committed."""
        if self.committed(writer):
            return False
        self.commit(writer, self.stage(rows, files), buckets)
        return True

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the versions but for the newest ``keep``, and the data that these do not list."""
        versioned.drop_versions(self.spark, self._manifests, keep)
        used = set()
        for number, _, _ in self.versions():
            used |= {e.folder.rsplit(f"/{BUCKET}=", 1)[0] for e in self.entries(number)}
            used |= {e.folder for e in self.entries(number)}
        gone = []
        for name in versioned.children(self.spark, f"{self.path}/data"):
            folder = f"{self.path}/data/{name}"
            if folder in used:  # a folder goes bucket by bucket as later ones replace them
                for child in versioned.children(self.spark, folder):
                    if child.startswith(f"{BUCKET}=") and f"{folder}/{child}" not in used:
                        versioned.remove(self.spark, f"{folder}/{child}")
                        gone.append(f"{folder}/{child}")
            else:
                versioned.remove(self.spark, folder)
                gone.append(folder)
        return gone
