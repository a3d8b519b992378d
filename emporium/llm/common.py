"""Helpers that several operators share: scratch tables, folds, word hashes.

The numpy kernels work on the UTF-8 buffers of Arrow string columns, in chunks
of a bounded number of bytes, so a task's memory does not follow the size of
its partition.  A single text longer than a chunk is handled as one chunk.
"""
from __future__ import annotations

import ctypes
import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.session import ensure_checkpoint_dir, scratch_path

CHUNK_BYTES = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BASE_INV = _U(pow(int(_BASE), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as a zip that Spark distributes, once a session."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="emporium-")).resolve() / "emporium_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the cluster's shared checkpoint folder and read it
    back: cuts the lineage, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    ship(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a ``scratch_table`` that nothing reads any more."""
    spark = table.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(jvm.org.apache.hadoop.fs.Path(base).toUri().getPath() + "/"):
            path.getFileSystem(conf).delete(path, True)


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % F.lit(n)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` for mapInArrow; at the end of a partition its worker, which Spark keeps
    for later tasks, gives the memory that it no longer uses back to the system."""
    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
            if trim is not None:
                trim(0)
    return run


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.type != pa.large_string():
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray,
           limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: (first, last, bytes, offsets)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray,
          lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text, A-Z lower-cased.

    Returns (start byte, end byte, words per text).
    """
    text_ids = len(offsets) - 1
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(text_ids, np.int64)
    solid = ~_SPACE[data]
    before = np.empty_like(solid)
    before[0] = False
    before[1:] = solid[:-1]
    bounds = offsets[:-1][offsets[:-1] < len(data)]
    before[bounds] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[-1] = False
    after[:-1] = solid[1:]
    ends_at = offsets[1:][offsets[1:] > 0] - 1
    after[ends_at] = False
    ends = np.flatnonzero(solid & ~after) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts.astype(np.int64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, from one prefix sum of byte · base^position."""
    if len(starts) == 0:
        return np.zeros(0, _U)
    powers = np.full(len(data), _BASE, _U)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    prefix = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * powers, out=prefix[1:])
    inverse = np.full(len(data), _BASE_INV, _U)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    return mix((prefix[ends] - prefix[starts]) * inverse[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words per text); words are lower-cased in A-Z."""
    low = _LOWER[data]
    starts, ends, counts = words(low, offsets)
    return span_hashes(low, starts, ends), counts


def letter_runs(data: np.ndarray, offsets: np.ndarray,
                digits: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts, ends) of the runs of letters, non-ASCII bytes
    and, if asked for, digits."""
    low = _LOWER[data]
    latin = np.flatnonzero(data[:-1] == 0xC3) + 1  # U+00C0..U+00DE
    latin = latin[(data[latin] >= 0x80) & (data[latin] <= 0x9E) & (data[latin] != 0x97)]
    low[latin] += 32
    solid = np.zeros(len(low) + 2, bool)
    solid[1:-1] = ((low >= 97) & (low <= 122)) | (low >= 0x80)
    if digits:
        solid[1:-1] |= (low >= 48) & (low <= 57)
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    return low, starts, ends


def sequence_hashes(h: np.ndarray, counts: np.ndarray,
                    size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within each text, in text order.

    A text of fewer words (but at least one) yields its whole sequence once.
    Returns (hashes, runs per text).
    """
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    total = int(n.sum())
    if total == 0:
        return np.zeros(0, _U), n
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), n)
    at = first[text] + (np.arange(total) - np.repeat(np.cumsum(n) - n, n))
    left = counts[text] - (at - first[text])
    out = np.zeros(total, _U)
    padded = np.concatenate([h, np.zeros(size, _U)])
    for j in range(size):
        factor = _U((0xD6E8FEB86659FD93 * (2 * j + 1) + 0x9E3779B97F4A7C15 * j) % (1 << 64) | 1)
        out += np.where(left > j, mix(padded[at + j] + _U(j + 1)) * factor, _U(0))
    return mix(out), n


def distinct_per_text(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text, and how many each text has."""
    text = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    fresh = np.ones(len(h), bool)
    if len(h) > 1:
        fresh[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[fresh], np.bincount(text[fresh], minlength=len(n)).astype(np.int64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
