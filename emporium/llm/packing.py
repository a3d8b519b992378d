"""Best-fit packing of documents into fixed-length training sequences.

Documents are tokenised, ended by one end token, and cut into pieces of at most
``capacity`` tokens (only longer documents are cut).  How pieces share sequences
depends only on how many pieces there are of each length, so the plan is made
from the histogram of lengths: at most ``capacity`` rows, whatever the corpus.

Exact-complement hashing: the sums of one, two and three available lengths are
indexed by what they leave of a sequence.  Lengths are taken from the longest
down; a combination that fills the gap exactly is consumed as often as the
counts of its lengths allow, a single before a pair before a triple.  What no
exact combination fits goes to the fullest open sequence that can still take
it (best fit), again by counts.

Pieces get their places by rank: the n-th piece of a length takes the n-th place
that the plan has for this length.  Ranks are counted in shards, so that one
length holding a third of all pieces is numbered in many tasks.

Defined results: a null or empty text is one piece holding only the end token;
repeated rows are packed like any others; an empty table gives no rows; other
columns of the input are ignored.
"""
from __future__ import annotations

import heapq
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporium.llm.common import _LOWER, chunks, scratch_table, span_hashes, string_buffers, tidy

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECES_IDS = PIECES + ", ids array<int>"
#: Word parts that a worker keeps with their ids (about 30 bytes each); when it
#: holds more, it starts anew.  This bounds memory and changes no result.
CACHE_PARTS = 500_000

_STATE: dict = {}

# Byte classes: white space, letter, symbol, apostrophe, digit, anything else.
_SPACE, _LETTER, _SYMBOL, _QUOTE, _DIGIT, _OTHER = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[:128] = _SYMBOL
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[list(range(48, 58))] = _DIGIT
_CLASS[[32, 9, 10, 11, 12, 13]] = _SPACE
_CLASS[[*range(9), *range(14, 32), 127]] = _OTHER  # control characters
_CLASS[39] = _QUOTE
#: Neighbours (before, after) that the vocabulary's splitting rule never joins.
_APART = np.zeros((6, 6), bool)
for _pair_ in ((_LETTER, _SYMBOL), (_LETTER, _QUOTE), (_SYMBOL, _LETTER), (_LETTER, _DIGIT),
               (_DIGIT, _LETTER), (_SYMBOL, _DIGIT), (_DIGIT, _SYMBOL), (_DIGIT, _DIGIT),
               (_QUOTE, _DIGIT), (_DIGIT, _QUOTE)):
    _APART[_pair_] = True


def _byte_names() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in shown]
    return {x: chr(x) for x in shown} | {x: chr(256 + i) for i, x in enumerate(hidden)}


class WordIds:
    """Token ids of word parts, kept by 64-bit hash.

    The vocabulary's tokenizer drops white space and splits words by character
    class before it merges, so a text's ids are the ids of its parts in a row.
    A-Z are lower-cased first, as the tokenizer does.  Parts are found through
    two direct-address tables of slots; one that loses its slots to others is
    just encoded again.
    """

    SLOTS = 1 << 22

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.names = _byte_names()
        self._clear()

    def _clear(self) -> None:
        self.slots = np.zeros((2, self.SLOTS), np.int32)  # 0 is the part that none has
        self.hashes = np.zeros(1, np.uint64)
        self.at = np.zeros(1, np.int64)
        self.size = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _slots_of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(self.SLOTS - 1)
        return (h & mask).astype(np.int64), ((h >> np.uint64(40)) & mask).astype(np.int64)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The number of each part, 0 where it isn't kept."""
        one, two = self._slots_of(h)
        own = self.slots[0][one]
        lost = np.flatnonzero(self.hashes[own] != h)
        other = self.slots[1][two[lost]]
        own[lost] = np.where(self.hashes[other] == h[lost], other, 0)
        return own

    def _encode(self, part: bytes, plain: bool) -> list[int]:
        text = part.decode("utf-8")
        if plain:  # letters only: the merges alone decide
            units = text.lower().encode().decode("latin-1").translate(self.names)
            return [t.id for t in self.tok.model.tokenize(units)]
        return self.tok.encode(text, add_special_tokens=False).ids

    def _learn(self, hashes: np.ndarray, parts: list[bytes], plain: list[bool]) -> np.ndarray:
        """Keep new parts; returns their numbers."""
        ids = [self._encode(p, q) for p, q in zip(parts, plain)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        own = (len(self.hashes) + np.arange(len(ids))).astype(np.int32)
        self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.hashes = np.concatenate([self.hashes, hashes])
        self.flat = np.concatenate([self.flat, np.array([y for x in ids for y in x], np.uint32)])
        one, two = self._slots_of(hashes)
        free = self.slots[0][one] == 0
        self.slots[0][one[free]] = own[free]
        self.slots[1][two[~free]] = own[~free]
        return own

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text of a chunk (UTF-8 bytes and text offsets)."""
        if b"<|" in data.tobytes():  # strings of special tokens keep their case
            return [np.array(self.tok.encode(data[i:j].tobytes().decode("utf-8"),
                                             add_special_tokens=False).ids, np.uint32)
                    for i, j in zip(offsets[:-1], offsets[1:])]
        if len(data) == 0:
            return [np.zeros(0, np.uint32)] * (len(offsets) - 1)
        kind = _CLASS[data]
        # Two-byte letters U+00C0..U+024F, but for the signs of multiplication and
        # division and for the dotted capital I, whose lower case is not one letter.
        lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC9))
        lead = lead[~((data[lead] == 0xC3) & np.isin(data[lead + 1], (0x97, 0xB7)))
                    & ~((data[lead] == 0xC4) & (data[lead + 1] == 0xB0))]
        kind[lead] = kind[lead + 1] = _LETTER
        edge = np.zeros(len(data) + 1, bool)
        edge[1:-1] = _APART.ravel()[kind[:-1] * np.uint8(6) + kind[1:]]
        edge[offsets] = True
        solid = np.zeros(len(data) + 2, bool)
        solid[1:-1] = kind != _SPACE
        starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
        ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
        low = _LOWER[data]
        h = span_hashes(low, starts, ends)
        if len(self.hashes) > CACHE_PARTS:
            self._clear()
        own = self._find(h)
        missed = np.flatnonzero(own == 0)
        if len(missed):
            unique, first, inverse = np.unique(h[missed], return_index=True, return_inverse=True)
            new, raw = missed[first], low.tobytes()
            odd = np.concatenate([[0], np.cumsum(kind != _LETTER)])
            plain = odd[ends[new]] == odd[starts[new]]
            parts = [raw[i:j] for i, j in zip(starts[new].tolist(), ends[new].tolist())]
            own[missed] = self._learn(unique, parts, plain.tolist())[inverse]
        size = self.size[own]
        stop = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.arange(stop[-1]) + np.repeat(self.at[own] - stop[:-1], size)]
        cuts = stop[np.searchsorted(starts, offsets)]
        return [ids[i:j] for i, j in zip(cuts[:-1], cuts[1:])]


def word_ids(path: str) -> WordIds:
    """The worker's own, kept between its tasks."""
    if _STATE.get("path") != path:
        _STATE.update(path=path, ids=WordIds(path))
    return _STATE["ids"]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
           with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenised pieces of every document, with their ids if ``with_ids``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer_path)
        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            doc_ids = b.column("doc_id").to_pylist()
            for i, j, part, offs in chunks(data, offsets, 1 << 19):
                rows: list[tuple] = []
                for doc, ids in zip(doc_ids[i:j], ids_of(part, offs)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for p, s in enumerate(range(0, len(ids), capacity)):
                        own = ids[s:s + capacity]
                        rows.append((doc, p, s, len(own), zlib.crc32(own.tobytes()), own))
                cols = list(zip(*rows))
                arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                          pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()),
                          pa.array(cols[4], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int32) for x in cols[5]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(tidy(cut), PIECES_IDS if with_ids else PIECES))


class _Available:
    """Counts of the lengths left, and the length nearest below a limit."""

    def __init__(self, counts: dict[int, int]):
        self.left = {k: v for k, v in counts.items() if v}
        self.order = sorted(self.left)

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            self.left[x] -= times

    def times(self, lengths: tuple[int, ...], most: int) -> int:
        need: dict[int, int] = defaultdict(int)
        for x in lengths:
            need[x] += 1
        return min([most, *(self.left.get(x, 0) // n for x, n in need.items())])

    def prune(self) -> None:
        self.order = [x for x in self.order if self.left[x]]


def _pair(available: _Available, gap: int) -> tuple[int, int] | None:
    """Two available lengths that sum to ``gap``: the longest one as long as can be."""
    left = available.left
    for x in reversed(available.order):
        y = gap - x
        if y > x:
            return None
        if y > 0 and left[x] and left.get(y, 0) >= (2 if x == y else 1):
            return x, y
    return None


def _triple(available: _Available, gap: int) -> tuple[int, int, int] | None:
    """Three available lengths that sum to ``gap``, the pair sums looked up by complement."""
    left = available.left
    order = np.array([x for x in available.order if left[x]], np.int64)
    have = np.zeros(gap + 1, bool)
    have[order[order <= gap]] = True
    for x in order[::-1]:
        rest = gap - int(x)
        if rest < 2 or x < gap / 3:
            continue
        low = order[(order <= rest // 2)]
        fits = low[have[rest - low]]
        for y in fits[::-1]:
            combo = (int(x), rest - int(y), int(y))
            if available.times(combo, 1):
                return combo
    return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """How often which combination of lengths makes one sequence: (lengths, times)."""
    available, out = _Available(counts), []
    open_runs: list[tuple[tuple[int, ...], int]] = []  # no exact complement
    for x in sorted(counts, reverse=True):
        while (n := available.left.get(x, 0)) > 0:
            gap = capacity - x
            if gap == 0:
                combo, times = (x,), n
                available.take(combo, times)
                out.append((combo, times))
                continue
            found: tuple[int, ...] | None = None
            if available.left.get(gap, 0) >= (2 if gap == x else 1):
                found = (gap,)
            if found is None:
                available.left[x] -= 1  # itself is not free for its own gap
                available.prune()
                found = _pair(available, gap) or _triple(available, gap)
                available.left[x] += 1
                if x not in available.order:
                    available.order = sorted([*available.order, x])
            if found is None:
                available.take((x,), n)
                open_runs.append(((x,), n))
                break
            combo = (x, *found)
            times = available.times(combo, n)
            available.take(combo, times)
            out.append((combo, times))
    # Best fit by counts: runs of equally filled sequences, by the room they have.
    rooms: dict[int, list[list]] = defaultdict(list)
    by_room: list[int] = []

    def put(lengths: tuple[int, ...], times: int) -> None:
        room = capacity - sum(lengths)
        if room not in rooms or not rooms[room]:
            heapq.heappush(by_room, room)
        rooms[room].append([lengths, times])

    for (x,), n in open_runs:  # longest first
        while n:
            fit = min((r for r in rooms if r >= x and rooms[r]), default=None)
            if fit is None:
                fill = capacity // x
                if n >= fill:
                    put((x,) * fill, n // fill)
                if n % fill:
                    put((x,) * (n % fill), 1)
                n = 0
            else:
                lengths, times = rooms[fit].pop()
                each = min(fit // x, n)
                full = min(times, n // each)
                put(lengths + (x,) * each, full)
                if times > full:
                    rooms[fit].append([lengths, times - full])
                n -= each * full
    out.extend((tuple(lengths), times) for runs in rooms.values() for lengths, times in runs)
    return out


def places(runs: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first_rank, last_rank, first_sequence, slots, offset).

    The pieces of ``length`` ranked first..last fill the places at ``offset`` of
    sequences from ``first_sequence`` on; equal lengths next to each other in a
    sequence share a row of ``slots`` places each.
    """
    out, seen, sequence = [], defaultdict(int), 0
    for lengths, times in runs:
        offset, i = 0, 0
        while i < len(lengths):
            j = i
            while j < len(lengths) and lengths[j] == lengths[i]:
                j += 1
            x, slots = lengths[i], j - i
            out.append((x, seen[x], seen[x] + slots * times - 1, sequence, slots, offset))
            seen[x] += slots * times
            offset += slots * x
            i = j
        sequence += times
    return out


def _ranked(df: DataFrame, shards: int) -> DataFrame:
    """Number the pieces of each length from 0, shard by shard."""
    split = df.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(shards)))
    sizes = split.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("shard")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("length", "shard").orderBy("doc_id", "piece"))
    return (split.withColumn("r", within)
            .join(sizes.withColumn("before", before).drop("n"), ["length", "shard"])
            .withColumn("rank", F.col("before") + F.col("r") - 1).drop("shard", "before", "r"))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its sequence_id and offset (and its ids if ``with_ids``)."""
    spark = docs.sparkSession
    cut = scratch_table(pieces(docs, tokenizer_path, capacity, end_id, with_ids, id_col, text_col),
                        "pack-pieces")
    # One row per length: at most ``capacity`` rows reach the driver.
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = places(plan(counts, capacity))
    table = spark.createDataFrame(
        rows, "length long, first long, last long, sequence long, slots long, at long")
    # A length has few rows of places; its ranges are looked up in its own array.
    ranges = table.groupBy("length").agg(F.array_sort(F.collect_list(
        F.struct("first", "last", "sequence", "slots", "at"))).alias("ranges"))
    ranked = _ranked(cut, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    own = F.element_at(F.filter("ranges", lambda p: (p["first"] <= F.col("rank"))
                                & (F.col("rank") <= p["last"])), 1)
    out = ranked.join(F.broadcast(ranges), "length").withColumn("own", own)
    step = F.col("rank") - F.col("own.first")
    out = (out.withColumn("sequence_id", F.col("own.sequence") + F.floor(step / F.col("own.slots")))
           .withColumn("offset", F.col("own.at") + F.pmod(step, F.col("own.slots")) * F.col("length")))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32",
                      F.col("sequence_id").cast("long"), F.col("offset").cast("long"),
                      *(["ids"] if with_ids else []))
