"""Language-model scores from a probabilistic suffix tree of words.

Tokens are the words of a text, lower-cased in A-Z, then one end token.  The
base model is the smoothed unigram distribution over all training tokens.  What
the tree learns grows with the corpus; nothing is kept by its share of it:

* a candidate context is any run of up to ``depth`` tokens (the start of the text
  may be its oldest) that occurs at least ``SUPPORT`` times;
* its entries are the tokens that follow it at least ``SUPPORT`` times; they are
  smoothed towards the distribution of the context's suffix with the weight of
  ``smoothing`` tokens, and the mass of the other tokens is shared out as the
  suffix does.  Every state sums to one;
* it is retained if its distribution diverges from that of its longest retained
  suffix by at least ``divergence`` nats (Kullback-Leibler).

A text's score is the sum over its tokens of log10 P(token | longest retained
suffix of what precedes it).  A run of n tokens that occurs ``SUPPORT`` times has
all its parts occur so often, so this sum is the base score plus one weight for
each run of up to ``depth`` + 1 tokens in the text: what the run's last token
gains as an entry, and the factor of other tokens if the run is a retained
context.  Runs, weights and counts are tables; texts are joined to them by run.
The most frequent ones also travel to the tasks, at most ``entries`` per length, and
so do bit maps of the supported runs, which let all of these pass and a share of
the others: both save rows and change no result.

What texts send to the tables goes as arrays, one for each task and part of the
keys, so that a run takes some 7 to 17 bytes of a shuffle, and for ``SLICES`` of the
texts after one another; tables and shuffles go when the last step that reads them is done.

Tokens and runs are told apart by 64-bit hashes.

Defined results: null and empty texts are one end token; repeated rows are scored
one by one; with no training text all counts are 0; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm.common import chunks, discard, fold, mix, scratch_table, string_buffers, tidy, word_hashes
from emporium.session import shuffle_partitions

END = np.uint64(1)  # the hash that stands for the end token
BEGIN = np.uint64(2)  # and for the start of a text, in contexts only
#: Occurrences from which a run is a context or an entry.
SUPPORT = 2
#: Distinct runs that a task gathers before it passes its counts on.
GATHER = 2_000_000
#: Runs that it holds before it looks for equal ones, and text bytes that it cuts into tokens at once.
PENDING, CHUNK = 1_000_000, 1 << 18
#: Parts of the keys for each shuffle partition, so that these come out even.
PARTS = 4
#: Training tokens for each task that looks weights up, and shares of the texts that do so at a time.
LOOKUP, SLICES = 1 << 22, 2
#: Most bits of a key that number its place in a bit map.
SIEVE_BITS = 27
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Settings:
    depth: int = 3
    entries: int = 1 << 21
    divergence: float = 0.02
    smoothing: float = 20.0


class Index:
    """Positions of 64-bit keys in an array, by direct addressing."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype(np.uint64)
        self.order = np.argsort(self.keys)
        bits = max(10, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.shift = np.uint64(64 - bits)
        self.slots = np.zeros(1 << bits, np.int32)
        self.slots[self._slot(self.keys)] = np.arange(1, len(keys) + 1, dtype=np.int32)

    def __reduce__(self):  # only the keys travel
        return Index, (self.keys,)

    def _slot(self, k: np.ndarray) -> np.ndarray:
        return ((k * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it is not there."""
        if len(self.keys) == 0:
            return np.full(len(keys), -1, np.int64)
        keys = keys.astype(np.uint64)
        own = self.slots[self._slot(keys)].astype(np.int64) - 1
        taken = np.flatnonzero((own >= 0) & (self.keys[own] != keys))  # another key has the slot
        if len(taken):
            at = np.minimum(np.searchsorted(self.keys, keys[taken], sorter=self.order), len(self.keys) - 1)
            at = self.order[at]
            own[taken] = np.where(self.keys[at] == keys[taken], at, -1)
        return own


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, tokens per text), the end tokens included."""
    h, n = word_hashes(data, offsets)
    return np.insert(h, np.cumsum(n), END), n + 1


class Sieve:
    """A bit map of keys: has() is true for all of them and for some others.

    It has about a bit for every two training tokens, up to 2^SIEVE_BITS bits.
    """

    def __init__(self, keys: DataFrame, total: int):
        bits_wide = max(10, min(SIEVE_BITS, total.bit_length() - 2))
        self.shift = np.uint64(64 - bits_wide)
        place = F.shiftrightunsigned("key", 64 - bits_wide)
        words = keys.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit")) \
            .groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
        word, bits = _columns(words, "word", "bits")
        self.words = np.zeros(1 << (bits_wide - 6), np.uint64)
        self.words[word.astype(np.int64)] = bits.astype(np.int64).view(np.uint64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> self.shift
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _key(context: np.ndarray, suffix: np.ndarray, level: int) -> np.ndarray:
    """The key of a run of ``level`` tokens and one more, from those of its two parts."""
    return mix(context * np.uint64(0xD6E8FEB86659FD93) + mix(suffix + np.uint64(level))) if level else suffix


def _runs(h: np.ndarray, n: np.ndarray, sieves: list[Sieve], depth: int) -> list[tuple[np.ndarray, ...]]:
    """For 0..depth tokens of context: (positions, keys, contexts, suffixes) of the
    runs that end there, as far as the sieves let both parts of a run pass.

    A run's context lacks its last token and its suffix the oldest; the oldest
    may be the start of the text.
    """
    nth = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    at, shorter = np.arange(len(h)), h
    out = [(at, h, np.zeros(len(h), np.uint64), h)]
    for d in range(1, depth + 1):
        live = np.zeros(len(h), bool)
        live[at] = sieves[d - 1].has(shorter[at])
        first = nth == 0 if d == 1 else np.zeros(len(h), bool)
        before = np.concatenate([[False], live[:-1]]) & (nth > 0)
        at = np.flatnonzero(live & (before | first))
        suffix = shorter[at]
        context = np.where(first[at], BEGIN, shorter[at - 1])
        key = _key(context, suffix, d)
        out.append((at, key, context, suffix))
        shorter = np.zeros(len(h), np.uint64)
        shorter[at] = key
    return out


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where sorted keys are cut into ``parts`` equal ranges of all keys."""
    return np.searchsorted((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1))


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences, byte by byte: those of many keys begin with zeros."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(b: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(),
                     dtype=np.uint64)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the keys, where in it each distinct one begins)."""
    order = np.argsort(keys)
    k = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)


def _counted(train: DataFrame, level: int, sieves: list[Sieve], support: int) -> DataFrame:
    """(key, context, suffix, n) of the runs of ``level`` tokens and one more that occur ``support`` times.

    A task gathers distinct runs and passes on both parts and the count of each, as
    arrays for each part of the keys; one task sums up what all have of a part.
    """
    partitions = shuffle_partitions(train.sparkSession)
    parts = PARTS * partitions

    def merged(rows: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        key, context, suffix, n = (np.concatenate(c) for c in zip(*rows))
        order, first = _groups(key)
        one = order[first]
        return key[one], context[one], suffix[one], np.add.reduceat(n[order], first) if len(first) else n

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[np.ndarray, ...]] = []
        pending = 0

        def out() -> pa.RecordBatch:
            key, context, suffix, n = rows[0]
            cut = _cuts(key, parts)
            full = np.flatnonzero(np.diff(cut))
            columns = [[c[cut[i]:cut[i + 1]].tobytes() for i in full] for c in (context, suffix, n)]
            return pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), *(pa.array(c, pa.binary()) for c in columns)],
                names=["part", "context", "suffix", "n"])

        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            for _, _, piece, offs in chunks(data, offsets, CHUNK):
                _, key, context, suffix = _runs(*_tokens(piece, offs), sieves, level)[level]
                rows.append((key, context, suffix, np.ones(len(key), np.int64)))
                pending += len(key)
                if pending > PENDING:
                    rows, pending = [merged(rows)], 0
                    if len(rows[0][0]) > GATHER:
                        yield out()
                        rows = []
        if rows:
            rows = [merged(rows)]
            yield out()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            context, suffix, n = (np.frombuffer(b"".join(b.column(c).to_pylist()), t)
                                  for c, t in (("context", np.uint64), ("suffix", np.uint64), ("n", np.int64)))
            rows.append((_key(context, suffix, level), context, suffix, n))
        if rows:
            columns = merged(rows)
            enough = columns[3] >= support
            columns = [c[enough].view(np.int64) for c in columns]
            for i in range(0, len(columns[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c[i:i + (1 << 16)]) for c in columns],
                                                 names=["key", "context", "suffix", "n"])

    return (train.select("text").mapInArrow(tidy(local), "part int, context binary, suffix binary, n binary")
            .repartition(partitions, "part")
            .mapInArrow(tidy(summed), "key long, context long, suffix long, n long"))


@contextmanager
def _freeing(spark: SparkSession) -> Iterator[None]:
    """Meanwhile, shuffle files go when the step that wrote them has ended."""
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)


@dataclass
class Tree:
    """The model: tables, and the bounded parts of them that travel, as arrays."""

    settings: Settings
    total: int  # N
    distinct: int  # V
    tokens: DataFrame  # counts of all tokens: key, n
    weights: list[DataFrame]  # by length: key, weight w, count c as a token (else 0), n
    often: int  # occurrences from which a run travels
    heavy: Index  # these
    heavy_weight: np.ndarray
    heavy_count: np.ndarray  # as a token, else 0
    sieves: list[Sieve]  # of the supported runs of each level
    levels: list[tuple[DataFrame, ...]]  # (runs, entries, states) of each length, if they were kept

    @property
    def entries(self) -> DataFrame:
        """level, key, context, suffix, n, p (by the longest retained context)"""
        return reduce(DataFrame.unionAll, (
            runs.join(entries.select("key", "p"), "key").select(F.lit(d).alias("level"), "key", "context", "suffix", "n", "p")
            for d, (runs, entries, _) in enumerate(self.levels, 1)))

    @property
    def states(self) -> DataFrame:
        """Candidate contexts: level, key, suffix, retained, rest (log10)."""
        above = [None, *(runs for runs, _, _ in self.levels)]
        return reduce(DataFrame.unionAll, (
            (states.join(above[d - 1].select("key", "suffix"), "key") if d > 1
             else states.withColumn("suffix", F.lit(0).cast("long")))
            .select(F.lit(d).alias("level"), "key", "suffix", "retained", "rest")
            for d, (_, _, states) in enumerate(self.levels, 1)))

    @property
    def norm(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    def base(self) -> np.ndarray:
        return np.log10((self.heavy_count + 0.5) / self.norm)

    # The whole model as arrays, to look at a small one: symbol 0 is all tokens
    # below the support, symbol 1 the start of a text, context 0 the root.

    @cached_property
    def _view(self) -> dict:
        key, n = _columns(self.tokens.where(F.col("n") >= SUPPORT).orderBy("key"), "key", "n")
        symbol = {int(k): 2 + i for i, k in enumerate(key)}
        root = np.zeros(2 + len(key))
        root[2:] = (n + 0.5) / self.norm
        root[0] = max(1e-300, 1 - root.sum())
        level, own, suffix, kept, rest = _columns(self.states.orderBy("level", "key"),
                                                  "level", "key", "suffix", "retained", "rest")
        number = {int(k): 1 + i for i, k in enumerate(own)}
        up = np.array([0] + [number.get(int(x), 0) for x in suffix], np.int64)
        retained = np.concatenate([[False], kept.astype(bool)])
        parent = np.zeros(len(up), np.int64)
        for c in range(1, len(up)):  # shorter contexts come first
            parent[c] = up[c] if retained[up[c]] else parent[up[c]]
        index, value = [], []
        e_level, e_key, e_context, e_suffix, p = _columns(self.entries.orderBy("level"),
                                                          "level", "key", "context", "suffix", "p")
        last = dict(symbol)  # the last token of each run
        for k, c, s, x in zip(e_key.tolist(), e_context.tolist(), e_suffix.tolist(), p):
            last[k] = last[s]
            if retained[number[c]]:
                index.append(number[c] * len(root) + last[k])
                value.append(np.log10(x / root[last[k]]))
        return {"root": root, "retained": retained, "parent": parent, "rest": np.concatenate([[0.0], rest]),
                "steps": np.unique(level), "entry": Index(np.array(index, np.uint64)), "value": np.array(value)}

    @property
    def retained(self) -> np.ndarray:
        return self._view["retained"]

    @property
    def steps(self) -> np.ndarray:
        """The lengths that contexts have."""
        return self._view["steps"]

    @property
    def n_symbols(self) -> int:
        return len(self._view["root"])

    def root(self) -> np.ndarray:
        """P(symbol) without context."""
        return self._view["root"]

    def ratio(self, context: np.ndarray, sym: np.ndarray) -> np.ndarray:
        """log10 P(symbol | context) / P(symbol), contexts being retained ones or 0."""
        v, out, context = self._view, np.zeros(len(sym)), context.copy()
        live = np.flatnonzero(context)
        while len(live):
            at = v["entry"].find(context[live] * self.n_symbols + sym[live])
            found = at >= 0
            out[live[found]] += v["value"][at[found]]
            lost = live[~found]
            out[lost] += v["rest"][context[lost]]
            context[lost] = v["parent"][context[lost]]
            live = lost[context[lost] > 0]
        return out


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    table = df.select(*names).toArrow()
    return [table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in names]


def _learn(own: DataFrame, shorter: DataFrame, contexts: DataFrame, level: int, s: Settings,
           keep: bool) -> tuple[DataFrame, DataFrame]:
    """(entries, states) of the contexts of ``level`` tokens.

    ``own``: their supported runs; ``shorter``: entries of one token less of context,
    whose p is that of the suffix; ``contexts``: runs of one token less, and how often
    (size) each occurs, all those that have an entry among them.
    """
    with_q = scratch_table(
        own.join(shorter.select(F.col("key").alias("suffix"), F.col("p").alias("q")).hint("shuffle_hash"), "suffix")
        .select("key", "context", "n", "q"), f"pst-suffix-{level}")
    sums = with_q.groupBy("context").agg(F.sum("n").alias("kept"), F.sum("q").alias("kept_q"),
                                         F.sum(F.col("n") * F.log(F.col("n") / F.col("q"))).alias("a"))
    # A context without entries shares all its mass out as its suffix does: it is no state.
    c = contexts.join(sums.withColumnRenamed("context", "key").hint("shuffle_hash"), "key")
    left, left_q = F.greatest(F.col("size") - F.col("kept"), F.lit(0)), F.greatest(1 - F.col("kept_q"), F.lit(1e-12))
    share = left / F.col("size")
    gain = (F.col("a") - F.col("kept") * F.log("size")) / F.col("size") \
        + F.when(left > 0, share * F.log(share / left_q)).otherwise(0.0)
    states = scratch_table(c.select(
        "key", "size", (gain >= s.divergence).alias("retained"),
        F.log10((s.smoothing + left / left_q) / (F.col("size") + s.smoothing)).alias("rest")), f"pst-states-{level}")
    kept = states.where("retained").select(F.col("key").alias("context"), "size", "rest")
    p = F.when(F.col("size").isNotNull(), (F.col("n") + s.smoothing * F.col("q")) / (F.col("size") + s.smoothing)) \
        .otherwise(F.col("q"))
    gained = F.when(F.col("size").isNotNull(), F.log10(p / F.col("q")) - F.col("rest")).otherwise(0.0)
    # The longest runs are nobody's suffix.
    more = [p.alias("p")] if keep or level < s.depth else []
    entries = scratch_table(with_q.join(kept.hint("shuffle_hash"), "context", "left").select("key", "n", gained.alias("gained"), *more),
                            f"pst-entries-{level}")
    discard(with_q)
    return entries, states


def fit(train: DataFrame, s: Settings = Settings(), keep: bool = True) -> tuple[Tree, DataFrame]:
    """(tree, counts of all training tokens) from the texts of ``train`` (column text).

    ``keep``: leave the tables of the single levels, to look at them.
    """
    with _freeing(train.sparkSession):
        counts = scratch_table(_counted(train, 0, [], 1).select("key", "n"), "pst-tokens")
        size = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
        total, distinct = int(size.n or 0), int(size.v)
        norm = total + 0.5 * (distinct + 1)
        single = counts.where(F.col("n") >= SUPPORT)
        sieves = [Sieve(single, total)]
        shorter = single.select("key", "n", ((F.col("n") + 0.5) / F.lit(norm)).alias("p"))
        # Texts begin as often as they end.
        contexts = single.where(F.col("key") != int(END)).select("key", F.col("n").alias("size")).unionAll(
            single.where(F.col("key") == int(END)).select(F.lit(int(BEGIN)).cast("long"), "n"))
        levels: list[tuple[DataFrame, ...]] = []
        weights: list[DataFrame] = []
        zero = F.lit(0).cast("long")
        for level in range(1, s.depth + 1):
            own = scratch_table(_counted(train, level, list(sieves), SUPPORT), f"pst-runs-{level}")
            sieves.append(Sieve(own, total))
            entries, states = _learn(own, shorter, contexts, level, s, keep)
            # What a run one token shorter gains as an entry, and its factor as a context.
            rest = states.where("retained").select("key", "rest")
            if level == 1:
                shorter = counts.select("key", F.lit(0.0).alias("gained"), F.col("n").alias("c"), "n")
                start = rest.where(F.col("key") == int(BEGIN)).select("key", F.lit(0.0), zero, zero)
                shorter = shorter.unionAll(start)
            else:
                shorter = shorter.select("key", "gained", zero.alias("c"), "n")
            weights.append(scratch_table(
                shorter.join(rest.hint("shuffle_hash"), "key", "left").select(
                    "key", (F.col("gained") + F.coalesce("rest", F.lit(0.0))).alias("w"), "c", "n")
                .where("w <> 0 OR c > 0"), f"pst-weights-{level - 1}"))
            if not keep:
                for table in (states, *(levels[-1][:2] if levels else [])):
                    discard(table)
            levels.append((own, entries, states))
            shorter, contexts = entries, own.select("key", F.col("n").alias("size"))
        weights.append(shorter.where("gained <> 0").select("key", F.col("gained").alias("w"), zero.alias("c"), "n"))
        if not keep and levels:
            discard(levels[-1][0])
        often = max(1, -(-total // s.entries))
        # Of each length at most ``entries``: they occur no more often than all tokens do.
        heavy, w, c = _columns(reduce(DataFrame.unionAll, weights).where(F.col("n") >= often), "key", "w", "c")
    tree = Tree(s, total, distinct, counts, weights, often, Index(heavy.astype(np.int64).view(np.uint64)), w, c, sieves,
                levels if keep else [])
    return tree, counts


def score(docs: DataFrame, tree: Tree, counts: DataFrame, id_col: str = "doc_id",
          text_col: str = "text", keep: bool = True) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``keep``: leave the tree's tables, to score other texts.

    Runs that do not travel are looked up: a task sends its distinct ones with the
    places of their texts, as arrays for each part of the keys, to where the weights of
    that part come together; from there sums go to the texts.
    """
    depth, sieves, norm = tree.settings.depth, tree.sieves, tree.norm
    heavy, heavy_weight, heavy_count, base = tree.heavy, tree.heavy_weight, tree.heavy_count, tree.base()
    partitions = max(12, tree.total // LOOKUP)
    parts = PARTS * partitions
    schema = ("part int, kind int, first long, keys binary, times binary, texts binary, w binary, c binary, "
              "doc_id array<long>, n_tokens array<long>, known array<long>, base array<double>, gain array<double>")
    names = [c.split()[0] for c in schema.split(", ")]

    def batch(part: np.ndarray, kind: int, first: int, **columns: list) -> pa.RecordBatch:
        given = {"part": part, "kind": [kind] * len(part), "first": [first] * len(part), **columns}
        types = {"part": pa.int32(), "kind": pa.int32(), "first": pa.int64(), "base": pa.list_(pa.float64()),
                 "gain": pa.list_(pa.float64()), **dict.fromkeys(("doc_id", "n_tokens", "known"), pa.list_(pa.int64()))}
        return pa.RecordBatch.from_arrays(
            [pa.array(given.get(c, [None] * len(part)), types.get(c, pa.binary())) for c in names], names=names)

    def asked(kind: int, first: int, keys: np.ndarray, text: np.ndarray) -> pa.RecordBatch:
        """The distinct keys, how often each occurs, and in which texts."""
        order, begin = _groups(keys)
        text, keys = text[order], keys[order][begin]
        end = np.concatenate([begin, [len(order)]])
        cut = _cuts(keys, parts)
        full = np.flatnonzero(np.diff(cut))
        return batch(full, kind, first, keys=[_packed(keys[cut[i]:cut[i + 1]]) for i in full],
                     times=[np.diff(end[cut[i]:cut[i + 1] + 1]).astype(np.int32).tobytes() for i in full],
                     texts=[text[end[cut[i]]:end[cut[i + 1]]].astype(np.uint16).tobytes() for i in full])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[tuple[np.ndarray, ...]] = []
        first, here, size = None, 0, 0

        def out() -> Iterator[pa.RecordBatch]:
            token, token_text, run, run_text = (np.concatenate(c) for c in zip(*gathered))
            yield asked(0, first, token, token_text)
            yield asked(1, first, run, run_text)

        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            if first is None and len(b):
                first = b.column("row")[0].as_py()
            for i, j, piece, offs in chunks(data, offsets, CHUNK):
                for i0 in range(i, j, 1 << 14):  # a place is a number of 16 bits
                    i1 = min(j, i0 + (1 << 14))
                    lo, hi = offs[i0 - i], offs[i1 - i]
                    h, n = _tokens(piece[lo:hi], offs[i0 - i:i1 - i + 1] - lo)
                    k = i1 - i0
                    text = np.repeat(np.arange(k), n)
                    at = heavy.find(h)
                    known = (at >= 0) & (heavy_count[at] > 0) if len(heavy.keys) else np.zeros(len(h), bool)
                    plain = np.bincount(text[known], weights=base[at[known]], minlength=k)
                    # The start of a text is a context, too.
                    runs, owner = [np.full(k, BEGIN)], [np.arange(k)]
                    for level, (place, run, _, _) in enumerate(_runs(h, n, sieves, depth)):
                        own = sieves[level].has(run) & (known[place] if level == 0 else True)
                        runs.append(run[own])
                        owner.append(text[place[own]])
                    run, who = np.concatenate(runs), np.concatenate(owner)
                    own = heavy.find(run)
                    met = own >= 0
                    gain = np.bincount(who[met], weights=heavy_weight[own[met]], minlength=k)
                    if here + k > 1 << 16 or size > PENDING:
                        yield from out()
                        gathered, first, here, size = [], first + here, 0, 0
                    yield batch(np.array([(first + here) % parts]), 2, first + here,
                                doc_id=[b.column("doc_id").slice(i0, k).to_pylist()], n_tokens=[n],
                                known=[np.bincount(text[known], minlength=k)], base=[plain], gain=[gain])
                    gathered.append((h[~known], here + text[~known], run[~met], here + who[~met]))
                    here, size = here + k, size + (~known).sum() + (~met).sum()
        if gathered:
            yield from out()

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, w, c = (b.column(x).to_numpy(zero_copy_only=False) for x in ("key", "w", "c"))
            key = key.astype(np.int64).view(np.uint64)
            order = np.argsort(key)
            key, w, c = key[order], w[order], c[order]
            cut = _cuts(key, parts)
            full = np.flatnonzero(np.diff(cut))
            piece = [slice(cut[i], cut[i + 1]) for i in full]
            yield batch(full, 3, 0, keys=[_packed(key[x]) for x in piece], w=[w[x].tobytes() for x in piece],
                        c=[c[x].tobytes() for x in piece])

    result = ["row", "doc_id", "n_tokens", "known", "base", "gain"]

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, wanted = [], []
        for b in batches:
            for i in range(len(b)):
                x = b.slice(i, 1).to_pylist()[0]
                if x["kind"] == 2:
                    k = len(x["n_tokens"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(x["first"], x["first"] + k)),
                         *(pa.array(x[c], pa.float64() if c in ("base", "gain") else pa.int64()) for c in result[1:])],
                        names=result)
                elif x["kind"] == 3:
                    weights.append((_unpacked(x["keys"]), np.frombuffer(x["w"], np.float64),
                                    np.frombuffer(x["c"], np.int64)))
                else:
                    wanted.append([x[c] for c in ("kind", "first", "keys", "times", "texts")])
        key = w = c = np.zeros(0, np.uint64)
        if weights:
            key, w, c = (np.concatenate(x) for x in zip(*weights))
            weights.clear()
            order, begin = _groups(key)
            key, w, c = key[order][begin], np.add.reduceat(w[order], begin), np.add.reduceat(c[order], begin)
            del order, begin
        wanted.sort(key=lambda x: x[1])
        while wanted:  # those of one group of texts at a time
            first, sums = wanted[-1][1], np.zeros((3, 1 << 16))
            some = np.zeros(1 << 16, bool)
            while wanted and wanted[-1][1] == first:
                kind, _, keys, times, texts = wanted.pop()
                k = _unpacked(keys)
                at = np.minimum(np.searchsorted(key, k), max(0, len(key) - 1))
                found = key[at] == k if len(key) else np.zeros(len(k), bool)
                times, text = np.frombuffer(times, np.int32), np.frombuffer(texts, np.uint16)

                def add(to: int, values: np.ndarray) -> None:
                    sums[to] += np.bincount(text, weights=np.repeat(values, times), minlength=1 << 16)

                some[text] = True
                weight, count = np.zeros(len(k)), np.zeros(len(k))
                weight[found], count[found] = w[at[found]], c[at[found]]
                add(2, weight)
                if kind == 0:
                    add(0, (count > 0).astype(np.float64))
                    add(1, np.log10((count + 0.5) / norm))
            text = np.flatnonzero(some)
            none = pa.nulls(len(text), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(first + text), none, none, pa.array(sums[0, text].astype(np.int64)),
                 pa.array(sums[1, text]), pa.array(sums[2, text])], names=result)

    rare = reduce(DataFrame.unionAll, tree.weights).where(F.col("n") < tree.often).select("key", "w", "c")
    out = []
    with _freeing(docs.sparkSession):
        packed = scratch_table(rare.mapInArrow(tidy(table), schema), "pst-packed")
        for x in () if keep else tree.weights:
            discard(x)
        for i in range(SLICES):
            asks = docs.where(fold(id_col, SLICES) == i).select(
                F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                F.col(text_col).alias("text")).mapInArrow(tidy(local), schema)
            rows = asks.unionAll(packed).repartition(partitions, "part") \
                .mapInArrow(tidy(looked_up), "row long, doc_id long, n_tokens long, known long, base double, gain double")
            out.append(scratch_table(rows.groupBy("row").agg(
                F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("known").alias("n_known"),
                F.sum("base").alias("base_score"), F.sum("gain").alias("gain")).select(
                    "doc_id", "n_tokens", "n_known", F.lit(tree.total).cast("long").alias("train_tokens"), "base_score",
                    (F.col("base_score") + F.col("gain")).alias("score")), f"pst-scores-{i}"))
        discard(packed)
    return reduce(DataFrame.unionAll, out)


def score_documents(docs: DataFrame, s: Settings = Settings(), folds: int = 5, held: int = 1) -> DataFrame:
    """Fit on the documents outside the held-out fold and score them all."""
    train = docs.where(fold("doc_id", folds) != held).select("text")
    tree, counts = fit(train, s, keep=False)
    scored = score(docs, tree, counts, keep=False)
    discard(counts)
    return scored.select(
        "doc_id", (fold("doc_id", folds) == held).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")
