"""Merkle manifest of a dataset as a persistent, path-copying hash tree.

Every row is a leaf; the leaves of a group stand in id order and form a binary tree,
and the groups' roots, in group order, form the tree of the dataset.  A run of two
nodes, or the last one alone, becomes the hash of its hex digests; a lone node is its
tree's root.

* Places come from a range partitioning, so a group with most rows lies in many tasks.
* A tree is cut into aligned blocks of ``2 ** bits`` leaves.  A block is hashed in one
  task and its top node is a leaf of the next tier, until one block is left.
* A changed leaf makes a version of its own.  The version shares every untouched node
  and copies only the leaf's ancestors: first those within its block, then, with the
  siblings that the upper tiers hand down to the block, those above it.  Versions of
  different blocks never meet, so any number of changed leaves is shared out by block.
* The siblings that a version shares are its leaf's proof of membership.

Nothing but digests is shuffled: one row a leaf, then one a block and tier.

Defined results: a null column hashes as ``-``; a null group is a group and comes
first; a null id comes first in its group and counts as unchanged by ``tampered_rows``; rows
of equal id stand in the order of their leaves, equal rows are leaves of their own; an
empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.llm.common import scratch_table
from emporium.operators.windows import seq_number

BITS = 12  # 4096 leaves a block


def digest(*parts: str) -> str:
    """Lower-case hex sha256 of the texts' concatenation."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_hash(cols: Sequence[Column]) -> Column:
    """The leaf of a row: each value as its UTF-8 byte count, ``:`` and the value; ``-`` for null."""
    parts = []
    for c in cols:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


class BlockTree:
    """All nodes of one aligned block, level by level; never changed once built."""

    def __init__(self, leaves: list[str], first: int, total: int):
        """``leaves`` from index ``first`` of a level that holds ``total`` nodes."""
        self.first, self.levels, self.totals = first, [leaves], [total]
        size = 1
        while self.totals[-1] > 1 and size < (1 << BITS):
            low = self.levels[-1]
            self.levels.append([digest(*low[i:i + 2]) for i in range(0, len(low), 2)])
            self.totals.append(-(-self.totals[-1] // 2))
            size *= 2

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def siblings(self, at: int) -> list[str | None]:
        """The sibling on each level of the leaf at ``at`` of this block; None where it is alone."""
        out = []
        for level in self.levels[:-1]:
            out.append(level[at ^ 1] if at ^ 1 < len(level) else None)
            at >>= 1
        return out


def copied(node: str, at: int, siblings: list[str | None]) -> list[str]:
    """Copies of the ancestors of ``node``, index ``at``, that share ``siblings``."""
    out = [node]
    for other in siblings:
        pair = (out[-1],) if other is None else (other, out[-1]) if at & 1 else (out[-1], other)
        out.append(digest(*pair))
        at >>= 1
    return out


def _path_text(siblings: list[str | None]) -> str | None:
    return ",".join(x or "" for x in siblings) if siblings else None


def _path(text: str | None) -> list[str | None]:
    return [] if text is None else [x or None for x in text.split(",")]


def _same(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[f"_{c}"]) for c in cols])


def _join(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``other``'s row of the same keys; null equals null."""
    o = other.select(*[F.col(c).alias(f"_{c}") for c in keys], *[c for c in other.columns if c not in keys])
    return rows.join(o, _same(rows, o, keys)).drop(*[f"_{c}" for c in keys])


def _block(table: pa.Table, hashes: str) -> tuple[pa.Table, BlockTree]:
    table = table.sort_by("idx")
    return table, BlockTree(table[hashes].to_pylist(), table["idx"][0].as_py(), table["total"][0].as_py())


def _tops(nodes: DataFrame, tree: str) -> DataFrame:
    """(tree, idx, total, hash) of the blocks' top nodes: the next tier."""
    nodes = nodes.select(tree, "idx", "total", "hash")

    def top(table: pa.Table) -> pa.Table:
        table, block = _block(table, "hash")
        return pa.table([table[tree].slice(0, 1), pa.array([block.first >> BITS], pa.int64()),
                         pa.array([-(-block.totals[0] >> BITS)], pa.int64()), pa.array([block.top])],
                        names=[tree, "idx", "total", "hash"])

    return (nodes.withColumn("block", F.shiftright("idx", BITS))
            .groupBy(tree, "block").applyInArrow(top, nodes.schema))


def _paths(nodes: DataFrame, tree: str) -> DataFrame:
    """(tree, block, path): of every node, the siblings from its level to its tree's root.

    ``nodes`` has (tree, idx, total, hash, up); node ``idx`` is the top of block ``idx`` below
    and ``up`` the path above the node's own block."""
    key = nodes.schema[tree].dataType.simpleString()

    def paths(table: pa.Table) -> pa.Table:
        table, block = _block(table, "hash")
        up = _path(table["up"][0].as_py())
        text = [_path_text([*block.siblings(i), *up]) for i in range(table.num_rows)]
        return pa.table([table[tree], table["idx"], pa.array(text, pa.string())], names=[tree, "block", "path"])

    return (nodes.withColumn("own", F.shiftright("idx", BITS)).groupBy(tree, "own")
            .applyInArrow(paths, f"{tree} {key}, block long, path string"))


def forest(leaves: DataFrame, tree: str) -> tuple[DataFrame, DataFrame]:
    """Hash every tree of ``leaves`` (tree, idx, total, hash).

    Returns the roots (tree, hash) and the paths (tree, block, path) that each block of
    leaves has above it."""
    tiers = [scratch_table(_tops(leaves, tree), "manifest-tier")]
    while (tiers[-1].agg(F.max("total")).first()[0] or 0) > 1:
        tiers.append(scratch_table(_tops(tiers[-1], tree), "manifest-tier"))
    above = None
    for tier in reversed(tiers):
        rows = (tier.withColumn("up", F.lit(None).cast("string")) if above is None else
                _join(tier.withColumn("block", F.shiftright("idx", BITS)),
                      above.withColumnRenamed("path", "up"), [tree, "block"]).drop("block"))
        above = scratch_table(_paths(rows, tree), "manifest-paths")
    return tiers[-1].select(tree, "hash"), above


def build(rows: DataFrame, group: str, order: str) -> tuple[DataFrame, DataFrame]:
    """Place and hash ``rows`` (group, order, leaf and others).

    Returns the placed leaves (rows' columns, idx, total) and the blocks (group, block,
    path, subroot, place, over, root): ``path`` leads from a block to its group's
    root, ``over`` from there to the root of all."""
    placed = seq_number(rows, group, [order, "leaf"], "_nr", total="total")
    placed = scratch_table(placed.withColumn("idx", F.col("_nr") - 1).drop("_nr"), "manifest-leaves")
    roots, paths = forest(placed.select(group, "idx", "total", F.col("leaf").alias("hash")), group)
    subs = seq_number(roots.withColumn("_one", F.lit(1)), "_one", [group], "_nr", total="total")
    subs = scratch_table(subs.withColumn("idx", F.col("_nr") - 1).drop("_nr"), "manifest-groups")
    root, over = forest(subs.select("_one", "idx", "total", "hash"), "_one")
    inner = _join(subs.withColumn("block", F.shiftright("idx", BITS)),
                  over.withColumnRenamed("path", "up"), ["_one", "block"])
    over = _paths(inner.select("_one", "idx", "total", "hash", "up"), "_one")
    groups = _join(subs.select(group, F.col("hash").alias("subroot"), F.col("idx").alias("place")),
                   over.select(F.col("block").alias("place"), F.col("path").alias("over")), ["place"])
    blocks = _join(paths, scratch_table(groups, "manifest-over"), [group])
    return placed, scratch_table(blocks.withColumn("root", root.select("hash").scalar()), "manifest-blocks")


def prove(placed: DataFrame, blocks: DataFrame, group: str, changed: str) -> DataFrame:
    """Proof and version of every leaf: the leaves' columns, subroot, root, ``proof`` (its
    siblings in hex, bottom up), ``copies`` (the nodes that its version holds for itself,
    bottom up, the root last; null without a change) and ``folded_root``.

    ``changed`` holds a leaf's other hash, null where it is unchanged: its version then is
    the tree itself, folded from the leaf."""
    rows = _join(placed.withColumn("block", F.shiftright("idx", BITS)), blocks, [group, "block"])
    keep = [*placed.columns, "subroot", "root"]
    schema = T.StructType([rows.schema[c] for c in keep]).simpleString()[len("struct<"):-1]

    def fold(table: pa.Table) -> pa.Table:
        table, block = _block(table, "leaf")
        up, over = _path(table["path"][0].as_py()), _path(table["over"][0].as_py())
        place = table["place"][0].as_py()
        proofs, versions, ends = [], [], []
        for at, (leaf, other) in enumerate(zip(table["leaf"].to_pylist(), table[changed].to_pylist())):
            own = block.siblings(at)
            nodes = copied(leaf if other is None else other, at, own)
            nodes += copied(nodes[-1], block.first >> BITS, up)[1:]
            nodes += copied(nodes[-1], place, over)[1:]
            proofs.append([x for x in (*own, *up, *over) if x])
            versions.append(None if other is None else nodes)
            ends.append(nodes[-1])
        return pa.table([*[table[c] for c in keep], pa.array(proofs, pa.list_(pa.string())),
                         pa.array(versions, pa.list_(pa.string())), pa.array(ends, pa.string())],
                        names=[*keep, "proof", "copies", "folded_root"])

    return rows.groupBy(group, "block").applyInArrow(
        fold, f"{schema}, proof array<string>, copies array<string>, folded_root string")


def tampered_rows(id_col: Column, share: int = 7) -> Column:
    """Rows whose id as decimal text has a crc32 divisible by ``share``; a null id never."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % share == 0, F.lit(False))


def verify(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
           cols: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), bumped: str = "n_chars",
           share: int = 7) -> DataFrame:
    """Manifest of ``docs`` and a check of it against tampered rows, whose ``bumped`` is one more.

    Returns doc_id, lang (the group), leaf, changed, idx, total, subroot, root, proof, copies,
    folded_root (see ``prove``)."""
    own = [F.col(c) for c in cols]
    other = [F.col(c).cast("decimal(20,0)") + 1 if c == bumped else F.col(c) for c in cols]
    hit = tampered_rows(F.col(id_col), share) & F.col(bumped).isNotNull()
    rows = scratch_table(docs.select(
        F.col(id_col).alias("doc_id"), F.col(group_col).alias("lang"), leaf_hash(own).alias("leaf"),
        F.when(hit, leaf_hash(other)).alias("changed")), "manifest-hashes")
    return prove(*build(rows, "lang", "doc_id"), "lang", "changed")
