"""Merkle manifest of a data set: incremental witnesses.

Every row is a leaf, the hash of its fields.  The leaves of one group (a language) ascend by id.
They are appended to a tree, aligned block by aligned block: a block of ``BLOCK`` leaves is one
group of one task, which appends its leaves in order to a frontier of open subtrees.  A leaf's
witness starts empty and is attached to the open subtree that holds it; whenever a sibling
completes, the two witnesses of the merged subtrees grow by one digest.  What a block leaves is
its root, and the block roots are the next appends, in blocks again, until one node of each group
is left; the groups' roots are appended the same way.  A leaf's whole witness is its own, extended
by that of its block's root, and so on up to the root.

The texts are read once, where the leaves are hashed by SQL functions; afterwards only digests and
keys travel.  Ranks come from a range shuffle over (group, id, leaf) and counts per range, so a
group with a third of all rows is many ranges and many blocks.  No task holds more than a block.

Defined results: a null field is ``-``, an empty text ``0:``; null ids come first, ties of ids by
leaf, and equal rows are leaves of their own; the null group is first, the others follow by their
UTF-8 bytes.  Texts of any length are hashed whole, by Spark.  An empty table has no rows and no
root.  Extra columns, whatever their names, are left out, as are the fields themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from keyfig.llm.common import lookup, shuffle_parts, stored

#: Leaves of a block; a power of two, so that full blocks are whole subtrees.
BLOCK = 4096


def combine(*digests: bytes) -> bytes:
    """The parent of one or two nodes: a hash of their digests as hex text."""
    return sha256(b"".join(digests).hex().encode()).digest()


def field(column: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*columns: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, columns)), 256))


# ---------------------------------------------------------------------------------- frontier

class Frontier:
    """Open subtrees of one block, and the partial witnesses of its nodes."""

    def __init__(self, block: int = BLOCK):
        self.levels = block.bit_length() - 1
        self.siblings = np.zeros((block, self.levels, 32), np.uint8)
        self.sides = np.zeros((block, self.levels), np.uint8)
        self.clear()

    def clear(self) -> None:
        self.open: list[tuple[int, bytes, int, int]] = []  # height, digest, nodes from, to
        self.n = 0

    def append(self, digest: bytes) -> None:
        node = (0, digest, self.n, self.n + 1)
        self.n += 1
        while self.open and self.open[-1][0] == node[0]:
            node = self._merge(self.open.pop(), node)
        self.open.append(node)

    def _merge(self, left: tuple[int, bytes, int, int], right: tuple[int, bytes, int, int]) -> tuple[int, bytes, int, int]:
        height, first, a, b = left
        _, second, _, c = right
        self.siblings[a:b, height] = np.frombuffer(second, np.uint8)
        self.siblings[b:c, height] = np.frombuffer(first, np.uint8)
        self.sides[a:b, height], self.sides[b:c, height] = ord("R"), ord("L")
        return height + 1, combine(first, second), a, c

    def close(self, lift: bool) -> tuple[bytes, list[bytes], list[str]]:
        """The block's root, and each node's siblings and steps, from below.

        A step is the side of the sibling, or N where a node has none.  ``lift``: the group has
        more blocks, so that this one's root must be as high as theirs.
        """
        node = self.open.pop()
        while self.open or lift and node[0] < self.levels:
            height, digest, a, b = node
            if self.open and self.open[-1][0] == height:
                node = self._merge(self.open.pop(), node)
            else:
                self.sides[a:b, height] = ord("N")
                node = height + 1, combine(digest), a, b
        height, root, _, _ = node
        steps = [x.tobytes().decode() for x in self.sides[:self.n, :height]]
        held = self.siblings[:self.n, :height]
        there = self.sides[:self.n, :height] != ord("N")
        siblings = [x[t].tobytes() for x, t in zip(held, there, strict=True)]
        self.clear()
        return root, siblings, steps


def fold(digest: bytes, siblings: bytes, steps: str) -> bytes:
    """The root that a leaf and its witness lead to."""
    at = 0
    for step in steps:
        if step == "N":
            digest = combine(digest)
            continue
        other = siblings[at:at + 32]
        at += 32
        digest = combine(digest, other) if step == "R" else combine(other, digest)
    return digest


# ------------------------------------------------------------------------------------ ranks

def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with their ``rank`` in their ``seq`` and the ``total`` of it; stored.

    Rows equal in ``order`` may take each other's ranks.
    """
    parts = shuffle_parts(nodes.sparkSession)
    dealt = (nodes.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(parts, "seq", *order, "tie")
             .sortWithinPartitions("seq", *order, "tie").drop("tie"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields) + ", part int, nth long"
    numbered = stored(dealt.mapInArrow(_number(nodes.columns.index("seq"), [*nodes.columns, "part", "nth"]), schema), "ranks")
    counts = numbered.groupBy("seq", "part").agg((F.max("nth") + 1).alias("weight"))  # a row per range and group that meet
    own = Window.partitionBy("seq")
    totals = stored(counts.select("*", F.sum("weight").over(own).alias("total"),
                                  F.coalesce(F.sum("weight").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")), "rank-offsets")
    out = lookup(numbered, totals, ["seq", "part"], "weight")
    return out.withColumn("rank", F.col("before") + F.col("nth")).drop("before", "nth", "part")


def _number(at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            seq = batch.column(at).to_pylist()
            nth = np.empty(len(seq), np.int64)
            for i, s in enumerate(seq):
                n = n + 1 if s == last else 0
                last, nth[i] = s, n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(seq), part, np.int32)), pa.array(nth)], names=names)
    return run


# ---------------------------------------------------------------------------------- appends

_NODE = ["seq", "total", "rank", "digest"]


def append_blocks(nodes: DataFrame, payload: list[str], block: int = BLOCK) -> DataFrame:
    """``nodes`` (seq, total, rank, digest, payload) with block, block root, siblings, steps; stored."""
    n = len(_NODE)
    sent = nodes.select(*_NODE, F.floor(F.col("rank") / block).alias("block"), *payload)
    dealt = sent.repartition(shuffle_parts(nodes.sparkSession), "seq", "block").sortWithinPartitions("seq", "block", "rank")
    names = [*_NODE, "block", *payload, "root", "siblings", "steps"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sent.schema.fields)

    def done(tree: Frontier, rows: list[pa.RecordBatch], lift: bool) -> Iterator[pa.RecordBatch]:
        root, siblings, steps = tree.close(lift)
        a = 0
        for part in rows:
            b = a + part.num_rows
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([root] * part.num_rows, pa.binary()), pa.array(siblings[a:b], pa.binary()),
                                              pa.array(steps[a:b], pa.string())], names=names)
            a = b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, rows, last, lift = Frontier(block), [], None, False
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(n).to_pylist(), strict=True))
            digests, totals = batch.column(3).to_pylist(), batch.column(1).to_pylist()
            a = 0
            for i, key in enumerate(keys):
                if key != last:
                    if i > a:
                        rows.append(batch.slice(a, i - a))
                    if rows:
                        yield from done(tree, rows, lift)
                    rows, a, last, lift = [], i, key, totals[i] > block
                tree.append(digests[i])
            if len(keys) > a:
                rows.append(batch.slice(a))
        if rows:
            yield from done(tree, rows, lift)

    return stored(dealt.mapInArrow(run, f"{kinds}, root binary, siblings binary, steps string"), "appends")


def grow(nodes: DataFrame, payload: list[str], block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Whole witnesses of ``nodes`` up to the root of their ``seq``, and these roots.

    Returns (seq, payload, digest, siblings, steps, root) and (seq, digest), one row a sequence.
    """
    levels = [append_blocks(nodes, payload, block)]
    while True:
        below = levels[-1]
        roots = below.where(F.col("rank") % block == 0).select(
            "seq", F.ceil(F.col("total") / block).alias("total"), F.col("block").alias("rank"), F.col("root").alias("digest"))
        if (below.agg(F.max("total").alias("n")).first()["n"] or 0) <= block:
            break
        levels.append(append_blocks(roots, [], block))
    above = levels[-1]
    for level in reversed(levels[:-1]):
        more = above.select("seq", F.col("rank").alias("block"), F.col("siblings").alias("more"), F.col("steps").alias("more_steps"),
                            F.col("root").alias("top"), F.lit(block).alias("weight"))
        above = (lookup(level, more, ["seq", "block"], "weight")
                 .withColumn("siblings", F.concat("siblings", "more")).withColumn("steps", F.concat("steps", "more_steps"))
                 .withColumn("root", F.col("top")).drop("more", "more_steps", "top"))
        if level is not levels[0]:
            above = stored(above, "witnesses")
    return above.select("seq", *payload, "digest", "siblings", "steps", "root"), roots.select("seq", "digest")


def manifest(rows: DataFrame, key: str, fields: list[Column], group: str, carry: dict[str, Column] | None = None, block: int = BLOCK) -> DataFrame:
    """Per row: ``key``, the columns of ``carry``, leaf, subroot, root, siblings and steps.

    ``fields`` are the leaf's values in order; ``group`` names the column whose values have a tree
    of their own; ``carry`` gives further columns (of fixed names) that are computed with the leaves.
    """
    carry = carry or {}
    g = F.col(f"`{group}`").cast("string")
    # "" is the null group, which sorts first, and no other group's
    leaves = stored(rows.select(F.when(g.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), g)).alias("seq"), F.col(f"`{key}`").alias("key"),
                                leaf(*fields).alias("digest"), *(c.alias(n) for n, c in carry.items())), "leaves")
    own, subroots = grow(ranked(leaves, ["key", "digest"]), ["key", *carry], block)
    tops = ranked(subroots.select(F.lit("").alias("seq"), F.col("seq").alias("name"), "digest"), ["name"])
    upper, _ = grow(tops, ["name"], block)
    sizes = leaves.groupBy("seq").agg(F.count("*").alias("weight"))
    more = stored(upper.select(F.col("name").alias("seq"), F.col("siblings").alias("more"), F.col("steps").alias("more_steps"), F.col("root").alias("top"))
                  .join(sizes, "seq"), "group-witnesses")
    out = lookup(own, more, ["seq"], "weight")
    return out.select(F.col("key").alias(key), *carry, F.col("digest").alias("leaf"), F.col("root").alias("subroot"), F.col("top").alias("root"),
                      F.concat("siblings", "more").alias("siblings"), F.concat("steps", "more_steps").alias("steps"))


def proved(found: DataFrame, key: str, claimed: str) -> DataFrame:
    """Per row of a manifest: digests in hex, the hash of its siblings, and what ``claimed`` folds to."""
    sent = found.select(key, "leaf", "subroot", "root", F.coalesce(F.col(claimed), F.col("leaf")).alias("claimed"), "siblings", "steps")
    kind = found.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, leaves, subroots, roots, claims, siblings, steps = (batch.column(i).to_pylist() if i else None for i in range(7))
            folded = [fold(*x) for x in zip(claims, siblings, steps, strict=True)]
            text = lambda xs: pa.array([x.hex() for x in xs], pa.string())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), text(leaves), text(subroots), text(roots),
                pa.array([sha256(x.hex().encode()).hexdigest() for x in siblings], pa.string()), text(folded),
                pa.array([a == b for a, b in zip(folded, roots, strict=True)])],
                names=[key, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return sent.mapInArrow(run, f"`{key}` {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
