"""Merkle manifest of a dataset with a membership witness for every row.

A tree is grown by appends. An appended leaf is an open subtree of height 0; whenever the
last two open subtrees are of one height they are joined, and the witnesses of all leaves
of either are extended by the other's root. At the end the open subtrees that have no
sibling left are raised alone. Rows of a group (language) are numbered in order and cut
into aligned blocks of `2 ** BLOCK_HEIGHT` leaves, which grow apart from each other in Spark
tasks; the roots of the blocks are appended to the tree above in the same way, in blocks again,
until one root is left. The roots of the groups are the leaves of the last tree.

A node is the lower-case hex SHA-256 of its children's digests as hex text, one after the
other; a node without a sibling is the digest of the one digest. A group of one leaf has
that leaf as its root.

Defined cases: null values of a leaf are `-`, others their UTF-8 byte count, a colon and the
value, so that no two rows share a leaf unless they are equal; a null group comes first; rows with
equal ids are ordered by leaf, so equal rows are leaves of their own beside each other; an
empty table gives no rows; whole texts of any length enter the leaf; columns not named
do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.ranking import numbered
from tallyloom.llm.tables import stored

BLOCK_HEIGHT = 10
DIGEST_BYTES = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left: boolean, digest: binary>>"


def digest(*children: bytes) -> bytes:
    return sha256("".join(c.hex() for c in children).encode()).digest()


class GrowingTree:
    """Open subtrees of the leaves appended so far, and every leaf's partial witness.

    witness[i, h] is the sibling leaf i meets at height h, side[i, h] where it stands:
    -1 left, 1 right, 0 no sibling.
    """

    def __init__(self, capacity: int, height: int):
        self.witness = np.zeros((capacity, height, DIGEST_BYTES), np.uint8)
        self.side = np.zeros((capacity, height), np.int8)
        self.size = 0
        self.open: list[tuple[int, int, bytes]] = []  # height, first leaf, root

    def append(self, leaf: bytes) -> None:
        self.open.append((0, self.size, leaf))
        self.size += 1
        self._join()

    def _join(self) -> None:
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            (height, first, left), (_, middle, right) = self.open[-2:]
            self.witness[first:middle, height] = np.frombuffer(right, np.uint8)
            self.side[first:middle, height] = 1
            self.witness[middle : self.size, height] = np.frombuffer(left, np.uint8)
            self.side[middle : self.size, height] = -1
            self.open[-2:] = [(height + 1, first, digest(left, right))]

    def close(self, height: int) -> bytes:
        """The root at this height; what has no sibling rises alone."""
        while self.open[-1][0] < height:
            at, first, root = self.open[-1]
            self.open[-1] = (at + 1, first, digest(root))
            self._join()
        return self.open[0][2]


def encoded(column: Column) -> Column:
    """A value with its UTF-8 byte count in front, `-` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(encoded, values)), 256))


def _grown_block(nodes: pa.Table, block_height: int) -> pa.Table:
    """Witnesses of the nodes of one block; the block's root stands in its first row."""
    nodes = nodes.sort_by("place")
    left = nodes["left"][0].as_py()  # nodes of the whole tree at this height
    height = min(block_height, (left - 1).bit_length())
    tree = GrowingTree(len(nodes), height)
    for leaf in nodes["node"].to_pylist():
        tree.append(leaf)
    root = tree.close(height)
    there = tree.side.ravel() != 0
    found = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(DIGEST_BYTES), there.size, [None, pa.py_buffer(tree.witness.tobytes())]
    ).cast(pa.binary())
    alone = pa.array(~there)
    digests = pa.compute.if_else(alone, pa.scalar(None, pa.binary()), found)
    steps = pa.StructArray.from_arrays([pa.array(tree.side.ravel() < 0), digests], names=["left", "digest"])
    offsets = pa.array(np.arange(len(nodes) + 1, dtype=np.int32) * height)
    return pa.table(
        {
            "tree": nodes["tree"],
            "place": nodes["place"],
            "steps": pa.ListArray.from_arrays(offsets, steps),
            "root": pa.array([root] + [None] * (len(nodes) - 1), pa.binary()),
        }
    )


def _grow(nodes: DataFrame, block_height: int) -> tuple[DataFrame, DataFrame]:
    """(tree, place, steps to the root) of all nodes (tree, place, left, node), and (tree, root).

    `left` is the number of nodes of the tree. Each turn covers block_height heights; the
    number of turns is a logarithm of the largest tree.
    """
    blocks = 1 << block_height
    largest = nodes.agg(F.max("left")).first()[0] or 0
    turns = []
    while True:
        at = F.shiftright("place", block_height)
        grown = nodes.groupBy("tree", at.alias("_block")).applyInArrow(
            lambda _, table: _grown_block(table, block_height),
            f"tree long, place long, steps {STEPS}, root binary",
        )
        turns.append(stored(grown, "witnesses"))
        roots = turns[-1].filter("root is not null").select("tree", at.alias("place"), F.col("root").alias("node"))
        if largest <= blocks:
            break
        largest = -(-largest // blocks)
        sizes = nodes.select("tree", F.ceil(F.col("left") / blocks).alias("left")).distinct()
        nodes = stored(roots.join(sizes, "tree"), "block-roots")
    steps = turns.pop().drop("root")
    for lower in reversed(turns):
        upper = steps.select("tree", F.col("place").alias("_block"), F.col("steps").alias("_more"))
        joined = lower.withColumn("_block", F.shiftright("place", block_height)).join(upper, ["tree", "_block"])
        steps = joined.select("tree", "place", F.concat("steps", "_more").alias("steps"))
    return steps, roots.select("tree", F.col("node").alias("root"))


def manifest(
    leaves: DataFrame, group: str, key: str, keep: Sequence[str] = (), block_height: int = BLOCK_HEIGHT
) -> DataFrame:
    """(group, key, kept columns, leaf, subroot, root, steps) of every row (group, key, leaf, ..).

    `leaf` is binary; `steps` is the witness of a row: the siblings from its leaf to the root,
    with the side they stand on, null where the node has none.
    """
    # Equal rows are told apart, so that not even they are bound to one task.
    rows = leaves.select(group, key, *keep, "leaf").withColumn("_row", F.monotonically_increasing_id())
    rows = stored(rows, "leaves")
    groups = rows.groupBy(group).agg(F.count("*").alias("left"))
    groups = numbered(groups.withColumn("_all", F.lit(0)), "_all", [F.col(group)], "tree")
    groups = stored(groups.select(F.col(group).alias("_of"), "left", "tree"), "groups")
    placed = numbered(rows, group, [F.col(key), F.col("leaf"), F.col("_row")])
    placed = placed.join(groups, F.col(group).eqNullSafe(F.col("_of"))).drop("_of", "_row")
    placed = stored(placed, "placed")
    lower, subroots = _grow(placed.select("tree", "place", "left", F.col("leaf").alias("node")), block_height)
    subroots = stored(subroots, "subroots")
    top = subroots.select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("place"),
        F.lit(groups.count()).cast("long").alias("left"),
        F.col("root").alias("node"),
    )
    upper, root = _grow(top, block_height)
    whole = upper.join(root, "tree").select(F.col("place").alias("tree"), F.col("steps").alias("_more"), "root")
    whole = whole.join(subroots.select("tree", F.col("root").alias("subroot")), "tree")
    found = placed.drop("left").join(lower, ["tree", "place"]).join(whole, "tree")
    return found.select(
        group, key, *keep, "leaf", "subroot", "root", F.concat("steps", "_more").alias("steps")
    )


def hex_text(column: Column | str) -> Column:
    return F.lower(F.hex(column))


def folded(leaf: Column, steps: Column) -> Column:
    """The root a leaf and its witness lead to, as hex text."""

    def climbed(below: Column, step: Column) -> Column:
        other = hex_text(step["digest"])
        both = F.when(step["digest"].isNull(), below).when(step["left"], F.concat(other, below))
        return F.sha2(both.otherwise(F.concat(below, other)), 256)

    return F.aggregate(steps, hex_text(leaf), climbed)


def proof_digest(steps: Column) -> Column:
    """The digest of all siblings of a witness."""
    there = F.filter(steps, lambda s: s["digest"].isNotNull())
    return F.sha2(F.array_join(F.transform(there, lambda s: hex_text(s["digest"])), ""), 256)
