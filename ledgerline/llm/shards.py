"""Sharding by a hierarchical weighted hash tree.

A tree of regions, racks and shards has a weight at every node (inner nodes:
the sum of their children). A document descends from the root: at each level it
draws, for each child, -ln(u) / weight with u a hash of its id and the child's path,
and takes the child with the smallest draw, so children receive shares in
proportion to their weights. Draws of other children do not change when a weight
changes: documents move only into a subtree that gained weight or out of one that lost it.

Growing by one shard hangs a new region (one rack, one shard) under the root, so
documents move only into the new shard.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored, text_of

#: Rows that one numbering group holds on average, whatever the size of the table.
ROWS_PER_GROUP = 100_000


@dataclass(frozen=True)
class Node:
    """A region, rack or shard: a shard has a number and a weight, the others children."""

    name: str
    children: tuple["Node", ...] = ()
    shard: int = -1
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(regions: int, racks: int, shards: int) -> Node:
    """An even tree of regions * racks * shards shards, numbered from 0."""
    numbered = iter(range(regions * racks * shards))
    return Node("root", tuple(
        Node(f"region{r}", tuple(
            Node(f"rack{k}", tuple(Node(f"shard{s}", shard=s) for s in (next(numbered) for _ in range(shards))))
            for k in range(racks)))
        for r in range(regions)))


def count(node: Node) -> int:
    return sum(count(c) for c in node.children) if node.children else 1


def grown(root: Node, weight: float = 1.0) -> Node:
    """``root`` with one more shard, in a region of its own."""
    n = count(root)
    new = Node(f"region-of-{n}", (Node("rack0", (Node(f"shard{n}", shard=n, own_weight=weight),)),))
    return Node(root.name, (*root.children, new))


def shard_of(key: Column, node: Node, path: str = "") -> Column:
    """The shard of ``key`` under ``node``; nodes without weight receive nothing."""
    if not node.children:
        return F.lit(node.shard)
    alive = [c for c in node.children if c.weight > 0]
    if len(alive) == 1:
        return shard_of(key, alive[0], f"{path}/{alive[0].name}")

    def draw(child: Node) -> Column:
        # 52 bits of the hash, never 0 or 1
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(f"{path}/{child.name}")), 12).cast("double") + 0.5) / 2.0 ** 52
        return -F.log(u) / child.weight

    best = F.array_min(F.array(*[F.struct(draw(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(alive)]))["i"]
    out = None
    for i, c in enumerate(alive):
        inner = shard_of(key, c, f"{path}/{c.name}")
        out = F.when(best == i, inner) if out is None else out.when(best == i, inner)
    return out


def assign(docs: DataFrame, root: Node, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    The id alone decides the shard (all null ids share one). ``size`` is the UTF-8
    bytes of the text (null: none) plus 8. ``slot`` numbers the rows of a shard from 0 without gaps:
    rows are numbered inside hash groups of about ROWS_PER_GROUP rows, and the groups of
    a shard follow each other by a prefix sum over their counts. Repeated rows are
    numbered one by one; which of two equal rows comes first does not show. An empty table
    gives an empty result; other columns are not read.
    """
    key = F.col("doc_id")
    text = text_of("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"), shard_of(key, root).cast("int").alias("shard"),
        shard_of(key, grown(root)).cast("int").alias("grown_shard"))
    rows = stored(rows, "shards")
    groups = max(1, math.ceil(rows.count() / (count(root) * ROWS_PER_GROUP)))
    rows = rows.withColumn("__g", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(groups)))
    sizes = rows.groupBy("shard", "__g").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", "__g", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "__g").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("at", F.row_number().over(inside)).join(bases, ["shard", "__g"])
            .select("doc_id", "size", "text_crc32", "law", "shard",
                    (F.col("base") + F.col("at") - 1).cast("long").alias("slot"), "grown_shard"))
