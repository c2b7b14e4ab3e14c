"""Sharding: contiguous shards of ordered atomic groups with the smallest possible largest shard.

Rows with equal texts form a group, which no shard may split. Groups are ordered by falling size, then by digest.
Groups of one size are interchangeable, so the number of groups of each size says all about the order; there are at most
sqrt(2 * bytes) different sizes, and the driver gets these numbers only. It binary-searches the smallest capacity
for which greedy filling needs no more shards than there are, cuts the first shard there, and repeats this with the
groups and shards that are left, so that a giant group does not leave other shards empty.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.numbering import numbered
from sievewright.storage import Workspace

#: Bytes that a row takes besides its text.
ROW_BYTES = 16
SHARDS = 40


class _Order:
    """Ordered groups as runs of equal sizes, largest first; a position is a number of groups before it."""

    def __init__(self, sizes: np.ndarray, counts: np.ndarray):
        order = np.argsort(-sizes, kind="stable")
        self.sizes, self.counts = sizes[order], counts[order]
        self.groups = np.concatenate([[0], np.cumsum(self.counts)])
        self.bytes = np.concatenate([[0], np.cumsum(self.sizes * self.counts)])

    def before(self, position: int) -> int:
        """Bytes of the groups before a position."""
        run = min(int(np.searchsorted(self.groups, position, side="right")) - 1, len(self.sizes) - 1)
        return int(self.bytes[run] + (position - self.groups[run]) * self.sizes[run])

    def reach(self, limit: int) -> int:
        """The last position that has at most ``limit`` bytes before it."""
        run = int(np.searchsorted(self.bytes, limit, side="right")) - 1
        if run >= len(self.sizes):
            return int(self.groups[-1])
        return int(self.groups[run] + (limit - self.bytes[run]) // self.sizes[run])

    def feasible(self, start: int, shards: int, capacity: int) -> bool:
        for _ in range(shards):
            start = self.reach(self.before(start) + capacity)
            if start == self.groups[-1]:
                return True
        return False

    def capacity(self, start: int, shards: int) -> int:
        rest = int(self.bytes[-1]) - self.before(start)
        largest = int(self.sizes[int(np.searchsorted(self.groups, start, side="right")) - 1])
        low, high = max(largest, -(-rest // shards)), rest // shards + largest
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.feasible(start, shards, middle) else (middle + 1, high)
        return low


def cuts(sizes: np.ndarray, counts: np.ndarray, shards: int = SHARDS) -> list[tuple[int, int]]:
    """Where shards 1, 2, ... start: a size, and the number of groups of that size before the cut."""
    if not len(sizes):
        return [(0, 0)] * (shards - 1)
    order, start, out = _Order(np.asarray(sizes, dtype=np.int64), np.asarray(counts, dtype=np.int64)), 0, []
    for k in range(shards - 1):
        if start < order.groups[-1]:
            start = order.reach(order.before(start) + order.capacity(start, shards - k))
        run = int(np.searchsorted(order.groups, start, side="right")) - 1
        out.append((int(order.sizes[run]), int(start - order.groups[run])) if run < len(order.sizes) else (0, 0))
    return out


def shard(docs: DataFrame, space: Workspace, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, digest, shard, slot`` of every row. Null texts have no bytes and form one group with
    empty ones; rows may share ids; ``slot`` counts the rows of a shard from 0."""
    text = F.coalesce("text", F.lit(""))
    rows = space.hold(docs.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest")), "sizes")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    found = groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).collect()
    at = cuts(np.array([r["bytes"] for r in found]), np.array([r["n"] for r in found]), shards)
    # Only where a cut falls between groups of one size does their order matter: number them by digest, in 65,536
    # buckets per size so that no window is large.
    split = sorted({size for size, rank in at if rank})
    bucket = F.conv(F.substring(F.hex("digest"), 1, 4), 16, 10).cast("int")
    inner = groups.where(F.col("bytes").isin(split)).withColumn("bucket", bucket)
    before = Window.partitionBy("bytes").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = inner.groupBy("bytes", "bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("bytes", "bucket").orderBy("digest")) - 1
    ranks = inner.withColumn("within", within).join(first.drop("n"), ["bytes", "bucket"]).select(
        "digest", (F.col("first") + F.col("within")).alias("rank"))
    ranked = groups.join(ranks, "digest", "left") if split else groups.withColumn("rank", F.lit(0))
    rank = F.coalesce("rank", F.lit(0))
    passed = [((F.col("bytes") < size) | ((F.col("bytes") == size) & (rank >= n))).cast("int") for size, n in at]
    placed = ranked.select("digest", reduce(lambda a, b: a + b, passed, F.lit(0)).alias("shard"))
    return numbered(rows.join(placed, "digest"), "shard", "slot", space, "placed")[0]


def report(docs: DataFrame, space: Workspace) -> DataFrame:
    return shard(docs, space).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
