"""SimHash near-dedup: 64-bit fingerprints, and all pairs within a few bits by vantage-point trees.

Two fingerprints that differ in at most ``b`` bits differ in at most ``b // 2`` bits in one of their halves. So there
are two trees, one by the Hamming distance of each half, searched with that smaller radius: a smaller radius
prunes more by the triangle bounds. A node splits its points by the distance to a vantage point; a query goes on to both
sides only if it is within the radius of the border. Where a half cannot split (many equal halves), a node goes on with
the distance of the other half and the full radius.

The top of each tree is built on the driver from a bounded sample of fingerprints and only decides which
shard a fingerprint lives in; every fingerprint is stored once per tree and visits the shards whose borders it is
near. Inside its shard each tree goes on to small leaves, where pairs are compared exactly. The result is exact,
whatever the sample. A shard returns spanning links of what it found, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.components import components
from sievewright.llm.keys import shielded
from sievewright.llm.text import add_columns, widened
from sievewright.storage import Workspace

SHINGLE = 3
MAX_BITS = 3
SHARD = 16_384
SAMPLE = 20_000
_LEAF = 128
_HALVES = (np.uint64(0xFFFFFFFF00000000), np.uint64(0x00000000FFFFFFFF))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text: XXH64 (seed 42) of lower-cased word shingles, repeats included; a bit is set if it
    is in more than half of the hashes. Without words: 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for lo in range(0, n, 50_000):
        h = [digest(joined[a:b], 42) for a, b in zip(starts[lo:min(n, lo + 50_000)].tolist(), last[lo:lo + 50_000].tolist())]
        total += np.unpackbits(np.array(h, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def _print(batches: Iterator[pa.RecordBatch], text: str, shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(text)], dtype=np.uint64)
        yield add_columns(batch, {"__print": pa.array(found.view(np.int64))})


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """All columns of ``docs`` and ``__print``, the fingerprint as a signed number."""
    return docs.mapInArrow(partial(_print, text=text, shingle=shingle), widened(docs, "__print bigint"))


@dataclass
class Node:
    """Points within ``border`` of the vantage point, by the bits in ``mask``, are on the near side."""

    vantage: np.uint64
    mask: np.uint64
    radius: int
    border: int
    near: Node | int
    far: Node | int


def _distance(points: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & mask)


def _split(points: np.ndarray, half: int, max_bits: int) -> tuple[np.uint64, np.uint64, int, int] | None:
    """Vantage point, mask, radius and border that divide the points best; None if all of them are equal."""
    for mask, radius in ((_HALVES[half], max_bits // 2), (_HALVES[1 - half], max_bits)):
        for vantage in points[:: max(1, len(points) // 5)][:5]:
            d = _distance(points, vantage, mask)
            border = int(np.median(d))
            if border == d.max():
                border -= 1
            if 0 <= border and (d <= border).any() and (d > border).any():
                return vantage, mask, radius, border
    return None


def top_tree(sample: np.ndarray, half: int, max_bits: int, shards: int) -> tuple[Node | int, int]:
    """A tree whose leaves are shard numbers, and how many there are. Sides get shards by their share of the sample."""
    count = 0

    def build(points: np.ndarray, want: int) -> Node | int:
        nonlocal count
        found = _split(points, half, max_bits) if want > 1 and len(points) > 1 else None
        if found is None:
            count += 1
            return count - 1
        near = _distance(points, *found[:2]) <= found[3]
        part = min(max(round(want * float(near.mean())), 1), want - 1)
        return Node(*found, build(points[near], part), build(points[~near], want - part))

    return build(sample, shards), count


def _visits(points: np.ndarray, node: Node | int, home: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Shard, places of the points that visit it, and whether it is where they live."""
    if not len(at):
        return
    if not isinstance(node, Node):
        yield node, at, home
        return
    d = _distance(points[at], node.vantage, node.mask).astype(np.int64)
    near = d <= node.border
    for side, lives, visits in ((node.near, near, d - node.radius <= node.border), (node.far, ~near, d + node.radius > node.border)):
        yield from _visits(points, side, (home & lives)[visits], at[visits])


def _route(batches: Iterator[pa.RecordBatch], trees: list[tuple[Node | int, int]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = batch.column("__print").to_numpy().view(np.uint64)
        first = 0
        for tree, shards in trees:
            for shard, at, home in _visits(points, tree, np.ones(len(points), dtype=bool), np.arange(len(points))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), first + shard, dtype=np.int32)), pa.array(home), pa.array(points[at].view(np.int64))],
                    names=["shard", "home", "__print"])
            first += shards


def _pairs(queries: np.ndarray, points: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    left, right = [], []
    step = max(1, (1 << 18) // max(1, len(points)))
    for lo in range(0, len(queries), step):
        q, p = np.nonzero(np.bitwise_count(queries[lo:lo + step, None] ^ points[None, :]) <= max_bits)
        left.append(queries[lo + q])
        right.append(points[p])
    return np.concatenate(left), np.concatenate(right)


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same nodes: each node with the smallest of its component."""
    node, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(node))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rest = label != np.arange(len(node))
    return node[rest], node[label[rest]]


def search(queries: np.ndarray, points: np.ndarray, half: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a query and another point within ``max_bits`` that are near in this half, by leaves."""
    if not len(queries) or not len(points):
        return
    found = _split(points, half, max_bits) if len(points) > _LEAF else None
    if found is None:
        u, v = _pairs(queries, points, max_bits)
        yield u[u != v], v[u != v]
        return
    vantage, mask, radius, border = found
    d, q = _distance(points, vantage, mask), _distance(queries, vantage, mask).astype(np.int64)
    yield from search(queries[q - radius <= border], points[d <= border], half, max_bits)
    yield from search(queries[q + radius > border], points[d > border], half, max_bits)


def _search_shard(table: pa.Table, first_of_second: int, max_bits: int) -> pa.Table:
    points = table.column("__print").to_numpy().view(np.uint64)
    home = table.column("home").to_numpy()
    half = int(table.column("shard")[0].as_py() >= first_of_second)
    us, vs, size = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.uint64)], 0
    for u, v in search(points, points[home], half, max_bits):
        us.append(u)
        vs.append(v)
        size += len(u)
        if size > 1 << 20:
            us, vs = ([x] for x in spanning(np.concatenate(us), np.concatenate(vs)))
            size = 0
    u, v = spanning(np.concatenate(us), np.concatenate(vs))
    return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})


def links(prints: DataFrame, space: Workspace, max_bits: int = MAX_BITS, shard: int = SHARD) -> DataFrame:
    """``u, v``: links that join the same fingerprints as all pairs within ``max_bits`` do. ``prints`` is a held table
    of different fingerprints, ``__print``."""
    shards = max(1, -(-prints.count() // shard))
    # Eight sampled fingerprints for each shard to be.
    sample = prints.select("__print", F.xxhash64("__print").alias("h")).orderBy("h").limit(max(SAMPLE, 8 * shards)).toPandas()["__print"].to_numpy(np.int64).view(np.uint64)
    trees = [top_tree(sample, half, max_bits, max(1, min(shards, len(sample) // 8))) for half in (0, 1)]
    routed = prints.select("__print").mapInArrow(partial(_route, trees=trees), "shard int, home boolean, __print bigint")
    first_of_second = trees[0][1]
    found = routed.groupBy("shard").applyInArrow(lambda t: _search_shard(t, first_of_second, max_bits), "u bigint, v bigint")
    return space.hold(found, "pairs")


def grouped(docs: DataFrame, space: Workspace, text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, __print, __component`` of every row: the smallest ``doc_id`` that links of at most ``max_bits`` lead to.

    Rows may share ids; null ids take part, and a component of null ids only has a null number. Null and empty texts have
    fingerprint 0. Copies share a fingerprint and never meet each other as pairs.
    """
    prints = space.hold(fingerprints(docs.select("doc_id", text), text, shingle).select("doc_id", "__print"), "prints")
    different = space.hold(prints.groupBy("__print").agg(F.min("doc_id").alias("least")), "different")
    roots = components(links(different, space, max_bits), space)
    rooted = different.join(roots, F.col("__print") == F.col("node"), "left").select(
        "__print", "least", F.coalesce("root", "__print").alias("root"))
    numbers = rooted.groupBy("root").agg(F.min("least").alias("__component"))
    return prints.join(rooted.join(numbers, "root").select("__print", "__component"), "__print")


def report(docs: DataFrame, space: Workspace) -> DataFrame:
    return grouped(docs, space).select(
        "doc_id", F.lower(F.lpad(F.hex("__print"), 16, "0")).alias("fingerprint"), F.col("__component").alias("component_id"))


def clean(docs: DataFrame, space: Workspace) -> DataFrame:
    """One document of each component, the one with the smallest id (the first of its rows, if it has several), columns
    as they came; the rest go. Rows with a null id stay only where no row of their component has an id, one of each."""
    hidden, named = shielded(docs, "doc_id", "text")
    own = space.hold(hidden.withColumn("__row", F.monotonically_increasing_id()), "rows")
    groups = grouped(own.select(F.struct("doc_id", "__row").alias("doc_id"), "text"), space)
    order = F.struct(F.col("doc_id.doc_id").isNull(), F.col("doc_id.doc_id"), F.col("doc_id.__row"))
    kept = groups.groupBy("__component").agg(F.min(order).alias("first")).select(F.col("first.__row").alias("__row"))
    return named(own.join(kept, "__row", "left_semi"))
