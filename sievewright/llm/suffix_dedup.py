"""Suffix-array dedup: remove bytes of strings of fixed length that start earlier in the corpus.

A string of ``length`` bytes at every position of every document is judged; one that also starts earlier (smaller
document id, or same document and earlier start) is removed. To bring equal strings together without shipping every
position, positions are dealt by the smallest hash of the short grams in their string: equal strings have equal
smallest grams, and neighbouring positions mostly share theirs, so they travel together as one piece.

1. Each document lists its pieces: smallest hash (``mark``), a hash of the whole piece (``body``), place and positions.
2. Marks that occur once are done: none of their strings repeats. Of pieces with equal bodies, all but the first go.
3. The first pieces of marks with several bodies (and pieces in which a gram repeats) are compared string by string
   in blocks of bounded size, by a suffix array: two-stage sorting orders the suffixes, the common prefixes of
   neighbours find equal strings. Only the suffixes smaller than their successors are sorted directly, the rest are induced by
   a scan of the buckets of first bytes.
4. The pieces of a mark that too many places share are spread over several blocks. Each of these blocks then hands on
   the first place of each of its strings, and equal strings of different blocks meet by their hash, with map-side minima.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.keys import keyed, unkeyed
from sievewright.llm.text import RangeHash, eight_bytes, mixed, raw_bytes, slices
from sievewright.storage import Workspace

LENGTH = 100
GRAM = 20
BLOCK_BYTES = 2 << 20
HOT = 4_000
KEY = ["doc_id", "__copy"]


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    out, have = h, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def pieces(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Row, first position, number of positions, mark and body of every piece of a slice of texts, and whether the mark's
    gram may stand in it twice, so that the piece may repeat a string of its own."""
    n = len(data) - length + 1
    empty = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return empty, empty, empty, empty, empty, empty > 0
    ranges = RangeHash(data)
    at = np.arange(len(data) - gram + 1)
    h, width = ranges(at, at + gram), length - gram + 1
    mark = _smallest(h, width)
    row = np.searchsorted(bounds, np.arange(n), side="right") - 1
    inside = np.arange(n) + length <= bounds[row + 1]
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (mark[1:] != mark[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    end = np.flatnonzero(inside & ~np.concatenate([inside[1:] & ~new[1:], [False]])) + 1
    body = mixed(ranges(first, end + length - 1) ^ mark[first] + np.uint64(length) * (end - first).astype(np.uint64))
    # A gram is the smallest of some string if it equals the largest mark of the strings that hold it. The next string
    # of a piece may hold the next standing just as it loses the last: these are ``width`` apart.
    ends = np.zeros(width - 1, dtype=np.uint64)
    largest = ~_smallest(~np.concatenate([ends, mark, ends]), width)
    chosen = np.flatnonzero(largest == h)
    twice = chosen[:-1][(h[chosen[1:]] == h[chosen[:-1]]) & (np.diff(chosen) <= width)]
    again = np.searchsorted(twice, end + width - 1) > np.searchsorted(twice, first)
    return row[first], first - bounds[row[first]], end - first, mark[first].view(np.int64), body.view(np.int64), again


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, _, data, bounds in slices(batch.column("text")):
            row, at, n, mark, body, again = pieces(data, bounds)
            row = pa.array(lo + row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(row), batch.column("__copy").take(row), pa.array(at), pa.array(n), pa.array(mark), pa.array(body), pa.array(again)],
                names=[*KEY, "at", "n", "mark", "body", "again"])


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the pieces of each document."""
    for batch in batches:
        data, bounds = raw_bytes(batch.column("text"))
        raw, wanted = data.tobytes(), batch.column("wanted")
        each = np.diff(wanted.offsets.to_numpy())
        rows, item = np.repeat(np.arange(len(batch)), each), wanted.flatten()
        at, n = (item.field(k).to_numpy() for k in ("at", "n"))
        start = bounds[rows] + at
        parts = [raw[a:b] for a, b in zip(start.tolist(), (start + n + length - 1).tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(rows)), batch.column("__copy").take(pa.array(rows)), item.field("at"), item.field("n"),
             item.field("block"), item.field("hot"), pa.array(parts, pa.binary())],
            names=[*KEY, "at", "n", "block", "hot", "piece"])


def _words(data: np.ndarray) -> np.ndarray:
    """Eight bytes from every position as one number that compares as they do."""
    return eight_bytes(data)[:len(data)].byteswap()


def _sort_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes at least; equal ones in any order."""
    key = words[at]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(at) else np.zeros(0, dtype=bool)
    for done in range(8, depth, 8):
        # Only groups of equal suffixes are sorted further.
        tied = ~new
        tied[:-1] |= ~new[1:]
        place = np.flatnonzero(tied)
        if not len(place):
            break
        group = np.cumsum(new)[place]
        source = at[place] + done
        key = np.where(source < len(words), words[np.minimum(source, len(words) - 1)], np.uint64(0))
        order = np.lexsort((key, group))
        at[place] = at[place][order]
        key, group = key[order], group[order]
        new[place] |= np.concatenate([[True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
    return at


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of ``data`` in the order of their first ``depth`` bytes, by two-stage sorting."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    symbol = data.astype(np.int16)
    change = np.concatenate([np.flatnonzero(symbol[1:] != symbol[:-1]), [n - 1]])
    turn = change[np.searchsorted(change, np.arange(n))]
    following = np.append(symbol, np.int16(-1))[turn + 1]
    rising = symbol < following  # the suffix is smaller than its successor
    direct = _sort_directly(np.flatnonzero(rising), _words(data), depth)
    edges = np.searchsorted(symbol[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[symbol[n - 1]].append(np.array([n - 1]))
    out = []

    def hand_on(done: np.ndarray, bucket: int) -> None:
        """The predecessors of sorted suffixes follow, in the same order, in the buckets of their larger first bytes."""
        before = done[done > 0] - 1
        before = before[~rising[before] & (symbol[before] > bucket)]
        first = symbol[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        where = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else order
        for a, b in zip(where.tolist(), [*where.tolist()[1:], len(before)]):
            waiting[first[a]].append(before[a:b])

    for bucket in range(256):
        found = np.concatenate([np.zeros(0, dtype=np.int64), *waiting[bucket]])
        bucket_parts = [found]
        while len(found):  # runs of one byte induce within their own bucket
            found = found[found > 0] - 1
            found = found[~rising[found] & (symbol[found] == bucket)]
            bucket_parts.append(found)
        bucket_parts.append(direct[edges[bucket]:edges[bucket + 1]])
        done = np.concatenate(bucket_parts)
        hand_on(done, bucket)
        out.append(done)
    return np.concatenate(out)


def common_prefixes(data: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """How many bytes, ``limit`` at most, each suffix shares with the one before it in ``order``; the first: 0."""
    words, out = _words(data), np.zeros(len(order), dtype=np.int64)
    alive = np.arange(1, len(order))
    for done in range(0, limit, 8):
        a, b = order[alive - 1] + done, order[alive] + done
        last = len(words) - 1
        inside = (a <= last) & (b <= last)
        diff = words[np.minimum(a, last)] ^ words[np.minimum(b, last)]
        same = inside & (diff == 0)
        part = alive[inside & ~same]
        top = diff[inside & ~same]
        high = top >> np.uint64(32)
        # Zero bytes at the front of the difference; a float64 holds the upper half exactly.
        lead = np.where(high > 0, (32 - np.ceil(np.log2(high.astype(float) + 1))) // 8, 4 + (32 - np.ceil(np.log2((top & np.uint64(0xFFFFFFFF)).astype(float) + 1))) // 8)
        out[part] = done + lead
        alive = alive[same]
        out[alive] = done + 8
    return np.minimum(out, limit)


def _block(table: pa.Table, length: int) -> pa.Table:
    """Of the pieces of one block: runs of positions to remove (``a`` to ``b``, the byte after their last string), and
    from a hot block the first place of each string, with its hash (``b`` is null)."""
    data, bounds = raw_bytes(table.column("piece"))
    at, n = table.column("at").to_numpy(), table.column("n").to_numpy()
    doc, copy = table.column("doc_id").to_numpy(), table.column("__copy").to_numpy()
    rank = np.unique(np.rec.fromarrays([doc, copy]), return_inverse=True)[1].astype(np.int64)
    owner = np.repeat(np.arange(len(n)), np.diff(bounds))
    within = np.arange(len(data)) - bounds[owner]
    order = suffix_array(data, length)
    order = order[within[order] < n[owner[order]]]
    fresh = common_prefixes(data, order, length) < length
    place = rank[owner[order]] * (1 << 40) + at[owner[order]] + within[order]
    group = np.cumsum(fresh) - 1
    first = np.minimum.reduceat(place, np.flatnonzero(fresh)) if len(order) else place
    later = np.flatnonzero(place > first[group]) if len(order) else order
    later = later[np.argsort(place[later])]
    spot, mine = place[later], owner[order[later]]
    start = np.flatnonzero(np.concatenate([[True], spot[1:] > spot[:-1] + length])) if len(spot) else spot
    stop = np.concatenate([start[1:], [len(spot)]])[:len(start)] - 1
    position = (1 << 40) - 1
    rows = [(doc[mine[start]], copy[mine[start]], spot[start] & position, (spot[stop] & position) + length, np.zeros(len(start), dtype=np.int64), np.ones(len(start), dtype=bool))]
    if table.column("hot")[0].as_py() and len(order):
        lead = np.flatnonzero(place == first[group])
        h = RangeHash(data)(order[lead], order[lead] + length).view(np.int64)
        own = owner[order[lead]]
        rows.append((doc[own], copy[own], place[lead] & position, np.zeros(len(lead), dtype=np.int64), h, np.zeros(len(lead), dtype=bool)))
    doc, copy, a, b, h, done = (np.concatenate(x) for x in zip(*rows))
    return pa.table({"doc_id": doc, "__copy": copy, "a": a, "b": b, "hash": h, "done": done})


def removals(own: DataFrame, space: Workspace, length: int = LENGTH, hot: int = HOT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, __copy, a, b``: spans of bytes to remove; they may overlap."""
    # Listing costs more than reading the list again: it is written once.
    listed = space.hold(own.select(*KEY, "text").mapInArrow(
        _list, "doc_id bigint, __copy bigint, at bigint, n bigint, mark bigint, body bigint, again boolean"), "listed")
    # First only the marks: those of two pieces, or of one in which their gram repeats.
    often = space.hold(listed.groupBy("mark").agg(F.count(F.lit(1)).alias("c"), F.max("again").alias("again")).where("c > 1 or again").select("mark"), "marks")
    found = space.hold(listed.join(often, "mark", "left_semi"), "pieces")
    place = F.struct(*KEY, "at")
    bodies = space.hold(found.groupBy("mark", "body").agg(F.min(place).alias("first"), F.max("n").alias("n"), F.max("again").alias("again")), "bodies")
    copies = found.join(bodies.select("mark", "body", "first"), ["mark", "body"]).where(place > F.col("first")).select(
        *KEY, F.col("at").alias("a"), (F.col("at") + F.col("n") + (length - 1)).alias("b"))
    # Only marks with several bodies, and pieces that may repeat within themselves, need the suffix array.
    marks = bodies.groupBy("mark").agg(F.count(F.lit(1)).alias("c"), F.max("again").alias("again")).where("c > 1 or again")
    todo = space.hold(bodies.drop("again").join(marks, "mark").select("mark", "body", "first.*", "n", "c"), "todo")
    size = todo.agg(F.sum(F.col("n") + (length - 1))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    is_hot = F.col("c") > hot
    block = F.when(is_hot, F.pmod(F.xxhash64("mark", F.pmod("body", F.ceil(F.col("c") / hot))), F.lit(blocks)) + blocks).otherwise(F.pmod(F.xxhash64("mark"), F.lit(blocks)))
    wanted = todo.groupBy(*KEY).agg(F.collect_list(F.struct("at", "n", block.alias("block"), is_hot.alias("hot"))).alias("wanted"))
    cut = own.select(*KEY, "text").join(wanted, KEY).mapInArrow(
        partial(_cut, length=length), "doc_id bigint, __copy bigint, at bigint, n bigint, block bigint, hot boolean, piece binary")
    judged = space.hold(cut.groupBy("block").applyInArrow(
        lambda t: _block(t, length), "doc_id bigint, __copy bigint, a bigint, b bigint, hash bigint, done boolean"), "judged")
    rest = judged.where("not done")
    first = rest.groupBy("hash").agg(F.min(F.struct(*KEY, "a")).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    across = rest.join(first, "hash").where(F.struct(*KEY, "a") > F.col("first")).select(*KEY, "a", (F.col("a") + length).alias("b"))
    return copies.unionByName(judged.where("done").select(*KEY, "a", "b")).unionByName(across)


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = raw_bytes(batch.column("text"))
        raw, spans, rows = data.tobytes(), batch.column("spans"), []
        each, item = spans.offsets.to_numpy() - spans.offsets[0].as_py(), spans.flatten()
        a, b = (item.field(k).to_numpy() for k in ("a", "b"))
        for i in range(len(batch)):
            lo, hi = int(bounds[i]), int(bounds[i + 1])
            kept, removed, runs, done = [], 0, 0, 0
            # Spans come sorted by their start.
            for x, y in zip(a[each[i]:each[i + 1]].tolist(), b[each[i]:each[i + 1]].tolist()):
                if x > done or not runs:
                    kept.append(raw[lo + done:lo + x])
                    runs, removed, done = runs + 1, removed + y - x, y
                elif y > done:
                    removed, done = removed + y - done, y
            kept.append(raw[lo + done:hi])
            rows.append((hi - lo, removed, runs, b"".join(kept)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("__copy"), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)), pa.array([r[3] for r in rows], pa.binary())],
            names=[*KEY, "n_bytes", "n_removed", "n_spans", "kept"])


def dedup(docs: DataFrame, space: Workspace, length: int = LENGTH, hot: int = HOT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row of ``doc_id, text``; ``kept`` is the bytes left.

    Null counts as empty; texts shorter than ``length`` bytes lose nothing. Shared and null ids: see ``keys.keyed``; null
    ids come first.
    """
    own = keyed(docs.select("doc_id", "text"), space)
    spans = removals(own, space, length, hot, block_bytes)
    reach = F.max("b").over(Window.partitionBy(*KEY).orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1))
    useful = spans.withColumn("reach", reach).where("reach is null or b > reach")
    per_doc = useful.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))
    body = own.join(per_doc, KEY, "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<a:bigint,b:bigint>>")))
    return unkeyed(body.mapInArrow(_keep, "doc_id bigint, __copy bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"))


def report(docs: DataFrame, space: Workspace) -> DataFrame:
    return dedup(docs, space).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
