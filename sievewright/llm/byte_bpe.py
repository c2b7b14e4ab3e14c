"""Byte-level BPE by a table of ranks: overlapping chunk encoding, and decoding by joining the bytes of the ids.

A pattern splits a text into pieces, each piece is merged by itself. Long texts are cut into overlapping chunks that tasks
split into pieces on their own. A chunk may start inside a piece, so its first boundaries may be wrong; the pattern looks
ahead only, so from the first boundary that it shares with the chunk before it both agree. There the chunks are stitched,
junction by junction, by a small aggregate of boundaries. Two chunks that share no boundary in their overlap (one
piece may be longer than that) become one chunk, and their outer junctions are judged again; that ends at the latest when
the text is whole. Then the pieces are encoded, each part of a text in any task, and the ids are put together.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.keys import keyed, unkeyed
from sievewright.storage import Workspace

CHUNK = 1 << 14  # characters
OVERLAP = 1 << 10
#: What the pattern may look at behind the end of a piece: boundaries closer to the end of a chunk are not trusted.
AHEAD = 2
KNOWN_PIECES = 400_000
LONG_PIECE = 200
KEY = ["doc_id", "__copy"]
_NONE = 1 << 60


class Ranks:
    """The bytes of all ids, and the ids of pieces. ``path`` names a file of lines ``base64 rank``."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.token = [b""] * (max(self.rank.values(), default=-1) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        self._pairs()
        self.forget()

    def forget(self) -> None:
        #: The number of each known piece; its ids stand in the pool from ``first[number]`` to ``first[number + 1]``.
        self.known: dict[str, int] = {}
        self.first, self.pool = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int32)

    def _pairs(self) -> None:
        """All ways to write a token as two tokens, by the numbers of both; for single bytes as a square."""
        rank = self.rank.get
        key, value = [], []
        for token, number in self.rank.items():
            for i in range(1, len(token)):
                a, b = rank(token[:i]), rank(token[i:])
                if a is not None and b is not None:
                    key.append(a << 32 | b)
                    value.append(number)
        order = np.argsort(np.array(key, dtype=np.int64))
        self.key, self.value = np.array(key, dtype=np.int64)[order], np.array(value, dtype=np.int64)[order]
        self.byte = np.array([rank(bytes([i]), -1) for i in range(256)], dtype=np.int64)
        both = np.repeat(self.byte, 256) << 32 | np.tile(self.byte, 256)
        self.square = self._joined(both)

    def _joined(self, key: np.ndarray) -> np.ndarray:
        """The token that each pair makes; none: a number above all."""
        if not len(self.key):
            return np.full(len(key), _NONE)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.value[at], _NONE)

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in one array, and how many each has. A piece that is a token is that token; else of all neighbours
        that join to one, those with the lowest rank are joined first, the leftmost of equals."""
        whole = [self.rank.get(piece, -1) for piece in pieces]
        out = [(i, [number]) for i, number in enumerate(whole) if number >= 0]
        out += [(i, self._merge_long(pieces[i])) for i, number in enumerate(whole) if number < 0 and len(pieces[i]) > LONG_PIECE]
        owner = np.repeat([i for i, _ in out], [len(ids) for _, ids in out]).astype(np.int64)
        ids = np.fromiter(chain.from_iterable(x for _, x in out), dtype=np.int64)
        short = [i for i, number in enumerate(whole) if number < 0 and len(pieces[i]) <= LONG_PIECE]
        more, at = self._merge_short([pieces[i] for i in short])
        owner, ids = np.concatenate([owner, np.array(short, dtype=np.int64)[at]]), np.concatenate([ids, more])
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(pieces))

    def _merge_short(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces and the piece of each id, one join per piece at a time, all pieces side by side."""
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        token, done = self.byte[raw], []
        cost = np.full(len(raw), _NONE)
        if len(raw):
            same = owner[1:] == owner[:-1]
            cost[:-1][same] = self.square[raw[:-1][same] << 8 | raw[1:][same]]
        while len(token):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.minimum.reduceat(cost, first)
            size = np.diff(first, append=len(token))
            open_ = least < _NONE
            if not open_.all():
                left = np.repeat(open_, size)
                done.append((token[~left], owner[~left]))
                token, owner, cost, least, size = token[left], owner[left], cost[left], least[open_], size[open_]
                if not len(token):
                    break
            hit = np.flatnonzero(cost == np.repeat(least, size))
            at = hit[np.concatenate([[True], owner[hit[1:]] != owner[hit[:-1]]])]
            token[at] = cost[at]
            keep = np.ones(len(token), dtype=bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            token, owner, cost = token[keep], owner[keep], cost[keep]
            for place in (at, at - 1):
                place = place[(place >= 0) & (place < len(token) - 1)]
                inside = owner[place] == owner[place + 1]
                cost[place[~inside]] = _NONE
                place = place[inside]
                cost[place] = self._joined(token[place] << 32 | token[place + 1])
            if at[-1] == len(token) - 1:
                cost[-1] = _NONE
        tokens, owners = ([np.zeros(0, dtype=np.int64), *(d[k] for d in done)] for k in (0, 1))
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(tokens)[order], owner[order]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same for one piece of any length, with a heap over linked neighbours."""
        rank, n = self.rank.get, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(cost, i, i + 2) for i in range(n - 1) if (cost := rank(piece[i:i + 2], _NONE)) != _NONE]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                end = after[after[i]]
                cost = rank(piece[i:end], _NONE)
                if cost != _NONE:
                    heapq.heappush(heap, (cost, i, end))

        while heap:
            _, i, end = heapq.heappop(heap)
            # Stale when either part has grown or is gone since.
            if after[i] < 0 or after[i] >= n or after[after[i]] != end:
                continue
            middle = after[i]
            after[i], after[middle] = end, -1
            if end < n:
                before[end] = i
            offer(before[i])
            offer(i)
        ids, i = [], 0
        while i < n:
            ids.append(self.rank[piece[i:after[i]]])
            i = after[i]
        return ids

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in one array, and how many ids each has."""
        if len(self.known) > KNOWN_PIECES:
            self.forget()
        fresh = list(set(pieces).difference(self.known))
        if fresh:
            ids, n = self.merged([piece.encode() for piece in fresh])
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(n)])
            self.pool = np.concatenate([self.pool, ids.astype(np.int32)])
        which = np.fromiter(map(self.known.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        n = (self.first[1:] - self.first[:-1])[which]
        ends = np.cumsum(n)
        return self.pool[np.repeat(self.first[which] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)], n


_ranks: dict[str, Ranks] = {}


def ranks(path: str) -> Ranks:
    """The worker's own table, kept while the worker lives."""
    if path not in _ranks:
        _ranks[path] = Ranks(path)
    return _ranks[path]


def _sizes(n: np.ndarray) -> bytes:
    """Small numbers as bytes: 255 as often as it goes in, then the rest."""
    out = np.full(int((n // 255 + 1).sum()), 255, dtype=np.uint8)
    out[np.cumsum(n // 255 + 1) - 1] = n % 255
    return out.tobytes()


def _ends(raw: bytes) -> np.ndarray:
    """The running sums of the numbers."""
    n = np.frombuffer(raw, dtype=np.uint8)
    return np.cumsum(n, dtype=np.int64)[n != 255]


def _lists(flat: np.ndarray, n: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(flat, pa.int32()))


def _per_row(many: np.ndarray, rows: list[int]) -> np.ndarray:
    """Sums of ``many`` over the next ``rows[0]``, ``rows[1]``, ... numbers."""
    total = np.concatenate([[0], np.cumsum(many)])
    edge = np.concatenate([[0], np.cumsum(rows, dtype=np.int64)])
    return total[edge[1:]] - total[edge[:-1]]


def _runs(sizes: list[int], limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Rows of about ``limit`` characters together."""
    lo = total = 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > limit:
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def _encode_whole(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    split, table = regex.compile(pattern), ranks(path)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for lo, hi in _runs([len(t) for t in texts]):
            cut = [split.findall(t) for t in texts[lo:hi]]
            ids, many = table.encode([p for pieces in cut for p in pieces])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), _lists(ids, _per_row(many, [len(c) for c in cut]))], names=["doc_id", "ids"])


def _chunks(batches: Iterator[pa.RecordBatch], size: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """``head`` and ``tail`` are the numbers of the first and the last stride of a chunk, here one and the same."""
    for batch in batches:
        for i, text in enumerate(batch.column("text").to_pylist()):
            count = max(1, -(-(len(text) - overlap) // size))
            for lo in range(0, count, 256):
                k = np.arange(lo, min(lo + 256, count))
                n, row = len(k), pa.array(np.full(len(k), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(row), batch.column("__copy").take(row), pa.array(k, pa.int32()), pa.array(k, pa.int32()),
                     pa.array(np.full(n, count), pa.int32()), pa.array([text[j * size:(j + 1) * size + overlap] if j + 1 < count else text[j * size:] for j in k.tolist()], pa.string())],
                    names=[*KEY, "head", "tail", "strides", "body"])


def _split(batches: Iterator[pa.RecordBatch], pattern: str, size: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """The lengths of the pieces of each chunk; of their ends the ones that its two junctions may meet at, counted from the start
    of the text."""
    cut = regex.compile(pattern)
    for batch in batches:
        head, tail, strides = (batch.column(k).to_numpy() for k in ("head", "tail", "strides"))
        sizes, left, right = [], [], []
        for i, body in enumerate(batch.column("body").to_pylist()):
            n = np.fromiter(map(len, cut.findall(body)), dtype=np.int64)
            end, start = np.cumsum(n), int(head[i]) * size
            sizes.append(_sizes(n))
            left.append(start + np.concatenate([[0], end[end <= overlap]]) if head[i] else end[:0])
            trusted = (end >= (int(tail[i]) + 1) * size - start) & (end + AHEAD <= len(body))
            right.append(start + end[trusted] if tail[i] + 1 < strides[i] else end[:0])
        made = [pa.array(sizes, pa.binary()), *(pa.array(x, pa.list_(pa.int64())) for x in (left, right))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "sizes", "lefts", "rights"])


_CHUNK = "doc_id bigint, __copy bigint, head int, tail int, strides int, body string"
_PIECES = f"{_CHUNK}, sizes binary, lefts array<bigint>, rights array<bigint>"


def _meetings(pieces: DataFrame) -> DataFrame:
    """``at``: the first boundary that both chunks of each junction have, null if there is none."""
    none = F.lit(None).cast("array<bigint>")
    left = pieces.where("head > 0").select(*KEY, F.col("head").alias("junction"), "lefts", none.alias("rights"))
    right = pieces.where("tail + 1 < strides").select(*KEY, (F.col("tail") + 1).alias("junction"), none.alias("lefts"), "rights")
    both = left.unionByName(right).groupBy(*KEY, "junction").agg(F.first("lefts", True).alias("lefts"), F.first("rights", True).alias("rights"))
    return both.select(*KEY, "junction", F.array_min(F.array_intersect("lefts", "rights")).alias("at"))


def _joined(pieces: DataFrame, open_ends: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The chunks left as they are, and those that become one because they share no boundary."""
    opened = open_ends.select(*KEY, F.col("junction").alias("head"), F.lit(True).alias("open"))
    heads = pieces.select(*KEY, "head").join(opened, [*KEY, "head"], "left")
    within = Window.partitionBy(*KEY).orderBy("head")
    group = F.last(F.when(F.col("open").isNull(), F.col("head")), ignorenulls=True).over(within)
    groups = heads.withColumn("group", group)
    sizes = groups.groupBy(*KEY, "group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    moved = groups.join(sizes, [*KEY, "group"]).select(*KEY, "head", "group")
    kept = pieces.join(moved, [*KEY, "head"], "left_anti")
    parts = pieces.join(moved, [*KEY, "head"]).groupBy(*KEY, "group").agg(
        F.sort_array(F.collect_list(F.struct("head", "tail", "strides", "body"))).alias("p"))
    body = F.expr(f"""concat(array_join(transform(slice(p, 1, size(p) - 1),
        x -> substring(x.body, 1, (x.tail - x.head + 1) * {size})), ''), element_at(p, -1).body)""")
    return kept, parts.select(
        *KEY, F.col("group").alias("head"), F.expr("element_at(p, -1).tail").alias("tail"), F.expr("p[0].strides").alias("strides"), body.alias("body"))


def _encode_parts(batches: Iterator[pa.RecordBatch], path: str, size: int) -> Iterator[pa.RecordBatch]:
    table = ranks(path)
    for batch in batches:
        bodies = batch.column("body").to_pylist()
        start = batch.column("head").to_numpy().astype(np.int64) * size
        entry, leave = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("entry", "leave"))
        for lo, hi in _runs([len(b) for b in bodies]):
            pieces, n = [], []
            for i in range(lo, hi):
                end = _ends(batch.column("sizes")[i].as_py())
                from_, to = int(entry[i] - start[i]), int(leave[i] - start[i]) if leave[i] >= 0 else len(bodies[i])
                own = end[(end > from_) & (end <= to)].tolist()
                pieces += [bodies[i][a:b] for a, b in zip([from_, *own], own)]
                n.append(len(own))
            ids, many = table.encode(pieces)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).slice(lo, hi - lo) for k in (*KEY, "head")), _lists(ids, _per_row(many, n))], names=[*KEY, "head", "ids"])


def encode(docs: DataFrame, path: str, pattern: str, space: Workspace, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, ids`` of every row of ``doc_id, text`` (null: empty), as the tiktoken library has them without special tokens.

    ``pattern`` may look ahead by ``AHEAD`` characters at most and not behind. Other columns are left out. Rows may share ids or
    have none; each stays a row of its own. ``size`` must be at least ``overlap``.
    """
    if not 0 < overlap <= size:
        raise ValueError("chunks must be at least as long as their overlap, and that at least 1")
    own = keyed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), space)
    is_long = F.length("text") > size + overlap
    short = unkeyed(own.where(~is_long)).mapInArrow(partial(_encode_whole, path=path, pattern=pattern), "doc_id bigint, ids array<int>")
    chunks = own.where(is_long).mapInArrow(partial(_chunks, size=size, overlap=overlap), _CHUNK)
    split = partial(_split, pattern=pattern, size=size, overlap=overlap)
    pieces = space.hold(chunks.repartition(*KEY, "head").mapInArrow(split, _PIECES), "pieces0")
    for turn in range(1, 65):
        cuts = space.hold(_meetings(pieces), f"cuts{turn}")
        open_ends = cuts.where("at is null")
        if open_ends.isEmpty():
            break
        kept, merged = _joined(pieces, open_ends, size)
        pieces = space.hold(kept.unionByName(merged.mapInArrow(split, _PIECES)), f"pieces{turn}")
    enters = cuts.select(*KEY, F.col("junction").alias("head"), F.col("at").alias("entry"))
    leaves = cuts.select(*KEY, (F.col("junction") - 1).alias("tail"), F.col("at").alias("leave"))
    spans = pieces.select(*KEY, "head", "tail").join(enters, [*KEY, "head"], "left").join(leaves, [*KEY, "tail"], "left").select(
        *KEY, "head", F.coalesce("entry", F.lit(0)).alias("entry"), F.coalesce("leave", F.lit(-1)).alias("leave"))
    parts = pieces.select(*KEY, "head", "body", "sizes").join(spans, [*KEY, "head"]).mapInArrow(
        partial(_encode_parts, path=path, size=size), "doc_id bigint, __copy bigint, head int, ids array<int>")
    long = parts.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("head", "ids"))).alias("p"))
    return short.unionByName(unkeyed(long.select(*KEY, F.flatten("p.ids").alias("ids"))))


def _decode(batches: Iterator[pa.RecordBatch], path: str, digests: bool) -> Iterator[pa.RecordBatch]:
    token = ranks(path).token
    written = [str(i).encode() for i in range(len(token))]
    for batch in batches:
        edges, ids = batch.column("ids").offsets.to_numpy(), batch.column("ids").values.to_numpy()
        rows = [ids[a:b].tolist() for a, b in zip(edges, edges[1:])]
        raw = [b"".join(map(token.__getitem__, r)) for r in rows]
        if digests:
            columns = [pa.array([len(r) for r in rows], pa.int64()),
                       pa.array([hashlib.sha256(b" ".join(map(written.__getitem__, r))).hexdigest() for r in rows], pa.string()),
                       pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        else:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(raw, pa.binary())], names=["doc_id", "bytes"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, bytes`` of every row of ``doc_id, ids``: the bytes of its ids, joined. Null ids count as none. An id that the
    table lacks is an error."""
    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(partial(_decode, path=path, digests=False), "doc_id bigint, bytes binary")


def report(docs: DataFrame, path: str, pattern: str, space: Workspace) -> DataFrame:
    """Encode, then decode; digests of both."""
    return encode(docs, path, pattern, space).mapInArrow(
        partial(_decode, path=path, digests=True), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
