"""Hard-negative mining with exact integer scores by the method of the four Russians.

Vectors become integers. Candidates are packed in blocks as bit planes: for eight dimensions at a time, one byte per row
and plane holds one bit of each of the eight components. For every anchor and every eight dimensions a table lists the sums of
all 256 subsets of its components, so the byte of a plane looks up what that plane adds, and shifting the running sum by
one bit from plane to plane gives the exact product. The highest plane is the sign and counts negative.

Two passes over the candidates, against anchors in broadcast parts of bounded size: the first looks only at rows of the anchor's
label and leaves the best positives, the second at all other rows and leaves the best negatives inside each positive's window.
Every block leaves a few rows per anchor, of which Spark keeps the first by score and id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.storage import Workspace

CANDIDATES = 4096
ANCHORS = 128
#: Bytes of anchors that every executor may hold at a time; more go in parts.
PART_BYTES = 32 << 20
_LOWEST = np.iinfo(np.int64).min


def taking_part(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, label, parts``: components as ``floor(scale * x)``, x as double. Rows with a null id, label or vector, or with a null
    or non-finite component, take no part."""
    x = F.expr("transform(embedding, x -> cast(x as double))")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), x.alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    return rows.select("vec_id", "label", F.transform("x", lambda v: F.floor(v * scale)).alias("parts"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of integers; shorter ones are filled with zeros."""
    edges, flat = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy()
    n = np.diff(edges)
    out = np.zeros((len(n), int(n.max(initial=0))), dtype=np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(edges[0], edges[-1]) - edges[:-1][row]] = flat[edges[0]:edges[-1]]
    return out


def bit_planes(parts: np.ndarray) -> np.ndarray:
    """Bytes by plane, eight dimensions and row: bit ``j`` of a byte is that plane's bit of dimension ``j``. The highest plane is the
    sign of two's complement; there are as many as the largest component needs."""
    n, dims = parts.shape
    planes = max(int(x).bit_length() for x in (parts.max(initial=0), ~parts.min(initial=0))) + 1
    if planes > 63:
        raise OverflowError("a component does not fit in 63 bits")
    padded = np.zeros((n, -(-dims // 8) * 8), dtype=np.int64)
    padded[:, :dims] = parts
    bits = (padded[None] >> np.arange(planes)[:, None, None]) & 1
    packed = np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")
    return np.ascontiguousarray(packed.transpose(0, 2, 1))


def subset_sums(parts: np.ndarray) -> np.ndarray:
    """For each eight dimensions, 256 rows with one sum per anchor."""
    n, dims = parts.shape
    padded = np.zeros((n, -(-dims // 8) * 8), dtype=np.int64)
    padded[:, :dims] = parts
    groups = padded.reshape(n, -1, 8)
    out = np.zeros((groups.shape[1], 256, n), dtype=np.int64)
    for j in range(8):
        out[:, 1 << j:2 << j] = out[:, :1 << j] + groups[:, :, j].T[:, None]
    return out


def scores(tables: np.ndarray, planes: np.ndarray, rows: int = 512) -> np.ndarray:
    """Exact products, candidates by anchors. Dimensions that only one side has count as zero."""
    groups, top = min(len(tables), planes.shape[1]), len(planes) - 1
    reach = int(np.abs(tables).max(axis=(1, 2), initial=0).sum()) << len(planes)
    if reach >= 1 << 63:
        raise OverflowError("a score does not fit in 63 bits")
    tables = tables.astype(np.int32 if reach < 1 << 31 else np.int64)
    out = np.zeros((planes.shape[2], tables.shape[2]), dtype=np.int64)
    for lo in range(0, len(out), rows):  # few enough to stay in the cache
        total = np.zeros((min(rows, len(out) - lo), out.shape[1]), dtype=tables.dtype)
        for b in range(top, -1, -1):
            if b < top:
                total <<= 1
            for g in range(groups):
                looked_up = tables[g][planes[b, g, lo:lo + rows]]
                (np.subtract if b == top else np.add)(total, looked_up, out=total)
        out[lo:lo + rows] = total
    return out


_PACKED = "row bigint, vec_id bigint, label bigint, parts array<bigint>"
_BLOCK = "block bigint, n int, planes int, ids binary, labels binary, rows binary, payload binary"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 40
    for batch in batches:
        row = pa.array(np.arange(first, first + len(batch)))
        first += len(batch)
        yield pa.RecordBatch.from_arrays([row, *batch.columns], names=["row", *batch.schema.names])


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of ``size`` rows, the last may have fewer."""
    held, n = [], 0
    for batch in batches:
        while len(batch):
            take = min(size - n, len(batch))
            held.append(batch.slice(0, take))
            batch, n = batch.slice(take), n + take
            if n == size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _pack(batches: Iterator[pa.RecordBatch], size: int, anchors: bool) -> Iterator[pa.RecordBatch]:
    """One row per block; its rows are ordered by label and then by id. Anchors keep their numbers, candidates become bit planes."""
    block = TaskContext.get().partitionId() << 40
    for batch in _gathered(batches, size):
        row, vec, label = (batch.column(k).to_numpy() for k in ("row", "vec_id", "label"))
        order = np.lexsort((row, vec, label))
        parts = _matrix(batch.column("parts"))[order]
        body = parts if anchors else bit_planes(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([len(order)], pa.int32()), pa.array([0 if anchors else len(body)], pa.int32()),
             *(pa.array([x[order].astype(np.int64).tobytes()], pa.binary()) for x in (vec, label, row)), pa.array([body.tobytes()], pa.binary())],
            names=["block", "n", "planes", "ids", "labels", "rows", "payload"])
        block += 1


class _Block:
    def __init__(self, batch: pa.RecordBatch, i: int, side: str):
        def of(name: str) -> bytes:
            return batch.column(side + name)[i].as_py()

        self.n, planes = of("n"), of("planes")
        self.ids, self.labels, self.rows = (np.frombuffer(of(k), dtype=np.int64) for k in ("ids", "labels", "rows"))
        body = of("payload")
        self.body = np.frombuffer(body, dtype=np.uint8).reshape(planes, -1, self.n) if planes else np.frombuffer(body, dtype=np.int64).reshape(self.n, -1)

    def labelled(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]).tolist())


class _Anchors(_Block):
    """A block of anchors with its tables, and the score of the positive of each anchor's place and turn."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        super().__init__(batch, i, "a_")
        self.tables = subset_sums(self.body)
        wanted = batch.column("wanted")[i].as_py() if "wanted" in batch.schema.names else []
        place = {row: k for k, row in enumerate(self.rows.tolist())}
        self.place = np.array([place[w["anchor"]] for w in wanted], dtype=np.int64)
        self.turn, self.score = (np.array([w[k] for w in wanted], dtype=np.int64) for k in ("turn", "positive_score"))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Anchors, _Block]]:
    """The tables of a block of anchors are made once while its pairs are near each other."""
    made: dict[int, _Anchors] = {}
    for batch in batches:
        for i in range(len(batch)):
            number = batch.column("a_block")[i].as_py()
            if number not in made:
                if len(made) > 8:
                    made.clear()
                made[number] = _Anchors(batch, i)
            yield made[number], _Block(batch, i, "")


def _first(values: np.ndarray, count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each row the largest value and its place, ``count`` times; the leftmost of equals first. ``values`` is used up."""
    at = np.arange(len(values))
    for _ in range(min(count, values.shape[1])):
        best = values.argmax(axis=1)
        yield best, values[at, best]
        values[at, best] = _LOWEST


def _positives(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    for anchors, candidates in _pairs(batches):
        found = []
        for label in np.unique(anchors.labels).tolist():
            mine, theirs = anchors.labelled(label), candidates.labelled(label)
            if theirs.start == theirs.stop:
                continue
            got = scores(anchors.tables[:, :, mine], candidates.body[:, :, theirs]).T.copy()
            got[anchors.rows[mine][:, None] == candidates.rows[theirs][None]] = _LOWEST
            for best, value in _first(got, count):
                real = value > _LOWEST
                found.append((anchors.rows[mine][real], candidates.ids[theirs][best][real], candidates.rows[theirs][best][real], value[real]))
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in zip(*found)], names=["anchor", "positive_id", "positive", "positive_score"])


def _negatives(batches: Iterator[pa.RecordBatch], count: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    for anchors, candidates in _pairs(batches):
        got = scores(anchors.tables, candidates.body).T.copy()
        for label in np.unique(anchors.labels).tolist():
            got[anchors.labelled(label), candidates.labelled(label)] = _LOWEST
        # Blocks order their rows by label; equal scores go by id.
        by_id = np.lexsort((candidates.rows, candidates.ids))
        got, found = got[:, by_id], []
        for turn in np.unique(anchors.turn).tolist():
            own = anchors.turn == turn
            mine, positive = anchors.place[own], anchors.score[own]
            least, most = -(-low * positive // 100), high * positive // 100
            values = got[mine]
            values[(values < least[:, None]) | (values > most[:, None])] = _LOWEST
            for best, value in _first(values, count):
                real = value > _LOWEST
                found.append((anchors.rows[mine][real], np.full(int(real.sum()), turn, dtype=np.int32), candidates.ids[by_id][best][real], candidates.rows[by_id][best][real], value[real]))
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in zip(*found)], names=["anchor", "turn", "negative_id", "negative", "negative_score"])


def _against(candidates: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every block of candidates with every block of the anchors, which are broadcast in parts of bounded size. No anchors: no rows."""
    sizes = anchors.select("block", (F.octet_length("payload") + 24 * F.col("n")).alias("bytes")).orderBy("block").collect()
    parts: list[list[int]] = [[]]
    room = PART_BYTES
    for r in sizes:
        if parts[-1] and r["bytes"] > room:
            parts.append([])
            room = PART_BYTES
        parts[-1].append(r["block"])
        room -= r["bytes"]
    named = anchors.select(*[F.col(c).alias(c if c == "wanted" else f"a_{c}") for c in anchors.columns])
    return reduce(DataFrame.unionAll, (
        candidates.withColumn("a_block", F.explode(F.lit(part).cast("array<bigint>"))).join(
            F.broadcast(named.where(F.col("a_block").isin(part))), "a_block") for part in parts))


def mine(rows: DataFrame, is_anchor: Column, space: Workspace, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         block: int = CANDIDATES, anchor_block: int = ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows of ``vec_id, label, parts`` where
    ``is_anchor`` holds.

    Positives are the ``positives`` best other rows of the anchor's label; a negative of another label has ``low`` to ``high`` percent
    of its positive's score. Equal scores go by id. Rows that share an id are rows of their own (an anchor's copy can be its
    positive), equal ids in any order, always the same one within a run. Vectors of different length: missing components count as zero.
    """
    numbered = space.hold(rows.select("vec_id", "label", "parts").mapInArrow(_numbered, _PACKED), "rows")
    total = numbered.count()
    blocks = max(1, -(-total // block))
    dealt = numbered.repartition(blocks, "row")
    candidates = space.hold(dealt.mapInArrow(partial(_pack, size=block, anchors=False), _BLOCK), "candidates").repartition(blocks, "block")
    chosen = numbered.where(is_anchor)
    few = max(1, -(-chosen.count() // (64 * anchor_block)))
    anchors = space.hold(chosen.repartition(few, "row").mapInArrow(partial(_pack, size=anchor_block, anchors=True), _BLOCK), "anchors")
    found = _against(candidates, anchors).mapInArrow(
        partial(_positives, count=positives), "anchor bigint, positive_id bigint, positive bigint, positive_score bigint")
    best = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "positive")
    kept = space.hold(found.withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= positives), "positives")
    # Which block an anchor stands in: its numbers are read back from the block's row.
    places = anchors.select("block", "rows").mapInArrow(_unpacked, "block bigint, anchor bigint")
    wanted = kept.join(places, "anchor").groupBy("block").agg(F.collect_list(F.struct("anchor", "turn", "positive_score")).alias("wanted"))
    asked = space.hold(anchors.join(wanted, "block"), "asked")
    against = _against(candidates, asked).mapInArrow(
        partial(_negatives, count=negatives, low=low, high=high), "anchor bigint, turn int, negative_id bigint, negative bigint, negative_score bigint")
    nearest = Window.partitionBy("anchor", "turn").orderBy(F.desc("negative_score"), "negative_id", "negative")
    ranked = against.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= negatives)
    ids = chosen.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return ranked.join(kept, ["anchor", "turn"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.frombuffer(x, dtype=np.int64) for x in batch.column("rows").to_pylist()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("block").to_numpy(), [len(r) for r in rows])), pa.array(np.concatenate(rows))], names=["block", "anchor"])


def report(embeddings: DataFrame, space: Workspace) -> DataFrame:
    """Anchors are the rows whose id is divisible by 50; the label of every seventh id is off by one, as planted errors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(taking_part(embeddings).withColumn("label", label), F.col("vec_id") % 50 == 0, space)


SQL = """
WITH v AS (
  SELECT vec_id::BIGINT AS vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same, list_inner_product(a.q, c.q)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, n.other AS negative_id, positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.other)
QUALIFY row_number() OVER w <= 3
"""
