"""Token ids in binary blocks: canonical length-limited Huffman codes from global counts.

Layout of a file set, two folders of Parquet files, so that Spark commits them whole and any executor can read any block:

* ``codebook``: ``id, bits``, the code length of each id that occurs. Codes are canonical: by length, then by id.
* ``blocks``: one row per block, in ascending document order by ``start`` (ids before the block), through the files by name and within
  each. A block holds whole documents
  and decodes by itself: ``doc_ids``, ``counts`` (ids of each), ``payload`` (codes, highest bit first) and ``steps``
  (bits of each run of 128 ids, 16 bits each: their running sums are the bit offsets where decoding can start).

All runs of a block are decoded side by side, one id of each at a time, by one look-up in a table of all bit patterns.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm.tokens import documents, encoder
from sievewright.storage import Workspace

LONGEST = 20
RUN = 128
BLOCK_IDS = 1 << 18
FILE_BLOCKS = 16
MOST_FILES = 20_000


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits (package-merge); 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids do not fit codes of {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    levels, packed = [], np.zeros(0, dtype=np.int64)
    for _ in range(longest):
        both = np.concatenate([weight, packed])
        rank = np.argsort(both, kind="stable")
        levels.append(rank < len(weight))
        both = both[rank]
        even = len(both) // 2 * 2
        packed = both[0:even:2] + both[1:even:2]
    bits, need = np.zeros(len(order), dtype=np.uint8), 2 * len(order) - 2
    for leaf in reversed(levels):
        leaves = int(leaf[:need].sum())
        bits[:leaves] += 1
        need = 2 * (need - leaves)
    out[order] = bits
    return out


def canonical(bits: np.ndarray) -> np.ndarray:
    """The code of each id, given the code lengths."""
    codes = np.zeros(len(bits), dtype=np.uint64)
    code = last = 0
    for i in np.lexsort((np.arange(len(bits)), bits)):
        if bits[i]:
            code <<= int(bits[i]) - last
            codes[i], code, last = code, code + 1, int(bits[i])
    return codes


def pack_bits(ids: np.ndarray, codes: np.ndarray, bits: np.ndarray) -> tuple[bytes, bytes]:
    """Payload and steps of a block."""
    width = bits[ids].astype(np.int64)
    ends = np.cumsum(width)
    total = int(ends[-1]) if len(ends) else 0
    at = ends - width
    value = codes[ids] << (64 - (at & 31) - width).astype(np.uint64)
    words = np.zeros(total // 32 + 2, dtype=np.uint64)
    # Codes of one word share no bit, so sums of up to 32 bits join them; a float64 holds those exactly.
    words += np.bincount(at >> 5, (value >> np.uint64(32)).astype(np.float64), len(words)).astype(np.uint64)
    words += np.bincount((at >> 5) + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), len(words)).astype(np.uint64)
    marks = np.concatenate([at[::RUN], [total]])
    return words.astype(">u4").tobytes()[:(total + 7) // 8], np.diff(marks).astype("<u2").tobytes()


class Decoder:
    def __init__(self, bits: np.ndarray):
        self.width = max(1, int(bits.max(initial=0)))
        codes = canonical(bits).astype(np.int64)
        self.ids, self.bits = np.zeros(1 << self.width, dtype=np.uint32), np.zeros(1 << self.width, dtype=np.uint8)
        used = np.flatnonzero(bits)
        used = used[np.argsort(codes[used] << (self.width - bits[used].astype(np.int64)), kind="stable")]
        span = 1 << (self.width - bits[used].astype(np.int64))
        n = int(span.sum())
        self.ids[:n], self.bits[:n] = np.repeat(used, span), np.repeat(bits[used], span)

    def block(self, payload: bytes, steps: bytes, n: int) -> np.ndarray:
        step = np.frombuffer(steps, dtype="<u2").astype(np.int64)
        at = np.cumsum(step) - step
        data = np.frombuffer(payload + bytes(RUN * LONGEST // 8 + 8), dtype=np.uint8).astype(np.uint32)
        window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        out = np.empty((RUN, len(at)), dtype=np.uint32)
        for i in range(RUN):
            pattern = (window[at >> 3] >> (32 - self.width - (at & 7)).astype(np.uint32)) & np.uint32((1 << self.width) - 1)
            out[i] = self.ids[pattern]
            at += self.bits[pattern]
        return out.T.ravel()[:n]


def _encode(batches: Iterator[pa.RecordBatch], path: str, added: bool) -> Iterator[pa.RecordBatch]:
    part, before = TaskContext.get().partitionId(), 0
    kind = "<u2" if encoder(path, added).size <= 1 << 16 else "<u4"
    for batch in batches:
        for lo, hi, ids, bounds in documents(batch, path, added=added):
            n = hi - lo
            raw = ids.astype(kind)
            at = bounds * raw.itemsize
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, n), pa.array(np.full(n, part, dtype=np.int32)), pa.array(before + bounds[:-1]),
                 pa.array(np.diff(bounds)), pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)])],
                names=["doc_id", "part", "first", "n_tokens", "ids"],
            )
            before += int(bounds[-1])


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    """All ids of a batch of ``ids, n_tokens`` in one array."""
    column = batch.column("ids")
    at = np.frombuffer(column.buffers()[1], dtype=np.int32, count=column.offset + len(column) + 1)[column.offset:]
    raw = np.frombuffer(column.buffers()[2], dtype=np.uint8)[at[0]:at[-1]]
    n = int(batch.column("n_tokens").to_numpy().sum())
    return raw.view("<u2" if len(raw) == 2 * n else "<u4").astype(np.int64)


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, dtype=np.int64)
    for batch in batches:
        more = np.bincount(_ids(batch), minlength=len(counts)) if len(batch) else counts[:0]
        more[:len(counts)] += counts[:len(more)]
        counts = more if len(more) >= len(counts) else counts
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["id", "n"])


def _to_blocks(batches: Iterator[pa.RecordBatch], bits: np.ndarray, offsets: dict[int, int], size: int) -> Iterator[pa.RecordBatch]:
    codes = canonical(bits)
    for batch in batches:
        counts, part = batch.column("n_tokens").to_numpy(), batch.column("part").to_numpy()
        first = batch.column("first").to_numpy()
        # A block ends with its part, or with the document that brings it to its size.
        group = np.cumsum(counts) // size
        cut = np.flatnonzero((np.diff(part) != 0) | (np.diff(group) != 0) | (np.diff(first) != counts[:-1])) + 1
        edges = [0, *cut.tolist(), len(batch)] if len(batch) else [0]
        rows = []
        for lo, hi in zip(edges, edges[1:]):
            ids = _ids(batch.slice(lo, hi - lo))
            payload, steps = pack_bits(ids, codes, bits)
            rows.append((offsets[int(part[lo])] + int(first[lo]), payload, steps))
        doc_ids = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), batch.column("doc_id"))
        n = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(counts))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), doc_ids, n,
             pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
            names=["start", "doc_ids", "counts", "payload", "steps"],
        )


def write(docs: DataFrame, tokenizer: str, path: str, space: Workspace, added: bool = False, block_ids: int = BLOCK_IDS) -> None:
    """Encode every text of ``doc_id, text`` (null: empty), append id 2, and write the ids below ``path`` in ascending
    ``doc_id`` order. Null ids come first; documents that share an id follow each other, each as one of its own.
    ``added``: see ``tokens``.

    The texts are shuffled once, by ranges of ids; their ids are held, counted and then coded, and the coded blocks go to
    their files. Only the counts of the vocabulary and one number per part go to the driver.
    """
    placed = docs.select("doc_id", "text").withColumn("__row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("__row")]
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    id_type = dict(docs.dtypes)["doc_id"]
    held = space.hold(ranged.mapInArrow(
        partial(_encode, path=tokenizer, added=added), f"doc_id {id_type}, part int, first bigint, n_tokens bigint, ids binary"), "ids")
    found = held.select("n_tokens", "ids").mapInArrow(_histogram, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([0, *(r["id"] + 1 for r in found)]), dtype=np.int64)
    for r in found:
        counts[r["id"]] = r["n"]
    bits = code_lengths(counts)
    offsets, total = {}, 0
    for r in held.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        offsets[r["part"]], total = total, total + r["n"]
    blocks = held.mapInArrow(
        partial(_to_blocks, bits=bits, offsets=offsets, size=block_ids),
        f"start bigint, doc_ids array<{id_type}>, counts array<bigint>, payload binary, steps binary")
    # Into files by ranges of the first id, whose border numbers are known: no sampling, and each file in order.
    files = min(MOST_FILES, max(1, -(-total // (FILE_BLOCKS * block_ids))))
    file = F.floor(F.col("start") / F.lit(max(1, -(-total // files)))).cast("int")
    blocks = blocks.repartitionById(files, file).sortWithinPartitions("start")
    used = np.flatnonzero(bits)
    spark = docs.sparkSession
    spark.createDataFrame([(int(i), int(bits[i])) for i in used], "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _decode(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(bits)
    for batch in batches:
        for i in range(len(batch)):
            counts = batch.column("counts")[i].values.to_numpy()
            n = int(counts.sum())
            ids = decoder.block(batch.column("payload")[i].as_py(), batch.column("steps")[i].as_py(), n)
            edges = np.concatenate([[0], np.cumsum(counts)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_ids")[i].values, pa.array(batch.column("start")[i].as_py() + edges[:-1]), pa.array(counts),
                 pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids.astype(np.int32)))],
                names=["doc_id", "start", "n_tokens", "ids"],
            )


def _open(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray, str]:
    book = spark.read.parquet(f"{path}/codebook").collect()
    bits = np.zeros(max([0, *(r["id"] + 1 for r in book)]), dtype=np.uint8)
    for r in book:
        bits[r["id"]] = r["bits"]
    blocks = spark.read.parquet(f"{path}/blocks")
    return blocks, bits, blocks.schema["doc_ids"].dataType.elementType.simpleString()


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files below ``path``."""
    blocks, bits, id_type = _open(spark, path)
    return blocks.mapInArrow(partial(_decode, bits=bits), f"doc_id {id_type}, start bigint, n_tokens bigint, ids array<int>")


def _digest(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in _decode(batches, bits):
        edges = batch.column("ids").offsets.to_numpy().astype(np.int64) * 4
        raw = batch.column("ids").values.to_numpy().astype("<u4").tobytes()
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(edges.tolist(), edges[1:].tolist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def digests(spark: SparkSession, path: str) -> DataFrame:
    """As ``read``, with the CRC-32 of the ids as little-endian unsigned 32-bit integers in place of the ids."""
    blocks, bits, id_type = _open(spark, path)
    return blocks.mapInArrow(partial(_digest, bits=bits), f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")
