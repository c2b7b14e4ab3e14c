"""Best-fit packing by exact complements.

Only lengths decide where a piece goes, so the plan is made from the number of pieces of each length: at most one
number per token of capacity, whatever the corpus. Sums of one, two and three available lengths are indexed by hash. Longest
first, the plan looks up the gap that a piece leaves and uses the combination that fills it exactly as often as the counts allow; the
index is made anew whenever some lengths have run out. What is left is packed best fit, longest first, in whole classes of equal
pieces and equal gaps. Pieces then find their places by their number within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.numbering import numbered
from sievewright.llm.text import add_columns, widened
from sievewright.llm.tokens import documents
from sievewright.storage import Workspace

CAPACITY = 1024
#: Lengths that may run out before the index of sums is made anew.
REBUILD = 64


class Plan:
    """Runs of equal pieces: the pieces ``rank .. rank + n - 1`` of ``length`` go to the sequences from ``sequence``
    on, one each, at ``offset``."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        if any(not 0 < length <= capacity for length in counts):
            raise ValueError(f"lengths must be 1 to {capacity}")
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.used = np.zeros(capacity + 1, dtype=np.int64)
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self._exact()
        self._best_fit()

    def _put(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.runs.append((length, int(self.used[length]), n, sequence, offset))
        self.used[length] += n
        self.left[length] -= n

    def _fill(self, lengths: tuple[int, ...]) -> None:
        """As many sequences of these lengths as there are pieces for."""
        n = min(int(self.left[x]) // lengths.count(x) for x in lengths)
        offset = 0
        for x in lengths:
            self._put(x, n, self.sequences, offset)
            offset += x
        self.sequences += n

    def _index(self) -> None:
        """Sums of two and of three available lengths, hashed: to the longer lengths of the pairs with that sum, and to the longest
        lengths whose rest is the sum of a pair. Longest first. Lengths run out and never come back, so an index made earlier
        holds all there is, and each hit is checked against the counts."""
        lengths = np.flatnonzero(self.left)[::-1]
        self.pairs: dict[int, np.ndarray] = {}
        self.triples: dict[int, np.ndarray] = {}
        for total in range(2, self.capacity):
            long = lengths[(lengths < total) & (2 * lengths >= total)]
            if len(long := long[self._there(long, total)]):
                self.pairs[total] = long
        for total in range(3, self.capacity):
            longest = lengths[(lengths < total) & (3 * lengths >= total)]
            if len(longest := longest[np.array([total - x in self.pairs for x in longest.tolist()], dtype=bool)]):
                self.triples[total] = longest

    def _there(self, long: np.ndarray, total: int) -> np.ndarray:
        """Are both lengths of a pair left, if they are equal two of them?"""
        return (self.left[long] > 0) & (self.left[total - long] > (2 * long == total))

    def _two(self, total: int, most: int) -> tuple[int, int] | None:
        """Two available lengths with this sum, the longer at most ``most``; the most unequal ones first."""
        if (long := self.pairs.get(total)) is None:
            return None
        fits = self._there(long, total) & (long <= most)
        return (int(long[fits.argmax()]), total - int(long[fits.argmax()])) if fits.any() else None

    def _three(self, total: int) -> tuple[int, ...] | None:
        for x in self.triples.get(total, np.zeros(0, dtype=np.int64)).tolist():
            if not self.left[x] or total - x not in self.pairs:
                continue
            self.left[x] -= 1
            two = self._two(total - x, x)
            self.left[x] += 1
            if two:
                return (x, *two)
        return None

    def _complement(self, length: int) -> tuple[int, ...] | None:
        gap = self.capacity - length
        self.left[length] -= 1  # the piece whose gap is to be filled
        try:
            if gap == 0 or self.left[gap]:
                return (gap,) if gap else ()
            return self._two(gap, gap) or self._three(gap)
        finally:
            self.left[length] += 1

    def _exact(self) -> None:
        gone = REBUILD
        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                if gone >= REBUILD:
                    self._index()
                    gone = 0
                if (rest := self._complement(length)) is None:
                    break
                self._fill((length, *rest))
                gone += sum(not self.left[x] for x in {length, *rest})

    def _best_fit(self) -> None:
        gaps: dict[int, list[tuple[int, int]]] = {}  # free tokens: first sequence, number of sequences
        wide = np.zeros(self.capacity + 1, dtype=bool)

        def leave(gap: int, sequence: int, n: int) -> None:
            if n:
                gaps.setdefault(gap, []).append((sequence, n))
                wide[gap] = True

        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                n, gap = int(self.left[length]), length + int(wide[length:].argmax())
                if wide[gap]:
                    sequence, many = gaps[gap].pop()
                    wide[gap] = bool(gaps[gap])
                    k = min(n, many)
                    self._put(length, k, sequence, self.capacity - gap)
                    leave(gap, sequence + k, many - k)
                    leave(gap - length, sequence, k)
                else:
                    each = self.capacity // length
                    k = max(1, n // each)
                    fit = min(each, n)
                    for i in range(fit):
                        self._put(length, k, self.sequences, i * length)
                    leave(self.capacity - fit * length, self.sequences, k)
                    self.sequences += k

    def table(self) -> np.ndarray:
        """The runs, ordered by length and rank."""
        runs = np.array(self.runs, dtype=np.int64).reshape(-1, 5)
        runs = runs[runs[:, 2] > 0]
        return runs[np.lexsort((runs[:, 1], runs[:, 0]))]


def _place(batches: Iterator[pa.RecordBatch], runs: np.ndarray) -> Iterator[pa.RecordBatch]:
    widest = int(runs[:, 1].max(initial=0)) + 1
    keys = runs[:, 0].astype(object) * widest + runs[:, 1].astype(object)
    small = not len(keys) or keys[-1] < 1 << 62
    keys = keys.astype(np.int64) if small else keys
    for batch in batches:
        length, rank = (batch.column(k).to_numpy() for k in ("length", "__rank"))
        want = length * widest + np.minimum(rank, widest - 1) if small else length.astype(object) * widest + rank
        run = np.searchsorted(keys, want, side="right") - 1
        yield add_columns(batch, {
            "sequence_id": pa.array(runs[run, 3] + rank - runs[run, 1]), "offset": pa.array(runs[run, 4]),
        })


def pack(pieces: DataFrame, space: Workspace, capacity: int = CAPACITY) -> DataFrame:
    """All columns of ``pieces``, ``sequence_id`` and ``offset``: the pieces of a sequence follow each other without
    gaps and have at most ``capacity`` tokens together. ``length`` (1 to ``capacity``, no null) is their size.

    Equal rows get places of their own. Only the number of pieces of each length goes to the driver. The pieces are
    written before they are numbered: in one task, the worker that encodes and the one that counts would both stay, and
    each would come to hold an encoder.
    """
    cut = space.hold(pieces.withColumn("length", F.col("length").cast("bigint")), "cut")
    ranked, totals = numbered(cut, "length", "__rank", space, "pieces")
    runs = Plan({r["length"]: r["rows"] for r in totals.collect()}, capacity).table()
    return ranked.mapInArrow(partial(_place, runs=runs), widened(ranked, "sequence_id bigint, offset bigint")).drop("__rank")


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, keep_ids: bool, added: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, ids, bounds in documents(batch, path, added=added):
            size = np.diff(bounds)
            pieces = -(-size // capacity)
            row = np.repeat(np.arange(hi - lo), pieces)
            number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head = size - (pieces - 1) * capacity  # the first piece takes what whole pieces leave
            start = np.where(number == 0, 0, head[row] + (number - 1) * capacity)
            length = np.where(number == 0, head[row], capacity)
            raw, at = ids.astype("<u4").tobytes(), 4 * (bounds[row] + start)
            parts = [raw[a:b] for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
            columns = {
                "doc_id": batch.column("doc_id").slice(lo, hi - lo).take(pa.array(row)), "piece": pa.array(number.astype(np.int32)),
                "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array([zlib.crc32(x) for x in parts], pa.int64()),
            }
            if keep_ids:
                columns["ids"] = pa.array([np.frombuffer(x, dtype="<i4") for x in parts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False, added: bool = False) -> DataFrame:
    """The token ids of whole texts (null: empty) with id 2 at the end, cut where they exceed ``capacity``. ``added``: see ``tokens``."""
    id_type = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids
    cut = partial(_cut, path=tokenizer, capacity=capacity, keep_ids=keep_ids, added=added)
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids``: the packed sequences, from pieces that kept their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
