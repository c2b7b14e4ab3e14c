"""Token ids of whole texts through the tokenizers library, fast for texts that share words.

Byte-level BPE never merges across the border between any character and a space that a non-blank follows, so a text
may be cut there and the parts be encoded by themselves: the ids are those of the whole text. Every part that a worker
has met is encoded by the library once and then known by its key, up to a fixed number of parts. Keys of parts of up to
seven bytes are exact; longer parts are compared byte by byte with the part that has their key, and a text with a part
whose key belongs to another goes through the library whole.

With ``added`` the literal content of an added token in a text becomes that token's id, as the library does it unless
told otherwise; without it the content of special tokens is spelled out. Cutting does not hold beside such a token, so
a text that contains one goes through the library whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from sievewright.llm.text import range_keys, same_bytes, slices

END = 2
KEPT_PARTS = 1_500_000
EXACT = 7  # bytes of a part that its key holds themselves
SLICE = 1 << 20

#: Bytes that start no blank character of Unicode. Some lead bytes are shared by blanks and other characters; a text
#: is not cut before these.
_SOLID = np.ones(256, dtype=bool)
_SOLID[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = False


class Encoder:
    """Ids of texts; ``path`` names the file of a byte-level BPE tokenizer without normalizer or added prefix space."""

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        #: What the library looks for in a text before anything else.
        self.literals = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values() if added or not x.special]
        self.joins = not any(b" " in x for x in self.literals)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max([END, *vocabulary.values()]) + 1
        self.spaced = np.zeros(self.size, dtype=bool)
        self.spaced[[i for token, i in vocabulary.items() if token[:1] == "Ġ"]] = True
        self.forget()

    def forget(self) -> None:
        #: Sorted keys, first place in the pool, number of ids, first place among the bytes, number of bytes. Small tables are
        #: merged into larger ones as they grow.
        self.known: list[tuple[np.ndarray, ...]] = []
        self.pool, self.filled = np.zeros(0, dtype=np.uint32), 0
        self.bytes, self.written = np.zeros(0, dtype=np.uint8), 0

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=np.uint32) for x in found]

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all ``parts`` in one array, in an order of its own; each part's first place there and number of ids.
        Parts whose only space is in front are encoded in lines of 100: a new one starts where an id has a space."""
        simple = [self.joins and x[0] == " " and " " not in x[1:] for x in parts]
        lined, alone = ([i for i, s in enumerate(simple) if s == kind] for kind in (True, False))
        found, n = [np.zeros(0, dtype=np.uint32)], np.zeros(len(parts), dtype=np.int64)
        lines = [lined[i:i + 100] for i in range(0, len(lined), 100)]
        for lo in range(0, len(lines), 256):
            for line, ids in zip(lines[lo:lo + 256], self.whole(["".join([parts[i] for i in g]) for g in lines[lo:lo + 256]])):
                n[line] = np.diff(np.flatnonzero(self.spaced[ids]), append=len(ids))
                found.append(ids)
        for i, ids in zip(alone, self.whole([parts[i] for i in alone])):
            n[i] = len(ids)
            found.append(ids)
        order = np.array([*lined, *alone], dtype=np.int64)
        first = np.empty(len(parts), dtype=np.int64)
        first[order] = np.cumsum(n[order]) - n[order]
        return np.concatenate(found), first, n

    def _find(self, key: np.ndarray) -> tuple[np.ndarray, ...]:
        """First place in the pool (-1: not known) and number of ids of each key, and the same of its part's bytes."""
        out = tuple(np.full(len(key), fill, dtype=np.int64) for fill in (-1, 0, 0, 0))
        for keys, *values in self.known:
            i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[i] == key
            for have, value in zip(out, values):
                have[hit] = value[i[hit]]
        return out

    @staticmethod
    def _kept(pool: np.ndarray, filled: int, more: np.ndarray) -> np.ndarray:
        if filled + len(more) > len(pool):
            pool = np.concatenate([pool[:filled], np.zeros(max(len(more), filled // 2, 1 << 20), dtype=pool.dtype)])
        pool[filled:filled + len(more)] = more
        return pool

    def _learn(self, key: np.ndarray, ids: np.ndarray, first: np.ndarray, n: np.ndarray, parts: list[bytes]) -> None:
        """``key`` is sorted and not known."""
        raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
        size = np.array([len(p) for p in parts], dtype=np.int64)
        self.pool, self.bytes = self._kept(self.pool, self.filled, ids), self._kept(self.bytes, self.written, raw)
        self.known.append((key, self.filled + first, n.astype(np.int32), self.written + np.cumsum(size) - size, size.astype(np.int32)))
        self.filled, self.written = self.filled + len(ids), self.written + len(raw)
        while len(self.known) > 1 and 2 * len(self.known[-1][0]) > len(self.known[-2][0]):
            last = self.known.pop()
            both = [np.concatenate(x) for x in zip(self.known.pop(), last)]
            order = np.argsort(both[0], kind="stable")
            self.known.append(tuple(x[order] for x in both))

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice of texts and the bounds of each text's ids."""
        rows = self._literal(data, bounds)
        while True:
            kept, edges = self._without(rows, data, bounds) if len(rows) else (data, bounds)
            ids, ends, strange = self._encode_cut(kept, edges)
            if not len(strange):
                break
            rows = np.union1d(rows, strange)
        if not len(rows):
            return ids, ends
        raw = data.tobytes()
        found = self.whole([raw[bounds[i]:bounds[i + 1]].decode() for i in rows.tolist()])
        many, n = np.array([len(x) for x in found]), np.diff(ends)
        n[rows] = many
        return np.insert(ids, np.repeat(ends[rows], many), np.concatenate(found)), np.concatenate([[0], np.cumsum(n)])

    @staticmethod
    def _without(rows: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts with those of some rows made empty."""
        size = np.diff(bounds)
        left = np.ones(len(size), dtype=bool)
        left[rows] = False
        return data[np.repeat(left, size)], np.concatenate([[0], np.cumsum(np.where(left, size, 0))])

    def _literal(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The texts that contain an added token; a few more may be among them."""
        raw, at = data.tobytes() if self.literals else b"", []
        for literal in self.literals:
            place = raw.find(literal)
            while place >= 0:
                row = int(np.searchsorted(bounds, place, side="right")) - 1
                at.append(row)
                place = raw.find(literal, int(bounds[row + 1]))
        return np.unique(np.array(at, dtype=np.int64))

    def _encode_cut(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``encode``, and the rows that have a part whose key belongs to other bytes; if there are any, without ids."""
        nothing = np.zeros(0, dtype=np.int64)
        if not len(data):
            return nothing.astype(np.uint32), np.zeros(len(bounds), dtype=np.int64), nothing
        if sum(len(x[0]) for x in self.known) > KEPT_PARTS:
            self.forget()
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[:-2] = (data[:-1] == 0x20) & _SOLID[data[1:]]
        cut[bounds[1:][bounds[1:] > 0] - 1] = False
        cut[bounds] = True
        edges = np.flatnonzero(cut)
        start, end = edges[:-1], edges[1:]
        key, example, which = np.unique(range_keys(data, start, end), return_index=True, return_inverse=True)
        at, n, place, size = self._find(key)
        long = np.flatnonzero(end - start > EXACT)
        mine = example[which[long]]
        strange = long[~same_bytes(data, start[long], end[long], data, start[mine], end[mine])]
        known = np.flatnonzero((at >= 0) & (end[example] - start[example] > EXACT))
        parts = example[known]
        other = known[~same_bytes(data, start[parts], end[parts], self.bytes, place[known], place[known] + size[known])]
        if len(strange) or len(other):
            strange = np.union1d(strange, np.flatnonzero(np.isin(which, other)))
            return nothing.astype(np.uint32), nothing, np.unique(np.searchsorted(bounds, start[strange], side="right") - 1)
        new = np.flatnonzero(at < 0)
        if len(new):
            raw = data.tobytes()
            parts = [raw[a:b] for a, b in zip(start[example[new]].tolist(), end[example[new]].tolist())]
            self._learn(key[new], *self._encode_parts([p.decode() for p in parts]), parts)
            at, n, _, _ = self._find(key)
        n = n[which]
        ends = np.cumsum(n)
        ids = self.pool[np.repeat(at[which] - (ends - n), n) + np.arange(ends[-1])]
        return ids, np.concatenate([[0], ends])[np.searchsorted(start, bounds)], nothing


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, added: bool = False) -> Encoder:
    """The worker's own encoder, kept while the worker lives."""
    if (path, added) not in _encoders:
        _encoders[path, added] = Encoder(path, added)
    return _encoders[path, added]


def documents(batch: pa.RecordBatch, path: str, text: str = "text", added: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of a batch: first row, row after the last, their ids with the end id after each, bounds."""
    coder = encoder(path, added)
    for lo, hi, data, bounds in slices(batch.column(text), SLICE):
        ids, edges = coder.encode(data, bounds)
        yield lo, hi, np.insert(ids, edges[1:], np.uint32(END)), edges + np.arange(len(edges))
