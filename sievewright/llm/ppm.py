"""LM scoring by prediction by partial matching over bytes.

A context trie of fixed order, learned from the training documents, gives every byte a probability: the longest known
context predicts it, or escapes to the next shorter one (escape method C: as likely as the number of different symbols seen
there), where the symbols of the longer context are excluded; below the shortest, all symbols left are equally likely.
The model is complete before scoring, so the cost of a byte depends on its context alone.

The trie is a set of tables, one per order, each a count per (context, symbol) gram. A gram of ``ORDER + 1`` symbols of
nine bits is one number, and a shorter context is its remainder. So the trie is built by grouping and its costs by joins of each
order with the next shorter one. Documents are dealt to blocks of bounded size. A block lists the grams and words it has,
these lists meet the counts of the corpus in a shuffle, and each block gets back the costs it needs: no
model is broadcast, whatever its size, and nothing is pruned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.text import mixed, range_keys, remainder, slices, word_bounds
from sievewright.storage import Workspace

ORDER = 5
BLOCK_BYTES = 32 << 20
SLICE_BYTES = 1 << 19
_BITS = 9
_STOP, _BEGIN = 256, 257  # the symbol after the last byte, and what stands before the first
#: Grams, words and the count of ends share one key column: grams are below this number, word hashes are negative.
_END = 1 << 62
_NO_KEY = np.int64(np.iinfo(np.int64).max)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every byte and stop of a slice of texts, and the bounds of each text's grams."""
    n = len(bounds) - 1
    # Each text: ORDER begins, its bytes, the stop.
    edges = bounds + np.arange(n + 1) * (ORDER + 1)
    symbols = np.full(int(edges[-1]), _BEGIN, dtype=np.int64)
    symbols[edges[1:] - 1] = _STOP
    shift = np.repeat((np.arange(n) + 1) * ORDER + np.arange(n), np.diff(bounds))
    symbols[np.arange(len(data)) + shift] = data
    out = np.zeros(len(symbols), dtype=np.int64)
    for back in range(ORDER + 1):
        out[back:] |= symbols[:len(symbols) - back] << (_BITS * back)
    keep = np.ones(len(symbols), dtype=bool)
    keep[(edges[:-1, None] + np.arange(ORDER)).ravel()] = False
    return out[keep], bounds + np.arange(n + 1)


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, row = word_bounds(data, bounds)
    return range_keys(data, start, end) | np.int64(-1 << 63), row


def _merged(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key = np.concatenate([np.zeros(0, dtype=np.int64), *(k for k, _ in lists)])
    n = np.concatenate([np.zeros(0, dtype=np.int64), *(n for _, n in lists)])
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
    return key[first], np.add.reduceat(n, first) if len(first) else n


def _counted(key: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, and how often each stands where ``train`` holds."""
    own, n = np.unique(key[train], return_counts=True)
    rest = np.setdiff1d(key[~train], own) if not train.all() else own[:0]
    return np.concatenate([own, rest]), np.concatenate([n, np.zeros(len(rest), dtype=np.int64)])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block has. The rows of a block follow each other; a task may hold several blocks."""
    block, found = None, [[], [], 0]

    def flush() -> Iterator[pa.RecordBatch]:
        for key, n in (_merged(found[0]), _merged(found[1]), (np.array([_END]), np.array([found[2]]))):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), block, dtype=np.int32)), pa.array(key), pa.array(n)], names=["block", "key", "n"])

    for batch in batches:
        blocks = batch.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)] if len(blocks) else [0]
        for a, b in zip(edges, edges[1:]):
            if blocks[a] != block:
                if block is not None:
                    yield from flush()
                block, found = int(blocks[a]), [[], [], 0]
            part = batch.slice(a, b - a)
            train = part.column("train").to_numpy(zero_copy_only=False)
            found[2] += int(train.sum())
            for lo, hi, data, bounds in slices(part.column("text"), SLICE_BYTES):
                data = _LOWER[data]
                gram, at = grams(data, bounds)
                found[0].append(_counted(gram, np.repeat(train[lo:hi], np.diff(at))))
                word, row = _words(data, bounds)
                found[1].append(_counted(word, train[lo:hi][row]))
            for i in (0, 1):
                if sum(len(k) for k, _ in found[i]) > 1_000_000:
                    found[i] = [_merged(found[i])]
    if block is not None:
        yield from flush()


def costs(totals: DataFrame, space: Workspace) -> DataFrame:
    """``key, value``: the bits that the last symbol of each gram costs. ``totals``: ``key, n`` of all grams of the corpus,
    ``n`` counting the training documents only.

    Of a gram and its context, ``c`` is its count, ``total`` and ``kinds`` are the symbols seen there, all and different.
    ``after`` is what it costs once its context has escaped, ``plain`` what it costs from its context on.
    """
    below = None
    for order in range(ORDER + 1):
        mask = (1 << _BITS * (order + 1)) - 1
        level = totals.groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("key")).agg(F.sum("n").alias("c"))
        here = Window.partitionBy(F.shiftright("key", _BITS))
        seen = F.col("c") > 0
        level = level.withColumn("total", F.sum("c").over(here)).withColumn("kinds", F.sum(seen.cast("int")).over(here))
        if below is None:
            level = level.withColumn("after", F.log2(F.greatest(F.lit(_STOP + 1) - F.col("kinds"), F.lit(1))))
            shorter = F.lit(float(np.log2(_STOP + 1)))
        else:
            parent = below.select(
                F.col("key").alias("p"), F.col("c").alias("pc"), F.col("total").alias("ptotal"), F.col("kinds").alias("pkinds"),
                F.col("after").alias("pafter"), F.col("plain").alias("pplain"))
            level = level.withColumn("p", F.col("key").bitwiseAND(F.lit(mask >> _BITS))).join(parent, "p")
            level = level.withColumn("known", F.sum(F.when(seen, F.col("pc")).otherwise(0)).over(here))
            left = F.col("pkinds") - F.col("kinds")
            all_left = F.col("ptotal") - F.col("known") + left
            after = (
                F.when(F.col("pc") > 0, F.log2(all_left / F.col("pc")))
                .when(left > 0, F.log2(all_left / left) + F.col("pafter")).otherwise(F.col("pafter")))
            level = level.withColumn("after", after)
            shorter = F.col("pplain")
        room = F.col("total") + F.col("kinds")
        plain = (
            F.when(F.col("total") == 0, shorter).when(seen, F.log2(room / F.col("c")))
            .otherwise(F.log2(room / F.col("kinds")) + F.col("after")))
        # What the next order asks of its shorter context; nothing asks the last.
        below = level.select("key", *(["c", "total", "kinds", "after"] if order < ORDER else []), plain.alias("plain"))
        below = space.hold(below, f"order{order}")
    return below.select("key", F.col("plain").alias("value"))


class Lookup:
    """Values of known numbers, by open addressing: a byte of text costs a few reads of memory instead of a search."""

    def __init__(self, key: np.ndarray, value: np.ndarray):
        bits = max(4, int(3 * len(key)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.key, self.value = np.full(1 << bits, _NO_KEY), np.zeros(1 << bits)
        owner = np.full(1 << bits, -1, dtype=np.int64)
        slot, left = self._slots(key), np.arange(len(key))
        while len(left):
            at = slot[left]
            free = self.key[at] == _NO_KEY
            owner[at[free]] = left[free]
            won = free & (owner[at] == left)
            self.key[at[won]], self.value[at[won]] = key[left[won]], value[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & self.last

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return (mixed(key.view(np.uint64)) >> self.shift).astype(np.int64)

    def __call__(self, key: np.ndarray) -> np.ndarray:
        """All of ``key`` must be known."""
        slot = self._slots(key)
        left = np.flatnonzero(self.key[slot] != key)
        while len(left):
            slot[left] = (slot[left] + 1) & self.last
            left = left[self.key[slot[left]] != key[left]]
        return self.value[slot]


def _score(batches: Iterator[pa.RecordBatch], tokens: int, words: int, ends: int) -> Iterator[pa.RecordBatch]:
    """Scores of the documents of each block: the values of its grams and words come first, then its documents."""
    smooth = tokens + 0.5 * (words + 1)
    log = lambda c: np.log10((c + 0.5) / smooth)
    block, listed, known = None, [], None
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)] if len(blocks) else [0]
        for a, b in zip(edges, edges[1:]):
            if blocks[a] != block:
                block, listed, known = blocks[a], [], None
            part = batch.slice(a, b - a)
            is_value = part.column("text").is_null().to_numpy(zero_copy_only=False)
            n_values = int(is_value.sum())  # they are sorted before the documents
            if n_values:
                listed.append(tuple(part.column(k).slice(0, n_values).to_numpy().copy() for k in ("key", "value")))
            part = part.slice(n_values)
            if not len(part):
                continue
            if known is None:
                known = Lookup(*(np.concatenate([np.zeros(0, dtype=kind), *(x[k] for x in listed)]) for k, kind in ((0, np.int64), (1, float))))
                listed = []
            for lo, hi, data, bounds in slices(part.column("text"), SLICE_BYTES):
                data, rows = _LOWER[data], hi - lo
                gram, at = grams(data, bounds)
                score = -np.add.reduceat(known(gram), at[:-1]) * np.log10(2)
                word, row = _words(data, bounds)
                c = known(word)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").slice(lo, rows), part.column("train").slice(lo, rows),
                     pa.array(np.bincount(row, minlength=rows) + 1), pa.array((np.bincount(row, weights=c > 0, minlength=rows) + (ends > 0)).astype(np.int64)),
                     pa.array(np.full(rows, tokens)), pa.array(np.bincount(row, weights=log(c), minlength=rows) + log(ends)), pa.array(score)],
                    names=["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score(docs: DataFrame, space: Workspace, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, train, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``doc_id, text, train``.

    Texts are lower-cased (A-Z) and scored whole; null counts as empty, which still has its end. ``score`` is the log10
    probability of all bytes and the stop. ``base_score`` is that of a word-count model. Its words are compared by keys: exact ones
    up to seven bytes, 62-bit hashes above. Without training documents all symbols are equally likely. Rows may share ids, ids may be null.
    """
    own = docs.select("doc_id", "text", "train")
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    # By id and text, so that copies and shared ids spread.
    dealt = own.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    together = dealt.repartitionById(blocks, "block").sortWithinPartitions("block")
    items = space.hold(together.mapInArrow(_gather, "block int, key bigint, n bigint"), "items")
    totals = space.hold(items.groupBy("key").agg(F.sum("n").alias("n")), "totals")
    known = totals.where(((F.col("key") < 0) | (F.col("key") == _END)) & (F.col("n") > 0)).agg(
        F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("words"), F.sum(F.when(F.col("key") == _END, F.col("n"))).alias("ends")).first()
    tokens, words, ends = (known[k] or 0 for k in ("tokens", "words", "ends"))
    priced = costs(totals.where((F.col("key") >= 0) & (F.col("key") < _END)).select("key", "n"), space)
    counted = totals.where("key < 0").select("key", F.col("n").cast("double").alias("value"))
    values = items.where(F.col("key") != _END).select("block", "key").join(priced.unionByName(counted), "key")
    id_type = dict(docs.dtypes)["doc_id"]
    none = lambda kind: F.lit(None).cast(kind)
    # A block is a partition of its own: what its grams and words cost, then its documents.
    left = values.select("block", none(id_type).alias("doc_id"), none("string").alias("text"), none("boolean").alias("train"), "key", "value")
    right = dealt.select("block", "doc_id", F.coalesce("text", F.lit("")).alias("text"), "train", none("bigint").alias("key"), none("double").alias("value"))
    together = left.unionAll(right).repartitionById(blocks, "block").sortWithinPartitions("block", F.col("text").isNotNull())
    return together.mapInArrow(
        partial(_score, tokens=tokens, words=words, ends=ends),
        f"doc_id {id_type}, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def report(docs: DataFrame, space: Workspace) -> DataFrame:
    """Scores by a model of the documents outside the fold ``crc32(doc_id) mod 5 = 1``."""
    held_out = remainder("doc_id", 5) == 1
    return score(docs.select("doc_id", "text", (~held_out).alias("train")), space).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
