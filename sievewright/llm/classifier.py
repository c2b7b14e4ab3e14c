"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Features of a text are shares of its n-grams: words, pairs of words, word shapes (first and last byte class, length,
same as the word before) and pairs of shapes, each hashed into one weight vector of fixed size. A document's score is
the logistic function of a sparse dot product, computed for whole Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.labelled import sample
from sievewright.llm.text import add_columns, mixed, range_keys, remainder, slices, widened, word_bounds

BITS = 18
SCALE = 6.0
_KIND = np.full(256, 5, dtype=np.uint64)  # marks and symbols by themselves are told apart below
_KIND[ord("a"):ord("z") + 1] = 1
_KIND[ord("A"):ord("Z") + 1] = 2
_KIND[ord("0"):ord("9") + 1] = 3
_KIND[128:] = 4
for _i, _c in enumerate(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
    _KIND[_c] = 8 + _i


def grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and weight index of every n-gram of a slice of texts, and the number of words of each row."""
    start, end, row = word_bounds(data, bounds)
    n = np.bincount(row, minlength=len(bounds) - 1)
    if not len(start):
        return row, row, n
    word = mixed(range_keys(data, start, end).view(np.uint64))
    after = np.zeros(len(row), dtype=bool)
    after[1:] = row[1:] == row[:-1]
    last = np.concatenate([word[:1] * np.uint64(0), word[:-1]])
    size = np.minimum(np.log2(end - start + 1), 6).astype(np.uint64)
    same = after & (word == last)
    shape = mixed(((_KIND[data[start]] * np.uint64(64) + _KIND[data[end - 1]]) * np.uint64(8) + size) * np.uint64(2) + same.astype(np.uint64))
    before = np.concatenate([shape[:1] * np.uint64(0), shape[:-1]])
    pair, shapes = mixed(last * np.uint64(3) + word)[after], mixed(before * np.uint64(5) + shape + np.uint64(7))[after]
    index = np.concatenate([word, pair, shape, shapes]) >> np.uint64(64 - BITS)
    return np.concatenate([row, row[after], row, row[after]]), index.astype(np.int64), n


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        indices, values = [], []
        for lo, hi, data, bounds in slices(batch.column("text")):
            row, index, n = grams(data, bounds)
            key, count = np.unique((row << BITS) + index, return_counts=True)
            at = np.searchsorted(key >> BITS, np.arange(hi - lo + 1))
            for i in range(hi - lo):
                indices.append((key[at[i]:at[i + 1]] & ((1 << BITS) - 1)).astype(np.int32))
                values.append((count[at[i]:at[i + 1]] * (SCALE / max(1, n[i]))).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), batch.column("place"),
             pa.array(indices, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
            names=["label", "place", "indices", "vals"],
        )


def follow(examples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 4, alpha: float = 0.6, beta: float = 1.0,
           l1: float = 0.02, l2: float = 0.5) -> np.ndarray:
    """Weights after follow-the-regularised-leader updates over the examples; the last weight is the bias."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    weights = lambda at: np.where(
        np.abs(z[at]) <= l1, 0.0, (np.sign(z[at]) * l1 - z[at]) / ((beta + np.sqrt(n[at])) / alpha + l2))
    for _ in range(epochs):
        for label, at, value in examples:
            at, value = np.append(at, size - 1), np.append(value, 1.0)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
            g = (p - label) * value
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    return weights(np.arange(size))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    examples = []
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False)
        for i in range(len(batch)):
            examples.append((label[i], batch.column("indices")[i].values.to_numpy(), batch.column("vals")[i].values.to_numpy()))
    w = follow(examples)
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(w[at])], names=["at", "weight"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 8_000) -> np.ndarray:
    """Weights learned from at most ``max_rows`` labelled documents; without any, all weights are zero.

    Features are extracted in parallel; the updates depend on each other and run in one task over that bounded sample.
    The weights, at most 2**18 + 1 numbers, come to the driver and go out with the scoring job.
    """
    rows = sample(docs, labels, label, max_rows).withColumn("place", F.xxhash64("doc_id", "text"))
    found = rows.mapInArrow(_features, "label int, place bigint, indices array<int>, vals array<float>")
    one = found.repartition(1).sortWithinPartitions("place").mapInArrow(_train, "at int, weight double")
    w = np.zeros((1 << BITS) + 1)
    for r in one.toLocalIterator():
        w[r["at"]] = r["weight"]
    return w


def _score(batches: Iterator[pa.RecordBatch], w: np.ndarray, text: str, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.zeros(len(batch))
        for lo, hi, data, bounds in slices(batch.column(text)):
            row, index, n = grams(data, bounds)
            total = np.bincount(row, weights=w[index], minlength=hi - lo)
            out[lo:hi] = total * SCALE / np.maximum(n, 1)
        out = 1 / (1 + np.exp(-np.clip(out + w[-1], -35, 35)))
        yield add_columns(batch, {name: pa.array(out)})


def score(docs: DataFrame, w: np.ndarray, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the probability of label 1. Null and empty texts get the bias alone; repeated rows
    the same score. Texts are scored whole."""
    return docs.mapInArrow(partial(_score, w=w.astype(np.float32), text=text, name=name), widened(docs, f"`{name}` double"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a model that never saw the fold ``crc32(doc_id) mod 3 = 1``."""
    own = docs.select("doc_id", "text")
    w = fit(own, labels.where(remainder("doc_id", 3) != 1))
    return score(own, w).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
