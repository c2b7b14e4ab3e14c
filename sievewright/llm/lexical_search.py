"""Ranked lexical search with posting lists in blocks of similar documents and exact upper bounds.

The score of a document for an item is a sum over the item's terms of the term's weight times what the document makes of it, its
*impact*: an integer that depends on term count and text length alone. Documents are indexed in shards of bounded size, each by one
task. In a shard every term has a posting list. The documents of a list are clustered by similarity (directions of their
impacts in a projected space, to the nearest of a few pivots from the list itself), and neighbours form blocks. A block keeps a summary:
for every term the largest impact of its documents. An item's product with the summary is at least the score of every
document in the block, so a block is skipped only if that product is below the item's tenth best score so far. An item reads its
lists by what they can add, the largest first, and stops where the largest impacts of all further lists add up to less than that.

Impacts of terms that no item has cannot add to any score, so the index covers the items' terms. Items come in parts with a
bounded number of terms. Counts (documents, terms, documents per term) are over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.text import range_keys, runs_of, same_bytes, slices
from sievewright.storage import Workspace

#: Bytes that are no part of a term.
_NO_TERM = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TOP = 10
SHARD = 2048
BLOCK = 32
PART_TERMS = 8192
TASK_SHARDS = 4
MOST_TASKS = 50_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_TERM = np.ones(256, dtype=bool)
_IN_TERM[_NO_TERM] = False


class Vocabulary:
    """Numbers of known terms, found by key and compared byte by byte."""

    def __init__(self, terms: list[bytes]):
        terms = sorted(set(terms))
        self.data = np.frombuffer(b"".join(terms), dtype=np.uint8)
        edge = np.concatenate([[0], np.cumsum([len(t) for t in terms], dtype=np.int64)])
        key = range_keys(self.data, edge[:-1], edge[1:])
        self.order = np.argsort(key, kind="stable")
        self.key, self.start, self.end = key[self.order], edge[:-1][self.order], edge[1:][self.order]

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each range of bytes, in the order of the sorted terms; -1 for an unknown one."""
        out = np.full(len(start), -1, dtype=np.int64)
        if not len(self.key) or not len(start):
            return out
        key = range_keys(data, start, end)
        at = np.searchsorted(self.key, key)
        # Different terms may share a key: all that do stand next to each other.
        open_ = np.flatnonzero(at < len(self.key))
        while len(open_):
            open_ = open_[self.key[at[open_]] == key[open_]]
            same = same_bytes(data, start[open_], end[open_], self.data, self.start[at[open_]], self.end[at[open_]])
            out[open_[same]] = self.order[at[open_[same]]]
            open_ = open_[~same]
            at[open_] += 1
            open_ = open_[at[open_] < len(self.key)]
        return out


@dataclass
class Items:
    """Items of one part: their ids, and for each the numbers of its terms, how often it has them, and their weights."""

    ids: list
    terms: list[np.ndarray]
    times: list[np.ndarray]
    weight: np.ndarray | None = None


def _terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return runs_of(_IN_TERM[data], bounds)


def _vectors(batches: Iterator[pa.RecordBatch], known: Vocabulary) -> Iterator[pa.RecordBatch]:
    """``doc_id, n`` (all terms) and the known terms of each text with their counts, by number."""
    for batch in batches:
        for lo, hi, data, bounds in slices(batch.column("text")):
            data = _LOWER[data]
            start, end, row = _terms(data, bounds)
            term = known.find(data, start, end)
            have = term >= 0
            pair, count = np.unique(row[have] << 32 | term[have], return_counts=True)
            edges = pa.array(np.searchsorted(pair >> 32, np.arange(hi - lo + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.bincount(row, minlength=hi - lo)),
                 pa.ListArray.from_arrays(edges, pa.array(pair & 0xFFFFFFFF, pa.int32())), pa.ListArray.from_arrays(edges, pa.array(count, pa.int32()))],
                names=["doc_id", "n", "terms", "counts"])


class Shard:
    """The index of some documents. ``impact`` has a row per document and a column per term of the part that any of them has.

    Posting lists get their blocks and summaries when an item first reads them.
    """

    def __init__(self, doc_ids: np.ndarray, terms: np.ndarray, impact: np.ndarray, block: int = BLOCK):
        self.doc_ids, self.terms, self.impact, self.block = doc_ids, terms, impact, block
        column, self.doc = np.nonzero(impact.T)
        self.edge = np.searchsorted(column, np.arange(len(terms) + 1))
        self.largest = impact.max(axis=0, initial=0)
        self.direction = self._directions()
        self.lists: dict[int, tuple[np.ndarray, ...]] = {}

    def _directions(self) -> np.ndarray:
        """Documents as unit vectors of few dimensions, by random signs that are the same for a term in every shard."""
        signs = np.random.default_rng(7).choice(np.array([-1, 1], dtype=np.float32), (int(self.terms.max(initial=0)) + 1, 16))[self.terms]
        out = self.impact.astype(np.float32) @ signs
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def postings(self, term: int) -> tuple[np.ndarray, ...]:
        """The list of a term: a row of documents per block (the last block repeats its last document), and the summaries of the blocks
        as sparse rows: bounds, columns, largest impacts."""
        if term not in self.lists:
            docs = self._clustered(self.doc[self.edge[term]:self.edge[term + 1]])
            short = -len(docs) % self.block
            blocks = np.concatenate([docs, np.full(short, docs[-1])]).reshape(-1, self.block)
            top = self.impact[blocks[:, 0]]
            for k in range(1, self.block if len(blocks) > 1 else len(docs)):
                np.maximum(top, self.impact[blocks[:, k]], out=top)
            row, column = np.nonzero(top)
            self.lists[term] = blocks, np.searchsorted(row, np.arange(len(blocks) + 1)), column, top[row, column].astype(np.int64)
        return self.lists[term]

    def _clustered(self, docs: np.ndarray) -> np.ndarray:
        """The documents of one list, those nearest to the same pivot together. Every so many documents one is a pivot."""
        if len(docs) <= self.block:
            return docs
        near = self.direction[docs] @ self.direction[docs[::self.block]].T
        return docs[np.lexsort((-near.max(axis=1), near.argmax(axis=1)))]

    def bounds(self, term: int, worth: np.ndarray) -> np.ndarray:
        """The product of a list's summaries with an item; ``worth`` is what one unit of impact of each column adds."""
        _, edge, column, value = self.postings(term)
        return np.add.reduceat(value * worth[column], edge[:-1])

    def search(self, terms: np.ndarray, worth: np.ndarray, best: list[tuple[int, int]], top: int) -> list[tuple[int, int]]:
        """The ``top`` of ``best`` and of this shard's documents, as (-score, id). ``terms`` are columns with a positive worth."""
        def floor() -> int:
            return -best[-1][0] if len(best) == top else 1

        reach = self.largest[terms] * worth[terms]
        order = np.argsort(-reach, kind="stable")
        left = np.cumsum(reach[order][::-1])[::-1].tolist()
        seen = np.zeros(len(self.doc_ids), dtype=bool)
        for term, rest in zip(terms[order].tolist(), left):
            if rest < floor():  # a document that stands in this and the further lists only scores less
                break
            blocks, bound = self.postings(term)[0], self.bounds(term, worth)
            by_bound = np.argsort(-bound, kind="stable")
            at, step = 0, 4
            while at < len(by_bound) and bound[by_bound[at]] >= floor():
                chosen = by_bound[at:at + step]
                at, step = at + step, min(2 * step, 256)
                docs = np.unique(blocks[chosen[bound[chosen] >= floor()]])
                docs = docs[~seen[docs]]
                seen[docs] = True
                score = self.impact[np.ix_(docs, terms)] @ worth[terms]
                good = score >= floor()
                if good.any():
                    best = sorted([*best, *zip((-score[good]).tolist(), self.doc_ids[docs[good]].tolist())])[:top]
        return best


def _search(batches: Iterator[pa.RecordBatch], items: Items, n_docs: int, n_terms: int, top: int, shard: int) -> Iterator[pa.RecordBatch]:
    best: list[list[tuple[int, int]]] = [[] for _ in items.ids]
    for batch in batches:
        for lo in range(0, len(batch), shard):
            part = batch.slice(lo, shard)
            n = part.column("n").to_numpy()
            edges = part.column("terms").offsets.to_numpy()
            term, count = (part.column(k).values.to_numpy()[edges[0]:edges[-1]].astype(np.int64) for k in ("terms", "counts"))
            row = np.repeat(np.arange(len(part)), np.diff(edges))
            length = 25 + 75 * n * n_docs // n_terms
            impact = 1_000_000_000 * count // (1000 * count + 8 * length[row])
            useful = (items.weight[term] > 0) & (impact > 0)
            terms, column = np.unique(term[useful], return_inverse=True)
            dense = np.zeros((len(part), len(terms)), dtype=np.int64 if len(impact) and impact.max() >= 1 << 31 else np.int32)
            dense[row[useful], column] = impact[useful]
            index = Shard(part.column("doc_id").to_numpy(), terms, dense)
            place = np.full(len(items.weight), -1, dtype=np.int64)
            place[terms] = np.arange(len(terms))
            for i, (own, times) in enumerate(zip(items.terms, items.times)):
                here = place[own] >= 0
                worth = np.zeros(len(terms), dtype=np.int64)
                worth[place[own[here]]] = times[here] * items.weight[own[here]]
                best[i] = index.search(place[own[here]], worth, best[i], top)
    rows = [(i, -score, doc) for i, found in enumerate(best) for score, doc in found]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["item", "score", "doc_id"])


def _asked(queries: DataFrame, space: Workspace) -> DataFrame:
    """``item, item_id, terms``: rows of the queries with their terms as bytes, in parts of few enough terms."""
    text = F.translate(F.coalesce("text", F.lit("")), _UPPER, _UPPER.lower())
    own = queries.select(F.col("item_id"), F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)).alias("terms"))
    return space.hold(own.withColumn("item", F.monotonically_increasing_id()), "items")


def _parts(asked: DataFrame, limit: int) -> Iterator[tuple[DataFrame, list]]:
    """Items with about ``limit`` terms at a time; an item with more is a part by itself. Only the part is on the driver."""
    sizes = asked.agg(F.sum(F.size(F.array_distinct("terms"))).alias("terms"), F.count(F.lit(1)).alias("n")).first()
    n = max(1, -(-(sizes["terms"] or 0) // limit))
    for i in range(n):
        part = asked if n == 1 else asked.where(F.pmod(F.xxhash64("item"), F.lit(n)) == i)
        yield part.orderBy("item").collect()


def search(docs: DataFrame, queries: DataFrame, space: Workspace, top: int = TOP, shard: int = SHARD, part_terms: int = PART_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``item_id, text`` of ``queries`` its best rows of ``doc_id, text``.

    Null texts have no terms; items without a term, and documents with score 0, have no result. Rows that share an id count each by
    itself and may both be ranked. Rows without a ``doc_id`` count in all statistics and have no result. Rows of ``queries`` that
    share an ``item_id``, or have none, are items of their own.
    """
    found = []
    asked = _asked(queries, space)
    for i, rows in enumerate(_parts(asked, part_terms)):
        known = sorted({t.encode() for r in rows for t in r["terms"]})
        number = {t: k for k, t in enumerate(known)}
        vectors = space.hold(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
            partial(_vectors, known=Vocabulary(known)), "doc_id bigint, n bigint, terms array<int>, counts array<int>"), f"vectors{i}")
        total = vectors.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        n_docs, n_terms = total["docs"], total["terms"] or 1
        weights = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
            "term", F.floor(1000 * F.log(F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1))).alias("w")).collect()
        weight = np.zeros(len(known), dtype=np.int64)
        for r in weights:
            weight[r["term"]] = r["w"]
        pairs = [np.unique(np.array([number[t.encode()] for t in r["terms"]], dtype=np.int64), return_counts=True) for r in rows]
        items = Items([r["item"] for r in rows], [p[0] for p in pairs], [p[1] for p in pairs], weight)
        # The index is far smaller than the texts, and its files fewer: a task gets a few shards.
        useful = vectors.where("doc_id is not null and size(terms) > 0").repartition(min(MOST_TASKS, max(1, -(-n_docs // (TASK_SHARDS * shard)))))
        hits = useful.mapInArrow(
            partial(_search, items=items, n_docs=n_docs, n_terms=n_terms, top=top, shard=shard), "item bigint, score bigint, doc_id bigint")
        names = docs.sparkSession.createDataFrame(
            [(k, r["item"]) for k, r in enumerate(rows)], "item bigint, of bigint").join(asked.select(F.col("item").alias("of"), "item_id"), "of")
        best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        found.append(hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).join(names, "item").select(
            "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return reduce(DataFrame.unionAll, found)


SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') AS w FROM documents),
b AS (SELECT item_id, row_number() OVER () AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') AS w FROM benchmark),
g AS (SELECT count(*)::BIGINT AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
q AS (SELECT item, term, count(*) AS times FROM (SELECT item, unnest(w) AS term FROM b) GROUP BY ALL),
t AS (SELECT doc_id, len(w) AS n, term, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY doc_id, w, term),
f AS (SELECT term, floor(1000 * ln((2 * g.n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM t, g GROUP BY term, g.n),
s AS (SELECT q.item, t.doc_id, sum(q.times * f.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (25 + (75 * t.n * g.n) // g.l))))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN f USING (term), g GROUP BY ALL)
SELECT b.item_id, (row_number() OVER r)::INTEGER AS rank, s.doc_id, s.score FROM s JOIN b USING (item) WHERE s.score > 0
WINDOW r AS (PARTITION BY s.item ORDER BY s.score DESC, s.doc_id) QUALIFY row_number() OVER r <= {TOP}
"""
