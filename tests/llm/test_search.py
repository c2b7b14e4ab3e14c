"""Byte BPE, ranked lexical search and hard negatives, against plain Python."""

import base64
import hashlib
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievewright.llm import byte_bpe, hard_negatives, lexical_search, queries
from sievewright.storage import Workspace


@pytest.fixture(scope="module")
def library():
    with open(queries.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: coder.encode_ordinary(text or "")


# --- byte BPE -----------------------------------------------------------------------------------

BORDERS = ["", None, " ", "a", "  \n\n  a", "don't 's 'l 'll'", "a" * 700, " " * 300 + "b", "\n" * 99 + "x" + "\n" * 99, "ab1!" * 90, "'" * 50 + "re" * 50,
           "é" * 130 + " " + "中" * 130, "x　　y  z\x85\x1c", "<|endoftext|> a", "a\n \n b \t\t c" * 30, "1234567890" * 40, "!?" * 200, "a" + "\r\n" * 100 + "b"]


def check_encoding(spark, space, texts, library, size, overlap):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: list(r["ids"]) for r in byte_bpe.encode(docs, queries.RANKS, public_tokenizers.PATTERN, space, size, overlap).collect()}
    assert got == {i: library(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("size, overlap", [(8, 4), (20, 20), (64, 10), (1 << 14, 1 << 10)])
def test_chunks_give_the_ids_of_whole_texts(shipped, space, library, size, overlap):
    """Small chunks cut inside every piece; long runs of one kind share no boundary and must join."""
    check_encoding(shipped, space, BORDERS, library, size, overlap)


def test_random_texts_in_chunks(shipped, space, library):
    rng = np.random.default_rng(5)
    kinds = ["a", "Z", "1", " ", "  ", "\n", "'s", "'", "'ll", "é", "中", "!", " \n ", "　", "b" * 9, " " * 9]
    texts = ["".join(rng.choice(kinds, rng.integers(1, 120))) for _ in range(150)]
    check_encoding(shipped, space, texts, library, 11, 5)


def test_a_whole_table_in_chunks(shipped, space, library):
    texts = [r["text"] for r in shipped.read.parquet(f"{SF}/documents.parquet").collect()]
    check_encoding(shipped, space, texts, library, 600, 40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab éth'n", min_size=1, max_size=40).map(str.encode), max_size=12))
def test_both_ways_to_merge(pieces):
    table = byte_bpe.ranks(queries.RANKS)
    ids, n = table.merged(pieces)
    many, at = table._merge_short(pieces)
    for i, piece in enumerate(pieces):
        assert many[at == i].tolist() == table._merge_long(piece)
        assert ids[n[:i].sum():n[:i + 1].sum()].tolist() == ([table.rank[piece]] if piece in table.rank else table._merge_long(piece))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2000), max_size=50))
def test_sizes_as_bytes(sizes):
    assert byte_bpe._ends(byte_bpe._sizes(np.array(sizes, dtype=np.int64))).tolist() == np.cumsum(sizes).tolist()


def test_pieces_of_any_length_merge_as_in_the_library(library):
    table = byte_bpe.ranks(queries.RANKS)
    for piece in ("a" * 30_000, "the" * 500, "abcdefghij" * 300, "zq" * 101):
        assert table.merged([piece.encode()])[0].tolist() == library(piece)


def test_every_character_is_split_as_in_the_library(library):
    table, split = byte_bpe.ranks(queries.RANKS), byte_bpe.regex.compile(public_tokenizers.PATTERN)
    for lo in range(0, 0x110000, 256):
        text = "\n".join(f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}" for c in range(lo, lo + 256) if not 0xD800 <= c < 0xE000)
        assert table.encode(split.findall(text))[0].tolist() == library(text)


def test_known_pieces_are_forgotten_beyond_the_limit(monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "KNOWN_PIECES", 3)
    table = byte_bpe.Ranks(queries.RANKS)
    for text in ("one two three four five", "six two seven one", "one"):
        ids, n = table.encode(byte_bpe.regex.findall(public_tokenizers.PATTERN, text))
        assert ids.tolist() == library(text) and n.sum() == len(ids)


def test_odd_rows_encode_and_decode(shipped, space, odd, none, library):
    rows = Counter((r["doc_id"], r["text"] or "") for r in odd.select("doc_id", "text").collect())
    encoded = byte_bpe.encode(odd, queries.RANKS, public_tokenizers.PATTERN, space, 500, 50)
    assert encoded.columns == ["doc_id", "ids"]
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in encoded.collect()) == Counter(
        {k: n for k, n in Counter((i, tuple(library(t))) for (i, t), m in rows.items() for _ in range(m)).items()})
    decoded = byte_bpe.decode(encoded, queries.RANKS).collect()
    assert Counter((r["doc_id"], bytes(r["bytes"]).decode()) for r in decoded) == rows
    assert byte_bpe.encode(none, queries.RANKS, public_tokenizers.PATTERN, Workspace(shipped, "none")).count() == 0
    assert byte_bpe.decode(shipped.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>"), queries.RANKS).count() == 2
    with pytest.raises(ValueError):
        byte_bpe.encode(odd, queries.RANKS, public_tokenizers.PATTERN, space, 5, 6)


def test_byte_bpe_query(shipped, library):
    texts = {r["doc_id"]: r["text"] or "" for r in shipped.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.REGISTRY["op13_byte_bpe"](shipped, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


# --- ranked lexical search ----------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, top=10):
    """All scores, plainly."""
    terms = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    n_docs, total = sum(bool(w) for _, w in terms), sum(len(w) for _, w in terms)
    df = Counter(t for _, w in terms for t in set(w))
    out = []
    for item, text in items:
        wanted = Counter(TERM.findall((text or "").translate(LOWER)))
        found = []
        for i, w in terms:
            if i is None:
                continue
            tf = Counter(w)
            m = 25 + (75 * len(w) * n_docs // total if total else 0)
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                        for t, k in wanted.items() if tf[t])
            if score > 0:
                found.append((-score, i))
        out += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(found)[:top])]
    return Counter(out)


def check_search(spark, docs, items, **options):
    left = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id bigint, text string, item_id int, score int").repartition(3)
    right = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, doc_id int")
    got = lexical_search.search(left, right, Workspace(spark, "search"), **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == ranked(docs, items, options.get("top", 10))


def invented(n, seed, words=60):
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, words + 1)
    names = [f"w{k}" if k % 3 else f"averylongwordnumber{k}é" for k in range(words)]
    return [" ".join(rng.choice(names, rng.integers(1, 40), p=share / share.sum())) for _ in range(n)]


@pytest.mark.parametrize("shard, part_terms", [(2048, 8192), (37, 8192), (150, 20)])
def test_search_finds_the_best_of_all(shipped, shard, part_terms):
    texts = invented(700, 1)
    docs = list(enumerate(texts + texts[:90] + [None, "", "...", "w1", "W1 w1"]))
    items = list(zip("abcdefghij", [*invented(6, 2), None, "nowhere", "w0 w0 w1 " * 9, texts[3]]))
    check_search(shipped, docs, items, shard=shard, part_terms=part_terms)


def test_search_of_odd_rows(shipped):
    docs = [(5, None), (1, ""), (2, " \n"), (3, "One two two"), (3, "One two two"), (None, "one two"), (4, "x" * 50_000), (7, "é É ñ 中文 x2 x_y 1-2"),
            (8, "two " * 9000), (9, "<tag> {one}"), (None, None)]
    items = [("a", "ONE two"), ("a", "ONE two"), (None, "中文 é"), ("b", ""), ("c", None), ("d", "x" * 50_000), ("e", "1 2 X2 y x")]
    check_search(shipped, docs, items)
    check_search(shipped, docs, items, top=1)
    check_search(shipped, [], items)
    check_search(shipped, docs, [])
    check_search(shipped, [(1, None), (2, "!")], items)


def test_terms_with_equal_keys_stay_apart(monkeypatch):
    keys = lexical_search.range_keys
    monkeypatch.setattr(lexical_search, "range_keys", lambda *x: keys(*x) & 1)
    terms = [b"one", b"two", b"three", b"a much longer term", b"a much longer tern"]
    data = np.frombuffer(b"".join([*terms, b"four"]), dtype=np.uint8)
    end = np.cumsum([*map(len, terms), 4])
    start = end - [*map(len, terms), 4]
    known = lexical_search.Vocabulary(terms)
    assert known.find(data, start, end).tolist() == [*(sorted(terms).index(t) for t in terms), -1]


def test_blocks_hold_each_posting_once_and_summaries_bound_their_documents():
    rng = np.random.default_rng(3)
    impact = rng.integers(1, 1000, (300, 20)) * (rng.random((300, 20)) < np.linspace(0.02, 0.9, 20))
    index = lexical_search.Shard(np.arange(300), np.arange(20), impact.astype(np.int32), 8)
    worth = rng.integers(0, 50, 20)
    for k in range(20):
        blocks = index.postings(k)[0]
        mine = blocks.ravel().tolist()
        assert blocks.shape[1] == 8 and sorted(set(mine)) == np.flatnonzero(impact[:, k]).tolist()
        assert mine[:len(set(mine))] == list(dict.fromkeys(mine))
        for docs, bound in zip(blocks, index.bounds(k, worth)):
            assert bound == (impact[docs].max(axis=0) * worth).sum() >= (impact[docs] @ worth).max()


def test_most_blocks_are_skipped():
    """Documents of four vocabularies: an item of one leaves most blocks unread, and finds the same."""
    rng = np.random.default_rng(4)
    kind = rng.integers(0, 4, 800)
    impact = rng.integers(1, 1000, (800, 40)) * (rng.random((800, 40)) < 0.05)
    impact[np.arange(800)[:, None], kind[:, None] * 10 + np.arange(10)] = rng.integers(1, 1000, (800, 10))
    index = lexical_search.Shard(np.arange(800), np.arange(40), impact.astype(np.int32), 16)
    worth = np.zeros(40, dtype=np.int64)
    worth[:10] = 7
    read = []
    whole = index.impact

    class Seen(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, tuple) and len(at) == 2:
                read.append(np.size(at[0]))
            return whole[np.asarray(at)] if not isinstance(at, tuple) else whole[at]

    index.impact = whole.view(Seen)
    got = index.search(np.arange(10), worth, [], 10)
    score = whole[:, :10].sum(axis=1, dtype=np.int64) * 7
    assert got == sorted(zip((-score).tolist(), range(800)))[:10]
    assert sum(read) < 500


# --- hard negatives -----------------------------------------------------------------------------

def mined(rows, positives=5, negatives=3):
    """All pairs, plainly; rows are (id, label, vector)."""
    rows = [(i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(x)) for x in v]) for i, label, v in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, label, v) in enumerate(rows):
        if i % 50:
            continue
        score = lambda w: sum(x * y for x, y in zip(v, w))
        others = sorted((-score(w), j, lab == label) for b, (j, lab, w) in enumerate(rows) if b != a)
        for s, j, _ in [o for o in others if o[2]][:positives]:
            fits = [(t, k) for t, k, same in others if not same and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(fits[:negatives])]
    return Counter(out)


def vectors(n, dims, seed, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dims)
    return [(i, int(rng.integers(labels)), [float(np.float32(x)) for x in rng.normal(size=dims) * 0.3 + centre]) for i in range(n)]


@pytest.mark.parametrize("block, anchor_block, dims", [(4096, 128, 32), (17, 3, 13), (64, 2, 8)])
def test_hard_negatives(shipped, space, monkeypatch, block, anchor_block, dims):
    rows = vectors(420, dims, dims)
    rows += [(i + 1000, label, v) for i, label, v in rows[:60]]  # equal vectors, other ids
    if block == 64:
        monkeypatch.setattr(hard_negatives, "PART_BYTES", 200)  # several parts of anchors
    df = shipped.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").repartition(4)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(hard_negatives.taking_part(df).withColumn("label", label), F.col("vec_id") % 50 == 0, space, block=block, anchor_block=anchor_block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, got.collect())) == mined(rows)


def test_hard_negatives_of_odd_rows(shipped):
    nan, inf = float("nan"), float("inf")
    rows = [*vectors(120, 4, 9, 2), (150, None, [1.0] * 4), (200, 1, None), (250, 1, [1.0, None, 1.0, 1.0]), (300, 1, [nan, 1.0, 1.0, 1.0]), (350, 0, [inf, 0.0, 0.0, 0.0]),
            (None, 1, [1.0] * 4), (400, 9, [0.5] * 4), (450, 1, []), (500, 0, [0.25]), (501, 1, [1.0] * 9), (-50, 1, [0.1, 0.2, 0.3, 0.4]), (550, 0, [-1e6, 1e6, 0.0, 1.0])]
    df = shipped.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, label int, embedding array<float>, rank int, block int").repartition(3)
    assert Counter(map(tuple, hard_negatives.report(df, Workspace(shipped, "odd")).collect())) == mined(rows)
    assert hard_negatives.report(df.limit(0), Workspace(shipped, "none")).count() == 0
    assert hard_negatives.report(df.where("vec_id = 400"), Workspace(shipped, "one")).count() == 0
    same = shipped.createDataFrame([(50, 1, [1.0, 0.0])] * 2 + [(51, 2, [0.9, 0.0])] * 5, "vec_id bigint, label int, embedding array<float>")
    assert Counter(map(tuple, hard_negatives.report(same, Workspace(shipped, "same")).collect())) == mined([(50, 1, [1.0, 0.0])] * 2 + [(51, 2, [0.9, 0.0])] * 5)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 20), st.integers(1, 30), st.integers(1, 50), st.integers(0, 2**32))
def test_lookups_give_exact_products(anchors, dims, candidates, seed):
    rng = np.random.default_rng(seed)
    reach = int(rng.choice([1, 2, 200, 1 << 20]))
    a, c = rng.integers(-reach, reach + 1, (anchors, dims)), rng.integers(-reach, reach, (candidates, dims))
    got = hard_negatives.scores(hard_negatives.subset_sums(a), hard_negatives.bit_planes(c), 7)
    assert (got == c @ a.T).all()


def test_numbers_too_large_are_refused():
    with pytest.raises(OverflowError):
        hard_negatives.scores(hard_negatives.subset_sums(np.array([[1 << 40]])), hard_negatives.bit_planes(np.array([[1 << 40]])))
