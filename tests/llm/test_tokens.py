"""Token ids: parts against whole texts, codes, id files, packing."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sievewright.llm import id_files, packing, queries
from sievewright.llm.tokens import END, Encoder, documents


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    tokenizer.encode_special_tokens = True
    return lambda text: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, END], dtype="<u4")


ODD = ["", None, " ", "  ", "a", "a ", " a", "a   b", "a\n b\n\n c", "x \t y", "don't we'll 's 't", "<|endoftext|> a<|endoftext|>", "“a” b “c”", "é ñ",
       "a b  c", "a 　b", "\x1c a \x1c", "﻿ a", "日本 語 テキスト", "a" * 5000, "x " * 4000]


def test_parts_give_the_ids_of_whole_texts(plain):
    column = pa.array(ODD + ODD[::-1])
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    got = [ids[a:b] for _, _, ids, bounds in documents(batch, queries.TOKENIZER) for a, b in zip(bounds, bounds[1:])]
    assert [x.tolist() for x in got] == [plain(t).tolist() for t in column.to_pylist()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tabZ'é  。1!", max_size=25), min_size=1, max_size=8))
def test_random_texts(texts):
    coder = _coder()
    from sievewright.llm.text import slices

    got = []
    for _, _, data, bounds in slices(pa.array(texts), 64):
        ids, at = coder.encode(data, bounds)
        got += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
    assert got == [x.tolist() for x in coder.whole(texts)]


def _coder(have=[]):
    if not have:
        have.append(Encoder(queries.TOKENIZER))
    return have[0]


def test_known_parts_are_forgotten_beyond_the_limit(monkeypatch):
    from sievewright.llm import tokens

    monkeypatch.setattr(tokens, "KEPT_PARTS", 3)
    coder = Encoder(queries.TOKENIZER)
    for text in ("a b c d e f", "a b c d e f g"):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        assert coder.encode(data, np.array([0, len(data)]))[0].tolist() == coder.whole([text])[0].tolist()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=200), st.integers(8, 20))
def test_code_lengths_are_complete_and_limited(counts, longest):
    bits = id_files.code_lengths(np.array(counts), longest)
    assert bits.max() <= longest and (len(counts) == 1 or (2.0 ** -bits.astype(float)).sum() == 1)


def test_code_lengths_are_optimal_without_a_limit():
    import heapq

    counts = np.random.default_rng(1).zipf(1.3, 300)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    assert (counts * id_files.code_lengths(counts, 20)).sum() >= cost
    assert (counts * id_files.code_lengths(np.minimum(counts, 10**5), 20)).sum() > 0
    small = np.array([1, 1, 2, 3, 5, 8, 13])
    assert (small * id_files.code_lengths(small)).sum() == 2 + 4 + 7 + 12 + 20 + 33 and id_files.code_lengths(small, 3).max() == 3


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=700))
def test_blocks_round_trip(ids):
    ids = np.array(ids, dtype=np.int64)
    bits = id_files.code_lengths(np.bincount(ids, minlength=1))
    payload, steps = id_files.pack_bits(ids, id_files.canonical(bits), bits)
    assert id_files.Decoder(bits).block(payload, steps, len(ids)).tolist() == ids.tolist()


def check_files(spark, docs, space, plain):
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0))
    id_files.write(docs, queries.TOKENIZER, space.path("files"), space)
    got = sorted(id_files.read(spark, space.path("files")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [r[0] for r in rows]
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in got) == sorted((r[0] or -1, plain(r[1]).astype(int).tolist()) for r in rows)
    assert [r["start"] for r in got] == (np.cumsum([0, *(len(r["ids"]) for r in got)])[:-1]).tolist()
    crc = {r["start"]: r["ids_crc32"] for r in id_files.digests(spark, space.path("files")).collect()}
    assert crc == {r["start"]: zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) for r in got}


def test_id_files(shipped, space, odd, plain):
    check_files(shipped, odd, space, plain)


def test_id_files_of_a_table(shipped, space, plain):
    check_files(shipped, shipped.read.parquet(f"{SF}/documents.parquet"), space, plain)


def test_id_files_of_no_documents(shipped, space, none, plain):
    check_files(shipped, none, space, plain)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for x in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - x)
        else:
            gaps.append(capacity - x)
    return len(gaps)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=150))
def test_plan(lengths):
    plan = packing.Plan(Counter(lengths), 50)
    places = {}
    for length, rank, n, sequence, offset in plan.table().tolist():
        for i in range(n):
            places.setdefault(sequence + i, []).append((offset, length))
            assert rank + i < lengths.count(length)
    assert sorted(x for p in places.values() for _, x in p) == sorted(lengths)
    assert sorted(places) == list(range(plan.sequences))
    for p in places.values():
        ends = np.cumsum([x for _, x in sorted(p)])
        assert [o for o, _ in sorted(p)] == [0, *ends[:-1].tolist()] and ends[-1] <= 50
    assert plan.sequences <= best_fit_decreasing(lengths, 50) * 1.1 + 1


def test_exact_complements_come_first():
    assert packing.Plan({600: 2, 424: 1, 200: 1, 224: 1}).sequences == 2
    assert packing.Plan({700: 3, 324: 1, 300: 1, 24: 1, 100: 2, 124: 1}).sequences == 3
    with pytest.raises(ValueError):
        packing.Plan({1025: 1})


def check_packing(docs, space, plain, capacity):
    rows = Counter((r[0], plain(r[1]).tobytes()) for r in docs.select("doc_id", "text").collect())
    packed = packing.pack(packing.pieces(docs, queries.TOKENIZER, capacity, keep_ids=True), space, capacity)
    got = packed.collect()
    sequences = {}
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) and r["length"] == len(r["ids"])
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in sequences.values():
        ends = np.cumsum([x for _, x in sorted(p)])
        assert [o for o, _ in sorted(p)] == [0, *ends[:-1].tolist()] and ends[-1] <= capacity
    assert sum(r["piece"] == 0 for r in got) == sum(rows.values())
    for (doc, raw), n in rows.items():
        size = len(raw) // 4
        count = -(-size // capacity)
        head = size - (count - 1) * capacity
        for k in range(count):
            start = 0 if k == 0 else head + (k - 1) * capacity
            part = raw[4 * start:4 * (start + (head if k == 0 else capacity))]
            assert sum((r["doc_id"], r["piece"], r["start"], np.array(r["ids"], "<u4").tobytes()) == (doc, k, start, part) for r in got) >= n
    joined = packing.sequences(packed).collect()
    assert len(joined) == len(sequences) and sum(len(r["ids"]) for r in joined) == sum(r["length"] for r in got)


def test_packing(space, odd, plain):
    check_packing(odd, space, plain, 64)


def test_packing_of_no_documents(space, none, plain):
    check_packing(none, space, plain, 64)


#: Literal added tokens: alone, beside blanks and letters, repeated, nearly, across the border of two texts.
LITERAL = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> b c", " <|endoftext|><|endoftext|>  d", "one <|endoftext|", "two <|endo", "ftext|> three",
           "plain words only", "", None, "é <|endoftext|>\n 中文 " * 50]


@pytest.fixture(scope="module")
def untouched():
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, END]


def test_literal_added_tokens_give_the_ids_of_the_library(untouched):
    assert untouched("a<|endoftext|>b") == [64, 50256, 65, END]
    column = pa.array(ODD + LITERAL + ODD[::-1] + LITERAL[::-1])
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    got = [ids[a:b] for _, _, ids, bounds in documents(batch, queries.TOKENIZER, added=True) for a, b in zip(bounds, bounds[1:])]
    assert [x.tolist() for x in got] == [untouched(t) for t in column.to_pylist()]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from([" ", "a", "é ", "<|endoftext|>", "<|endo", "ftext|>", "\n"]), max_size=8).map("".join), min_size=1, max_size=8))
def test_random_texts_with_added_tokens(untouched, texts):
    from sievewright.llm.text import slices
    from sievewright.llm.tokens import encoder

    got = []
    for _, _, data, bounds in slices(pa.array(texts), 64):
        ids, at = encoder(queries.TOKENIZER, True).encode(data, bounds)
        got += [[*ids[a:b].tolist(), END] for a, b in zip(at, at[1:])]
    assert got == [untouched(t) for t in texts]


def test_registered_queries_give_the_ids_of_the_library(shipped, untouched, tmp_path):
    import corpus_pipeline

    rows = list(enumerate(LITERAL))
    shipped.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    crc = lambda ids: zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    expected, start = [], 0
    for i, t in rows:
        expected.append((i, start, len(untouched(t)), crc(untouched(t))))
        start += len(untouched(t))
    got = queries.REGISTRY["op1_id_files"](shipped, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == expected
    docs = shipped.read.parquet(f"{tmp_path}/documents.parquet")
    for packed in (queries.REGISTRY["op3_best_fit_packing"](shipped, str(tmp_path)), corpus_pipeline.packed(shipped, docs, str(tmp_path))):
        assert sorted((r["doc_id"], r["length"], r["ids_crc32"]) for r in packed.collect()) == [(i, n, c) for i, _, n, c in expected]


def structured(n):
    """Two words of ``n`` bytes over two letters that polynomials modulo a power of two cannot tell apart: Thue-Morse and its complement."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_regular_words_have_their_own_keys():
    from sievewright.llm.text import RangeHash, range_keys

    for n in (8, 16, 64, 65, 1024, 4096):
        data = np.frombuffer("".join(structured(n)).encode(), dtype=np.uint8)
        start, end = np.array([0, n]), np.array([n, 2 * n])
        assert len(set(range_keys(data, start, end).tolist())) == 2
        assert len(set(RangeHash(data)(start, end).tolist())) == 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=80), min_size=1, max_size=30))
def test_keys_depend_on_the_bytes_alone(parts):
    from sievewright.llm.text import range_keys, same_bytes

    def keys(order):
        data = np.frombuffer(b"".join(order), dtype=np.uint8)
        end = np.cumsum([len(p) for p in order])
        start = end - [len(p) for p in order]
        a, b = np.repeat(np.arange(len(order)), len(order)), np.tile(np.arange(len(order)), len(order))
        same = same_bytes(data, start[a], end[a], data, start[b], end[b])
        assert same.tolist() == [order[i] == order[j] for i, j in zip(a, b)]
        return dict(zip(order, range_keys(data, start, end).tolist()))

    assert keys(parts) == keys(parts[::-1]) and len(set(keys(parts).values())) == len(set(parts))
    assert all(0 <= k < 1 << 63 for k in keys(parts).values())


def test_ids_are_right_when_all_keys_collide(monkeypatch, untouched):
    from sievewright.llm import tokens

    keys = tokens.range_keys
    monkeypatch.setattr(tokens, "range_keys", lambda *x: keys(*x) & 7)
    monkeypatch.setattr(tokens, "EXACT", -1)
    coder = Encoder(queries.TOKENIZER, True)
    texts = [*ODD, *LITERAL, "one two three", "three two one", "one two", "four two one"]
    for _ in range(2):
        column = pa.array([t or "" for t in texts])
        from sievewright.llm.text import slices

        for lo, hi, data, bounds in slices(column, 64):
            ids, at = coder.encode(data, bounds)
            assert [[*ids[a:b].tolist(), END] for a, b in zip(at, at[1:])] == [untouched(t) for t in texts[lo:hi]]
        texts = texts[::-1]


def test_regular_words_through_the_queries(shipped, untouched, tmp_path):
    a, b = structured(1024)
    rows = list(enumerate([a, b, f"x {a} y", f"x {b} y", f"{a} {b}", f"{b} {a}"]))
    shipped.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    crc = {i: (len(untouched(t)), zlib.crc32(np.array(untouched(t), dtype="<u4").tobytes())) for i, t in rows}
    got = queries.REGISTRY["op1_id_files"](shipped, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in got} == crc
    packed = queries.REGISTRY["op3_best_fit_packing"](shipped, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packed if r["piece"] == 0 and crc[r["doc_id"]][0] <= 1024} == {
        i: c for i, c in crc.items() if c[0] <= 1024}


def test_blocks_stand_in_the_order_of_documents(shipped, space):
    """Through the files by name and within each, however small the splits of the tables between."""
    import glob

    import pyarrow.parquet as pq

    docs = shipped.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet").repartition(13)
    shipped.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        id_files.write(docs, queries.TOKENIZER, space.path("ordered"), space, added=True, block_ids=1 << 12)
    finally:
        shipped.conf.unset("spark.sql.files.maxPartitionBytes")
    files = sorted(glob.glob(space.path("ordered") + "/blocks/part-*.parquet"))
    start = [x for f in files for x in pq.read_table(f, columns=["start"]).column(0).to_pylist()]
    assert len(files) > 4 and len(start) > 50 and start == sorted(start)
    ids = [x for f in files for x in pq.read_table(f, columns=["doc_ids"]).column(0).combine_chunks().flatten().to_pylist()]
    assert ids == sorted(ids)
