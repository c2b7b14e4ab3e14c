"""Line dedup, suffix-array dedup, SimHash groups and components against plain Python."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from sievewright.llm import components, decontamination, line_dedup, quality_rules, simhash, suffix_dedup
from sievewright.storage import Workspace


def ordered(docs):
    return sorted(((r[0], r[1]) for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def plain_lines(rows, least):
    """Texts without lines of runs of at least ``least`` bytes that occur earlier; blank lines do not count."""
    seen, out = {}, []
    runs = []
    for d, (_, text) in enumerate(rows):
        lines = (text or "").split("\n")
        ink = [i for i, x in enumerate(lines) if x.encode().strip(b" \t\n\x0b\x0c\r")]
        for a in range(len(ink)):
            size = 0
            for b in range(a, len(ink)):
                size += len(lines[ink[b]].encode()) + 1
                if size >= least:
                    run = "\n".join(lines[i] for i in ink[a:b + 1])
                    runs.append((d, a, ink[a], ink[b], run))
                    break
        for b in range(len(ink)):
            size = 0
            for a in range(b, -1, -1):
                size += len(lines[ink[a]].encode()) + 1
                if size >= least:
                    runs.append((d, a, ink[a], ink[b], "\n".join(lines[i] for i in ink[a:b + 1])))
                    break
    found = {}
    for d, (_, text) in enumerate(rows):
        lines = (text or "").split("\n")
        ink = [i for i, x in enumerate(lines) if x.encode().strip(b" \t\n\x0b\x0c\r")]
        for a, i in enumerate(ink):
            if len(lines[i].encode()) + 1 < least and len(lines[i].encode().split()) >= 4:
                found.setdefault(lines[i], []).append((d, a, i, i, lines[i]))
    runs += [r for same in found.values() if len({r[0] for r in same}) >= 3 for r in same]
    for d, a, _, _, run in sorted(runs):
        seen.setdefault(run, (d, a))
    for d, (_, text) in enumerate(rows):
        gone = {i for dd, a, lo, hi, run in runs if dd == d and seen[run] != (d, a) for i in range(lo, hi + 1)}
        out.append("\n".join(x for i, x in enumerate((text or "").split("\n")) if i not in gone) if text is not None else None)
    return out


def test_line_dedup(shipped, space):
    rng = np.random.default_rng(3)
    lines = [" ".join(rng.choice(list("abcdef"), rng.integers(1, 30))) for _ in range(12)] + ["", "  ", "é" * 60]
    rows = [(i, "\n".join(rng.choice(lines, rng.integers(0, 9)))) for i in range(120)] + [(200, None)]
    got = {r["doc_id"]: r for r in line_dedup.dedup(shipped.createDataFrame(rows, "doc_id bigint, text string"), space, 40).collect()}
    expected = plain_lines(rows, 40)
    assert [got[i]["text"] for i, _ in rows] == expected and any(e != t for e, (_, t) in zip(expected, rows))


def test_short_lines_that_recur(shipped, space):
    notice = "Licensed under the public terms."
    rows = [(i, f"own text {i}\n{notice}\nthree words only\n{pair}") for i, pair in enumerate(["one two three four five"] * 2 + ["x"] * 3)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(shipped.createDataFrame(rows, "doc_id bigint, text string"), space).collect()}
    assert got[0] == rows[0][1] and got[1] == "own text 1\nthree words only\none two three four five"
    assert all(got[i] == f"own text {i}\nthree words only\nx" for i in (2, 3, 4))


def test_line_dedup_of_odd_rows(space, odd):
    got = line_dedup.dedup(odd, space).collect()
    assert len(got) == odd.count() and {"n_words", "mark"} <= set(got[0].asDict())
    texts = Counter(r["text"] for r in got if r["doc_id"] == 3)
    # Rows that share an id are documents of their own; a single line under the limit in bytes is left.
    assert sum(texts.values()) == 2
    assert sum(r["text"] is None for r in got) == 2
    passage = [r["text"] for r in got if r["text"] and "passage1 word" in r["text"]]
    assert len(passage) == 1
    assert next(r["text"] for r in got if r["doc_id"] == 6) == "first line\n\nlast line"


def test_line_dedup_of_no_rows(space, none):
    left = line_dedup.clean(none, space)
    assert left.columns == none.columns and left.count() == 0


def test_cleaned_documents_that_lose_all_words_go(shipped, space):
    rows = [(1, "x" * 200), (2, "x" * 200), (3, ""), (4, "x" * 200 + "\nmore")]
    got = line_dedup.clean(shipped.createDataFrame(rows, "doc_id bigint, text string"), space).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, "x" * 200), (3, ""), (4, "more")]


def plain_strings(texts, length):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        mask = np.zeros(len(b) + 1, dtype=int)
        for s in range(len(b) - length + 1):
            if b[s:s + length] in seen:
                mask[s] += 1
                mask[s + length] -= 1
            seen.add(b[s:s + length])
        gone = np.cumsum(mask)[:len(b)] > 0
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("hot,block", [(4000, 1 << 20), (2, 1 << 12)])
def test_suffix_dedup(shipped, space, hot, block):
    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("abcé "), n))
    shared = [word(int(n)) for n in rng.integers(60, 400, 6)]
    rows = [(i, word(int(rng.integers(0, 150))) + str(rng.choice(shared)) + word(int(rng.integers(0, 150)))) for i in range(60)]
    rows += [(100, "a" * 700), (101, "ab" * 300 + word(30) + "ab" * 200), (102, None), (103, ""), (104, word(99)), (105, rows[3][1]), (106, rows[3][1])]
    docs = shipped.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.dedup(docs, space, hot=hot, block_bytes=block).collect()}
    assert [got[i] for i, _ in rows] == plain_strings([t for _, t in rows], 100)


@pytest.mark.parametrize("copied", [False, True])
def test_suffix_dedup_of_repeated_units(shipped, space, copied):
    """Units as long as a string has grams, and one byte shorter and longer: the smallest gram recurs at each of them."""
    rng = np.random.default_rng(11)
    units = ["".join(rng.choice(list("abcdefghij "), n)) for n in (80, 81, 82) for _ in range(8)]
    rows = list(enumerate(unit * n for i, unit in enumerate(units) for n in [3 + i % 8]))
    rows += [(100 + i, t) for i, t in rows] if copied else []
    docs = shipped.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.dedup(docs, space).collect()}
    assert [got[i] for i, _ in rows] == plain_strings([t for _, t in rows], 100)


def test_suffix_dedup_of_odd_rows(shipped, space, odd, none):
    got = suffix_dedup.dedup(odd, space).collect()
    assert len(got) == odd.count()
    total = plain_strings([t for _, t in ordered(odd)], 100)
    # Which of two rows with one id comes first is open, but not what is left of both.
    assert sum(r["n_removed"] for r in got) == sum(x[1] for x in total)
    assert suffix_dedup.report(none, simhash.Workspace(shipped, "test")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab\x00ÿ", max_size=80), st.integers(9, 30))
def test_suffix_array_and_common_prefixes(text, depth):
    raw = text.encode("latin-1")
    data = np.frombuffer(raw, dtype=np.uint8)
    order = suffix_dedup.suffix_array(data, depth)
    assert sorted(order.tolist()) == list(range(len(raw)))
    found = [raw[i:] for i in order.tolist()]
    pad = lambda s: s[:depth].ljust(depth, b"\0")
    if b"\0" not in raw:
        assert [s[:depth] for s in found] == sorted(s[:depth] for s in found)
    else:
        assert [pad(s) for s in found] == sorted(pad(s) for s in found)
    for i, n in enumerate(suffix_dedup.common_prefixes(data, order, 8).tolist()[1:], 1):
        a, b = found[i - 1][:8], found[i][:8]
        if len(a) == len(b) == 8:
            assert n == next((k for k in range(8) if a[k] != b[k]), 8)


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(prints, max_bits):
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(prints))]


def test_fingerprints(odd):
    for r in simhash.fingerprints(odd.select("doc_id", "text")).collect():
        assert r["__print"] % (1 << 64) == plain_print(r["text"])


@pytest.mark.parametrize("seed", [0, 1])
def test_all_near_pairs_are_linked(shipped, space, seed):
    """Random fingerprints, balls around some of them, equal halves, and chains."""
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 1 << 63, 500).tolist()
    for centre in values[:8]:
        values += [centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (60, 2))]
    values += [(7 << 32) | int(x) for x in rng.integers(0, 1 << 31, 300)]
    values = sorted(set(values))
    held = space.hold(shipped.createDataFrame([(v,) for v in values], "__print bigint"), "values")
    found = components.components(simhash.links(held, space, 3, shard=64), space).collect()
    root = {r["node"]: r["root"] for r in found}
    expected = plain_groups(values, 3)
    assert [root.get(v, v) for v in values] == [values[e] for e in expected]


def test_components(shipped, space):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, i) for i in range(6000, 6300)]
    found = {r["node"]: r["root"] for r in components.components(shipped.createDataFrame(edges, "u bigint, v bigint"), space).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert all(found.get(x, x) == r for x, r in label.items())


def test_simhash_groups_and_odd_rows(shipped, space, odd, none):
    docs = shipped.read.parquet(f"{SF}/documents.parquet")
    rows = ordered(docs)
    expected = plain_groups([plain_print(t) for _, t in rows], 3)
    got = {r["doc_id"]: r["component_id"] for r in simhash.report(docs, space).collect()}
    assert [got[i] for i, _ in rows] == [rows[e][0] for e in expected]
    many = simhash.report(odd, simhash.Workspace(shipped, "test")).collect()
    assert len(many) == odd.count()
    assert {r["component_id"] for r in many if r["fingerprint"] == "0" * 16} == {1}
    one = simhash.clean(odd, simhash.Workspace(shipped, "test"))
    assert one.columns == odd.columns and one.count() == len({r["component_id"] if r["component_id"] is not None else r["fingerprint"] for r in many})
    assert simhash.report(none, simhash.Workspace(shipped, "test")).count() == 0


def test_kept_bytes_digest(shipped, space):
    docs = shipped.createDataFrame([(1, "ab"), (2, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["kept_sha256"] for r in suffix_dedup.report(docs, space).collect()}
    assert got == {1: hashlib.sha256(b"ab").hexdigest(), 2: hashlib.sha256(b"").hexdigest()}


def test_columns_of_any_name_come_back_as_they_were(shipped, labels):
    """Names that the operators use themselves, with values that must not change."""
    names = ["__copy", "__row", "__lines", "__removed", "__spans", "__all", "__q_kept", "__q_n_words", "__user0", "__component", "n_words", "words", "tries"]
    text = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen."
    rows = [(i, t, *range(100 * i, 100 * i + len(names))) for i, t in ((1, text), (2, "own " + text + " with more words behind it"), (3, None), (4, text))]
    docs = shipped.createDataFrame(rows, ", ".join(["doc_id bigint", "text string", *(f"`{n}` int" for n in names)])).repartition(2)
    benchmark = shipped.createDataFrame([(1, "nothing of this stands anywhere")], "item_id bigint, text string")
    space = lambda: Workspace(shipped, "names")
    by_id = {r[0]: r for r in rows}
    for kept in (line_dedup.clean(docs, space()), simhash.clean(docs, space()), decontamination.clean(docs, benchmark, space()), quality_rules.keep_good(docs, labels)):
        assert kept.columns == docs.columns
        got = kept.collect()
        assert got and all(tuple(r)[2:] == by_id[r["doc_id"]][2:] for r in got)
    with pytest.raises(ValueError, match="__q_kept"):
        quality_rules.judge(docs, [])


def test_pieces_of_regular_texts_are_told_apart(shipped, space):
    """Thue-Morse words and their complements, which polynomials modulo a power of two cannot tell apart."""
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    docs = shipped.createDataFrame([(1, a), (2, b), (3, "x" + a), (4, b + "y")], "doc_id bigint, text string")
    got = {r["doc_id"]: bytes(r["kept"]).decode() for r in suffix_dedup.dedup(docs, space).collect()}
    assert [got[i] for i in (1, 2, 3, 4)] == [x[3].decode() for x in plain_strings([a, b, "x" + a, b + "y"], 100)]
