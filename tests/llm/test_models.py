"""Quality rules, the classifier, byte model scores, sharding and decontamination against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from sievewright.llm import classifier, decontamination, ppm, quality_rules, sharding
from sievewright.llm.labelled import sample
from sievewright.storage import Workspace

BIGGER = "/root/testdata/sf0.01"


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é#|\n\t\x1c ", max_size=60))
def test_text_counts(text):
    assert quality_rules.text_counts(text)[:5] == plain_counts(text)


def test_rules_report(shipped, odd, labels, none):
    got = quality_rules.report(odd, labels).collect()
    assert len(got) == odd.count()
    expected = Counter()
    for r in odd.select("doc_id", "text").collect():
        n = plain_counts(r["text"])
        expected[(r["doc_id"], *n, n[0] < 10 or 100 * n[4] > 20 * n[0])] += 1
    assert Counter(tuple(r)[:7] for r in got) == expected
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert quality_rules.report(none, labels).count() == 0
    kept = quality_rules.keep_good(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == sum(not r["base_failed"] for r in got)


def test_rules_follow_the_labels(shipped):
    docs, marks = (shipped.read.parquet(f"{BIGGER}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules.report(docs, marks).join(marks, "doc_id").where("not base_failed").collect()
    good, bad = ([r["kept"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_learned_conditions():
    rng = np.random.default_rng(0)
    x = {k: rng.random(900) for k in quality_rules.FEATURES}
    bad = (x["symbol_rate"] > 0.8) | ((x["dup_line_rate"] > 0.7) & (x["n_words"] < 0.4))
    rules = quality_rules.learn(x, bad)
    found = np.zeros(900, dtype=bool)
    for rule in rules:
        found |= quality_rules._covers(rule, x, 900)
    assert (found == bad).mean() > 0.95
    assert quality_rules.learn(x, np.zeros(900, dtype=bool)) == quality_rules.learn(x, np.ones(900, dtype=bool)) == []
    assert quality_rules.learn({k: v[:0] for k, v in x.items()}, bad[:0]) == []


def test_sample_is_bounded_and_skips_contradictions(odd, labels):
    rows = sample(odd, labels, "quality", 10).collect()
    # Of an id with several documents, one is taken.
    assert sorted(r["doc_id"] for r in rows) == [3, 8]
    assert len(sample(odd, labels, "quality", 1).collect()) == 1


def test_sample_stays_bounded_when_an_id_has_many_documents(shipped, labels):
    docs = shipped.range(5000).selectExpr("3L AS doc_id", "concat('text ', id) AS text").unionAll(shipped.createDataFrame([(8, None)], "doc_id bigint, text string"))
    rows = sample(docs, labels, "quality", 10).collect()
    assert sorted(r["doc_id"] for r in rows) == [3, 8]
    again = sample(docs.repartition(7), labels, "quality", 10).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)


def test_classifier_on_the_held_out_fold(shipped):
    docs, marks = (shipped.read.parquet(f"{BIGGER}/{t}.parquet") for t in ("documents", "labels"))
    rows = classifier.report(docs, marks).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in rows)
    quality = {r["doc_id"]: r["quality"] for r in marks.collect()}
    held = [(quality[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in quality]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_classifier_ignores_everything_but_the_text(shipped, odd, labels, none):
    rows = classifier.report(odd, labels).collect()
    assert len(rows) == odd.count() and len({r["score"] for r in rows if r["doc_id"] in (1, 2, 5)}) == 1
    assert classifier.report(none, labels).count() == 0
    assert {r["score"] for r in classifier.report(odd, labels.limit(0)).collect()} == {0.5}
    marks = shipped.createDataFrame([(i, int(i % 2)) for i in range(30)], "doc_id bigint, quality int")
    docs = shipped.createDataFrame([(i, "good text" if i % 2 else "bad junk") for i in range(30)] + [(99, "good text")], "doc_id bigint, text string")
    flipped = marks.withColumn("quality", classifier.F.when(classifier.remainder("doc_id", 3) == 1, 1 - classifier.F.col("quality")).otherwise(classifier.F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in classifier.report(docs, m).collect()} for m in (marks, flipped))
    assert a == b and a[99] > 0.5


def plain_scores(rows, order):
    lower = lambda t: (t or "").encode().lower()
    trie, words = {}, Counter()
    for text, train in rows:
        if train:
            s = [257] * order + list(lower(text)) + [256]
            words.update(lower(text).split())
            words[None] += 1
            for p in range(order, len(s)):
                for k in range(order + 1):
                    trie.setdefault(tuple(s[p - k:p]), Counter())[s[p]] += 1

    def bits(context, x):
        out, gone = 0.0, set()
        for k in range(order, -1, -1):
            here = {a: n for a, n in trie.get(tuple(context[order - k:]), {}).items() if a not in gone}
            if here:
                room = sum(here.values()) + len(here)
                if x in here:
                    return out - math.log2(here[x] / room)
                out -= math.log2(len(here) / room)
                gone |= set(here)
        return out + math.log2(257 - len(gone))

    n, v, out = sum(words.values()), len(words), []
    for text, _ in rows:
        s = [257] * order + list(lower(text)) + [256]
        tokens = [*lower(text).split(), None]
        base = sum(math.log10((words[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens)
        score = -sum(bits(s[p - order:p], s[p]) for p in range(order, len(s))) * math.log10(2)
        out.append((len(tokens), sum(words[x] > 0 for x in tokens), n, base, score))
    return out


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_byte_model(shipped, space, block):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["ab", "Abc", "b", "cab", "é", "\n"], int(rng.integers(0, 30)))) for _ in range(40)] + ["", None, "\x00ÿz", "zzz" * 30]
    rows = [(i, t, bool(i % 3)) for i, t in enumerate(texts)]
    got = {r["doc_id"]: tuple(r)[2:] for r in ppm.score(shipped.createDataFrame(rows, "doc_id bigint, text string, train boolean"), space, block).collect()}
    for i, expected in enumerate(plain_scores([(t, train) for _, t, train in rows], ppm.ORDER)):
        assert got[i] == pytest.approx(expected, rel=1e-9)


def test_words_that_only_look_alike_are_not_known(shipped, space):
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    rows = [(0, a, True), (1, b, False), (2, a, False)]
    got = {r["doc_id"]: r["n_known"] for r in ppm.score(shipped.createDataFrame(rows, "doc_id bigint, text string, train boolean"), space).collect()}
    assert got == {0: 2, 1: 1, 2: 2}


def test_lookups_by_open_addressing():
    rng = np.random.default_rng(8)
    key = np.unique(rng.integers(-(1 << 62), 1 << 62, 5000))
    value = rng.random(len(key))
    at = rng.integers(0, len(key), 20_000)
    assert (ppm.Lookup(key, value)(key[at]) == value[at]).all()
    assert ppm.Lookup(key[:0], value[:0])(key[:0]).tolist() == []
    assert ppm.Lookup(np.arange(100), np.arange(100.0))(np.arange(100)).tolist() == list(range(100))


def plain_follow(examples, epochs=4, alpha=0.6, beta=1.0, l1=0.02, l2=0.5):
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return (math.copysign(l1, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for label, at, value in examples:
            x = dict(zip(at.tolist(), map(float, value))) | {1 << classifier.BITS: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - label) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z if weight(i)}


def test_classifier_follows_plain_arithmetic():
    """The updates once more in plain floats over dictionaries: the same weights, and so the same scores."""
    rng = np.random.default_rng(6)
    examples = []
    for _ in range(50):
        at = np.sort(rng.choice(40, 6, replace=False)).astype(np.int32)
        examples.append((int(rng.integers(0, 2)), at, rng.random(6).astype(np.float32)))
    expected = plain_follow(examples)
    got = classifier.follow(examples)
    assert {int(i): got[i] for i in np.flatnonzero(got)} == pytest.approx(expected, rel=1e-4, abs=1e-6)


def test_byte_model_probabilities_sum_to_one(shipped, space):
    """A text of one byte, for every byte, and the empty text: the first symbols share a probability of one."""
    rows = [(i, chr(i) if i < 128 else None if i == 128 else "ab" * 5, i >= 128) for i in range(130)]
    scored = {r["doc_id"]: r["score"] for r in ppm.score(shipped.createDataFrame(rows, "doc_id bigint, text string, train boolean"), space).collect()}
    assert all(s < 0 for s in scored.values())


def test_byte_model_of_odd_rows(shipped, odd, none):
    rows = ppm.report(odd, Workspace(shipped, "test")).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert sum(r["held_out"] for r in rows) == sum(fold(r["doc_id"], 5) == 1 for r in odd.collect() if r["doc_id"] is not None)
    assert ppm.report(none, Workspace(shipped, "test")).count() == 0
    untrained = ppm.score(shipped.createDataFrame([(1, "ab", False)], "doc_id bigint, text string, train boolean"), Workspace(shipped, "test")).first()
    assert untrained["score"] == pytest.approx(-3 * math.log10(257)) and untrained["train_tokens"] == 0


def best_largest(sizes, shards):
    return min(
        max(sum(sizes[a:b]) for a, b in zip((0, *c), (*c, len(sizes))))
        for k in range(min(shards, len(sizes))) for c in combinations(range(1, len(sizes)), k))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=9), st.integers(1, 4))
def test_cuts(sizes, shards):
    sizes.sort(reverse=True)
    found = Counter(sizes)
    at = sharding.cuts(np.array(list(found)), np.array(list(found.values())), shards)
    totals, seen = [0] * shards, Counter()
    for size in sizes:
        totals[sum(size < s or (size == s and seen[size] >= n) for s, n in at)] += size
        seen[size] += 1
    assert sum(totals) == sum(sizes) and max(totals) == best_largest(sizes, shards)


def check_shards(docs, space, shards):
    rows = sharding.shard(docs, space, shards).collect()
    expected = Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    for k in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(sum(r["shard"] == k for r in rows)))
    assert all(len({r["shard"] for r in rows if r["digest"] == d}) == 1 for d in {r["digest"] for r in rows})
    return rows


def test_shards(shipped, space, odd, none):
    check_shards(odd, space, 5)
    assert sharding.report(none, Workspace(shipped, "test")).count() == 0
    same = shipped.createDataFrame([(i, f"text {i:04}" if i % 3 else "hot") for i in range(900)], "doc_id bigint, text string")
    rows = check_shards(same, Workspace(shipped, "test"), 10)
    totals = Counter()
    for r in rows:
        totals[r["shard"]] += r["size"]
    rest = sorted(totals.values())[:-1]  # the largest shard holds the copies that stay together
    assert len(totals) == 10 and rest[-1] - rest[0] <= 25


def plain_contamination(text, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, named = cut(text), set(), set()
    for item, body in items:
        w = cut(body)
        n = min(13, len(w))
        for window in {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else ():
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) == window:
                    hit |= set(range(i, i + n))
                    named.add(str(item))
    ids = ",".join(sorted(named))
    return len(words), len(hit), len(named), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("parts", [False, True])
def test_decontamination(shipped, space, monkeypatch, parts):
    if parts:
        monkeypatch.setattr(decontamination, "BROADCAST_MAX_ROWS", 3)
    rng = np.random.default_rng(6)
    word = lambda n: " ".join(rng.choice(["Aa", "b", "cÉ", "É", "d9", "eé-f", "g_h"], n))
    items = [(i, word(int(rng.integers(13, 25)))) for i in range(8)] + [(20, "only three words"), (21, "!!"), (22, None), (23, "ONLY three, words!"), (24, word(13))]
    docs = [(i, word(int(rng.integers(0, 60))) + " " + (items[int(rng.integers(0, 8))][1] if i % 3 == 0 else "") + " " + word(4)) for i in range(60)]
    docs += [(100, "so ONLY-three words here, only three words"), (101, None), (102, "..."), (103, items[0][1] * 3), (104, word(400) + " only three words")]
    got = {r["doc_id"]: tuple(r)[1:] for r in decontamination.report(
        shipped.createDataFrame(docs, "doc_id bigint, text string"), shipped.createDataFrame(items, "item_id bigint, text string"), space).collect()}
    assert got == {i: plain_contamination(t, items) for i, t in docs}


def test_decontamination_of_odd_rows(shipped, odd, none):
    benchmark = shipped.createDataFrame([(1, " ".join(f"passage{i} word" for i in range(10))), (1, None)], "item_id bigint, text string")
    rows = decontamination.report(odd, benchmark, Workspace(shipped, "test")).collect()
    assert len(rows) == odd.count() and sum(r["contaminated"] for r in rows) == 3
    kept = decontamination.clean(odd, benchmark, Workspace(shipped, "test"))
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3 and kept.where("doc_id is null").count() == 1
    assert decontamination.report(none, benchmark, Workspace(shipped, "test")).count() == 0
    assert not any(r["contaminated"] for r in decontamination.report(odd, benchmark.limit(0), Workspace(shipped, "test")).collect())
