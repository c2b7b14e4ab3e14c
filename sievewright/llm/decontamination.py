"""Benchmark decontamination: a prefix-filtered set join, in DataFrame functions only.

A window of an item must stand in a text word for word, so all its words are needed and one necessary word is enough to
find it. Its words are ordered by how rare they are in the corpus, and the rarest one is the window's prefix. The
words of the texts are joined with the prefixes; a match must leave room for the whole window before and after (the
positional and length bounds), and is then verified word for word against the window-sized slice of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.keys import keyed, shielded, unkeyed
from sievewright.storage import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, Workspace

SIZE = 13
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ["doc_id", "__copy"]


def words(text: str = "text") -> F.Column:
    body = F.coalesce(F.col(text), F.lit(""))
    # Only A-Z is lowered; lower() does the same to ASCII texts and is faster than translate().
    lowered = F.when(F.octet_length(body) == F.length(body), F.lower(body)).otherwise(F.translate(body, _UPPER, _UPPER.lower()))
    return F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))


def item_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """``window`` (array of words) and ``items`` (its item ids as text) of all different windows; ``unnamed``: whether an
    item without id has it too."""
    of_items = benchmark.select(F.col("item_id").cast("string").alias("item"), words().alias("w")).where("size(w) > 0")
    slices = F.expr(f"transform(sequence(0, greatest(size(w) - {size}, 0)), i -> slice(w, i + 1, {size}))")
    return of_items.select("item", F.explode(slices).alias("window")).groupBy("window").agg(
        F.collect_set("item").alias("items"), F.max(F.col("item").isNull()).alias("unnamed"))


def _parts(small: DataFrame, key: str) -> Iterator[DataFrame]:
    """A held table in parts that every executor may keep a copy of; usually it is one. No rows: one empty part."""
    size = small.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.to_json(F.struct("*"))) + 64).alias("bytes")).first()
    n = max(1, -(-size["n"] // BROADCAST_MAX_ROWS), -(-(size["bytes"] or 0) // BROADCAST_MAX_BYTES))
    for i in range(n):
        part = small if n == 1 else small.where(F.pmod(F.xxhash64(key), F.lit(n)) == i)
        yield F.broadcast(part)


def _union(parts: Iterator[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def prefixes(every: DataFrame, windows: DataFrame, space: Workspace) -> DataFrame:
    """``word, wants``: the rarest word of each window, with the windows (``id, at, len``) it stands for. ``every``: the
    ``word`` column of the corpus. A window with a word that no text has is left out, as it stands nowhere."""
    tokens = space.hold(windows.select(F.explode("window").alias("word")).distinct(), "tokens")
    counts = _union(every.join(t, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n")) for t in _parts(tokens, "word"))
    ordered = windows.select("id", F.size("window").alias("len"), F.posexplode("window").alias("at", "word")).join(counts, "word", "left")
    rarest = ordered.groupBy("id", "len").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("rare"))
    return space.hold(
        rarest.where("rare.n > 0").groupBy(F.col("rare.word").alias("word"))
        .agg(F.collect_list(F.struct("id", "rare.at", "len")).alias("wants")), "prefixes")


def judge(keyed_docs: DataFrame, benchmark: DataFrame, space: Workspace, size: int = SIZE) -> DataFrame:
    """``doc_id, __copy, n_words, n_hit, n_items, items_sha256, contaminated`` of every document.

    A text of nulls or without words has no hits and is clean; so is everything if no item has words. Equal windows
    of several items count for each of them. Items without id count as any other for ``n_hit`` and ``contaminated``, all
    together as one in ``n_items``, and are left out of ``items_sha256``. A benchmark too large to broadcast is joined in parts.
    """
    windows = space.hold(item_windows(benchmark, size).withColumn("id", F.xxhash64("window")), "windows")
    # Finding the words costs more than all that follows: they are written once, joined by blanks, which no word holds.
    joined = space.hold(keyed_docs.select(*KEY, F.array_join(words(), " ").alias("joined")), "words")
    cut = F.when(F.col("joined") != "", F.split("joined", " ")).otherwise(F.array().cast("array<string>"))
    wanted = prefixes(joined.select(F.explode(cut).alias("word")), windows, space)
    places = joined.select(*KEY, F.posexplode(cut).alias("pos", "word"))
    candidates = _union(
        places.join(part, "word").select(*KEY, "pos", F.explode("wants").alias("want")).where("pos >= want.at")
        .select(*KEY, (F.col("pos") - F.col("want.at")).alias("start"), "want.id", "want.len")
        for part in _parts(wanted, "word"))
    per_doc = candidates.groupBy(*KEY).agg(F.collect_set(F.struct("start", "len", "id")).alias("tries"))
    # The bound on the length, then the slice of the text against the window: by hash here, word for word below.
    there = F.expr("""filter(transform(filter(coalesce(tries, array()), x -> x.start + x.len <= size(words)),
        x -> named_struct('start', x.start, 'len', x.len, 'id', x.id, 'window', slice(words, x.start + 1, x.len))),
        x -> xxhash64(x.window) = x.id)""")
    base = space.hold(
        joined.join(per_doc, KEY, "left").select(*KEY, cut.alias("words"), "tries")
        .select(*KEY, F.size("words").cast("bigint").alias("n_words"), there.alias("found")), "base")
    hits = _union(
        base.select(*KEY, F.explode("found").alias("x")).select(*KEY, "x.start", "x.len", F.col("x.window").alias("window"))
        .join(part.select("window", "items", "unnamed"), "window") for part in _parts(windows, "id"))
    spans = F.sort_array(F.collect_set(F.struct("start", "len")))
    found = hits.groupBy(*KEY).agg(spans.alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"), F.max("unnamed").alias("unnamed"))
    covered = F.expr("""aggregate(spans, named_struct('n', 0L, 'end', 0L), (a, s) -> named_struct(
        'n', a.n + greatest(s.start + s.len - greatest(a.end, s.start), 0L), 'end', greatest(a.end, cast(s.start + s.len as bigint))), a -> a.n)""")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_items = F.size(items) + F.coalesce("unnamed", F.lit(False)).cast("int")
    return base.drop("found").join(found, KEY, "left").select(
        *KEY, "n_words", F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_hit"), n_items.cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(items), ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def report(docs: DataFrame, benchmark: DataFrame, space: Workspace) -> DataFrame:
    return unkeyed(judge(keyed(docs.select("doc_id", "text"), space), benchmark, space))


def clean(docs: DataFrame, benchmark: DataFrame, space: Workspace) -> DataFrame:
    """The documents that are not contaminated, all columns as they came."""
    hidden, named = shielded(docs, "doc_id", "text")
    own = keyed(hidden, space)
    bad = judge(own.select(*KEY, "text"), benchmark, space).where("contaminated").select(*KEY)
    return named(unkeyed(own.join(bad, KEY, "left_anti")))


SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), {SIZE}) AS n, array_to_string(w[i:i + least(len(w), {SIZE}) - 1], ' ') AS t
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - {SIZE - 1}, 1))) AS i FROM b WHERE len(w) > 0)),
place AS (SELECT doc_id, s.n, i, array_to_string(w[i:i + s.n - 1], ' ') AS t
  FROM (SELECT doc_id, w, s.n, unnest(generate_series(1, len(w) - s.n + 1)) AS i FROM d, (SELECT DISTINCT n FROM win) s WHERE len(w) >= s.n) s),
hit AS (SELECT p.doc_id, p.i, p.n, v.item FROM place p JOIN win v ON v.n = p.n AND v.t = p.t),
cover AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN named USING (doc_id)
"""
