"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A line of a later repeated run goes. A run is lines of at least ``least`` bytes together, with line ends and without blank
lines, or one shorter line of four words or more that stands in three documents or more; it is later if it also starts earlier
(smaller ``doc_id``, or same document and earlier line). Steps:

1. *Select*: from every line, forwards and backwards, the shortest run that reaches ``least`` bytes is a window; the
   smallest line hash in it is its fingerprint. Two equal runs have equal windows and so equal fingerprints.
2. *Join positions*: only windows whose fingerprint stands in more than one place stay.
3. *Extend*: around a fingerprint that recurs, a window is compared as a whole, by a hash of its lines; windows that
   follow each other join into runs, in both directions.
4. *Short lines* are counted by document, as texts, and met by those that recur.
5. *Delete* every window or short line but the earliest of its kind.

The first occurrence always stays, and so do repeated short lines of fewer words or in fewer documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.keys import keyed, shielded, unkeyed
from sievewright.storage import Workspace, is_small

LEAST_BYTES = 100
#: What makes a shorter line a run by itself.
LINE_WORDS = 4
LINE_DOCUMENTS = 3
KEY = ["doc_id", "__copy"]


def _windows(lines: str, least: int, backwards: bool) -> Column:
    """For each of the lines: the run from there that reaches ``least`` bytes, with its fingerprint and its hash."""
    # A line that is not blank has two bytes at least, so a window has no more than least / 2 lines.
    widest = (least + 1) // 2
    start = f"""named_struct('size', 0L, 'last', cast(-1 as int), 'mark', cast(null as bigint), 'at', cast(-1 as int),
                             'hash', cast({int(backwards)} as bigint))"""
    step = f"""(a, x) -> if(a.size >= {least}, a, named_struct(
        'size', a.size + x.size, 'last', x.line, 'mark', if(a.mark is null or x.hash < a.mark, x.hash, a.mark),
        'at', if(a.mark is null or x.hash < a.mark, x.line, a.at), 'hash', xxhash64(a.hash, x.hash)))"""
    runs = f"""transform({lines}, (line, i) -> named_struct('first', line.line, 'run', aggregate(
        slice({lines}, i + 1, {widest}), {start}, {step})))"""
    return F.expr(f"filter({runs}, w -> w.run.size >= {least})")


def windows(keyed_docs: DataFrame, least: int) -> DataFrame:
    """``doc_id, __copy, lo, hi, mark, at, hash, backwards`` of every window; ``lo`` and ``hi`` are line numbers from 0."""
    lines = F.expr(r"""filter(transform(split(text, '\n', -1), (x, i) -> named_struct(
        'line', i, 'size', cast(octet_length(x) + 1 as bigint), 'hash', xxhash64(x), 'full', x rlike '[^\\x20\\x09-\\x0D]')),
        x -> x.full)""")
    rows = keyed_docs.select(*KEY, lines.alias("lines")).select(*KEY, "lines", F.reverse("lines").alias("back"))
    both = F.concat(
        F.transform(_windows("lines", least, False), lambda w: F.struct(w["first"].alias("lo"), w["run"]["last"].alias("hi"), w["run"].alias("run"), F.lit(False).alias("backwards"))),
        F.transform(_windows("back", least, True), lambda w: F.struct(w["run"]["last"].alias("lo"), w["first"].alias("hi"), w["run"].alias("run"), F.lit(True).alias("backwards"))),
    )
    return rows.select(*KEY, F.explode(both).alias("w")).select(
        *KEY, "w.lo", "w.hi", F.col("w.run.mark").alias("mark"), F.col("w.run.at").alias("at"),
        F.col("w.run.hash").alias("hash"), "w.backwards")


def short_lines(keyed_docs: DataFrame, space: Workspace, least: int) -> DataFrame:
    """``doc_id, __copy, lo, hi``: the later occurrences of short lines that stand in enough documents."""
    lines = F.expr(rf"""filter(transform(split(text, '\n', -1), (x, i) -> named_struct('at', i, 'line', x)),
        x -> octet_length(x.line) + 1 < {least} and regexp_count(x.line, '[^\\x20\\x09-\\x0D]+') >= {LINE_WORDS})""")
    found = space.hold(keyed_docs.select(*KEY, F.inline(lines)), "lines")
    in_document = found.groupBy("line", *KEY).agg(F.min("at").alias("at"))
    recur = in_document.groupBy("line").agg(F.min(F.struct(*KEY, "at")).alias("first"), F.count(F.lit(1)).alias("n")).where(f"n >= {LINE_DOCUMENTS}")
    recur = space.hold(recur.drop("n"), "recurring")
    wanted = F.broadcast(recur) if is_small(recur.select("line")) else recur
    return found.join(wanted, "line").where(F.struct(*KEY, "at") > F.col("first")).select(*KEY, F.col("at").alias("lo"), F.col("at").alias("hi"))


def repeated_runs(keyed_docs: DataFrame, space: Workspace, least: int = LEAST_BYTES) -> DataFrame:
    """``doc_id, __copy, lo, hi``: the disjoint runs of lines to delete, as large as possible."""
    found = space.hold(windows(keyed_docs, least), "windows")
    # Counting a mark by its extreme places tells whether it has more than one, and is small before the shuffle.
    place = F.struct(*KEY, "at")
    marks = found.groupBy("mark").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a != b").select("mark")
    matched = found.join(marks, "mark", "left_semi")
    kind = ["mark", "hash", "backwards"]
    first = matched.groupBy(*kind).agg(F.min(F.struct(*KEY, "lo")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = matched.join(first, kind).where(F.struct(*KEY, "lo") > F.col("first"))
    own = Window.partitionBy(*KEY).orderBy("lo", "hi")
    reach = F.max("hi").over(own.rowsBetween(Window.unboundedPreceding, -1))
    every = later.select(*KEY, "lo", "hi").unionByName(short_lines(keyed_docs, space, least))
    parted = every.distinct().withColumn("new", F.coalesce(F.col("lo") > reach + 1, F.lit(True)).cast("int"))
    runs = parted.withColumn("run", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*KEY, "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("run")


def dedup(docs: DataFrame, space: Workspace, least: int = LEAST_BYTES) -> DataFrame:
    """All columns of ``docs``, with ``text`` without its later repeated runs, and ``__removed`` and ``__runs``: lines and
    runs deleted, ``__lines``: lines before. Null texts stay null and have no lines. Shared ids: see ``keys.keyed``. Names that
    begin with ``__`` are the operator's own here; ``clean`` takes columns of any name."""
    own = keyed(docs, space)
    # Runs with only blank lines between them are one run of text, yet the blank lines stay.
    per_doc = repeated_runs(own.select(*KEY, "text"), space, least).groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("__spans"))
    lines = F.split("text", "\n", -1)
    body = own.join(per_doc, KEY, "left").withColumn("__all", lines)
    spans = "__spans"
    kept = F.expr(f"""flatten(transform(sequence(0, size({spans})), j -> slice(__all,
        if(j = 0, 1, {spans}[j - 1].hi + 2),
        if(j = size({spans}), size(__all), {spans}[j].lo) - if(j = 0, 0, {spans}[j - 1].hi + 1))))""")
    removed = F.expr(f"aggregate({spans}, 0, (a, s) -> a + s.hi - s.lo + 1)")
    return unkeyed(
        body.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
        .withColumn("__lines", F.coalesce(F.size("__all"), F.lit(0)))
        .withColumn("__lines", F.when(F.col("__lines") < 0, 0).otherwise(F.col("__lines")))
        .withColumn("__removed", F.coalesce(removed, F.lit(0)))
        .withColumn("__runs", F.when(F.col(spans).isNull(), 0).otherwise(F.size(spans)))
        .drop("__all", spans)
    )


def report(docs: DataFrame, space: Workspace) -> DataFrame:
    """One row per document: its lines, the lines and runs deleted, and a digest of the text that is left."""
    return dedup(docs.select("doc_id", "text"), space).select(
        "doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), F.col("__runs").alias("n_runs"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def clean(docs: DataFrame, space: Workspace) -> DataFrame:
    """The documents without their later repeated runs, columns as they came; those of which no word is left go."""
    own, named = shielded(docs, "doc_id", "text")
    gone = (F.col("__removed") > 0) & ~F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    return named(dedup(own, space).where(~gone))


#: The same rows in DuckDB, from the definition alone: no hashes and no fingerprints.
SQL = f"""
WITH line AS (
  SELECT doc_id, i - 1 AS idx, x FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
ink AS (
  SELECT doc_id, idx, x, row_number() OVER w AS r, sum(strlen(x) + 1) OVER w AS c, strlen(x) + 1 AS n
  FROM line WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') WINDOW w AS (PARTITION BY doc_id ORDER BY idx ROWS UNBOUNDED PRECEDING)),
win AS (
  SELECT a.doc_id, a.r AS lo, min(b.r) AS hi FROM ink a JOIN ink b ON a.doc_id = b.doc_id AND b.r BETWEEN a.r AND a.r + 49
    AND b.c - a.c + a.n >= {LEAST_BYTES} GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.r), b.r FROM ink a JOIN ink b ON a.doc_id = b.doc_id AND b.r BETWEEN a.r AND a.r + 49
    AND b.c - a.c + a.n >= {LEAST_BYTES} GROUP BY b.doc_id, b.r),
body AS (
  SELECT w.doc_id, w.lo, w.hi, string_agg(i.x, chr(10) ORDER BY i.r) AS t
  FROM win w JOIN ink i ON i.doc_id = w.doc_id AND i.r BETWEEN w.lo AND w.hi GROUP BY ALL),
short AS (SELECT doc_id, r, x FROM ink WHERE n < {LEAST_BYTES} AND len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) >= {LINE_WORDS}),
often AS (SELECT x FROM short GROUP BY x HAVING count(DISTINCT doc_id) >= {LINE_DOCUMENTS}),
later AS (
  SELECT doc_id, lo, hi FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, lo) AS k FROM body) WHERE k > 1
  UNION SELECT doc_id, r, r FROM (SELECT *, row_number() OVER (PARTITION BY x ORDER BY doc_id, r) AS k FROM short JOIN often USING (x)) WHERE k > 1),
span AS (
  SELECT l.doc_id, a.idx AS lo, b.idx AS hi FROM later l
  JOIN ink a ON a.doc_id = l.doc_id AND a.r = l.lo JOIN ink b ON b.doc_id = l.doc_id AND b.r = l.hi),
gone AS (SELECT DISTINCT i.doc_id, i.idx FROM line i JOIN span s ON i.doc_id = s.doc_id AND i.idx BETWEEN s.lo AND s.hi),
state AS (
  SELECT l.doc_id, l.idx, l.x, g.idx IS NOT NULL AS dead,
    g.idx IS NOT NULL AND coalesce(lag(g.idx) OVER (PARTITION BY l.doc_id ORDER BY l.idx) IS NULL, true) AS first
  FROM line l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.idx = l.idx)
SELECT d.doc_id, coalesce(count(s.idx), 0)::INT AS n_lines, coalesce(sum(s.dead::INT), 0)::INT AS n_removed,
  coalesce(sum(s.first::INT), 0)::INT AS n_runs,
  sha256(coalesce(string_agg(s.x, chr(10) ORDER BY s.idx) FILTER (NOT s.dead), '')) AS kept_sha256
FROM documents d LEFT JOIN state s USING (doc_id) GROUP BY d.doc_id
"""
