"""Quarantine rules: each takes rows and returns the offending ones with diagnostics in front.

``rows -> dirty`` functions share the shape *metadata columns, then business columns*. ``logged_at`` is the
run's own time stamp, passed in, so that a repeated run writes the same records.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from sievewright.contracts import Profile
from sievewright.functions import checks
from sievewright.functions.dates import strict_issue
from sievewright.functions.identity import row_hash
from sievewright.functions.text import backticked, quoted
from sievewright.operators.dedup import dedup_full_row, dedup_row_hash
from sievewright.operators.keyed import conflicting_keys, hot_keys, keep_listed
from sievewright.operators.schema import align, normalize_headers
from sievewright.storage import Workspace, is_small


@dataclass(frozen=True)
class Stamp:
    """What every quarantine record says about the run that wrote it."""

    run_ts: datetime
    source_file: str
    project_name: str = "sales_etl"

    def source(self) -> Column:
        return F.lit(self.source_file).alias("source_file")

    def project(self) -> Column:
        return F.lit(self.project_name).alias("project_name")

    def logged(self) -> Column:
        return F.lit(self.run_ts).cast("timestamp").alias("logged_at")


def _business(names) -> list[str]:
    return [backticked(n) for n in names]


def _hash(names) -> Column:
    return row_hash(names).alias("row_hash")


def invalid_region(df: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    """Region given but not among the valid ones; a NULL region passes."""
    rows = align(df, profile.contract)
    names = profile.columns
    return dedup_row_hash(rows.where(outside_domain(profile)).select(
        F.lit("Invalid Region Value").alias("issue"), F.lit(profile.region_column).alias("column_flagged"),
        stamp.source(), stamp.project(), stamp.logged(), _hash(names), *_business(names),
    ))


def outside_domain(profile: Profile) -> Column:
    return F.coalesce(~quoted(profile.region_column).isin(*profile.regions), F.lit(False))


def region_conflicts(df: DataFrame, profile: Profile, stamp: Stamp, conflicts: DataFrame | None = None) -> DataFrame:
    """Rows of customers seen with more than one region; header names are lower-cased.

    Only the given rows are compared (in a stream: one micro-batch). Rows without a customer name never
    conflict, and stay out of the join.
    """
    rows = align_lower(df, profile.contract)
    customer, region = profile.customer_column.lower(), profile.region_column.lower()
    if conflicts is None:
        conflicts = conflicting_keys(rows, customer, region)
    names = rows.columns
    named = rows.where(quoted(customer).isNotNull())
    hit = keep_listed(named, conflicts, customer, conflicts.columns[0], hot=hot_keys(named, customer))
    return dedup_row_hash(hit.select(
        F.lit("Conflicting Region for Customer").alias("issue"), stamp.source(), stamp.logged(),
        _hash(names), *_business(names),
    ))


def align_lower(df: DataFrame, contract: StructType) -> DataFrame:
    lower = StructType([type(f)(f.name.lower(), f.dataType) for f in contract.fields])
    return align(normalize_headers(df), lower)


def type_dirty_rows(df: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    """One record per row with text that does not conform to the contract; columns and values joined by commas.

    ``profile.date_check="pattern"`` tests dates by shape, so a date the parser can read may still be
    reported and the other way round; ``"parse"`` reports exactly what the parser cannot read.
    """
    names = profile.columns
    bad = checks.any_of([checks.type_bad(f, profile.date_check) for f in profile.contract.fields])
    hit = align(df, profile.contract).where(bad).withColumn(
        "__cells", checks.type_issues(profile.contract, profile.date_check))
    return hit.select(
        F.lit("Type conversion failed").alias("issue"), stamp.source(), stamp.logged(),
        F.concat_ws(",", F.col("__cells.column")).alias("dirty_columns"),
        F.concat_ws(",", F.col("__cells.value")).alias("dirty_values"),
        *_business(names),
    )


def type_dirty_cells(df: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    """As :func:`type_dirty_rows`, one record per cell with its ``error_type``."""
    names = profile.columns
    cells = align(df, profile.contract).withColumn(
        "__cell", F.explode(checks.type_issues(profile.contract, profile.date_check)))
    shown = cells.select(
        F.col("__cell.column").alias("dirty_columns"), F.col("__cell.value").alias("dirty_values"),
        F.col("__cell.error_type").alias("error_type"), stamp.source(), stamp.logged(), *_business(names),
    )
    return with_record_hash(shown)


def type_dirty_described(df: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    """The financials flavour: signs are stripped from numbers and dates are read permissively first."""
    names = profile.columns
    hit = align(df, profile.contract).withColumn(
        "__cells", checks.type_issues(profile.contract, currency=True)).where(F.size("__cells") > 0)
    issues = F.transform("__cells", lambda c: F.concat(c["column"], F.lit(": Type conversion failed")))
    return hit.select(
        F.concat_ws(", ", F.col("__cells.column")).alias("column_flagged"),
        F.concat_ws(", ", F.col("__cells.expected_type")).alias("expected_type"),
        F.concat_ws("; ", issues).alias("issue"), stamp.source(), stamp.logged(), *_business(names),
    )


def nulls(df: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    """Rows with a missing value: NULL, or text that means missing, which is shown as NULL.

    Tokens match whole trimmed values in any case (``Canada`` is not missing); see
    ``profile.case_sensitive_tokens``.
    """
    names = profile.columns
    rows = align(df, profile.contract)
    shown = rows.select([
        F.when(~checks.is_null_token(quoted(n), profile.case_sensitive_tokens), quoted(n)).alias(n) for n in names
    ])
    gone = {n: quoted(n).isNull() for n in names}
    return dedup_row_hash(shown.where(checks.any_of(gone.values())).select(
        F.lit("Null values found").alias("issue"), checks.names_where(gone).alias("null_columns"),
        stamp.source(), stamp.project(), stamp.logged(), _hash(names), *_business(names),
    ))


def nonpositive(df: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    """Rows with a number ``<= 0`` (sales: zero counts) or ``< 0`` (financials), by ``profile.nonpositive_op``.

    Text columns are read with ``try_cast``, so the rule works before and after type conversion.
    """
    names = profile.columns
    rows = align(df, profile.contract)
    bad = {n: checks.nonpositive(n, profile.nonpositive_op) for n in checks.numeric_fields(profile.contract)}
    return dedup_row_hash(rows.where(checks.any_of(bad.values())).select(
        F.lit("Negative values found").alias("issue"), checks.names_where(bad).alias("negative_columns"),
        stamp.source(), stamp.project(), stamp.logged(), _hash(names), *_business(names),
    ))


def char_issue_text(profile: Profile, names=None) -> Column:
    """Issues of all columns joined by ``|``, then the note on a non-ASCII customer name."""
    checked = [n for n in (names or profile.columns) if n not in profile.skip_chars]
    issue = F.concat_ws(" | ", *[checks.char_issue(n) for n in checked])
    if profile.customer_column is None:
        return issue
    note = F.when(quoted(profile.customer_column).rlike(checks.NON_ASCII_PATTERN),
                  F.lit(f"Non-ASCII character detected in {profile.customer_column}"))
    return F.concat_ws(" | ", issue, note)


def chars_dirty(profile: Profile, names=None) -> Column:
    checked = [n for n in (names or profile.columns) if n not in profile.skip_chars]
    found = checks.any_of([checks.char_bad(n) for n in checked])
    if profile.customer_column in profile.skip_chars:
        found = found | F.coalesce(quoted(profile.customer_column).rlike(checks.NON_ASCII_PATTERN), F.lit(False))
    return found


def special_chars(df: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    """Rows with invisible characters, a sign at either edge of a value, or characters not allowed."""
    names = profile.columns
    checked = [n for n in names if n not in profile.skip_chars]
    values = F.concat_ws(" | ", *[F.when(checks.char_bad(n), quoted(n).cast("string")) for n in checked])
    return dedup_row_hash(align(df, profile.contract).where(chars_dirty(profile)).select(
        char_issue_text(profile).alias("issue"), values.alias("bad_value"), stamp.source(), stamp.logged(),
        _hash(names), *_business(names),
    ))


def special_chars_described(df: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    """The financials flavour: names the characters, lists the columns, shows ``column: value`` pairs."""
    names = profile.columns
    checked = [n for n in names if n not in profile.skip_chars]
    bad = {n: checks.char_bad(n) for n in checked}

    def joined(sep, text):
        return F.concat_ws(sep, *[F.when(bad[n], text(n)) for n in checked])

    return align(df, profile.contract).where(checks.any_of(bad.values())).select(
        F.concat_ws(" | ", *[checks.char_issue_described(n) for n in checked]).alias("issue"),
        joined(", ", F.lit).alias("column_flagged"),
        joined(" | ", lambda n: F.concat(F.lit(f"{n}: "), quoted(n).cast("string"))).alias("bad_value"),
        stamp.source(), stamp.logged(), *_business(names),
    )


def bigint(df: DataFrame, column: str, stamp: Stamp) -> DataFrame:
    """Values of ``column`` that are not all digits, or overflow a bigint; one record per distinct value."""
    c = quoted(column)
    bad = c.isNotNull() & (~c.rlike(checks.BIGINT_PATTERN) | c.try_cast("bigint").isNull())
    return dedup_row_hash(df.where(bad).select(
        *_business(df.columns), F.lit(column).alias("dirty_column"), c.alias("dirty_value"),
        F.lit("INVALID_BIGINT").alias("error_type"), stamp.source(), stamp.logged(),
        F.sha2(F.concat_ws("|", c.cast("string"), F.lit(stamp.source_file)), 256).alias("row_hash"),
    ))


def numeric_strings(df: DataFrame, profile: Profile, stamp: Stamp, skip=()) -> DataFrame:
    """All-digit values in text columns; one record per row and column."""
    names = profile.columns
    reasons = F.array_compact(F.array(*[
        F.when(quoted(n).rlike(checks.WHOLE_NUMBER_TEXT_PATTERN),
               F.lit(f"Numeric string in categorical column '{n}'"))
        for n in checks.text_fields(profile.contract) if n not in skip
    ]))
    return align(df, profile.contract).select(
        F.explode(reasons).alias("dirty_reason"), stamp.source(), stamp.logged(), *_business(names))


def dirty_dates(df: DataFrame, profile: Profile, stamp: Stamp, columns=None) -> DataFrame:
    """Date texts no strict format reads, with the reason; one record per row and column. Rows stay."""
    names = profile.columns
    columns = columns or [f.name for f in profile.contract.fields if isinstance(f.dataType, DateType)]
    cells = F.array_compact(F.array(*[
        F.when(strict_issue(quoted(n)).isNotNull(), F.struct(
            F.lit(n).alias("column"), F.trim(quoted(n)).alias("value"), strict_issue(quoted(n)).alias("issue")))
        for n in columns
    ]))
    hit = align(df, profile.contract).withColumn("__cell", F.explode(cells))
    return hit.select(
        F.col("__cell.column").alias("column_flagged"), F.col("__cell.value").alias("bad_date_value"),
        F.col("__cell.issue").alias("issue"), stamp.source(), stamp.project(), stamp.logged(), *_business(names))


def typos(df: DataFrame, profile: Profile, stamp: Stamp, max_distance: int = 2) -> DataFrame:
    """Near misses of dictionary values, one record per row, column and suggestion; rows stay.

    One pass over the rows: the suggestions of all columns are one array that is exploded.
    """
    names = df.columns

    def suggestions(name: str) -> Column:
        near = checks.typo_suggestions(name, profile.typo_dictionary[name], max_distance, profile.flag_valid_typos)
        return F.transform(near, lambda s: F.struct(F.lit(name).alias("column"), s.alias("suggestion")))

    listed = [n for n in checks.text_fields(profile.contract) if profile.typo_dictionary.get(n)]
    none = F.array().cast("array<struct<column:string,suggestion:string>>")
    hits = F.flatten(F.array(*[suggestions(n) for n in listed])) if listed else none
    found = df.withColumn("__typo", F.explode(hits)).select(
        *_business(names), F.lit("Possible typo").alias("dirty_reason"),
        F.col("__typo.column").alias("column_flagged"), F.col("__typo.suggestion").alias("suggested_value"),
        stamp.source(), stamp.logged(),
    )
    return dedup_full_row(found)


#: Characters at either end of a text whose deletions are indexed.
TYPO_END = 10
#: A broadcast of suggestions takes several times the bytes of their text, in the driver too.
SUGGESTIONS_MAX_BYTES = 8 * 1024 * 1024


def deletions(text: Column, count: int = 2, end: int = TYPO_END) -> Column:
    """Both ends of a text with up to ``count`` characters left out, in every way.

    Two texts at most ``count`` edits apart have one of these in common: leave out what differs. Of the middle
    that was cut out, as many characters are left out as the alignment is shifted by, which is part of that count. Both ends,
    because many texts may begin alike and would all meet by their beginnings.
    """
    ends = F.when(F.length(text) > 2 * end, F.concat(F.substring(text, 1, end), F.right(text, F.lit(end)))).otherwise(text)
    found = last = F.array(ends)
    for _ in range(count):
        last = F.array_distinct(F.flatten(F.transform(last, lambda t: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))),
            lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t)))))))
        found = F.array_union(found, last)
    return found


def near_words(texts: DataFrame, words: DataFrame, max_distance: int = 2) -> DataFrame:
    """``column_name, text, value``: pairs of different texts at most ``max_distance`` edits apart, in lower case.

    Joined on deletions instead of comparing every text with every word; the distance is computed for candidates only. ``texts`` has
    ``column_name, text`` in lower case, ``words`` ``column_name, value``. The join is on hashes of the deletions; texts that meet
    by chance are too far apart. It is never a broadcast: by the size of the words Spark cannot see how many deletions they have.
    """
    def variants(c: Column) -> Column:
        return F.explode(F.transform(deletions(c, max_distance), lambda v: F.xxhash64(v)))

    # Dealt out first: a small file of words makes much work.
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    indexed = words.repartition(parts, "value").withColumn("word", F.lower("value")).withColumn("variant", variants(F.col("word")))
    asked = texts.repartition(parts, "text").withColumn("variant", variants(F.col("text")))
    candidates = asked.join(indexed.hint("merge"), ["column_name", "variant"]).where(
        (F.abs(F.length("text") - F.length("word")) <= max_distance) & (F.col("text") != F.col("word")))
    pairs = candidates.where(F.levenshtein("text", "word", max_distance).between(0, max_distance))
    return pairs.select("column_name", "text", "value").distinct()


def typos_by_table(df: DataFrame, dictionary: DataFrame, stamp: Stamp, workspace: Workspace, max_distance: int = 2,
                   flag_valid: bool = False) -> DataFrame:
    """As :func:`typos`, with the dictionary as a table ``column_name, value`` of any size.

    Every different text is looked up once, however many rows have it; the rows then meet the suggestions, which are broadcast if they
    are few. Columns that ``df`` lacks are ignored, and so are NULLs on either side. ``df`` is read twice.
    """
    names = df.columns
    words = workspace.hold(dictionary.select("column_name", "value").where("value IS NOT NULL").distinct(), "words")
    listed = sorted({r["column_name"] for r in words.select("column_name").distinct().collect()} & set(names))
    none = F.array().cast("array<struct<column_name:string,text:string>>")
    cells = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lower(quoted(n)).alias("text")) for n in listed]) if listed else none
    texts = df.select(F.inline(cells)).where("text IS NOT NULL").distinct()
    if not flag_valid:
        right = words.select("column_name", F.lower("value").alias("text"))
        right = F.broadcast(right) if is_small(words, max_bytes=SUGGESTIONS_MAX_BYTES) else right.hint("merge")
        texts = texts.join(right, ["column_name", "text"], "left_anti")
    near = near_words(texts, words, max_distance).groupBy("column_name", "text").agg(F.sort_array(F.collect_set("value")).alias("values"))
    near = workspace.hold(near, "near")
    small = is_small(near.select("column_name", "text", F.array_join("values", ",")), max_bytes=SUGGESTIONS_MAX_BYTES)
    keys = F.broadcast(near) if small else near.hint("merge")
    flagged = df.withColumn("__cell", F.explode(cells))
    found = flagged.join(keys, (F.col("__cell.column_name") == keys["column_name"]) & (F.col("__cell.text") == keys["text"])).select(
        *_business(names), F.lit("Possible typo").alias("dirty_reason"), keys["column_name"].alias("column_flagged"),
        F.explode("values").alias("suggested_value"), stamp.source(), stamp.logged())
    return dedup_full_row(found)


def with_record_hash(dirty: DataFrame) -> DataFrame:
    """Add the record hash used by the stream, over everything but the time stamp."""
    return dirty.withColumn("row_hash", row_hash([c for c in dirty.columns if c != "logged_at"]))


def doubtful_text(df: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    """Text that looks mistyped: not in the allowed set, too short, double blanks, odd characters.

    One record per row and column; the reasons are those of that row, not of the whole column.
    """
    names = profile.columns
    cells = F.array(*[
        F.struct(F.lit(n).alias("column"),
                 checks.text_doubts(n, profile.typo_dictionary.get(n, ()), profile.min_text_length).alias("reasons"))
        for n in checks.text_fields(profile.contract)
    ])
    hit = align(df, profile.contract).withColumn(
        "__cell", F.explode(F.filter(cells, lambda c: F.size(c["reasons"]) > 0)))
    return hit.select(
        F.concat_ws("; ", F.col("__cell.reasons")).alias("dirty_reason"),
        F.col("__cell.column").alias("column_flagged"), stamp.source(), stamp.logged(), *_business(names))
