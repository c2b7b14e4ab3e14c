"""The financials pipeline: row rules only, so one projection decides for every row where it leaves.

    dates (reported, kept) -> nulls -> negatives -> numeric text -> characters -> doubtful text -> types
                           -> full-row distinct

There are no region rules: the schema has neither region nor customer.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, NumericType, StringType, StructField

from sievewright.contracts import Profile
from sievewright.functions import checks
from sievewright.functions.dates import parse_permissive, parse_strict
from sievewright.functions.identity import row_hash
from sievewright.functions.text import DIGITS_PATTERN, backticked, quoted, spelled_number, strip_currency
from sievewright.operators import rules
from sievewright.operators.dedup import dedup_full_row
from sievewright.operators.keyed import drop_listed
from sievewright.operators.rules import Stamp
from sievewright.operators.schema import align, clean_strings, to_text
from sievewright.plans.sales import PipelineResult, new_only
from sievewright.session import tune
from sievewright.sources.commits import KeyLookup
from sievewright.storage import Workspace

RULES = (
    "dirty_dates", "null_values", "negative_values", "numeric_strings", "unknown_chars", "typos", "type_conversion")
DATES, NULL, NEGATIVE, NUMERIC_TEXT, CHARS, TYPO, TYPE = RULES


def prepare(df: DataFrame, profile: Profile) -> DataFrame:
    """Clean the texts; spelled numbers become digits, currency signs go. Columns outside the contract ride along."""
    cleaned = align(clean_strings(df, profile.title_mode, profile.skip_clean), profile.contract, extras="keep")
    kinds = {f.name: f.dataType for f in profile.contract.fields}

    def number(n: str) -> Column:
        return F.when(quoted(n).rlike(DIGITS_PATTERN), quoted(n)).otherwise(strip_currency(spelled_number(n)))

    return cleaned.select([
        number(n).alias(n) if isinstance(kinds.get(n), NumericType) else backticked(n)
        for n in cleaned.columns
    ])


def settle_dates(rows: DataFrame, profile: Profile) -> DataFrame:
    """Dates a strict format reads are rewritten as ``yyyy-MM-dd``; other texts are kept as they are."""
    dates = {f.name for f in profile.contract.fields if isinstance(f.dataType, DateType)}
    return rows.select([
        F.coalesce(parse_strict(quoted(n)).cast("string"), quoted(n)).alias(n) if n in dates else backticked(n)
        for n in rows.columns
    ])


def leaves_at(profile: Profile) -> Column:
    """The first rule that removes the row; NULL for rows that pass. Rows of plainly good values only, mostly the most, do not
    go through the rules one by one."""
    good = reduce(and_, [
        checks.plainly_good(f, profile.nonpositive_op, profile.typo_dictionary.get(f.name, ()), profile.min_text_length)
        for f in profile.contract.fields
    ])
    return F.when(~good, _first_rule(profile))


def _first_rule(profile: Profile) -> Column:
    names, text = profile.columns, checks.text_fields(profile.contract)
    doubts = [
        F.size(checks.text_doubts(n, profile.typo_dictionary.get(n, ()), profile.min_text_length)) > 0 for n in text
    ]
    return (
        F.when(checks.any_of([checks.missing(n, profile.case_sensitive_tokens) for n in names]), NULL)
        .when(checks.any_of([checks.nonpositive(n, profile.nonpositive_op)
                             for n in checks.numeric_fields(profile.contract)]), NEGATIVE)
        .when(checks.any_of([F.coalesce(quoted(n).rlike(checks.WHOLE_NUMBER_TEXT_PATTERN), F.lit(False))
                             for n in text]), NUMERIC_TEXT)
        .when(checks.any_of([checks.char_bad(n) for n in names if n not in profile.skip_chars]), CHARS)
        .when(checks.any_of(doubts), TYPO)
        .when(checks.any_of([checks.type_bad(f, currency=True) for f in profile.contract.fields]), TYPE)
    )


def _typed(f: StructField) -> Column:
    c = quoted(f.name)
    if isinstance(f.dataType, DateType):
        return parse_permissive(c).alias(f.name)
    if isinstance(f.dataType, StringType):
        return c
    if isinstance(f.dataType, IntegralType):  # a double holds integers up to 2**53 only
        return c.try_cast(checks.EXACT).try_cast(f.dataType).alias(f.name)
    return c.try_cast("double").try_cast(f.dataType).alias(f.name)


def clean_rows(judged: DataFrame, profile: Profile) -> DataFrame:
    extras = [c for c in judged.columns if c not in profile.columns and c != "rule"]
    kept = judged.where(F.col("rule").isNull())
    return dedup_full_row(kept.select(*[_typed(f) for f in profile.contract.fields], *[quoted(c) for c in extras]))


def quarantine_of(judged: DataFrame, dirty: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    """All rules in one layout: rule, issue, flagged columns, bad values, expected types, metadata, record hash, business
    columns as text.

    Settled dates serve the date rule as well: a text that no strict format reads has been kept.
    """
    names = profile.columns

    def rows_of(rule: str) -> DataFrame:
        return dirty.where(F.col("rule") == rule).select(*[backticked(n) for n in names])

    def text(c: Column | None) -> Column:
        return (F.lit(None) if c is None else c).cast("string")

    def common(rule: str, found: DataFrame, issue: str = "issue", flagged: Column | None = None,
               bad_value: Column | None = None, expected_type: Column | None = None) -> DataFrame:
        return to_text(found.select(
            F.lit(rule).alias("rule"), F.col(issue).alias("issue"),
            text(flagged).alias("flagged"), text(bad_value).alias("bad_value"), text(expected_type).alias("expected_type"),
            "source_file", stamp.project(), "logged_at", row_hash(names).alias("row_hash"),
            *[backticked(n) for n in names],
        ))

    parts = [
        common(DATES, rules.dirty_dates(judged, profile, stamp), flagged=F.col("column_flagged"),
               bad_value=F.col("bad_date_value")),
        common(NULL, rules.nulls(rows_of(NULL), profile, stamp), flagged=F.concat_ws(",", "null_columns")),
        common(NEGATIVE, rules.nonpositive(rows_of(NEGATIVE), profile, stamp),
               flagged=F.concat_ws(",", "negative_columns")),
        common(NUMERIC_TEXT, rules.numeric_strings(rows_of(NUMERIC_TEXT), profile, stamp), "dirty_reason"),
        common(CHARS, rules.special_chars_described(rows_of(CHARS), profile, stamp), flagged=F.col("column_flagged"),
               bad_value=F.col("bad_value")),
        common(TYPO, rules.doubtful_text(rows_of(TYPO), profile, stamp), "dirty_reason", F.col("column_flagged")),
        common(TYPE, rules.type_dirty_described(rows_of(TYPE), profile, stamp), flagged=F.col("column_flagged"),
               expected_type=F.col("expected_type")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def run(df: DataFrame, profile: Profile, stamp: Stamp, workspace: Workspace,
        existing_keys: DataFrame | KeyLookup | None = None) -> PipelineResult:
    """``existing_keys`` are keys already loaded; their rows are not loaded again."""
    tune(df.sparkSession)
    judged = workspace.hold(
        settle_dates(prepare(df, profile), profile).withColumn("rule", leaves_at(profile)), "judged")
    dirty = workspace.hold(judged.where(F.col("rule").isNotNull()), "dirty")
    clean = clean_rows(judged, profile)
    if isinstance(existing_keys, KeyLookup):
        clean = new_only(clean, existing_keys, profile, workspace)
    elif existing_keys is not None:
        clean = drop_listed(clean, existing_keys, profile.key)
    return PipelineResult(clean, quarantine_of(judged, dirty, profile, stamp), judged)
