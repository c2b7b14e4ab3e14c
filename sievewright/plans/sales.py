"""The sales pipeline.

The rules run in a fixed order and each sees only what earlier ones left over. Row rules are booleans of one
projection (:func:`judge`), so the order is a matter of which boolean comes first, not of repeated scans:

    region -> customer conflict -> types (by id) -> nulls -> non-positive -> characters (by id)
           -> one row per id -> ids not loaded yet

Shuffles of whole rows, each avoided where the keys it is for are measured as few enough to broadcast: the customer flag, the id
aggregate of :func:`settle`, the anti join with the ids the target holds.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.contracts import Profile
from sievewright.functions import checks
from sievewright.functions.identity import row_hash
from sievewright.functions.text import quoted
from sievewright.operators import rules
from sievewright.operators.dedup import hash_rank, one_per_key
from sievewright.operators.keyed import conflicting_keys, drop_listed, flag_listed, hot_keys, keep_listed, seen_values
from sievewright.operators.rules import Stamp
from sievewright.operators.schema import align, clean_for
from sievewright.session import tune
from sievewright.sources.commits import KeyLookup
from sievewright.storage import Workspace, is_small

TYPED = "typed_"
REGION, CONFLICT, TYPE, NULL, NONPOSITIVE, CHARS, TYPO = (
    "invalid_region", "region_conflicts", "type_conversion", "null_values", "negative_values",
    "unknown_chars", "typos",
)
ISSUES = {
    REGION: "Invalid Region Value",
    CONFLICT: "Conflicting Region for Customer",
    TYPE: "Type conversion failed",
    NULL: "Null values found",
    NONPOSITIVE: "Negative values found",
}


@dataclass(frozen=True)
class PipelineResult:
    """Lazy frames: rows to load, quarantined rows of all rules, the judged input, row counts; if asked for, the regions that each
    customer of the input appears with."""

    clean: DataFrame
    quarantine: DataFrame
    judged: DataFrame
    seen: DataFrame | None = None

    @property
    def report(self) -> DataFrame:
        return report_of(self.judged, self.quarantine, self.clean)


def typed_name(name: str) -> str:
    return TYPED + name


def typed(profile: Profile, name: str) -> Column:
    """The converted value. Text needs no conversion, so the cleaned column serves."""
    is_text = name in checks.text_fields(profile.contract)
    return quoted(name) if is_text else quoted(typed_name(name))


def shown_value(profile: Profile, name: str) -> Column:
    """The converted value as the null report shows it: text that means missing is NULL."""
    value = typed(profile, name)
    if name in checks.text_fields(profile.contract):
        return F.when(~checks.is_null_token(value, profile.case_sensitive_tokens), value)
    return value


def judge(df: DataFrame, profile: Profile) -> DataFrame:
    """Clean the rows, convert them, and evaluate every row rule: projections only, no shuffle.

    Adds the converted value of every column that is not text, and one boolean per rule.
    """
    rows = align(clean_for(df, profile), profile.contract)
    fields = profile.contract.fields
    text = checks.text_fields(profile.contract)
    # Texts with a signed year never get as far as their converted value: by shape they are type-dirty.
    signed_years = profile.date_check == "parse"
    converted = rows.select("*", *[
        checks.convert(f, signed_years).alias(typed_name(f.name)) for f in fields if f.name not in text
    ])
    compare = {"<=": lambda c: c <= 0, "<": lambda c: c < 0}[profile.nonpositive_op]
    # A converted number or date prints as digits and inner hyphens, which no character rule reports,
    # so only text can be char-dirty among rows that reach that rule.
    return converted.select(
        "*",
        rules.outside_domain(profile).alias("is_" + REGION),
        checks.any_of([checks.type_bad(f, profile.date_check) for f in fields]).alias("is_" + TYPE),
        checks.any_of([shown_value(profile, n).isNull() for n in profile.columns]).alias("is_" + NULL),
        checks.any_of([F.coalesce(compare(typed(profile, n)), F.lit(False))
                       for n in checks.numeric_fields(profile.contract)]).alias("is_" + NONPOSITIVE),
        rules.chars_dirty(profile, text).alias("is_" + CHARS),
    )


def conflicting_customers(cleaned: DataFrame, profile: Profile) -> DataFrame:
    """Customers with several regions among the rows whose region is valid; reads two columns."""
    return conflicting_keys(cleaned, profile.customer_column, profile.region_column, profile.regions)


def flag_conflicts(judged: DataFrame, profile: Profile, customers: DataFrame, small: bool = False,
                   hot: dict[object, int] | None = None) -> DataFrame:
    """Mark the rows of the customers; in a join with a set too large to broadcast, the ``hot`` customers and the rows without a
    customer are split, because either may be a large share of the table."""
    keys = F.broadcast(customers) if small else customers
    return flag_listed(judged, keys, profile.customer_column, "is_" + CONFLICT, hot=None if small else hot or {})


def _reached_types() -> Column:
    return ~F.col("is_" + REGION) & ~F.col("is_" + CONFLICT)


def _survives_rows() -> Column:
    return ~F.col("is_" + TYPE) & ~F.col("is_" + NULL) & ~F.col("is_" + NONPOSITIVE)


def settle(flagged: DataFrame, profile: Profile, one_text_per_id: bool = False, workspace: Workspace | None = None) -> DataFrame:
    """From flagged rows to one clean row per id.

    Given a workspace, and as long as every id is written in one way, the ids that are rejected or repeated are found first, by an
    aggregate of a few numbers per id. If these are few enough to broadcast, the rows are neither shuffled nor sorted. Otherwise:

    Rejection by id and the choice of the surviving row are the same aggregate: per id, is any row
    type-dirty, is any row that got that far char-dirty, and which row has the smallest hash. Tasks
    reduce their own rows first, so a hot id costs one row per task, and no join is needed.

    Type rejection compares ids as text, the later steps as numbers. Both agree when each number is
    written in one way; the caller may assert that with ``one_text_per_id`` and saves a second aggregate.
    """
    id_column = profile.key
    by_id = profile.reject_by == "id"
    alive = _survives_rows()
    if not by_id and profile.reject_chars:
        alive = alive & ~F.col("is_" + CHARS)
    useful = alive | F.col("is_" + TYPE) if by_id else alive
    number = typed(profile, id_column)
    others = [n for n in profile.columns if n != id_column]
    reached = flagged.where(_reached_types() & useful & quoted(id_column).isNotNull())
    state = [
        quoted(id_column).alias("id_text"), number.alias("id"), alive.alias("alive"),
        (F.col("is_" + TYPE) if by_id else F.lit(False)).alias("bad_type"),
        (alive & F.col("is_" + CHARS) if by_id and profile.reject_chars else F.lit(False)).alias("bad_chars"),
    ]
    whole = F.struct(row_hash_of_typed(profile).alias("hash"), *[typed(profile, n).alias(n) for n in others])
    if workspace is not None and (one_text_per_id or not by_id):
        listed = workspace.hold(_ids_to_look_at(reached.select(*state, row_hash_of_typed(profile).alias("hash"))), "listed")
        if is_small(listed):
            return _settle_listed(reached.where(alive & number.isNotNull()).select(number.alias("id"), whole.alias("best")), listed, profile)
    rows = reached.select(*state[:2], *state[3:], F.when(alive, whole).alias("best"))

    def reduce_by(frame: DataFrame, *keys: str) -> DataFrame:
        return frame.groupBy(*keys).agg(
            F.bool_or("bad_type").alias("bad_type"), F.bool_or("bad_chars").alias("bad_chars"),
            F.min("best").alias("best"))

    if by_id and not one_text_per_id:
        by_text = reduce_by(rows, "id_text", "id").where(~F.col("bad_type") & F.col("best").isNotNull())
        settled = reduce_by(by_text, "id")
    else:
        settled = reduce_by(rows.where(F.col("id").isNotNull()), "id")
        settled = settled.where(~F.col("bad_type") & F.col("best").isNotNull())
    return _business_columns(settled.where(~F.col("bad_chars")), profile)


def _business_columns(settled: DataFrame, profile: Profile) -> DataFrame:
    return settled.select(*[F.col("id" if n == profile.key else f"best.{n}").alias(n) for n in profile.columns])


def _ids_to_look_at(state: DataFrame) -> DataFrame:
    """The ids that are rejected or have several surviving rows, with the smallest rank of these: a hash aggregate of numbers, far
    narrower than the rows."""
    alive_rank = F.when(F.col("alive"), hash_rank(F.col("hash")))
    numbers = state.where("id IS NOT NULL").groupBy("id").agg(
        F.bool_or(F.col("bad_type") | F.col("bad_chars")).alias("bad"), F.count(alive_rank).alias("n"), F.min(alive_rank).alias("least"))
    return numbers.where("bad OR n > 1").select(F.col("id").alias("listed_id"), "bad", "least")


def _settle_listed(rows: DataFrame, listed: DataFrame, profile: Profile) -> DataFrame:
    """The surviving rows: all whose id is not listed, and of the others the smallest per id that is not rejected.

    The rows pass by the broadcast ids without a shuffle. Copies collapse before the few rows of repeated ids are compared as a whole.
    """
    joined = rows.join(F.broadcast(listed), F.col("id") == F.col("listed_id"), "left")
    alone = joined.where(F.col("listed_id").isNull()).select("id", "best")
    repeated = joined.where(~F.col("bad") & (hash_rank(F.col("best.hash")) == F.col("least"))).select("id", "best.*").dropDuplicates()
    names = [c for c in repeated.columns if c != "id"]
    first = repeated.groupBy("id").agg(F.min(F.struct(*[quoted(c) for c in names])).alias("best"))
    return _business_columns(alone.unionByName(first), profile)


def row_hash_of_typed(profile: Profile) -> Column:
    text = checks.text_fields(profile.contract)
    return row_hash([n if n in text else typed_name(n) for n in profile.columns])


def new_only(clean: DataFrame, existing_keys: DataFrame | KeyLookup | None, profile: Profile,
             workspace: Workspace | None = None) -> DataFrame:
    """Drop ids the target already holds.

    A target that can be asked by key (``KeyLookup``) is asked for the ids of the load, and reads only files that may hold one.

    The target may hold far more keys than one load brings rows. Given a workspace, a load small enough to
    broadcast its ids first picks those keys out of the target's, without a shuffle of either. Otherwise the
    keys are shuffled to the rows, which :func:`settle` has already partitioned by id.
    """
    if existing_keys is None:
        return clean
    id_column = profile.key
    if isinstance(existing_keys, KeyLookup):
        if workspace is None:
            raise ValueError("a lookup by key reads the ids of the load several times and needs a workspace to hold them")
        clean = workspace.hold(clean, "settled")
        ids = clean.select(quoted(id_column))
        held_already = existing_keys.matching(ids)
        return drop_listed(clean, F.broadcast(held_already) if is_small(ids) else held_already, id_column)
    key = existing_keys.columns[0]
    if workspace is not None:
        clean = workspace.hold(clean, "settled")
        ids = clean.select(quoted(id_column))
        if is_small(ids):
            held_already = keep_listed(existing_keys, F.broadcast(ids), key, id_column).distinct()
            return drop_listed(clean, F.broadcast(held_already), id_column, key)
    return drop_listed(clean, existing_keys, id_column, key)


def any_flag() -> Column:
    return checks.any_of([F.col("is_" + r) for r in (REGION, CONFLICT, TYPE, NULL, NONPOSITIVE, CHARS)])


def rejected_ids(dirty: DataFrame, profile: Profile) -> DataFrame:
    """Distinct id texts of type-dirty rows."""
    id_column = profile.key
    bad = dirty.where(_reached_types() & F.col("is_" + TYPE) & quoted(id_column).isNotNull())
    return bad.select(quoted(id_column).alias("id_text")).distinct()


def reported_rows(dirty: DataFrame, profile: Profile) -> DataFrame:
    """Every row some rule reports, with that rule.

    A row is reported by the first rule that catches it and, when rows are rejected by id, not by a rule
    behind the type rule if its id is rejected there. Two kinds of rows are reported twice: type-dirty rows
    without an id, which no id can reject and which leave as null rows; and null rows that are also
    non-positive, where the profile lets the number rule see them.
    """
    id_column = profile.key
    by_id = profile.reject_by == "id"
    caught_late = F.col("is_" + NULL) | F.col("is_" + NONPOSITIVE) | F.col("is_" + CHARS)
    early = dirty.where(~_reached_types() | F.col("is_" + TYPE)).withColumn(
        "rule", F.when(F.col("is_" + REGION), REGION).when(F.col("is_" + CONFLICT), CONFLICT).otherwise(TYPE))
    passed_types = ~F.col("is_" + TYPE) | quoted(id_column).isNull() if by_id else ~F.col("is_" + TYPE)
    late = dirty.where(_reached_types() & passed_types & caught_late)
    if by_id:
        late = drop_listed(late, rejected_ids(dirty, profile), id_column, "id_text", split_nulls=True)
    if profile.nonpositive_before_nulls:
        found = F.array_compact(F.array(
            F.when(F.col("is_" + NULL), NULL), F.when(F.col("is_" + NONPOSITIVE), NONPOSITIVE),
            F.when(~F.col("is_" + NULL) & ~F.col("is_" + NONPOSITIVE), CHARS)))
        return early.unionByName(late.withColumn("rule", F.explode(found)))
    return early.unionByName(late.withColumn(
        "rule", F.when(F.col("is_" + NULL), NULL).when(F.col("is_" + NONPOSITIVE), NONPOSITIVE).otherwise(CHARS)))


def shape_quarantine(found: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    """Common layout of all rules: rule, metadata, record hash, business columns as text.

    Early rules show the cleaned text, later ones the converted values. ``flagged`` names the columns,
    ``bad_value`` shows the offending texts where the rule does.
    """
    names = profile.columns
    late = F.col("rule").isin(NULL, NONPOSITIVE, CHARS)
    gone = F.concat_ws(",", *[F.when(shown_value(profile, n).isNull(), F.lit(n)) for n in names])
    shown = found.select("rule", gone.alias("__gone"), *[
        F.when(late, shown_value(profile, n).cast("string")).otherwise(quoted(n)).alias(n) for n in names
    ])
    cells = checks.type_issues(profile.contract, profile.date_check)
    text = checks.text_fields(profile.contract)
    low = F.concat_ws(",", *[
        F.when(checks.nonpositive(n, profile.nonpositive_op), F.lit(n))
        for n in checks.numeric_fields(profile.contract)])
    bad_text = F.concat_ws(" | ", *[F.when(checks.char_bad(n), quoted(n)) for n in text])
    issue = F.when(F.col("rule") == CHARS, rules.char_issue_text(profile, text))
    for rule, label in ISSUES.items():
        issue = issue.when(F.col("rule") == rule, label)
    return shown.withColumn("__cells", F.when(F.col("rule") == TYPE, cells)).select(
        "rule", issue.alias("issue"),
        F.when(F.col("rule") == REGION, profile.region_column)
        .when(F.col("rule") == TYPE, F.concat_ws(",", F.col("__cells.column")))
        .when(F.col("rule") == NULL, F.col("__gone"))
        .when(F.col("rule") == NONPOSITIVE, low).alias("flagged"),
        F.when(F.col("rule") == TYPE, F.concat_ws(",", F.col("__cells.value")))
        .when(F.col("rule") == CHARS, bad_text).alias("bad_value"),
        F.lit(None).cast("string").alias("suggested_value"),
        stamp.source(), stamp.project(), stamp.logged(), row_hash(names).alias("row_hash"),
        *[quoted(n) for n in names],
    )


def dedup_quarantine(shaped: DataFrame) -> DataFrame:
    """One record per rule and row hash; the type rule logs every row, copies included."""
    once = one_per_key(shaped.where(F.col("rule") != TYPE), ["rule", "row_hash"])
    return shaped.where(F.col("rule") == TYPE).unionByName(once)


def typo_records(flagged: DataFrame, dirty: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    """Dictionary near misses among the rows that pass all row rules, in the quarantine layout."""
    id_column = profile.key
    passed = flagged.where(_reached_types() & _survives_rows())
    if profile.reject_chars:
        passed = passed.where(~F.col("is_" + CHARS))
    if profile.reject_by == "id":
        bad_types = rejected_ids(dirty, profile)
        passed = drop_listed(passed, bad_types, id_column, "id_text")
        if profile.reject_chars:
            bad = dirty.where(_reached_types() & _survives_rows() & F.col("is_" + CHARS))
            bad_chars = drop_listed(bad, bad_types, id_column, "id_text")
            ids = bad_chars.select(typed(profile, id_column).alias("id")).distinct()
            passed = drop_listed(passed, ids, typed_name(id_column), "id")
    names = profile.columns
    found = rules.typos(passed.select(*[typed(profile, n).alias(n) for n in names]), profile, stamp)
    return found.select(
        F.lit(TYPO).alias("rule"), F.col("dirty_reason").alias("issue"), F.col("column_flagged").alias("flagged"),
        F.lit(None).cast("string").alias("bad_value"), "suggested_value", "source_file", stamp.project(),
        "logged_at", row_hash([*names, "dirty_reason", "column_flagged", "suggested_value"]).alias("row_hash"),
        *[quoted(n).cast("string").alias(n) for n in names],
    )


def quarantine_of(flagged: DataFrame, dirty: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    records = dedup_quarantine(shape_quarantine(reported_rows(dirty, profile), profile, stamp))
    if not profile.typo_dictionary:
        return records
    return records.unionByName(typo_records(flagged, dirty, profile, stamp))


def report_of(raw: DataFrame, quarantine: DataFrame, clean: DataFrame | int) -> DataFrame:
    """Row counts: what came in, records per rule, rows to load. ``clean`` may be a number that is known already."""
    def total(df: DataFrame | int, label: str) -> DataFrame:
        if isinstance(df, int):
            return raw.sparkSession.createDataFrame([(label, df)], "stage string, rows bigint")
        return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(label).alias("stage"), "rows")

    per_rule = quarantine.groupBy(F.col("rule").alias("stage")).agg(F.count(F.lit(1)).alias("rows"))
    return total(raw, "raw").unionByName(per_rule).unionByName(total(clean, "loaded"))


def ids_written_one_way(flagged: DataFrame, profile: Profile) -> bool:
    """True when no id text differs from its number in plain digits (``007``); reads two columns."""
    id_column = profile.key
    differs = quoted(id_column) != typed(profile, id_column).cast("string")
    return not flagged.agg(F.bool_or(differs).alias("differs")).first()["differs"]


class SeenBefore(Protocol):
    """The regions that earlier inputs had for customers, as :func:`seen_values` has them."""

    def of(self, customers: DataFrame) -> DataFrame: ...


def conflicts_with_earlier(cleaned: DataFrame, profile: Profile, earlier: SeenBefore, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """The customers of this input that have several regions in it and all earlier ones together, and what it adds."""
    name = profile.customer_column
    own = workspace.hold(seen_values(cleaned, name, profile.region_column, profile.regions).where("seen <> 0"), "seen")
    together = own.unionByName(earlier.of(own.select(quoted(name)))).groupBy(quoted(name)).agg(F.bit_or("seen").alias("seen"))
    return together.where(F.bit_count("seen") > 1).select(quoted(name)), own


def run(df: DataFrame, profile: Profile, stamp: Stamp, workspace: Workspace,
        existing_keys: DataFrame | KeyLookup | None = None, earlier: SeenBefore | None = None) -> PipelineResult:
    """The whole pipeline over ``df``.

    Held in the workspace: the customers in conflict, the flagged rows, and the flagged rows some rule
    reports. The three results are lazy reads of those; decisions that depend on the data (broadcast or
    shuffle, one id aggregate or two) are taken on measured sizes. With ``earlier`` a customer is in conflict also by what
    earlier inputs had; their rows that are loaded already stay.
    """
    tune(df.sparkSession)
    seen = None
    if earlier is None:
        found = conflicting_customers(clean_for(df, profile), profile)
    else:
        found, seen = conflicts_with_earlier(clean_for(df, profile), profile, earlier, workspace)
    customers = workspace.hold(found, "conflicts")
    small = is_small(customers)
    hot = None if small else hot_keys(clean_for(df, profile), profile.customer_column)
    flagged = workspace.hold(flag_conflicts(judge(df, profile), profile, customers, small, hot), "flagged")
    dirty = workspace.hold(flagged.where(any_flag()), "dirty")
    one_way = profile.reject_by == "row" or ids_written_one_way(flagged, profile)
    clean = new_only(settle(flagged, profile, one_way, workspace), existing_keys, profile, workspace)
    return PipelineResult(clean, quarantine_of(flagged, dirty, profile, stamp), flagged, seen)
