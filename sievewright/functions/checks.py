"""Row checks: booleans for the main flow, texts and names for the diagnostics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from sievewright.contracts import INVISIBLE_CHARACTERS, REPLACEMENT_CHARACTER, SPECIAL_CHARACTERS
from sievewright.functions.dates import DATE_PATTERN, parse_multi, parse_permissive
from sievewright.functions.text import SHORT_TEXT, backticked, is_null_token, quoted, strip_currency

# Patterns of the type, number and character rules.
INTEGER_PATTERN = r"^-?\d+$"
FLOAT_PATTERN = r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"
ANY_NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
NUMERIC_TEXT_PATTERN = r"^[0-9]+(\.[0-9]+)?$"
WHOLE_NUMBER_TEXT_PATTERN = r"^\d+$"
BIGINT_PATTERN = r"^[0-9]+$"
EDGE_PATTERN = r"^[^a-zA-Z0-9]|[^a-zA-Z0-9]$"
# A text is rejected if it holds a character that is not listed, or a hyphen beside a blank. Two plain patterns say so; one
# with a look-around at every character would mean the same and be slower.
ALLOWED_PATTERN = r"^[a-zA-Z0-9\s.,;:()_/-]+$"
SPACED_HYPHEN_PATTERN = r"\s-|-\s"
NON_ASCII_PATTERN = r"[^\x00-\x7F]"
SPECIAL_PATTERN = "[" + SPECIAL_CHARACTERS + "]"
SUSPICIOUS_PATTERN = r"[^a-zA-Z0-9\s.,;:!?()\-_/]"

# One look at a value that has none of the three character issues.
CLEAN_TEXT_PATTERN = r"^[a-zA-Z0-9]([a-zA-Z0-9\s.,;:()_/-]*[a-zA-Z0-9])?\z"


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def names_where(conditions: dict[str, Column]) -> Column:
    """array<string> of the names whose condition holds."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(n)) for n, cond in conditions.items()]))


def numeric_fields(contract: StructType) -> list[str]:
    return [f.name for f in contract.fields if isinstance(f.dataType, NumericType)]


def text_fields(contract: StructType) -> list[str]:
    return [f.name for f in contract.fields if isinstance(f.dataType, StringType)]


# Holds every 64-bit integer, also one written with fraction or exponent.
EXACT = "decimal(38,10)"


# --- missing values -----------------------------------------------------------------------------

def missing(name: str, case_sensitive: bool = False) -> Column:
    c = quoted(name)
    return c.isNull() | is_null_token(c, case_sensitive)


# --- numbers ------------------------------------------------------------------------------------

def nonpositive(name: str, op: str = "<=") -> Column:
    """The value reads as a number and is ``<= 0`` (or ``< 0``); NULL and other text are not."""
    number = quoted(name).try_cast("double")
    hit = {"<=": number <= 0, "<": number < 0}[op]
    return F.coalesce(hit, F.lit(False))


# --- types --------------------------------------------------------------------------------------

def _reads_as(c: Column, dtype: DataType, date_check: str, currency: bool) -> Column:
    if isinstance(dtype, DateType):
        if currency:
            return parse_permissive(c).isNotNull()
        return parse_multi(c, signed_years=True).isNotNull() if date_check == "parse" else c.rlike(DATE_PATTERN)
    if currency and isinstance(dtype, NumericType):
        text = strip_currency(c)
        number = text.rlike(ANY_NUMBER_PATTERN)
        if isinstance(dtype, (DoubleType, FloatType)):
            return number
        exact, whole = text.try_cast(EXACT), text.try_cast("double") == F.floor(text.try_cast("double"))
        return F.coalesce(number & whole & (exact == F.floor(exact)) & exact.try_cast(dtype).isNotNull(), F.lit(False))
    if isinstance(dtype, IntegerType):
        return c.rlike(INTEGER_PATTERN)
    if isinstance(dtype, (DoubleType, FloatType)):
        return F.translate(c, "$,", "").rlike(FLOAT_PATTERN)
    if isinstance(dtype, StringType):
        return F.lit(True) if currency else ~c.rlike(NUMERIC_TEXT_PATTERN)
    return c.try_cast(dtype).isNotNull()


def type_bad(f: StructField, date_check: str = "pattern", currency: bool = False) -> Column:
    """The non-null text does not conform to the contract type.

    An integer is tested on the raw text (``$1,200`` is dirty) unless ``currency`` strips signs first.
    Text is dirty when purely numeric. A date is dirty by shape, or, with ``date_check="parse"``, when
    no format reads it. Types without a pattern of their own are dirty when ``try_cast`` fails.
    """
    c = quoted(f.name)
    return F.coalesce(c.isNotNull() & ~_reads_as(c, f.dataType, date_check, currency), F.lit(False))


def type_error_name(dtype: DataType) -> str:
    if isinstance(dtype, DateType):
        return "INVALID_DATE"
    if isinstance(dtype, IntegerType):
        return "INVALID_INTEGER"
    if isinstance(dtype, (DoubleType, FloatType)):
        return "INVALID_FLOAT"
    if isinstance(dtype, StringType):
        return "STRING_NUMERIC_MIX"
    return "UNKNOWN_TYPE"


def type_issues(contract: StructType, date_check: str = "pattern", currency: bool = False) -> Column:
    """array<struct<column,value,error_type,expected_type>>, one entry per dirty cell of the row."""
    cells = [
        F.when(
            type_bad(f, date_check, currency),
            F.struct(
                F.lit(f.name).alias("column"),
                quoted(f.name).cast("string").alias("value"),
                F.lit(type_error_name(f.dataType)).alias("error_type"),
                F.lit(f.dataType.simpleString()).alias("expected_type"),
            ),
        )
        for f in contract.fields
    ]
    return F.array_compact(F.array(*cells))


def convert(f: StructField, signed_years: bool = True) -> Column:
    """The text as its contract type, NULL where it does not read; never raises under ANSI."""
    c = quoted(f.name)
    if isinstance(f.dataType, DateType):
        return parse_multi(c, signed_years)
    return c.try_cast(f.dataType)


# --- characters ---------------------------------------------------------------------------------

def char_bad(name: str) -> Column:
    """The value has one of the three character issues: the good case costs two patterns, not four."""
    c = quoted(name).cast("string")
    return F.coalesce(~c.rlike(CLEAN_TEXT_PATTERN) | (c.contains("-") & c.rlike(SPACED_HYPHEN_PATTERN)), F.lit(False))


def char_issue(name: str) -> Column:
    c = quoted(name).cast("string")
    return (
        F.when(c.rlike(SPECIAL_PATTERN), f"Contains special char in {name}")
        .when(c.rlike(EDGE_PATTERN), f"Invalid leading/trailing char in {name}")
        .when(char_bad(name), f"Invalid characters in {name}")
    )


def special_names(name: str) -> Column:
    """Names of the special characters found, in the fixed order of the character list."""
    listed = {REPLACEMENT_CHARACTER: "unknown replacement char", **INVISIBLE_CHARACTERS}
    known = ",".join(f"{ch}:{text}" for ch, text in listed.items())
    return F.expr(f"""array_join(transform(
        filter(map_entries(str_to_map('{known}')), e -> contains({backticked(name)}, e.key)), e -> e.value), ', ')""")


def char_issue_described(name: str) -> Column:
    c = quoted(name).cast("string")
    return (
        F.when(c.rlike(SPECIAL_PATTERN),
               F.concat(F.lit(f"Contains special char(s) in {name}: "), special_names(name)))
        .when(c.rlike(EDGE_PATTERN), f"Invalid leading/trailing character in {name}")
        .when(char_bad(name), f"Invalid characters in {name}")
    )


# --- text heuristics ----------------------------------------------------------------------------

def text_doubts(name: str, allowed=(), min_length: int = 3) -> Column:
    """array<string> of the reasons why a text looks mistyped, judged row by row."""
    text = F.coalesce(F.trim(quoted(name)), F.lit(""))
    reasons = []
    if allowed:
        titled = sorted({str(v).strip().title() for v in allowed})
        reasons.append(F.when(~F.initcap(text).isin(*titled) & (text != ""),
                              f"Value not in allowed set for '{name}'"))
    reasons += [
        F.when((F.length(text) < min_length) & (text != ""), f"Too short (<{min_length}) in '{name}'"),
        F.when(text.rlike(r"\s{2,}"), f"Contains double spaces in '{name}'"),
        F.when(text.rlike(SUSPICIOUS_PATTERN), f"Contains suspicious characters in '{name}'"),
    ]
    return F.array_compact(F.array(*reasons))


def plainly_good(f: StructField, op: str = "<", allowed=(), min_length: int = 3) -> Column:
    """One look at a text that no row rule of the financials reports: a short plain number, ``yyyy-MM-dd``, plain words.

    True only if the value is not missing, not nonpositive, has no doubtful or bad characters, and conforms to its type with currency
    signs stripped. False says nothing: then the rules themselves decide.
    """
    c, first = quoted(f.name), "[1-9]" if op == "<=" else "[0-9]"
    if isinstance(f.dataType, StringType) and not allowed:
        words = rf"^(?!(?i:null|none|nan)\z)[a-zA-Z][a-zA-Z0-9]{{{max(min_length, 3) - 1},}}(?: [a-zA-Z0-9]+)*\z"
        good = (F.length(c) <= SHORT_TEXT) & c.rlike(words)
    elif isinstance(f.dataType, DateType):
        good = c.rlike(r"^\d{4}-\d{2}-\d{2}\z") & c.try_cast("date").isNotNull()
    elif isinstance(f.dataType, (DoubleType, FloatType)):
        good = c.rlike(rf"^{first}[0-9]{{0,14}}(?:\.[0-9]{{1,6}})?\z")
    elif isinstance(f.dataType, (IntegerType, LongType)):
        good = c.rlike(rf"^{first}[0-9]{{0,{8 if isinstance(f.dataType, IntegerType) else 14}}}\z")
    else:
        good = F.lit(False)
    return F.coalesce(good, F.lit(False))


def typo_suggestions(name: str, dictionary, max_distance: int = 2, flag_valid: bool = False) -> Column:
    """array<string> of dictionary values within ``max_distance`` edits of the value, ignoring case.

    A value that is itself in the dictionary is right and gets no suggestion, although dictionary values
    may lie close to each other; ``flag_valid=True`` reports those as well.
    """
    text = F.lower(quoted(name))
    near = F.filter(
        F.array(*[F.lit(v) for v in dictionary]),
        lambda v: F.levenshtein(text, F.lower(v), max_distance).between(0, max_distance) & (text != F.lower(v)),
    )
    wanted = text.isNotNull()
    if not flag_valid:
        wanted = wanted & ~text.isin(*[v.lower() for v in dictionary])
    return F.when(wanted, near).otherwise(F.array().cast("array<string>"))
