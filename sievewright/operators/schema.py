"""Column layout: alignment to a contract, header names, key discovery, text casts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, MapType, StringType, StructType

from sievewright.contracts import Profile
from sievewright.functions.checks import any_of, convert
from sievewright.functions.dates import DATE_LIKE_PATTERN
from sievewright.functions.text import (
    backticked,
    blank_to_null,
    quoted,
    strip_currency,
    strip_special,
    title_letters,
    title_words,
    upper_id,
)


def align(df: DataFrame, contract: StructType, extras: str = "drop") -> DataFrame:
    """Contract columns in contract order; absent ones are NULL of the contract type.

    Present columns keep their current type. ``extras="keep"`` appends other columns at the end.
    """
    present = set(df.columns)
    cols = [
        backticked(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
        for f in contract.fields
    ]
    if extras == "keep":
        expected = set(contract.fieldNames())
        cols += [backticked(c) for c in df.columns if c not in expected]
    elif extras != "drop":
        raise ValueError(f"extras must be 'drop' or 'keep', not {extras!r}")
    return df.select(cols)


def enforce(df: DataFrame, contract: StructType) -> DataFrame:
    """Contract columns, cast to contract types; what does not cast, or is absent, is NULL."""
    present = set(df.columns)
    return df.select([
        (quoted(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in contract.fields
    ])


def convert_types(df: DataFrame, contract: StructType) -> DataFrame:
    """As :func:`enforce`, with dates read by the seven-format parser."""
    present = set(df.columns)
    return df.select([
        (convert(f) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in contract.fields
    ])


def normalize_headers(df: DataFrame, lower: bool = True) -> DataFrame:
    """Trim header names and collapse blanks inside them; optionally lower-case them."""
    names = [" ".join(c.split()) for c in df.columns]
    return df.toDF(*[n.lower() for n in names] if lower else names)


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def detect_date_columns(df: DataFrame, contract: StructType | None = None) -> DataFrame:
    """One row per date column (``column_name``): by contract type, else by content.

    The content test is one aggregate over the whole table, true when any value looks like a date,
    so the answer does not depend on which rows come first.
    """
    spark = df.sparkSession
    by_type = [f.name for f in (contract.fields if contract else []) if isinstance(f.dataType, DateType)]
    if by_type:
        return spark.createDataFrame([(c,) for c in by_type], "column_name string")
    seen = df.agg(*[
        F.max(F.coalesce(quoted(c).cast("string").rlike(DATE_LIKE_PATTERN), F.lit(False))).alias(f"c{i}")
        for i, c in enumerate(df.columns)
    ])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("hit")) for i, c in enumerate(df.columns)
    ])
    return seen.select(F.inline(pairs)).where("hit").select("column_name")


def to_text(df: DataFrame) -> DataFrame:
    """Every column as text; arrays, maps and structs as JSON, because no table sink takes them portably."""
    nested = (ArrayType, MapType, StructType)
    return df.selectExpr(*[
        ("to_json({c}) AS {c}" if isinstance(f.dataType, nested) else "cast({c} AS string) AS {c}").format(
            c=backticked(f.name))
        for f in df.schema.fields
    ])


def _each_text_column(df: DataFrame, fn, skip=()) -> DataFrame:
    return df.select([
        fn(quoted(f.name)).alias(f.name)
        if isinstance(f.dataType, StringType) and f.name not in skip else backticked(f.name)
        for f in df.schema.fields
    ])


def blanks_to_null(df: DataFrame, skip=()) -> DataFrame:
    return _each_text_column(df, blank_to_null, skip)


def clean_strings(df: DataFrame, mode: str = "words", skip=()) -> DataFrame:
    """Title-case every text column not skipped, in one projection."""
    return _each_text_column(df, {"words": title_words, "letters": title_letters}[mode], skip)


def clean_ids(df: DataFrame, id_columns=()) -> DataFrame:
    """Upper-case the listed columns; listed columns the table lacks are ignored."""
    wanted = set(id_columns)
    return df.select([upper_id(quoted(c)).alias(c) if c in wanted else backticked(c) for c in df.columns])


def strip_special_characters(df: DataFrame) -> DataFrame:
    return _each_text_column(df, strip_special)


def clean_for(df: DataFrame, profile: Profile) -> DataFrame:
    """The cleaning step of a profile: title case, then upper-case ids."""
    titled = clean_strings(df, profile.title_mode, profile.skip_clean)
    return clean_ids(titled, profile.upper_ids) if profile.upper_ids else titled


def light_transform(df: DataFrame, currency=("Unit_Price", "Total_Amount"),
                    integers=("Quantity", "Unit_Price", "Total_Amount")) -> DataFrame:
    """Row-local stream clean-up: trim, blank to NULL, strip currency signs, cast integers."""
    def one(f):
        c = quoted(f.name)
        if isinstance(f.dataType, StringType):
            c = F.when(F.trim(c) != "", F.trim(c))
        if f.name in currency:
            c = strip_currency(c)
        if f.name in integers:
            c = c.try_cast("int")
        return c.alias(f.name)

    return df.select([one(f) for f in df.schema.fields])


def union_by_name(frames, allow_missing: bool = False) -> DataFrame:
    """Union by column name; a missing column is an error unless allowed."""
    first, *rest = list(frames)
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=allow_missing)
    return first


def drop_incomplete(df: DataFrame, columns=None) -> DataFrame:
    cols = columns or df.columns
    return df.where(~any_of([quoted(c).isNull() for c in cols]))
