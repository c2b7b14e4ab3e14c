"""Text-file sources and the raw landing table."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sievewright.contracts import all_text
from sievewright.functions.text import backticked, quoted
from sievewright.operators.rules import Stamp
from sievewright.operators.schema import blanks_to_null, union_by_name

SOURCE_FILE = "source_file"
#: The column with the text of a line that is no record, and the rule of its quarantine records.
MALFORMED = "malformed_csv"
MALFORMED_ISSUE = "Malformed CSV line"


def run_date_text(run_date: str | date | datetime) -> str:
    return run_date if isinstance(run_date, str) else run_date.strftime("%Y-%m-%d")


def dated_table(prefix: str, run_date: str | date | datetime) -> str:
    """``raw_sales`` + 2024-01-31 -> ``raw_sales_2024_01_31``."""
    return f"{prefix}_{run_date_text(run_date).replace('-', '_')}"


def prefix_glob(folder: str, prefix: str) -> str:
    """Matches entries of ``folder`` whose name starts with ``prefix`` in any letter case."""
    any_case = "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in prefix)
    return f"{folder.rstrip('/')}/{any_case}*"


def _entry_name(prefix: str):
    """The folder entry a row came from: a file, or a directory of part files."""
    name = F.regexp_extract(F.col("_metadata.file_path"), f"/((?i:{re.escape(prefix)})[^/]*)", 1)
    return F.url_decode(F.regexp_replace(name, r"\+", "%2B"))


def _nothing_found(error: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def _unbalanced(line: Column) -> Column:
    """An odd number of quotes, escaped ones left out: a value goes on in the next line, or its quote is broken."""
    bare = F.regexp_replace(line, r"\\.", "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit('"')))) % 2 == 1


def _read_records(spark: SparkSession, header: Header, entry: Column, multi_line: bool, malformed: str) -> DataFrame:
    """The records of files with one header: every column text, ``source_file``, and what ``malformed`` says about lines that are none.

    A line is a record if it has as many values as the header and its quotes are balanced. ``"column"`` adds ``malformed_csv`` with the
    text of any other line, whose values are then all NULL; ``"fail"`` makes it an error that shows it. A line equal to
    the header is a header wherever it stands. With ``multi_line`` quoted values may hold line breaks; files are then read by one task
    each. Without it, the lines of such a record are malformed.
    """
    if malformed not in ("column", "fail"):
        raise ValueError(f"malformed must be 'column' or 'fail', not {malformed!r}")
    schema = StructType([StructField(n, StringType()) for n in (*header.names, MALFORMED)])
    options = {"nullValue": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    first = quoted(header.names[0])
    if multi_line:
        rows = spark.read.schema(schema).options(**options, header=True, multiLine=True, enforceSchema=False).csv(header.paths)
        # The reader refuses to read the text of bad records alone, so it always reads a column with it.
        line = F.concat(quoted(MALFORMED), F.substring(F.coalesce(first, F.lit("")), 1, 0))
        parsed = rows.select(*[quoted(n) for n in header.names], line.alias(MALFORMED), entry.alias(SOURCE_FILE))
    else:
        lines = spark.read.text(header.paths).select(F.regexp_replace("value", "^\ufeff", "").alias("line"), entry.alias(SOURCE_FILE))
        ddl = ", ".join(f"{backticked(n)} string" for n in schema.fieldNames())
        read = lines.where((F.trim("line") != "") & ~F.col("line").isin(*header.lines)).select(
            "line", SOURCE_FILE, F.from_csv("line", ddl, options).alias("r"))
        line = F.when(_unbalanced(F.col("line")), F.col("line")).otherwise(F.col("r").getField(MALFORMED))
        parsed = read.select(*[F.col("r").getField(n).alias(n) for n in header.names], line.alias(MALFORMED), SOURCE_FILE)
    bad = quoted(MALFORMED).isNotNull()
    if malformed == "fail":
        error = F.concat(F.lit("malformed line in "), F.coalesce(SOURCE_FILE, F.lit("?")), F.lit(": "), F.substring(MALFORMED, 1, 200))
        return blanks_to_null(parsed.where(F.when(bad, F.raise_error(error).cast("boolean")).otherwise(F.lit(True))).drop(MALFORMED))
    values = parsed.select(*[F.when(~bad, quoted(n)).alias(n) for n in header.names], SOURCE_FILE, MALFORMED)
    return blanks_to_null(values, skip=(MALFORMED,))


def split_malformed(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The records, and the lines that are none with their files; None if the rows do not say."""
    if MALFORMED not in rows.columns:
        return rows, None
    lines = rows.where(quoted(MALFORMED).isNotNull()).select(MALFORMED, SOURCE_FILE)
    return rows.where(quoted(MALFORMED).isNull()).drop(MALFORMED), lines


def malformed_records(lines: DataFrame, stamp: Stamp) -> DataFrame:
    """Quarantine records of the rule ``malformed_csv``: every line as often as it came, its text as ``bad_value``."""
    return lines.select(
        F.lit(MALFORMED).alias("rule"), F.lit(MALFORMED_ISSUE).alias("issue"), F.col(MALFORMED).alias("bad_value"),
        SOURCE_FILE, stamp.project(), stamp.logged(), F.sha2(F.concat_ws("|", MALFORMED, SOURCE_FILE), 256).alias("row_hash"))


@dataclass(frozen=True)
class Header:
    """Column names, the files that have them, and how the header line is written in these."""

    names: tuple[str, ...]
    paths: list[str]
    lines: list[str]


def _headers(spark: SparkSession, paths: str | list[str]) -> list[Header]:
    """The files below ``paths`` by their header. Files without any line are left out.

    One scan of the text keeps a line per file; only these go to the driver.
    """
    try:
        lines = spark.read.text(paths)
    except Exception as error:
        if not _nothing_found(error):
            raise
        return []
    path = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")).alias("path")
    tops = lines.select(
        path, "value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    first = tops.where("block = 0 AND trim(value) <> ''").groupBy("path").agg(F.min_by("value", "at").alias("header"))
    found = defaultdict(list)
    for row in first.orderBy("path").collect():
        line = row["header"].removeprefix("\ufeff")
        found[tuple(next(csv.reader([line])))].append((row["path"], line))
    return [Header(names, [p for p, _ in files], sorted({h for _, h in files})) for names, files in found.items()]


def csv_headers(spark: SparkSession, folder: str, prefix: str) -> dict[tuple[str, ...], list[str]]:
    """The files that start with ``prefix``, by their header. Files without any line are left out."""
    return {h.names: h.paths for h in _headers(spark, prefix_glob(folder, prefix))}


def read_csv_folder(spark: SparkSession, folder: str, prefix: str, contract: StructType, null_tokens: tuple[str, ...] = (),
                    multi_line: bool = False, malformed: str = "fail") -> DataFrame:
    """All files that start with ``prefix``, in one scan: header, every column text, blank as NULL.

    Headers are checked against the contract, and a file with other names or another order fails; see
    :func:`read_csv_by_name` for files that differ. ``null_tokens`` are further texts that mean NULL. A folder
    without such files gives an empty table. Adds ``source_file``. ``multi_line``, ``malformed``: see :func:`_read_records`.
    """
    found = _headers(spark, prefix_glob(folder, prefix))
    names = tuple(contract.fieldNames())
    for header in found:
        if header.names != names:
            raise ValueError(f"the columns of {header.paths[0]} are {', '.join(header.names)}, not {', '.join(names)}")
    if not found:
        added = (SOURCE_FILE, MALFORMED) if malformed == "column" else (SOURCE_FILE,)
        return spark.createDataFrame([], StructType([*all_text(contract).fields, *[StructField(n, StringType()) for n in added]]))
    return null_tokens_to_null(_read_records(spark, found[0], _entry_name(prefix), multi_line, malformed), null_tokens)


def read_csv_by_name(spark: SparkSession, folder: str, prefix: str, null_tokens: tuple[str, ...] = (), multi_line: bool = False,
                     malformed: str = "fail") -> DataFrame | None:
    """All files that start with ``prefix``, united by column name whatever their column order; one scan per header.

    Every column is text, blank as NULL; a column that some header lacks is an error. Adds ``source_file``. None if
    there is no file with a header. ``multi_line``, ``malformed``: see :func:`_read_records`.
    """
    frames = [_read_records(spark, header, _entry_name(prefix), multi_line, malformed)
              for header in _headers(spark, prefix_glob(folder, prefix))]
    return null_tokens_to_null(union_by_name(frames), null_tokens) if frames else None


def read_csv_files(spark: SparkSession, paths: list[str], allow_missing: bool = False, multi_line: bool = False,
                   malformed: str = "fail") -> DataFrame:
    """Files whose headers differ, united by column name; a missing column is an error unless allowed."""
    frames = []
    for p in paths:
        headers = _headers(spark, p)
        if not headers:
            raise ValueError(f"no header in {p}")
        name = F.lit(p.rstrip("/").rsplit("/", 1)[-1])
        frames += [_read_records(spark, h, name, multi_line, malformed) for h in headers]
    return union_by_name(frames, allow_missing)


def null_tokens_to_null(df: DataFrame, tokens: tuple[str, ...]) -> DataFrame:
    """Whole values equal to one of the tokens become NULL."""
    if not tokens:
        return df
    return df.select([
        F.when(~quoted(c).isin(*tokens), quoted(c)).alias(c) if c not in (SOURCE_FILE, MALFORMED) else quoted(c) for c in df.columns
    ])


def write_csv(df: DataFrame, path: str) -> None:
    """Text rows as CSV with header, blanks kept."""
    (df.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def land_raw(df: DataFrame, path: str, run_date: str | date | datetime) -> None:
    """Write the raw rows of one day; a repeated run replaces that day only."""
    dated = df.withColumn("run_date", F.lit(run_date_text(run_date)))
    (dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").parquet(path))


def read_raw(spark: SparkSession, path: str, run_date: str | date | datetime) -> DataFrame:
    """The raw rows landed for one day; only that partition is read."""
    day = run_date_text(run_date)
    return spark.read.option("basePath", path).parquet(f"{path}/run_date={day}").drop("run_date")
