"""Change logs of the cleaning steps, run audit records, schema events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sievewright.functions.identity import row_hash
from sievewright.functions.text import collapse_spaces, quoted
from sievewright.operators.dedup import dedup_full_row
from sievewright.operators.rules import Stamp


def _changes(df: DataFrame, cells: list[Column], action: str, stamp: Stamp) -> DataFrame:
    logged = dedup_full_row(
        df.withColumn("__change", F.explode(F.array_compact(F.array(*cells)))).select(
            *[quoted(c) for c in df.columns], F.col("__change.*"), F.lit(action).alias("action"), stamp.logged())
    )
    return logged.withColumn("row_hash", row_hash([c for c in logged.columns if c != "logged_at"]))


def _cell(name: str, cleaned: Column, changed: Column) -> Column:
    return F.when(quoted(name).isNotNull() & changed, F.struct(
        F.lit(name).alias("column_name"), quoted(name).cast("string").alias("original_value"),
        cleaned.alias("cleaned_value")))


def id_changes(df: DataFrame, id_columns, stamp: Stamp) -> DataFrame:
    """Ids that cleaning changes, in letter case or blanks. Each record shows the row as it came in."""
    cells = []
    for n in id_columns:
        if n in df.columns:
            text = quoted(n).cast("string")
            cleaned = F.upper(collapse_spaces(text))
            cells.append(_cell(n, cleaned, text != cleaned))
    return _changes(df, cells or [_no_cell()], "ID_CLEAN_AND_UPPERCASE", stamp)


def string_changes(df: DataFrame, stamp: Stamp, skip=()) -> DataFrame:
    """Text that cleaning changes inside (blanks collapsed); changes of case or outer blanks do not count."""
    cells = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType) and f.name not in skip:
            c = quoted(f.name)
            cleaned = F.initcap(collapse_spaces(c))
            cells.append(_cell(f.name, cleaned, F.lower(F.trim(c)) != F.lower(F.trim(cleaned))))
    return _changes(df, cells or [_no_cell()], "TITLE_CASE_CLEAN", stamp)


def _no_cell() -> Column:
    return F.lit(None).cast("struct<column_name:string,original_value:string,cleaned_value:string>")


def audit_record(spark: SparkSession, username: str, action: str, table_name: str, details: str) -> DataFrame:
    return spark.createDataFrame(
        [(username, action, table_name, details)],
        "username string, action string, table_name string, details string")


def load_audit(loaded: DataFrame, username: str, table_name: str) -> DataFrame:
    """The audit record of a successful load, with the number of rows counted by Spark."""
    return loaded.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(username).alias("username"), F.lit("INSERT").alias("action"), F.lit(table_name).alias("table_name"),
        F.concat(F.lit("Loaded "), F.col("rows").cast("string"), F.lit(" rows")).alias("details"))


def audit_event(spark: SparkSession, action: str, table_name: str, status: str, source_file: str,
                run_ts: datetime) -> DataFrame:
    return spark.createDataFrame(
        [(action, table_name, status, source_file, run_ts.isoformat())],
        "action string, table_name string, status string, source_file string, logged_at string")


def schema_event(cells: DataFrame, column: str, table_name: str, run_ts: datetime) -> DataFrame:
    """One record that announces the columns of a quarantine table: the distinct values of ``column``,
    of which there are no more than the contract has columns."""
    names = F.array_sort(F.collect_set(quoted(column)))
    return cells.agg(names.alias("columns")).select(
        F.lit("DIRTY_TYPE_SCHEMA").alias("event_type"), F.lit(table_name).alias("table_name"), "columns",
        F.lit(run_ts.isoformat()).alias("logged_at"))
