"""Target, quarantine and audit tables: by path (parquet) or over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, IntegerType, LongType, StructType, TimestampType

from sievewright.operators.schema import to_text


def table_exists(spark: SparkSession, path: str) -> bool:
    """Has the table been written, even with no rows?"""
    try:
        return bool(spark.read.parquet(path).columns)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise


def existing_keys(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    """The key column of the target and nothing else; None before the first load."""
    if not table_exists(spark, path):
        return None
    return spark.read.parquet(path).select(key)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_aligned(df: DataFrame, path: str) -> None:
    """Append with the column order of the table, or create it. Both must have the same columns."""
    spark = df.sparkSession
    if table_exists(spark, path):
        unknown = set(df.columns) - set(spark.read.parquet(path).columns)
        if unknown:
            raise ValueError(f"the table has no column {', '.join(sorted(unknown))}")
        df = df.select(*[F.col(f"`{c}`") for c in spark.read.parquet(path).columns])
    append(df, path)


def create_empty(df: DataFrame, path: str) -> None:
    """The table with the columns of ``df`` as text and no rows, unless it exists."""
    if not table_exists(df.sparkSession, path):
        to_text(df).limit(0).write.parquet(path)


def write_quarantine(records: DataFrame, path: str, run: str) -> None:
    """The records of one run, a day or a micro-batch of one job, below ``run=...``, partitioned by rule.

    A repeated run replaces all of them, also those of rules that no longer find anything. Rows are
    rebalanced by rule first, so a rule fills a few files instead of one per task, and adaptive execution
    splits a rule that holds most of the rows.
    """
    (to_text(records).hint("rebalance", "rule").write.mode("overwrite")
     .partitionBy("rule").parquet(f"{path}/run={run}"))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# The columns of batch records and of stream events.
AUDIT_COLUMNS = ("username", "action", "table_name", "details", "status", "source_file", "logged_at")


def whole_audit(record: DataFrame) -> DataFrame:
    """An audit record with the columns of all kinds of records, so that one table takes them all."""
    return record.select([
        F.col(c).cast("string") if c in record.columns else F.lit(None).cast("string").alias(c) for c in AUDIT_COLUMNS])


def append_audit(record: DataFrame, path: str) -> bool:
    """Append an audit record; a failing audit table must not fail the load, so it only reports False."""
    try:
        append(record, path)
        return True
    except Exception as error:  # whatever the table service raises
        print(f"audit record not written: {error}")
        return False


# --- JDBC ---------------------------------------------------------------------------------------

# Column types used when a quarantine table is created over JDBC.
JDBC_TYPES: dict[type[DataType], str] = {
    IntegerType: "INTEGER", LongType: "BIGINT", DoubleType: "DOUBLE PRECISION", DateType: "DATE",
    TimestampType: "TIMESTAMP",
}
JDBC_TEXT = "TEXT"  # quarantined values have any length
JDBC_NARROW = {"project_name": "VARCHAR(100)", "row_hash": "VARCHAR(64)"}


@dataclass(frozen=True)
class JdbcTarget:
    """Where a database is. Credentials come from the caller, never from this package."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)

    def read_options(self, table: str, key: str | None = None, lower: int | None = None,
                     upper: int | None = None, partitions: int | None = None) -> dict[str, str]:
        """Options of a scan; with a key range the scan is split into parallel range queries."""
        options = {"url": self.url, "dbtable": table, **self.properties}
        if key is not None:
            if lower is None or upper is None or partitions is None:
                raise ValueError("a partitioned scan needs lower, upper and partitions")
            options |= {"partitionColumn": key, "lowerBound": str(lower), "upperBound": str(upper),
                        "numPartitions": str(partitions)}
        return options

    def write_options(self, table: str, schema: StructType | None = None, batch_size: int = 10_000) -> dict[str, str]:
        options = {"url": self.url, "dbtable": table, "batchsize": str(batch_size), **self.properties}
        if schema is not None:
            options["createTableColumnTypes"] = column_types(schema)
        return options

    def read(self, spark: SparkSession, table: str, **split) -> DataFrame:
        return spark.read.format("jdbc").options(**self.read_options(table, **split)).load()

    def exists(self, spark: SparkSession, table: str) -> bool:
        """Can the table be read? Anything else that is wrong with the database shows when it is written."""
        try:
            return bool(self.read(spark, table).columns)
        except Exception:
            return False

    def read_keys(self, spark: SparkSession, table: str, key: str, **split) -> DataFrame:
        """Only the key column travels: the scan prunes the others in the database."""
        return self.read(spark, table, **split).select(key)

    def write(self, df: DataFrame, table: str, mode: str = "append", text: bool = False) -> None:
        rows = to_text(df) if text else df
        rows.write.format("jdbc").options(**self.write_options(table, rows.schema)).mode(mode).save()


def column_types(schema: StructType) -> str:
    """``name TYPE, ...`` for the create statement; only fixed metadata is bounded."""
    return ", ".join(
        f"`{f.name}` {JDBC_TYPES.get(type(f.dataType), JDBC_NARROW.get(f.name, JDBC_TEXT))}" for f in schema.fields)
