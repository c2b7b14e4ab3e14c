"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sievewright.contracts import (
    CSV_NA_TOKENS,
    FINANCIALS,
    FINANCIALS_BATCH,
    SALES,
    SALES_BATCH,
    SALES_STREAM,
    STREAM_TYPO_DICTIONARY,
    Profile,
    all_text,
)
from sievewright.fixtures import financials_raw, sales_raw, table
from sievewright.functions import dates, text
from sievewright.functions.identity import row_hash
from sievewright.operators import audits, dedup, keyed, rules, schema
from sievewright.operators.rules import Stamp
from sievewright.plans import financials, sales
from sievewright.plans.batch import run_batch
from sievewright.plans.ingest import run_for_date
from sievewright.sources import files, streams, tables
from sievewright.sources.commits import Store
from sievewright.sources.sinks import (
    AUDIT_TOPIC,
    FINANCIALS_RULES,
    RULES,
    SCHEMA_TOPIC,
    CommittedRun,
    CommittedSinks,
    Sinks,
    rule_table,
    to_event_topic,
    to_topics,
    type_schema_event,
)
from sievewright.storage import Workspace
from sievewright.streaming import runner

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = "2024-01-31"
RUN_TS = datetime(2024, 1, 31)
SALES_STAMP = Stamp(RUN_TS, "sales_raw")
FINANCIALS_STAMP = Stamp(RUN_TS, "financials_raw")
ROWS_PER_STREAM_FILE = 100_000

REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def records(df: DataFrame) -> DataFrame:
    """A quarantine frame without the time stamp, lists as JSON text."""
    return schema.to_text(df.drop("logged_at"))


def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned rows, held once as the pipelines do: rules read a column several times, and without the
    hold the cleaning expressions would be inlined at each of those places."""
    ws = Workspace(spark, "clean_sales")
    return ws.hold(schema.clean_for(sales_raw(spark, sf_dir), SALES_BATCH), "cleaned")


def loaded_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys the target holds already: the orders that are finished."""
    done = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return done.select(F.col("o_orderkey").cast("int").alias("Order_ID"))


# --- sources and sinks --------------------------------------------------------------------------

@query
def src_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "src_csv_text")
    files.write_csv(sales_raw(spark, sf_dir), ws.path("inbox/Test_Data_sales"))
    return files.read_csv_folder(spark, ws.path("inbox"), "test_data", SALES)


@query
def src_csv_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "src_csv_financials")
    files.write_csv(financials_raw(spark, sf_dir), ws.path("inbox/Financials"))
    return files.read_csv_folder(spark, ws.path("inbox"), "financials", FINANCIALS, CSV_NA_TOKENS)


@query
def src_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "src_union_by_name")
    rows = sales_raw(spark, sf_dir)
    files.write_csv(rows.where("Region = 'North'"), ws.path("north"))
    files.write_csv(rows.where("Region <> 'North'").select(*reversed(rows.columns)), ws.path("others"))
    return files.read_csv_files(spark, [ws.path("north"), ws.path("others")])


@query
def src_csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV text, of which some have a value too many or too few, or a quote that does not close, and some a quoted comma."""
    ws = Workspace(spark, "src_csv_malformed")
    order, customer, state = (F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderstatus"))
    kind = F.col("o_orderkey") % 10
    line = (F.when(kind == 1, F.concat_ws(",", order, customer, state, F.lit("5"))).when(kind == 2, F.concat_ws(",", order, customer))
            .when(kind == 3, F.concat_ws(",", order, F.concat(F.lit('"'), customer), state))
            .when(kind == 4, F.concat_ws(",", order, F.concat(F.lit('"'), customer, F.lit(',"')), state))
            .otherwise(F.concat_ws(",", order, customer, state)))
    # One file per writing task, each with a header: the name of the one column that holds the lines, which are written as they are.
    as_they_are = {"sep": "\x01", "quote": "", "escapeQuotes": False, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines = table(spark, sf_dir, "orders").select(line.alias("id,customer,state"))
    lines.write.options(**as_they_are, header=True).csv(ws.path("inbox/Test_Data"))
    contract = StructType([StructField(c, StringType()) for c in ("id", "customer", "state")])
    return files.read_csv_folder(spark, ws.path("inbox"), "test_data", contract, malformed="column")


@query
def sink_raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "sink_raw_landing")
    rows = schema.blanks_to_null(sales_raw(spark, sf_dir))
    files.land_raw(rows.where("Region = 'North'"), ws.path("raw"), RUN_DATE)
    files.land_raw(rows.where("Region = 'South'"), ws.path("raw"), "2024-02-01")
    files.land_raw(rows, ws.path("raw"), RUN_DATE)
    landed = spark.read.parquet(ws.path("raw"))
    return landed.select(*rows.columns, F.col("run_date").cast("string").alias("run_date"))


@query
def src_raw_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "src_raw_reload")
    files.land_raw(schema.blanks_to_null(sales_raw(spark, sf_dir)), ws.path("raw"), RUN_DATE)
    return files.read_raw(spark, ws.path("raw"), RUN_TS)


@query
def sink_text_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.nonpositive(clean_sales(spark, sf_dir), SALES_BATCH, SALES_STAMP))


@query
def sink_empty_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty table is created once; creating it again leaves what has been appended."""
    ws = Workspace(spark, "sink_empty_schema")
    found = records(rules.type_dirty_rows(clean_sales(spark, sf_dir), SALES_BATCH, SALES_STAMP))
    tables.create_empty(found, ws.path("dirty"))
    tables.append_aligned(found.select(*reversed(found.columns)), ws.path("dirty"))
    tables.create_empty(found, ws.path("dirty"))
    return spark.read.parquet(ws.path("dirty"))


@query
def sink_align_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "sink_align_append")
    rows = sales_raw(spark, sf_dir)
    tables.append_aligned(rows, ws.path("t"))
    tables.append_aligned(rows.select(*reversed(rows.columns)), ws.path("t"))
    return spark.read.parquet(ws.path("t"))


@query
def audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "audit_events")
    loaded = schema.drop_incomplete(schema.convert_types(clean_sales(spark, sf_dir), SALES))
    tables.append_audit(audits.load_audit(loaded, "admin", "sales"), ws.path("audit"))
    return spark.read.parquet(ws.path("audit"))


@query
def schema_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = rules.type_dirty_cells(clean_sales(spark, sf_dir), SALES_BATCH, SALES_STAMP)
    return schema.to_text(audits.schema_event(cells, "dirty_columns", "dirty_type_conversion", RUN_TS))


@query
def kafka_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope of the region rule, opened again."""
    found = rules.invalid_region(clean_sales(spark, sf_dir), SALES_BATCH, SALES_STAMP).drop("logged_at")
    sent = streams.to_envelope(found, "row_hash")
    fields = StructType([StructField(c, StringType()) for c in found.columns])
    return sent.select("key", F.from_json("value", fields).alias("r")).select("key", "r.*")


# --- cleaning -----------------------------------------------------------------------------------

@query
def clean_blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.blanks_to_null(sales_raw(spark, sf_dir))


@query
def clean_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.clean_strings(sales_raw(spark, sf_dir))


@query
def clean_strings_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.clean_strings(financials_raw(spark, sf_dir), "letters")


@query
def clean_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.clean_ids(sales_raw(spark, sf_dir), ["Order_ID", "Customer_Name", "Absent"])


@query
def strip_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_raw(spark, sf_dir).select(
        "Order_ID", text.strip_currency(F.col("Unit_Price")).alias("Unit_Price"),
        text.strip_currency(F.concat(F.lit("€ "), F.col("Total_Amount"))).alias("Total_Amount"))


@query
def strip_special_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.strip_special_characters(sales_raw(spark, sf_dir))


@query
def spelled_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return financials_raw(spark, sf_dir).select(
        "Row ID", text.spelled_number("Units Sold").alias("Units Sold"),
        text.spelled_number("Segment").alias("Segment"))


# English number words.
UNITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen",
         "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen")
TENS = ("", "", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")


def _in_words(n: Column) -> Column:
    """A number below a million as English words."""
    units, tens = (F.array(*[F.lit(w) for w in words]) for words in (UNITS, TENS))

    def below_hundred(x: Column) -> Column:
        unit = F.when(x % 10 > 0, F.concat(F.lit("-"), F.get(units, (x % 10).cast("int")))).otherwise("")
        return F.when(x < 20, F.get(units, x.cast("int"))).otherwise(F.concat(F.get(tens, F.floor(x / 10).cast("int")), unit))

    def below_thousand(x: Column) -> Column:
        rest = F.when(x % 100 > 0, F.concat(F.lit(" and "), below_hundred(x % 100))).otherwise("")
        return F.when(x < 100, below_hundred(x)).otherwise(F.concat(F.get(units, F.floor(x / 100).cast("int")), F.lit(" Hundred"), rest))

    rest = F.when(n % 1000 > 0, F.concat(F.lit("  "), below_thousand(n % 1000))).otherwise("")
    return F.when(n < 1000, below_thousand(n)).otherwise(F.concat(below_thousand(F.floor(n / 1000)), F.lit(" thousand"), rest))


@query
def spelled_numbers_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of numbers written out and read again."""
    n = F.col("p_partkey") * 7919 % 1_000_000
    written = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") < 1000, F.col("p_partkey")).otherwise(n).alias("n"))
    rows = written.select("p_partkey", _in_words(F.col("n")).alias("written"))
    return rows.select("p_partkey", text.spelled_number("written").alias("number"))


@query
def normalize_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = financials_raw(spark, sf_dir)
    return schema.normalize_headers(rows.toDF(*[f"  {c.replace(' ', '   ')} " for c in rows.columns]))


def _partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales_raw(spark, sf_dir)
    return rows.drop("Product").select(F.lit("x").alias("Remark"), *reversed(rows.drop("Product").columns))


@query
def schema_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.align(_partial(spark, sf_dir), SALES)


@query
def schema_align_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.align(_partial(spark, sf_dir), SALES, extras="keep")


@query
def schema_enforce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.enforce(_partial(spark, sf_dir), SALES)


@query
def cast_dates_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_raw(spark, sf_dir).select(
        "Order_ID", "Order_Date", dates.parse_multi(F.col("Order_Date"), signed_years=True).alias("parsed"))


@query
def cast_dates_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in twenty ways, among them ambiguous, partial and impossible ones."""
    date = F.col("o_orderdate").cast("date")
    y, m, d = F.date_format(date, "yyyy"), F.date_format(date, "MM"), F.date_format(date, "dd")
    month, day = F.date_format(date, "MMMM"), F.dayofmonth(date).cast("string")
    short = F.substring(month, 1, 3)
    ways = [
        F.concat_ws("-", y, m, d), F.concat_ws(" ", d, month, y), F.concat(short, F.lit(" "), day, F.lit(", "), y),
        F.concat(F.date_format(date, "EEEE"), F.lit(", "), F.upper(month), F.lit(" "), day, F.lit("th "), y),
        F.concat_ws("/", d, m, y), F.concat_ws("-", m, d, y), F.concat_ws(".", y, F.month(date).cast("string"), day), F.concat_ws(".", d, m, y),
        F.concat(y, m, d), F.concat(F.concat_ws("-", y, m, d), F.lit("T23:59:59.5Z")), F.concat_ws("/", m, d, F.substring(y, 3, 2)),
        F.concat_ws("-", day, short, F.substring(y, 3, 2)), F.concat_ws("-", y, F.lit("13"), F.lit("45")), F.concat_ws(" ", month, y),
        F.concat_ws(" ", F.lit("31 February"), y), F.concat(F.concat_ws("/", m, d, y), F.lit(" 11:05 PM")), F.concat_ws("/", y, d, m),
        F.concat_ws(" ", y, short, d), F.concat(F.concat_ws("-", y, m, d), F.lit(" 25:10")), F.concat(F.lit(" "), day, F.lit("th of "), month, F.lit("  "), y),
    ]
    text = F.lit(None).cast("string")
    for k, way in enumerate(ways):
        text = F.when(F.col("o_orderkey") % 20 == k, way).otherwise(text)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    return rows.select("o_orderkey", "text", dates.parse_permissive(F.col("text")).alias("parsed"))


@query
def cast_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales_raw(spark, sf_dir)
    return rows.select("Order_ID", *[
        F.col(c).try_cast(t).alias(f"{c}_{t}")
        for c in ("Quantity", "Unit_Price", "Total_Amount") for t in ("int", "double")
    ])


@query
def stream_light_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "stream_light_transform")
    stream = _sales_stream(spark, sf_dir, ws).drop(streams.CORRUPT)
    job = schema.light_transform(stream).writeStream.queryName("light_transform").format("parquet").option(
        "path", ws.path("out")).option("checkpointLocation", ws.path("checkpoint")).trigger(availableNow=True)
    job.start().awaitTermination()
    return spark.read.parquet(ws.path("out"))


# --- identity and dedup -------------------------------------------------------------------------

@query
def row_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales_raw(spark, sf_dir)
    return rows.select("*", row_hash(rows.columns).alias("row_hash"))


REGISTRY["row_hash"] = REGISTRY.pop("row_hashes")


@query
def dedup_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns, so that most rows have copies."""
    rows = clean_sales(spark, sf_dir).select("Customer_Name", "Region", "Payment_Method")
    return dedup.dedup_row_hash(rows.select("*", row_hash(rows.columns).alias("row_hash")), Workspace(spark, "dedup_row_hash"))


@query
def dedup_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_primary_key(clean_sales(spark, sf_dir), "Order_ID", workspace=Workspace(spark, "dedup_primary_key"))


@query
def dedup_full_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns, so that some rows have copies."""
    return dedup.dedup_full_row(clean_sales(spark, sf_dir).select("Customer_Name", "Region", "Product"))


# --- row rules ----------------------------------------------------------------------------------

@query
def rule_invalid_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.invalid_region(clean_sales(spark, sf_dir), SALES_BATCH, SALES_STAMP))


@query
def rule_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.nulls(clean_sales(spark, sf_dir), SALES_BATCH, SALES_STAMP))


@query
def rule_nulls_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.nulls(financials_raw(spark, sf_dir), FINANCIALS_BATCH, FINANCIALS_STAMP))


@query
def rule_nonpositive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.nonpositive(clean_sales(spark, sf_dir), SALES_BATCH, SALES_STAMP))


@query
def rule_negative_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.nonpositive(financials_raw(spark, sf_dir), FINANCIALS_BATCH, FINANCIALS_STAMP))


@query
def rule_special_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.special_chars(clean_sales(spark, sf_dir), SALES_BATCH, SALES_STAMP))


@query
def rule_special_chars_described(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.special_chars_described(financials_raw(spark, sf_dir), FINANCIALS_BATCH, FINANCIALS_STAMP))


@query
def rule_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.bigint(clean_sales(spark, sf_dir), "Order_ID", SALES_STAMP))


@query
def rule_type_dirty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.type_dirty_rows(clean_sales(spark, sf_dir), SALES_BATCH, SALES_STAMP))


@query
def rule_type_dirty_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type rule with dates judged by the parser instead of by shape."""
    profile = SALES_BATCH.with_options(date_check="parse")
    return records(rules.type_dirty_rows(clean_sales(spark, sf_dir), profile, SALES_STAMP))


@query
def rule_type_dirty_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.type_dirty_cells(clean_sales(spark, sf_dir), SALES_STREAM, SALES_STAMP))


@query
def rule_type_dirty_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "rule_type_dirty_financials")
    prepared = ws.hold(financials.prepare(financials_raw(spark, sf_dir), FINANCIALS_BATCH), "prepared")
    return records(rules.type_dirty_described(prepared, FINANCIALS_BATCH, FINANCIALS_STAMP))


@query
def rule_numeric_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.numeric_strings(financials_raw(spark, sf_dir), FINANCIALS_BATCH, FINANCIALS_STAMP))


@query
def rule_dates_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.dirty_dates(financials_raw(spark, sf_dir), FINANCIALS_BATCH, FINANCIALS_STAMP))


@query
def cast_dates_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return financials_raw(spark, sf_dir).select(
        "Row ID", dates.parse_strict(F.col("Date")).alias("parsed"), dates.strict_issue(F.col("Date")).alias("issue"))


@query
def detect_date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.detect_date_columns(financials_raw(spark, sf_dir))


@query
def rule_typos_heuristic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.doubtful_text(financials_raw(spark, sf_dir), FINANCIALS_BATCH, FINANCIALS_STAMP))


def _typos(spark: SparkSession, sf_dir: str, flag_valid: bool) -> DataFrame:
    profile = SALES_STREAM.with_options(typo_dictionary=STREAM_TYPO_DICTIONARY, flag_valid_typos=flag_valid)
    return records(rules.typos(sales_raw(spark, sf_dir), profile, SALES_STAMP))


@query
def rule_typos_levenshtein(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typos(spark, sf_dir, False)


@query
def rule_typos_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typos(spark, sf_dir, True)


@query
def rule_typos_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typo rule with its dictionary as a table."""
    pairs = [(name, value) for name, values in STREAM_TYPO_DICTIONARY.items() for value in values]
    dictionary = spark.createDataFrame(pairs, "column_name string, value string")
    return records(rules.typos_by_table(sales_raw(spark, sf_dir), dictionary, SALES_STAMP, Workspace(spark, "rule_typos_table")))


@query
def rule_typos_part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with a letter too few or too many against a dictionary of all part names."""
    name, key = F.concat_ws(" ", "p_name", "p_partkey"), F.col("p_partkey") % 3
    parts = table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))
    written = (F.when(key == 0, F.concat(F.expr("substring(name, 1, 2)"), F.expr("substring(name, 4)")))
               .when(key == 1, F.concat("name", F.lit("x"))).otherwise(F.col("name")))
    rows = parts.select("p_partkey", written.alias("Product"))
    dictionary = parts.select(F.lit("Product").alias("column_name"), F.col("name").alias("value"))
    return records(rules.typos_by_table(rows, dictionary, SALES_STAMP, Workspace(spark, "rule_typos_part_names")))


# --- set rules ----------------------------------------------------------------------------------

@query
def agg_region_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.conflicting_keys(clean_sales(spark, sf_dir), "Customer_Name", "Region")


@query
def rule_region_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(rules.region_conflicts(clean_sales(spark, sf_dir), SALES_BATCH, SALES_STAMP))


@query
def drop_conflict_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_sales(spark, sf_dir)
    customers = keyed.conflicting_keys(rows, "Customer_Name", "Region")
    return keyed.drop_listed(rows, customers, "Customer_Name", hot=keyed.hot_keys(rows, "Customer_Name"))


@query
def reject_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_sales(spark, sf_dir)
    dirty = rules.type_dirty_rows(rows, SALES_BATCH, SALES_STAMP)
    ids = dirty.select("Order_ID").distinct()
    return keyed.drop_listed(rows, ids, "Order_ID", split_nulls=True)


@query
def load_existing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "load_existing_keys")
    tables.append(table(spark, sf_dir, "orders").withColumn("Order_ID", F.col("o_orderkey").cast("int")), ws.path("t"))
    return tables.existing_keys(spark, ws.path("t"), "Order_ID")


@query
def load_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = schema.convert_types(clean_sales(spark, sf_dir), SALES)
    return keyed.drop_listed(typed, loaded_keys(spark, sf_dir), "Order_ID", split_nulls=True)


@query
def load_new_only_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same against a target of several loads, which is asked for the ids of the load by file range."""
    ws = Workspace(spark, "load_new_only_clustered")
    store = _loaded_store(spark, sf_dir, ws)
    typed = ws.hold(schema.convert_types(clean_sales(spark, sf_dir), SALES), "typed")
    there = store.keys("target", "Order_ID").matching(typed.select("Order_ID"))
    return keyed.drop_listed(typed, there, "Order_ID", split_nulls=True)


def _loaded_store(spark: SparkSession, sf_dir: str, ws: Workspace) -> Store:
    """A committed target that holds the finished orders, loaded in three ranges of ids and then compacted."""
    store, loaded = Store(spark, ws.path("store")), ws.hold(loaded_keys(spark, sf_dir), "loaded")
    middle = F.floor(F.col("Order_ID") / 1000) % 3
    for part in range(3):
        commit = store.commit(f"load-{part}")
        commit.add("target", schema.convert_types(schema.align(loaded.where(middle == part), SALES), SALES), "Order_ID", files=4)
        commit.publish()
    store.compact("target", "Order_ID")
    return store


# --- audits -------------------------------------------------------------------------------------

@query
def audit_id_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(audits.id_changes(sales_raw(spark, sf_dir), ["Order_ID", "Customer_Name"], SALES_STAMP))


@query
def audit_string_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(audits.string_changes(sales_raw(spark, sf_dir), SALES_STAMP))


@query
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties; those of error events arrive cut short and must keep their payload."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)"))
        .otherwise(F.col("props")).alias("value"))
    return streams.decode(events, StructType([StructField("k", IntegerType())]))


# --- pipelines ----------------------------------------------------------------------------------

def _sales_run(spark: SparkSession, sf_dir: str, name: str, profile: Profile = SALES_BATCH) -> sales.PipelineResult:
    """The pipeline over landed rows: it reads its source twice, once only two columns of it."""
    ws = Workspace(spark, name)
    landed = ws.hold(sales_raw(spark, sf_dir), "landed")
    return sales.run(landed, profile, SALES_STAMP, ws, loaded_keys(spark, sf_dir))


@query
def etl_batch_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales_run(spark, sf_dir, "etl_batch_clean").clean


@query
def quarantine_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales_run(spark, sf_dir, "quarantine_all").quarantine.drop("logged_at")


@query
def quarantine_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine table of every rule, each in its own layout, as one JSON record per row."""
    found = _sales_run(spark, sf_dir, "quarantine_tables").quarantine
    return _rule_records(found, [r for r in RULES if r != "typos"], SALES.fieldNames())


def _rule_records(found: DataFrame, listed: list[str], business: list[str]) -> DataFrame:
    out = None
    for rule in listed:
        rows = rule_table(found, rule, business).drop("logged_at")
        shaped = rows.select(F.lit(rule).alias("rule"), F.concat_ws("|", *[F.col(f"`{c}`") for c in rows.columns]).alias("record"))
        out = shaped if out is None else out.unionByName(shaped)
    return out


@query
def kafka_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of all rules with the topic each goes to."""
    sent = to_topics(_sales_run(spark, sf_dir, "kafka_topics").quarantine)
    return sent.select("topic", "key", F.get_json_object("value", "$.issue").alias("issue"),
                       F.get_json_object("value", "$.Order_ID").alias("Order_ID"))


@query
def kafka_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load sends beside its records: the columns that the type rule reports, and the audit record."""
    result = _sales_run(spark, sf_dir, "kafka_events")
    sent = to_event_topic(type_schema_event(result.quarantine), SCHEMA_TOPIC).unionByName(
        to_event_topic(audits.load_audit(result.clean, "admin", "sales"), AUDIT_TOPIC))
    return sent.select("topic", "key", *[
        F.get_json_object("value", f"$.{n}").alias(n) for n in ("event_type", "action", "table_name", "columns", "details")])


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales_run(spark, sf_dir, "quality_report").report


@query
def quality_report_one_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a load into a committed target: the clean rows are written once, and counted on the way."""
    ws = Workspace(spark, "quality_report_one_write")
    store = _loaded_store(spark, sf_dir, ws)
    landed = ws.hold(sales_raw(spark, sf_dir), "landed")
    run_batch(spark, SALES_BATCH, landed, CommittedSinks(store.root), RUN_DATE, SALES_STAMP)
    return store.read("report").drop("run")


@query
def etl_batch_reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch pipeline with rejection of the dirty rows only, not of all rows with their id."""
    return _sales_run(spark, sf_dir, "etl_batch_reject_rows", SALES_BATCH.with_options(reject_by="row")).clean


@query
def etl_from_csv_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target after a folder of CSV files in three column orders was loaded, and then its landed day once more."""
    ws = Workspace(spark, "etl_from_csv_folder")
    rows = ws.hold(sales_raw(spark, sf_dir), "rows")
    names = rows.columns
    third = F.crc32(F.coalesce("Customer_Name", F.lit(""))) % 3
    for k, order in enumerate((names, names[::-1], names[3:] + names[:3])):
        files.write_csv(rows.where(third == k).select(*order), ws.path(f"inbox/Test_Data {k}"))
    sinks = Sinks(ws.path("out"))
    for again in (False, True):
        run_for_date(spark, SALES_BATCH, ws.path("inbox"), "test_data", ws.path("raw"), sinks, RUN_DATE, SALES_STAMP, force_from_raw=again)
    return spark.read.parquet(sinks.name)


def _financials_run(spark: SparkSession, sf_dir: str, name: str) -> sales.PipelineResult:
    return financials.run(financials_raw(spark, sf_dir), FINANCIALS_BATCH, FINANCIALS_STAMP, Workspace(spark, name))


@query
def etl_financials_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target after the same day has been loaded twice."""
    ws = Workspace(spark, "etl_financials_repeat")
    for _ in range(2):
        run_batch(spark, FINANCIALS_BATCH, financials_raw(spark, sf_dir), Sinks(ws.path("out")), "2024-01-31", FINANCIALS_STAMP)
    return spark.read.parquet(ws.path("out/target"))


@query
def etl_financials_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _financials_run(spark, sf_dir, "etl_financials_clean").clean


@query
def quarantine_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _financials_run(spark, sf_dir, "quarantine_financials").quarantine
    return found.select("rule", "issue", "flagged", "row_hash")


@query
def quarantine_tables_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The financials' quarantine table of every rule, each in its own layout, as one text per row."""
    ws = Workspace(spark, "quarantine_tables_financials")
    found = financials.run(financials_raw(spark, sf_dir), FINANCIALS_BATCH, FINANCIALS_STAMP, ws).quarantine
    return _rule_records(ws.hold(found, "records"), list(FINANCIALS_RULES), FINANCIALS.fieldNames())


# --- streaming ----------------------------------------------------------------------------------

def _sales_stream(spark: SparkSession, sf_dir: str, ws: Workspace) -> DataFrame:
    """The sales rows as JSON lines in a fresh folder, read as a stream."""
    rows = sales_raw(spark, sf_dir)
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.text(ws.path("in"))
    return streams.decode(streams.json_lines_stream(spark, ws.path("in")), all_text(SALES))


def _job(ws: Workspace, name: str) -> runner.Job:
    return runner.Job(name, ws.path(f"checkpoint-{name}"))


@query
def stream_json_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "stream_json_source")
    stream = _sales_stream(spark, sf_dir, ws)
    started = stream.writeStream.queryName("json_source").format("parquet").option("path", ws.path("out")).option(
        "checkpointLocation", ws.path("checkpoint")).trigger(availableNow=True).start()
    started.awaitTermination()
    return spark.read.parquet(ws.path("out"))


@query
def stream_raw_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "stream_raw_sink")
    stream = _sales_stream(spark, sf_dir, ws)
    runner.start_raw_sink(stream, ws.path("t"), ws.path("bad"), _job(ws, "raw_sink")).awaitTermination()
    return spark.read.parquet(ws.path("t")).drop("run")


def _stream_pipeline(spark: SparkSession, sf_dir: str, ws: Workspace, deliveries: int) -> None:
    stream = _sales_stream(spark, sf_dir, ws)
    for i in range(deliveries):
        job = _job(ws, f"pipeline_{i}")
        runner.start_pipeline(stream, Sinks(ws.path("out")), SALES_STREAM, SALES_STAMP, job).awaitTermination()


@query
def stream_etl_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "stream_etl_clean")
    _stream_pipeline(spark, sf_dir, ws, 1)
    return spark.read.parquet(ws.path("out/target"))


@query
def stream_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records delivered twice, the second time without a memory of the first."""
    ws = Workspace(spark, "stream_replay_idempotent")
    _stream_pipeline(spark, sf_dir, ws, 2)
    return spark.read.parquet(ws.path("out/target"))


def _batches(spark: SparkSession, sf_dir: str, ws: Workspace, part: Column) -> DataFrame:
    """The rows whose id no other row has, as a stream of as many files per ``part``, in the order of the parts; the files of a part are a
    micro-batch. A task writes one file, so their number follows the rows."""
    rows = ws.hold(sales_raw(spark, sf_dir), "rows")
    shared = rows.groupBy("Order_ID").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    alone = ws.hold(rows.join(shared, "Order_ID", "left_anti").select(*rows.columns, part.alias("part")), "alone")
    found = {r["part"]: r["count"] for r in alone.groupBy("part").count().collect()}
    n = max(1, min(found.get(k, 0) for k in range(3)) // ROWS_PER_STREAM_FILE)
    lines = alone.select("part", F.to_json(F.struct(*rows.columns)).alias("value"))
    for k in range(3):
        # Dealt out in turn, so that none of the files is without rows and left out.
        lines.where(F.col("part") == k).select("value").repartition(n).write.mode("append").text(ws.path("in"))
    return streams.decode(streams.json_lines_stream(spark, ws.path("in"), max_files=n), all_text(SALES))


class _StopsAtSecond(CommittedSinks):
    """Fails at the second micro-batch."""

    def begin(self, spark: SparkSession, run: str, key: str) -> CommittedRun:
        if run.endswith("-1"):
            raise RuntimeError("stopped at the second batch")
        return super().begin(spark, run, key)


def _in_two_runs(stream: DataFrame, sinks: CommittedSinks, job: runner.Job, **options) -> None:
    """One micro-batch, then a failure and a restart that takes the others."""
    for into in (_StopsAtSecond(sinks.root), sinks):
        try:
            runner.start_pipeline(stream, into, SALES_STREAM, SALES_STAMP, job, **options).awaitTermination()
        except StreamingQueryException:
            pass


@query
def stream_bounded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three bounded micro-batches with a restart after the first; no id or customer is in two of them, so one batch gives the same."""
    ws = Workspace(spark, "stream_bounded_batches")
    stream = _batches(spark, sf_dir, ws, F.crc32(F.coalesce(text.title_words(F.col("Customer_Name")), F.lit(""))) % 3)
    sinks = CommittedSinks(ws.path("out"))
    _in_two_runs(stream, sinks, _job(ws, "bounded"))
    if sinks.store(spark).last() != 3:
        raise RuntimeError("the stream came in other batches than three")
    return sinks.store(spark).read("target")


@query
def stream_conflicts_across_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in several micro-batches: a region that differs from an earlier batch is a conflict from then on."""
    ws = Workspace(spark, "stream_conflicts_across_batches")
    stream = _batches(spark, sf_dir, ws, F.coalesce(F.col("Order_ID").try_cast("bigint") % 3, F.lit(0)))
    sinks = CommittedSinks(ws.path("out"))
    _in_two_runs(stream, sinks, _job(ws, "conflicts"), remember_customers=True)
    return sinks.store(spark).read("target")


class _FailsAtLoad(CommittedSinks):
    """Fails between the quarantine and the load of every run."""

    def begin(self, spark: SparkSession, run: str, key: str) -> CommittedRun:
        staged = super().begin(spark, run, key)

        class Failing(CommittedRun):
            def load(self, clean: DataFrame) -> int:
                raise RuntimeError("stopped before the load")

        return Failing(staged.root, staged.commit, staged.key)


def _committed_stream(spark: SparkSession, sf_dir: str, ws: Workspace) -> Store:
    """The stream pipeline into committed tables: a delivery that fails before the load, and the same delivery again."""
    stream, sinks = _sales_stream(spark, sf_dir, ws), CommittedSinks(ws.path("out"))
    try:
        runner.start_pipeline(stream, _FailsAtLoad(sinks.root), SALES_STREAM, SALES_STAMP, _job(ws, "first")).awaitTermination()
    except StreamingQueryException:
        pass
    runner.start_pipeline(stream, sinks, SALES_STREAM, SALES_STAMP, _job(ws, "first")).awaitTermination()
    return sinks.store(spark)


@query
def stream_commit_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target as its log shows it, after a failure between quarantine and load and a second delivery."""
    ws = Workspace(spark, "stream_commit_replay")
    return _committed_stream(spark, sf_dir, ws).read("target")


@query
def stream_pipeline_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine of the stream pipeline, after the same failure and second delivery."""
    ws = Workspace(spark, "stream_pipeline_quarantine")
    return _committed_stream(spark, sf_dir, ws).read("quarantine").drop("run", "logged_at")


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "stream_quarantine")
    stream = _sales_stream(spark, sf_dir, ws)
    runner.start_detectors(stream, ws.path("q"), SALES_STREAM, SALES_STAMP, _job(ws, "detectors")).awaitTermination()
    return tables.read_quarantine(spark, ws.path("q")).select("rule", "key")


def _halves(spark: SparkSession, sf_dir: str, ws: Workspace) -> list[DataFrame]:
    """Two streams with the rows of every other customer each."""
    rows = sales_raw(spark, sf_dir)
    half = F.crc32(F.coalesce("Customer_Name", F.lit(""))) % 2
    out = []
    for k in (0, 1):
        rows.where(half == k).select(F.to_json(F.struct(*rows.columns)).alias("value")).write.text(ws.path(f"in{k}"))
        out.append(streams.decode(streams.json_lines_stream(spark, ws.path(f"in{k}")), all_text(SALES)))
    return out


@query
def stream_two_jobs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs with checkpoints of their own write to one raw table."""
    ws = Workspace(spark, "stream_two_jobs_raw")
    for k, stream in enumerate(_halves(spark, sf_dir, ws)):
        runner.start_raw_sink(stream, ws.path("t"), ws.path("bad"), _job(ws, f"raw_sink_{k}")).awaitTermination()
    return spark.read.parquet(ws.path("t")).drop("run")


@query
def stream_two_jobs_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs with checkpoints of their own write to one quarantine; no customer is in both."""
    ws = Workspace(spark, "stream_two_jobs_quarantine")
    for k, stream in enumerate(_halves(spark, sf_dir, ws)):
        runner.start_detectors(stream, ws.path("q"), SALES_STREAM, SALES_STAMP, _job(ws, f"detectors_{k}")).awaitTermination()
    return tables.read_quarantine(spark, ws.path("q")).select("rule", "key")


def entry(spark: SparkSession) -> DataFrame:
    return etl_batch_clean(spark, "/root/testdata/sf0.001")
