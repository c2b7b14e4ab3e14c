"""Where a job puts its results: tables by path, or a database with dated tables or topics per rule."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sievewright.contracts import FINANCIALS
from sievewright.functions.text import backticked, quoted
from sievewright.operators.keyed import keep_listed
from sievewright.plans.sales import SeenBefore
from sievewright.sources import tables
from sievewright.sources.commits import Commit, KeyLookup, Store
from sievewright.sources.files import dated_table
from sievewright.sources.tables import JdbcTarget

# Metadata columns of each quarantine table, in order, as (name, column of the common layout).
FRONT = {
    "invalid_region": (("issue", "issue"), ("column_flagged", "flagged"), ("source_file", "source_file"),
                       ("project_name", "project_name"), ("logged_at", "logged_at"), ("row_hash", "row_hash")),
    "region_conflicts": (("issue", "issue"), ("source_file", "source_file"), ("logged_at", "logged_at"),
                         ("row_hash", "row_hash")),
    "type_conversion": (("issue", "issue"), ("source_file", "source_file"), ("logged_at", "logged_at"),
                        ("dirty_columns", "flagged"), ("dirty_values", "bad_value")),
    "null_values": (("issue", "issue"), ("null_columns", "flagged"), ("source_file", "source_file"),
                    ("project_name", "project_name"), ("logged_at", "logged_at"), ("row_hash", "row_hash")),
    "negative_values": (("issue", "issue"), ("negative_columns", "flagged"), ("source_file", "source_file"),
                        ("project_name", "project_name"), ("logged_at", "logged_at"), ("row_hash", "row_hash")),
    "unknown_chars": (("issue", "issue"), ("bad_value", "bad_value"), ("source_file", "source_file"),
                      ("logged_at", "logged_at"), ("row_hash", "row_hash")),
    "malformed_csv": (("issue", "issue"), ("bad_value", "bad_value"), ("source_file", "source_file"),
                      ("project_name", "project_name"), ("logged_at", "logged_at"), ("row_hash", "row_hash")),
    "corrupt_json": (("payload", "bad_value"),),
}
BEHIND = {
    "typos": (("dirty_reason", "issue"), ("column_flagged", "flagged"), ("suggested_value", "suggested_value"),
              ("source_file", "source_file"), ("logged_at", "logged_at")),
}
RULES = (*FRONT, *BEHIND)
_ORIGIN = (("source_file", "source_file"), ("logged_at", "logged_at"))
# The same for the financials.
FINANCIALS_FRONT = {
    "dirty_dates": (("column_flagged", "flagged"), ("bad_date_value", "bad_value"), ("issue", "issue"),
                    ("source_file", "source_file"), ("project_name", "project_name"), ("logged_at", "logged_at")),
    "null_values": FRONT["null_values"],
    "negative_values": FRONT["negative_values"],
    "numeric_strings": (("dirty_reason", "issue"), *_ORIGIN),
    "unknown_chars": (("issue", "issue"), ("column_flagged", "flagged"), ("bad_value", "bad_value"), *_ORIGIN),
    "typos": (("dirty_reason", "issue"), ("column_flagged", "flagged"), *_ORIGIN),
    "type_conversion": (("column_flagged", "flagged"), ("expected_type", "expected_type"), ("issue", "issue"), *_ORIGIN),
    "malformed_csv": FRONT["malformed_csv"],
}
FINANCIALS_RULES = tuple(FINANCIALS_FRONT)

# The topic of each rule.
TOPICS = {
    "invalid_region": "dirty-region-events", "region_conflicts": "dirty-region-conflicts",
    "type_conversion": "dirty-type-events", "null_values": "dirty-null-values",
    "negative_values": "dirty-negative-values", "unknown_chars": "dirty-special-chars", "typos": "dirty-typos",
    "bigint_values": "dirty-bigint-values", "id_changes": "id-cleaning-audit", "string_changes": "string-cleaning-audit",
    "malformed_csv": "dirty-malformed-csv", "corrupt_json": "dirty-corrupt-json", "dirty_dates": "dirty-dates", "numeric_strings": "dirty-numeric-strings",
}


# Where audit records and announcements of a quarantine table's columns go.
AUDIT_TOPIC = "audit-events"
SCHEMA_TOPIC = "dirty-type-schema"


def to_event_topic(events: DataFrame, topic: str) -> DataFrame:
    """Envelopes of events: no key, the record without its empty columns as JSON."""
    body = F.to_json(F.struct(*[quoted(c) for c in events.columns]))
    return events.select(F.lit(topic).alias("topic"), F.lit(None).cast("string").alias("key"), body.alias("value"))


def type_schema_event(records: DataFrame) -> DataFrame:
    """One record that announces which columns the type rule reports in these records; none if it reports nothing."""
    found = records.where(F.col("rule") == "type_conversion").select(F.explode(F.split("flagged", ",")).alias("column"), "logged_at")
    return found.agg(F.array_sort(F.collect_set("column")).alias("columns"), F.max("logged_at").cast("string").alias("logged_at")).where(
        F.size("columns") > 0).select(
        F.lit("DIRTY_TYPE_SCHEMA").alias("event_type"), F.lit("dirty_type_conversion").alias("table_name"), "columns", "logged_at")


def rule_table(records: DataFrame, rule: str, business: list[str]) -> DataFrame:
    """The quarantine table of one rule: its own metadata columns, then the business columns (typos: before).

    Records of a rule or layout not listed keep all their columns.
    """
    def renamed(pairs) -> list[Column]:
        return [F.col(source).alias(name) for name, source in pairs]

    rows = records.where(F.col("rule") == rule)
    if set(business) == set(FINANCIALS.fieldNames()) and rule in FINANCIALS_FRONT:
        return rows.select(*renamed(FINANCIALS_FRONT[rule]), *[backticked(n) for n in business])
    listed = FRONT.get(rule, BEHIND.get(rule))
    if listed is None or not {source for _, source in listed} <= set(records.columns):
        return rows.drop("rule")
    if rule in BEHIND:
        return rows.select(*[backticked(n) for n in business], *renamed(BEHIND[rule]))
    if rule == "region_conflicts":
        return rows.select(*renamed(FRONT[rule]), *[F.col(backticked(n)).alias(n.lower()) for n in business])
    return rows.select(*renamed(FRONT[rule]), *[backticked(n) for n in business])


def to_topics(records: DataFrame, key: str = "row_hash", value: Column | None = None) -> DataFrame:
    """One envelope stream for all rules: the ``topic`` column sends each record to the topic of its rule.

    ``value`` is the JSON text to send; by default the record without its empty columns.
    """
    pairs = ",".join(f"{rule}:{topic}" for rule, topic in TOPICS.items())
    known = F.try_element_at(F.str_to_map(F.lit(pairs)), F.col("rule"))
    topic = F.when(known.isNotNull(), known).otherwise(F.raise_error(F.concat(F.lit("no topic for rule "), F.col("rule"))))
    rows = tables.to_text(records)
    body = F.to_json(F.struct(*[backticked(c) for c in rows.columns if c != "rule"])) if value is None else value
    return rows.select(topic.alias("topic"), F.col(key).alias("key"), body.alias("value"))


class JobSinks(Protocol):
    """What the jobs need from a place to write to.

    A run begins, writes its tables and publishes them. Where a place has no way to show several tables at once, each is
    visible as soon as it is written.
    """

    name: str

    def done(self, spark: SparkSession, run: str) -> bool:
        """Has this run been published, so that a repeated delivery of a micro-batch has nothing left to do?"""

    def begin(self, spark: SparkSession, run: str, key: str) -> JobSinks: ...

    def existing_keys(self, spark: SparkSession, key: str) -> DataFrame | KeyLookup | None: ...

    def load(self, clean: DataFrame) -> int:
        """Add rows to the target, in one write; how many they are."""

    def quarantine(self, records: DataFrame, run: str, day: str) -> None: ...

    def report(self, counts: DataFrame, run: str) -> None: ...

    def earlier(self, spark: SparkSession, customer: str) -> SeenBefore:
        """What earlier runs remembered of customers."""

    def remember(self, seen: DataFrame, customer: str) -> None: ...

    def publish(self) -> None: ...

    def audit(self, record: DataFrame) -> bool: ...


class _AtOnce:
    """Tables that are visible as they are written."""

    def done(self, spark: SparkSession, run: str) -> bool:
        return False

    def begin(self, spark: SparkSession, run: str, key: str) -> JobSinks:
        return self

    def earlier(self, spark: SparkSession, customer: str) -> SeenBefore:
        raise ValueError("what a run remembers must become visible with its rows: that takes committed tables")

    def publish(self) -> None:
        pass


def _counted(rows: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write the rows and count them on the way. A write that did not pass by the counter within a minute is counted after it."""
    seen, found = Observation(), []
    write(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
    waiting = threading.Thread(target=lambda: found.append(seen.get["rows"]), daemon=True)
    waiting.start()
    waiting.join(60)
    return found[0] if found else rows.count()


@dataclass(frozen=True)
class Sinks(_AtOnce):
    """Four tables below one folder."""

    root: str

    @property
    def name(self) -> str:
        return self.path("target")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def existing_keys(self, spark: SparkSession, key: str) -> DataFrame | None:
        return tables.existing_keys(spark, self.path("target"), key)

    def load(self, clean: DataFrame) -> int:
        return _counted(clean, lambda rows: tables.append(rows, self.path("target")))

    def quarantine(self, records: DataFrame, run: str, day: str) -> None:
        tables.write_quarantine(records, self.path("quarantine"), run)

    def report(self, counts: DataFrame, run: str) -> None:
        counts.write.mode("overwrite").parquet(f"{self.path('report')}/run={run}")

    def audit(self, record: DataFrame) -> bool:
        return tables.append_audit(tables.whole_audit(record), self.path("audit"))


@dataclass(frozen=True)
class CommittedSinks:
    """Target, quarantine and report below one folder, published together; see ``sources.commits``. An audit table beside them.

    A run that was published is not repeated by a stream; a batch job that repeats a day replaces the quarantine and
    the report of that day and adds to the target what it lacks.
    """

    root: str

    @property
    def name(self) -> str:
        return f"{self.root}/data/target"

    def store(self, spark: SparkSession) -> Store:
        return Store(spark, self.root)

    def done(self, spark: SparkSession, run: str) -> bool:
        return self.store(spark).has_run(run)

    def begin(self, spark: SparkSession, run: str, key: str) -> CommittedRun:
        return CommittedRun(self.root, self.store(spark).commit(run), key)

    def audit(self, record: DataFrame) -> bool:
        return tables.append_audit(tables.whole_audit(record), f"{self.root}/audit")


def _customer_key(customer: str) -> Column:
    return F.xxhash64(quoted(customer))


@dataclass(frozen=True)
class _Seen:
    """Customers and their bits, found by the hash of the customer."""

    store: Store
    customer: str

    def of(self, customers: DataFrame) -> DataFrame:
        lookup, name = self.store.keys("seen", "key"), quoted(self.customer)
        if lookup is None:
            return customers.select(name, F.lit(0).cast("bigint").alias("seen")).limit(0)
        near = lookup.rows(customers.select(_customer_key(self.customer).alias("key"))).select(name, "seen")
        return keep_listed(near, customers, self.customer)


@dataclass(frozen=True)
class CommittedRun(CommittedSinks):
    """What one run stages."""

    commit: Commit
    key: str

    def existing_keys(self, spark: SparkSession, key: str) -> KeyLookup | None:
        return self.store(spark).keys("target", key)

    def load(self, clean: DataFrame) -> int:
        return self.commit.add("target", clean, self.key)

    def quarantine(self, records: DataFrame, run: str, day: str) -> None:
        rows = tables.to_text(records).withColumn("run", F.lit(run)).hint("rebalance", "rule")
        self.commit.add("quarantine", rows, replaces=True)

    def report(self, counts: DataFrame, run: str) -> None:
        self.commit.add("report", counts.withColumn("run", F.lit(run)), replaces=True)

    def earlier(self, spark: SparkSession, customer: str) -> _Seen:
        return _Seen(self.store(spark), customer)

    def remember(self, seen: DataFrame, customer: str) -> None:
        self.commit.add("seen", seen.select(quoted(customer), "seen", _customer_key(customer).alias("key")), "key")

    def publish(self) -> None:
        self.commit.publish()


@dataclass(frozen=True)
class JdbcSinks(_AtOnce):
    """A database: the target table, one dated quarantine table per rule, an audit table.

    The target must exist. ``rules`` are the tables to write, empty ones included, by default those of the pipeline with
    these ``business`` columns; records of any other rule are refused. A batch job replaces the tables of its day; the
    micro-batches of a stream append to them, with their ``run`` as a column. A micro-batch that is delivered again appends only what
    its run has not written yet, also after a failure in the middle of a table. With ``kafka_servers`` the quarantine
    goes to the topics of the rules instead, with an announcement of the columns that the type rule reports, and audit records also go
    to a topic.
    """

    db: JdbcTarget
    target: str
    business: list[str]
    audit_table: str = "audit_log"
    rules: tuple[str, ...] | None = None
    kafka_servers: str | None = None
    key_range: dict[str, int] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return self.target

    def existing_keys(self, spark: SparkSession, key: str) -> DataFrame:
        split = {"key": key, **self.key_range} if self.key_range else {}
        return self.db.read(spark, self.target, **split).select(key)

    def load(self, clean: DataFrame) -> int:
        return _counted(clean, lambda rows: self.db.write(rows, self.target))

    def quarantine(self, records: DataFrame, run: str, day: str) -> None:
        if self.kafka_servers:
            self.send(to_topics(records))
            self.send(to_event_topic(type_schema_event(records), SCHEMA_TOPIC))
            return
        rules = self.rules or (FINANCIALS_RULES if set(self.business) == set(FINANCIALS.fieldNames()) else RULES)
        unknown = sorted({r["rule"] for r in records.select("rule").distinct().collect()} - set(rules))
        if unknown:
            raise ValueError(f"no table for records of {', '.join(unknown)}")
        for rule in rules:
            rows, table = rule_table(records, rule, self.business), dated_table(f"dirty_{rule}", day)
            if run == day:
                self.db.write(rows, table, mode="overwrite", text=True)
            else:
                self.db.write(self._not_written(tables.to_text(rows.withColumn("run", F.lit(run))), table, run), table, text=True)

    def _not_written(self, rows: DataFrame, table: str, run: str) -> DataFrame:
        """The records, as often as the table lacks them. A repeated run may have another time stamp: that is not compared."""
        spark = rows.sparkSession
        if not self.db.exists(spark, table):
            return rows
        have = self.db.read(spark, table).where(F.col("run") == run)
        if "logged_at" not in rows.columns:
            return rows.exceptAll(have.select(rows.columns))
        logged = rows.agg(F.max("logged_at")).first()[0]
        names = [quoted(c) for c in rows.columns if c != "logged_at"]
        left = rows.select(names).exceptAll(have.select(names))
        return left.withColumn("logged_at", F.lit(logged).cast("string")).select([quoted(c) for c in rows.columns])

    def report(self, counts: DataFrame, run: str) -> None:
        self.db.write(counts, dated_table("quality_report", run), mode="overwrite")

    def send(self, envelopes: DataFrame) -> None:
        envelopes.write.format("kafka").option("kafka.bootstrap.servers", self.kafka_servers).save()

    def audit(self, record: DataFrame) -> bool:
        try:
            self.db.write(record, self.audit_table)
            if self.kafka_servers:
                self.send(to_event_topic(record, AUDIT_TOPIC))
            return True
        except Exception as error:  # a failing audit table must not fail the load
            print(f"audit record not written: {error}")
            return False
