"""Streaming jobs over a decoded record stream.

Every query has a name and a checkpoint folder of its own, so a restart resumes where it stopped. Work per
micro-batch is the batch code on the micro-batch; it is safe to deliver a batch again.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sievewright.contracts import Profile
from sievewright.functions.text import quoted
from sievewright.operators import audits, rules
from sievewright.operators.rules import Stamp
from sievewright.operators.schema import to_text
from sievewright.plans import sales
from sievewright.session import tune
from sievewright.sources import tables
from sievewright.sources.sinks import JobSinks
from sievewright.sources.streams import split_corrupt
from sievewright.storage import Workspace

CORRUPT_RULE = "corrupt_json"


@dataclass(frozen=True)
class Job:
    """Name and checkpoint folder of one streaming query, and how it is triggered."""

    name: str
    checkpoint: str
    available_now: bool = True
    processing_time: str = "10 seconds"

    def start(self, stream: DataFrame, work: Callable[[DataFrame, str], None]) -> StreamingQuery:
        """``work`` gets each micro-batch and its run: the id that the checkpoint keeps for the query, and the number of
        the batch. A repeated delivery has the same run; a query with another checkpoint never does."""
        tune(stream.sparkSession)
        known, started = threading.Event(), {}

        def body(batch: DataFrame, batch_id: int) -> None:
            known.wait()
            work(batch, f"{started['id']}-{batch_id}")

        writer = (stream.writeStream.queryName(self.name).option("checkpointLocation", self.checkpoint)
                  .outputMode("append").foreachBatch(body))
        if self.available_now:
            writer = writer.trigger(availableNow=True)
        else:
            writer = writer.trigger(processingTime=self.processing_time)
        query = writer.start()
        started["id"] = query.id
        known.set()
        return query


def run_folder(path: str, run: str) -> str:
    return f"{path}/run={run}"


def start_raw_sink(stream: DataFrame, target: str, corrupt: str, job: Job) -> StreamingQuery:
    """Topic to table, no change; payloads that are not JSON go to a table of their own.

    Each micro-batch owns one partition, so a second delivery replaces it.
    """
    def body(batch: DataFrame, run: str) -> None:
        workspace = Workspace(batch.sparkSession, job.name, mode="memory")
        try:
            good, bad = split_corrupt(workspace.hold(batch, "batch"))
            good.write.mode("overwrite").parquet(run_folder(target, run))
            bad.write.mode("overwrite").parquet(run_folder(corrupt, run))
        finally:
            workspace.close()

    return job.start(stream, body)


def detect_all(batch: DataFrame, profile: Profile, stamp: Stamp) -> DataFrame:
    """Eight detectors over the same records as they arrived, in one layout.

    ``record`` is the full record of the rule as JSON, what a topic per rule would carry; ``key`` its hash.
    """
    id_column = profile.key
    found = {
        sales.NULL: rules.nulls(batch, profile, stamp),
        sales.NONPOSITIVE: rules.nonpositive(batch, profile, stamp),
        sales.CONFLICT: rules.region_conflicts(batch, profile, stamp),
        sales.CHARS: rules.special_chars(batch, profile, stamp),
        "bigint_values": rules.bigint(batch, id_column, stamp),
        sales.TYPO: rules.with_record_hash(rules.typos(batch, profile, stamp)),
        "id_changes": audits.id_changes(batch, [id_column], stamp),
        "string_changes": audits.string_changes(batch, stamp, profile.skip_clean),
    }
    out = None
    for rule, records in found.items():
        rows = to_text(records)
        shaped = rows.select(F.lit(rule).alias("rule"), F.col("row_hash").alias("key"),
                             F.to_json(F.struct(*[quoted(c) for c in rows.columns])).alias("record"))
        out = shaped if out is None else out.unionByName(shaped)
    return out


def _corrupt_records(payloads: DataFrame) -> DataFrame:
    return payloads.select(F.lit(CORRUPT_RULE).alias("rule"), F.sha2("payload", 256).alias("key"),
                           F.col("payload").alias("record"))


def start_detectors(stream: DataFrame, quarantine: str, profile: Profile, stamp: Stamp, job: Job) -> StreamingQuery:
    """One query for all detectors: the micro-batch is read once, held, and fanned out."""
    def body(batch: DataFrame, run: str) -> None:
        workspace = Workspace(batch.sparkSession, job.name, mode="memory")
        try:
            good, bad = split_corrupt(workspace.hold(batch, "batch"))
            records = detect_all(good, profile, stamp).unionByName(_corrupt_records(bad))
            tables.write_quarantine(records, quarantine, run)
        finally:
            workspace.close()

    return job.start(stream, body)


def start_pipeline(stream: DataFrame, sinks: JobSinks, profile: Profile, stamp: Stamp, job: Job,
                   remember_customers: bool = False) -> StreamingQuery:
    """The full pipeline per micro-batch: keys already loaded are skipped, so replays add nothing. A micro-batch whose run has been
    published is left alone.

    With ``remember_customers`` the regions of every customer are kept beside the target and published with it, so a customer whose
    region changes in a later micro-batch is in conflict there. Rows loaded before stay.
    """
    key = profile.key

    def body(batch: DataFrame, run: str) -> None:
        spark = batch.sparkSession
        if sinks.done(spark, run):
            return
        into = sinks.begin(spark, run, key)
        workspace = Workspace(spark, job.name, mode="memory")
        try:
            good, bad = split_corrupt(workspace.hold(batch, "batch"))
            earlier = into.earlier(spark, profile.customer_column) if remember_customers else None
            result = sales.run(good, profile, stamp, workspace, into.existing_keys(spark, key), earlier)
            records = result.quarantine.unionByName(
                bad.select(F.lit(CORRUPT_RULE).alias("rule"), F.col("payload").alias("bad_value")),
                allowMissingColumns=True)
            into.quarantine(workspace.hold(records, "records"), run, f"{stamp.run_ts:%Y-%m-%d}")
            into.load(result.clean)
            if result.seen is not None:
                into.remember(result.seen, profile.customer_column)
            into.publish()
            event = audits.audit_event(spark, "INSERT", sinks.name, "ETL_SUCCESS", stamp.source_file, stamp.run_ts)
        except Exception as error:
            event = audits.audit_event(spark, "ROLLBACK", sinks.name, str(error), stamp.source_file, stamp.run_ts)
            raise
        finally:
            sinks.audit(event)
            workspace.close()

    return job.start(stream, body)
