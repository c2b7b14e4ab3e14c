"""The batch job: read, run the pipeline of a profile, write target, quarantine, report and audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievewright.contracts import Profile
from sievewright.operators.audits import audit_record
from sievewright.operators.rules import Stamp
from sievewright.plans import financials, sales
from sievewright.plans.sales import PipelineResult, report_of
from sievewright.session import tune
from sievewright.sources.commits import KeyLookup
from sievewright.sources.files import malformed_records, split_malformed
from sievewright.sources.sinks import JobSinks
from sievewright.storage import Workspace


def run_pipeline(df: DataFrame, profile: Profile, stamp: Stamp, workspace: Workspace,
                 existing_keys: DataFrame | KeyLookup | None = None) -> PipelineResult:
    if profile.region_column is None:
        return financials.run(df, profile, stamp, workspace, existing_keys)
    return sales.run(df, profile, stamp, workspace, existing_keys)


def run_batch(spark: SparkSession, profile: Profile, source: DataFrame, sinks: JobSinks, run_date: str, stamp: Stamp,
              username: str = "etl") -> dict[str, int]:
    """One load. Returns the row counts: what came in, records per rule, rows loaded.

    Safe to repeat: keys already in the target are not loaded again, and quarantine and report of the day
    are replaced. An error is put on record as a rollback and raised again. The clean rows are written once and counted on
    the way. Lines that the CSV readers could not read go to the quarantine.
    """
    tune(spark)
    workspace = Workspace(spark, f"{profile.name}-{run_date}")
    into = sinks.begin(spark, run_date, profile.key)
    try:
        good, lines = split_malformed(source)
        result = run_pipeline(good, profile, stamp, workspace, into.existing_keys(spark, profile.key))
        found = result.quarantine if lines is None else result.quarantine.unionByName(
            malformed_records(lines, stamp), allowMissingColumns=True)
        records = workspace.hold(found, "records")
        into.quarantine(records, run_date, run_date)
        loaded = into.load(result.clean)
        raw = result.judged if lines is None else source
        counts = workspace.hold(report_of(raw, records, loaded), "counts")
        into.report(counts, run_date)
        into.publish()
        sinks.audit(audit_record(spark, username, "INSERT", sinks.name, f"Loaded {loaded} rows"))
        return {r["stage"]: r["rows"] for r in counts.collect()}
    except Exception as error:
        sinks.audit(audit_record(spark, username, "ROLLBACK", sinks.name, str(error)))
        raise
    finally:
        workspace.close()
