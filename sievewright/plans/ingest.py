"""The entry of a daily load: list the source folder, land it for a date, run the batch job on what was landed."""

from __future__ import annotations

from pyspark.sql import SparkSession

from sievewright.contracts import Profile
from sievewright.operators.rules import Stamp
from sievewright.plans.batch import run_batch
from sievewright.sources import files
from sievewright.sources.sinks import JobSinks


def run_for_date(spark: SparkSession, profile: Profile, folder: str, prefix: str, raw: str, sinks: JobSinks,
                 run_date: str, stamp: Stamp, force_from_raw: bool = False, null_tokens: tuple[str, ...] = (),
                 username: str = "etl", multi_line: bool = False) -> dict[str, int]:
    """Land the files of ``folder`` that start with ``prefix`` below ``raw`` for ``run_date`` and load them.

    ``force_from_raw`` leaves the folder alone and loads what was landed for that date before. A folder without rows is an
    error: landing it would leave an earlier landing of the day in place. Lines that are no records are landed as they are and
    quarantined under ``malformed_csv``; with ``multi_line`` quoted values may hold line breaks. Returns the counts of :func:`run_batch`.
    """
    if not force_from_raw:
        source = files.read_csv_by_name(spark, folder, prefix, null_tokens, multi_line, malformed="column")
        if source is None or source.isEmpty():
            raise ValueError(f"no rows in files {prefix}* of {folder}")
        files.land_raw(source, raw, run_date)
    return run_batch(spark, profile, files.read_raw(spark, raw, run_date), sinks, run_date, stamp, username)
