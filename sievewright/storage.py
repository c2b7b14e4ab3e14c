"""Work space in the shared checkpoint folder, written intermediate tables, the size check before a broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one disk, may go without the setting.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        own = tempfile.mkdtemp(prefix="sievewright-")
        spark.conf.set("spark.checkpoint.dir", own)
        return own
    raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")


class Workspace:
    """Intermediate tables of one run.

    ``mode="table"`` writes each once as a columnar table in the shared folder and reads it back: no lineage
    to recompute when an executor is lost, and every reader still prunes columns and pushes filters.
    ``mode="memory"`` caches instead, for micro-batches whose source can replay. Both also keep the rules
    of a stage from being inlined a second time into whatever reads it.
    """

    def __init__(self, spark: SparkSession, label: str, mode: str = "table"):
        if mode not in ("table", "memory"):
            raise ValueError(f"mode must be 'table' or 'memory', not {mode!r}")
        self.spark = spark
        self.mode = mode
        self._path = f"{shared_dir(spark)}/sievewright/{label}-{uuid.uuid4().hex}" if mode == "table" else None
        self._cached: list[DataFrame] = []

    def path(self, name: str) -> str:
        return f"{self._path}/{name}"

    def hold(self, df: DataFrame, name: str) -> DataFrame:
        if self.mode == "memory":
            held = df.persist()
            self._cached.append(held)
            return held
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def close(self) -> None:
        """Drop what was held; frames built on it cannot be read afterwards."""
        for df in self._cached:
            df.unpersist()
        self._cached.clear()
        if self._path:
            jvm = self.spark._jvm
            path = jvm.org.apache.hadoop.fs.Path(self._path)
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def is_small(keys: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Measure a *held* key table: may every executor keep a copy of it?"""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in keys.columns), F.lit(16)
    )
    size = keys.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes
