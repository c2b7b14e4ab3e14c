"""Tables whose files become visible together, and lookups by key that read few of them.

Layout below a root folder::

    data/<table>/<commit>/part-*.parquet    files of one table; a reader takes only files that the log names
    log/<commit>/part-*.parquet             the record of a commit: one file, moved to its place by one rename

A run stages its files for all tables and then publishes one record. Until then nothing of it is visible, and a run that fails
leaves nothing but files nobody reads. A record names each file with its smallest and largest key and its rows, so that a lookup
decides from the log which files can hold a key. Files of a keyed table are written by ranges of the key, sorted, and with
Bloom filters on it. ``compact`` brings files that many small commits have written back to narrow ranges, and ``summarise`` their
records to one.

The record must appear at once: true for HDFS and local disks; a store without renames needs a committer that has this property.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from sievewright.functions.text import quoted
from sievewright.operators.keyed import keep_listed
from sievewright.storage import is_small

RECORD = ("seq bigint, commit string, run string, replaces boolean, name string, file string, dropped boolean, "
          "lo bigint, hi bigint, rows bigint, schema string")
#: Up to so many keys a lookup hands its keys to the reader one by one, which asks the Bloom filter of each row group.
FEW_KEYS = 200
ROWS_PER_FILE = 4_000_000
SUMMARY = "-summary"


def _commit_of(path: str) -> str:
    """The folder of a record."""
    return path.rsplit("/", 2)[-2]


def _path_not_found(error: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def _any_of(conditions: list) -> F.Column:
    """A balanced tree, so that many conditions nest a few levels deep."""
    while len(conditions) > 1:
        conditions = [a | b for a, b in zip(conditions[::2], conditions[1::2])] + conditions[len(conditions) // 2 * 2:]
    return conditions[0]


@dataclass
class Commit:
    """What one run has staged. ``add`` writes files of a table; ``publish`` makes all of them visible."""

    store: Store
    run: str
    name: str = field(default_factory=lambda: uuid.uuid4().hex)
    records: list[tuple] = field(default_factory=list)
    dropped: list[tuple] = field(default_factory=list)

    def add(self, table: str, df: DataFrame, key: str | None = None, replaces: bool = False, files: int | None = None) -> int:
        """Write the rows of one table; how many they are. ``replaces``: they take the place of what earlier commits of this run
        put there.

        A ``key`` must be of an integer type; rows are then written by its ranges, about ``files`` of them.
        """
        schema, spark = df.schema, self.store.spark
        path = f"{self.store.root}/data/{table}/{self.name}"
        if key is None:
            df.write.parquet(path)
        else:
            if not isinstance(schema[key].dataType, IntegralType):
                raise ValueError(f"the key {key!r} of {table!r} must be an integer column")
            ranges = df.repartitionByRange(files, quoted(key)) if files else df.repartitionByRange(quoted(key))
            (ranges.sortWithinPartitions(quoted(key)).write.option("maxRecordsPerFile", ROWS_PER_FILE)
             .option(f"parquet.bloom.filter.enabled#{key}", "true")
             .option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path))
        written = spark.read.schema(schema).parquet(path)
        at = quoted(key).cast("bigint") if key else F.lit(None).cast("bigint")
        file = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
        found = written.groupBy(file.alias("file")).agg(
            F.min(at).alias("lo"), F.max(at).alias("hi"), F.count(F.lit(1)).alias("rows"))
        # A row per file written. Even without one the table exists now, and a run may replace its rows by none.
        listed = [(table, replaces, schema.json(), None, None, None, 0),
                  *((table, replaces, schema.json(), r["file"], r["lo"], r["hi"], r["rows"]) for r in found.collect())]
        self.records += listed
        return sum(r[-1] for r in listed)

    def drop(self, table: str, files: Iterable[str], schema: StructType) -> None:
        """Files of earlier commits that are no longer part of the table."""
        self.dropped += [(table, schema.json(), f) for f in files]

    def publish(self) -> int:
        """Make everything visible in one step; the number of the commit."""
        seq = self.store.last() + 1
        rows = [(seq, self.name, self.run, replaces, table, file, False, lo, hi, n, schema)
                for table, replaces, schema, file, lo, hi, n in self.records]
        rows += [(seq, self.name, self.run, False, table, file, True, None, None, 0, schema) for table, schema, file in self.dropped]
        (self.store.spark.createDataFrame(rows, RECORD).coalesce(1).write
         .parquet(f"{self.store.root}/log/{seq:012d}-{self.name}"))
        return seq


@dataclass
class Store:
    """Committed tables below ``root``. Several runs may commit at a time; only one may compact or summarise."""

    spark: SparkSession
    root: str

    def _listed(self) -> tuple[list[str], set[str]]:
        """The files of the log that are to be read: the newest summary, and all that it does not cover; and what it covers."""
        try:
            listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{self.root}/log/*").select("path")
        except Exception as error:  # the path is resolved here
            if not _path_not_found(error):
                raise
            return [], set()
        paths = sorted((r["path"] for r in listed.collect()), key=_commit_of)
        summaries = [p for p in paths if _commit_of(p).endswith(SUMMARY)]
        if not summaries:
            return paths, set()
        covered = self.spark.read.schema(RECORD).parquet(summaries[-1]).where("name IS NULL").select("file")
        known = {r["file"] for r in covered.collect()}
        return [p for p in paths if _commit_of(p) not in known], known

    def log(self) -> DataFrame:
        paths, _ = self._listed()
        if not paths:
            return self.spark.createDataFrame([], RECORD)
        return self.spark.read.schema(RECORD).parquet(*paths).where("name IS NOT NULL")

    def summarise(self) -> None:
        """Write one record that says what all records so far say, less what is replaced or dropped. Readers then read it instead.

        It names the records it covers, so one that is published meanwhile still counts. Runs stay on record. One writer at a time.
        """
        (paths, known), log = self._listed(), self.log()
        if len(paths) < 2:
            return
        newest = F.max("seq").over(Window.partitionBy("run", "name"))
        gone = log.where("dropped").select(F.col("file").alias("gone"))
        kept = log.withColumn("newest", newest).where("NOT dropped AND (NOT replaces OR seq = newest)")
        # Of the rows that only say that a run wrote a table, the last is enough.
        kept = kept.where("file IS NOT NULL OR seq = newest").drop("newest").join(gone, F.col("file") == F.col("gone"), "left_anti")
        seq, name = self.last(), f"{uuid.uuid4().hex}{SUMMARY}"
        covers = self.spark.createDataFrame([(c,) for c in sorted(known | {_commit_of(p) for p in paths})], "file string")
        rows = kept.unionByName(covers, allowMissingColumns=True).select(*StructType.fromDDL(RECORD).fieldNames())
        rows.coalesce(1).write.parquet(f"{self.root}/log/{seq:012d}-{name}")

    def last(self) -> int:
        return self.log().agg(F.max("seq")).first()[0] or 0

    def has_run(self, run: str) -> bool:
        return not self.log().where(F.col("run") == run).isEmpty()

    def commit(self, run: str) -> Commit:
        return Commit(self, run)

    def live(self, table: str) -> DataFrame:
        """The records of the files that make up a table now."""
        mine = self.log().where(F.col("name") == table)
        newest = F.max(F.when(F.col("replaces"), F.col("seq"))).over(Window.partitionBy("run"))
        added = mine.withColumn("newest", newest).where("NOT dropped AND file IS NOT NULL AND (NOT replaces OR seq = newest)")
        gone = mine.where("dropped").select(F.col("file").alias("gone"))
        return added.join(gone, F.col("file") == F.col("gone"), "left_anti").drop("newest")

    def schema(self, table: str) -> StructType | None:
        """That of the last commit; None if the table has never been written."""
        last = self.log().where(F.col("name") == table).agg(F.max_by("schema", "seq").alias("s")).first()["s"]
        return None if last is None else StructType.fromJson(json.loads(last))

    def files(self, table: str) -> list[str]:
        return [r["file"] for r in self.live(table).select("file").orderBy("file").collect()]

    def read(self, table: str) -> DataFrame | None:
        """The rows of a table as of now; None if it has never been written."""
        schema = self.schema(table)
        return None if schema is None else self._rows(self.files(table), schema)

    def _rows(self, files: list[str], schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def keys(self, table: str, key: str) -> KeyLookup | None:
        schema = self.schema(table)
        return None if schema is None else KeyLookup(self, table, key)

    def compact(self, table: str, key: str, rows_per_file: int = ROWS_PER_FILE) -> None:
        """Rewrite the files that are small, or whose range overlaps that of another file, into files of narrow ranges.

        Sorted by their lower end, a file overlaps one before it if that reaches beyond this end. Such neighbours form a chain; a file
        of at least half the wanted size in a chain of its own stays.
        """
        by_start = Window.orderBy("lo", "hi", "file")
        reach = F.max("hi").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
        # The log of one table: a row per file.
        chained = self.live(table).withColumn("chain", F.sum(F.when(F.col("lo") <= reach, 0).otherwise(1)).over(by_start))
        chained = chained.withColumn("many", F.count(F.lit(1)).over(Window.partitionBy("chain")))
        chosen = chained.where((F.col("many") > 1) | (2 * F.col("rows") < rows_per_file)).select("file", "rows").collect()
        if len(chosen) < 2:
            return
        schema, files = self.schema(table), [r["file"] for r in chosen]
        commit = self.commit(f"compact-{uuid.uuid4().hex}")
        commit.add(table, self._rows(files, schema), key, files=max(1, -(-sum(r["rows"] for r in chosen) // rows_per_file)))
        commit.drop(table, files, schema)
        commit.publish()


@dataclass(frozen=True)
class KeyLookup:
    """The keys of a table, asked for by the keys of a load."""

    store: Store
    table: str
    key: str

    def all(self) -> DataFrame:
        return self.store.read(self.table).select(quoted(self.key))

    def files_for(self, ids: DataFrame) -> list[str]:
        """The files whose range can hold one of the ids (one column of integers).

        A file has a level, the least power of two that its range is not longer than, and so meets at most two cells of that size. The
        ids, reduced to the smallest and the largest of each cell, meet the files by level and cell: an equi-join of
        small tables, however the ranges lie.
        """
        # As doubles, lest the difference overflow; they round, so a level more than needed.
        span = F.col("hi").cast("double") - F.col("lo").cast("double")
        level = F.least(F.ceil(F.log2(span + 1)) + 1, F.lit(63)).cast("int")
        live = self.store.live(self.table).where("lo IS NOT NULL").select("file", "lo", "hi", level.alias("level"))
        levels = [r["level"] for r in live.select("level").distinct().orderBy("level").collect()]
        if not levels:
            return []
        ranges = live.withColumn("cell", F.explode(F.expr("array_distinct(array(shiftright(lo, level), shiftright(hi, level)))")))
        wanted = ids.select(quoted(ids.columns[0]).cast("bigint").alias("id")).where("id IS NOT NULL")
        cells = wanted.withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels]))).groupBy(
            "level", F.expr("shiftright(id, level)").alias("cell")).agg(F.min("id").alias("least"), F.max("id").alias("most"))
        hit = ranges.join(cells, ["level", "cell"]).where("least <= hi AND most >= lo")
        return [r["file"] for r in hit.select("file").distinct().orderBy("file").collect()]

    def rows(self, ids: DataFrame) -> DataFrame:
        """The rows of the table whose key is among the ids. ``ids`` is read several times: a held table."""
        schema = self.store.schema(self.table)
        rows = self.store._rows(self.files_for(ids), schema)
        return keep_listed(rows, F.broadcast(ids) if is_small(ids) else ids, self.key, ids.columns[0])

    def matching(self, ids: DataFrame) -> DataFrame:
        """Those of the ids that the table holds, each once. ``ids`` is read several times: a held table."""
        name = ids.columns[0]
        files, schema = self.files_for(ids), self.store.schema(self.table)
        if not files:
            return self.store.spark.createDataFrame([], StructType([schema[self.key]]))
        keys = self.store.spark.read.schema(StructType([schema[self.key]])).parquet(*files)
        few = ids.where(quoted(name).isNotNull()).distinct().limit(FEW_KEYS + 1).collect()
        if 0 < len(few) <= FEW_KEYS:
            keys = keys.where(_any_of([quoted(self.key) == F.lit(r[0]) for r in few]))
        return keep_listed(keys, F.broadcast(ids) if is_small(ids) else ids, self.key, name).distinct()
