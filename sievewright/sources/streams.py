"""Streams of JSON records: Kafka or a folder of JSON lines, and the Kafka envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sievewright.functions.text import quoted
from sievewright.operators.schema import to_text

CORRUPT = "_corrupt_record"


#: What one micro-batch takes at most unless told otherwise: a backlog then arrives in batches of a size that is known, each
#: with a commit of its own, instead of in one.
MAX_OFFSETS = 1_000_000
MAX_FILES = 1_000


def kafka_read_options(servers: str, topic: str, starting: str = "earliest",
                       max_offsets: int | None = MAX_OFFSETS) -> dict[str, str]:
    """``max_offsets`` caps the records of one micro-batch, which is how this engine limits its rate. None: no cap."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_read_options(servers, topic, **options)).load()


def json_lines_stream(spark: SparkSession, folder: str, max_files: int | None = MAX_FILES) -> DataFrame:
    """One text record per line in a ``value`` column, the same shape Kafka gives. ``max_files`` caps a micro-batch."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def decode(records: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """The columns of the JSON record, and the payload in ``_corrupt_record`` when it is not JSON."""
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(quoted(value).cast("string"), with_corrupt, options)
    others = [c for c in records.columns if c != value]
    return records.select(*others, parsed.alias("__record")).select(*others, "__record.*")


def split_corrupt(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records without the payload column, and the payloads that could not be read."""
    good = decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = decoded.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("payload"))
    return good, bad


def to_envelope(df: DataFrame, key: str | None = None) -> DataFrame:
    """``key`` and ``value``: the row as one JSON record of texts."""
    rows = to_text(df)
    key_col = quoted(key) if key else F.lit(None).cast("string")
    return rows.select(key_col.alias("key"), F.to_json(F.struct(*[quoted(c) for c in rows.columns])).alias("value"))


def kafka_write_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def write_kafka(df: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    to_envelope(df, key).write.format("kafka").options(**kafka_write_options(servers, topic)).save()
