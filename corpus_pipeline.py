"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, benchmark decontamination, best-fit packing.

Each stage is a function of ``(spark, docs, sf_dir)`` that calls one operator on all that its predecessor kept. Its
result is written as Parquet, and the next stage reads it from there: an executor lost later costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import decontamination, line_dedup, packing, quality_rules, simhash
from sievewright.llm.queries import TOKENIZER, table
from sievewright.llm.shipping import ship
from sievewright.storage import Workspace


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that neither the base rules nor the rules learned from ``labels`` reject."""
    ship(spark)
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeated runs of lines; ``n_chars`` follows. Documents of which no word is left go."""
    ship(spark)
    kept = line_dedup.clean(docs, Workspace(spark, "pipeline-lines"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group whose fingerprints of three-word shingles link at three bits or fewer."""
    ship(spark)
    return simhash.clean(docs, Workspace(spark, "pipeline-simhash"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not contaminated by ``benchmark``."""
    ship(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), Workspace(spark, "pipeline-benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents and their places in sequences of at most 1024 tokens."""
    ship(spark)
    return packing.pack(packing.pieces(docs, TOKENIZER, added=True), Workspace(spark, "pipeline-packing"))


STAGES = [
    ("quality_rules", good_documents),
    ("line_dedup", without_repeated_lines),
    ("simhash", without_near_copies),
    ("decontamination", without_benchmark),
    ("best_fit_packing", packed),
]

#: Learned rules, fingerprint components and packing are beyond SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the result of the last one."""
    space = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = space.hold(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
