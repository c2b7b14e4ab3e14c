"""One registered query per operator, each over the whole of its tables, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sievewright.llm import (
    byte_bpe, classifier, decontamination, hard_negatives, id_files, lexical_search, line_dedup, packing, ppm, quality_rules, sharding, simhash,
    suffix_dedup,
)
from sievewright.llm.shipping import ship
from sievewright.storage import Workspace

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        @wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)

        REGISTRY[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The tokenizer of the queries; the operators take any path.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@register("op1_id_files")
def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, "id-files")
    id_files.write(table(spark, sf_dir, "documents"), TOKENIZER, space.path("files"), space, added=True)
    return id_files.digests(spark, space.path("files"))


@register("op2_line_dedup", line_dedup.SQL)
def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"), Workspace(spark, "line-dedup"))


@register("op3_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), TOKENIZER, added=True), Workspace(spark, "packing"))


@register("op4_decontamination", decontamination.SQL)
def benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontamination.report(documents, benchmark, Workspace(spark, "decontamination"))


@register("op5_sharding")
def balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(table(spark, sf_dir, "documents"), Workspace(spark, "sharding"))


@register("op6_simhash")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"), Workspace(spark, "simhash"))


@register("op7_ppm_scoring")
def byte_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.report(table(spark, sf_dir, "documents"), Workspace(spark, "ppm"))


@register("op8_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_suffix_dedup")
def repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"), Workspace(spark, "suffix-dedup"))


@register("op10_quality_rules")
def learned_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op11_lexical_search", lexical_search.SQL)
def best_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return lexical_search.search(documents, benchmark, Workspace(spark, "lexical-search"))


@register("op12_hard_negatives", hard_negatives.SQL)
def hard_negative_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.report(table(spark, sf_dir, "embeddings"), Workspace(spark, "hard-negatives"))


@register("op13_byte_bpe")
def byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.report(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, Workspace(spark, "byte-bpe"))
