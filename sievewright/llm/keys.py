"""A key for every row, where ids may be null or shared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.storage import Workspace


def keyed(docs: DataFrame, space: Workspace) -> DataFrame:
    """``docs`` with ``__copy``, so that (``doc_id``, ``__copy``) is unique, and null ids as -2**63.

    Usually ids are unique and ``__copy`` is 0. If some are shared or null, the rows are written once with a number of
    their own; rows that share an id then count as documents in that order.
    """
    own = docs.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint")))
    ids = own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where((F.col("n") > 1) | (F.col("doc_id") == -(1 << 63))).limit(1).isEmpty():
        return own.withColumn("__copy", F.lit(0).cast("bigint"))
    return space.hold(own.withColumn("__copy", F.monotonically_increasing_id()), "keyed")


def unkeyed(df: DataFrame) -> DataFrame:
    """Null ids again, and no ``__copy``."""
    return df.withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id"))).drop("__copy")


def shielded(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with every column but those ``used`` under a neutral name, and what gives the columns of ``docs`` back their names and
    order. So a column of any name rides through an operator unread, whatever names that uses itself."""
    names = {c: c if c in used else f"__user{i}" for i, c in enumerate(docs.columns)}
    hidden = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return hidden, lambda out: out.select(*[F.col(n).alias(c) for c, n in names.items()])
