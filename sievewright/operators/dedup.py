"""One row per key, chosen deterministically."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions.identity import row_hash
from sievewright.functions.text import backticked, quoted
from sievewright.storage import Workspace, is_small


def one_per_key(df: DataFrame, keys, order=()) -> DataFrame:
    """The smallest row per key, by ``order`` and then by all columns.

    Written as an aggregate, not a window: each task first reduces its own copies of a key, so a key that
    holds a third of the rows is one row per task by the time it is shuffled.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    names = [*order, *[c for c in df.columns if c not in order]]
    smallest = F.min(F.struct(*[quoted(c).alias(c) for c in names])).alias("__row")
    picked = df.groupBy(*[quoted(k).alias(f"__key{i}") for i, k in enumerate(keys)]).agg(smallest)
    return picked.select(*[F.col("__row").getField(c).alias(c) for c in df.columns])


def hash_rank(text_hash: Column) -> Column:
    """The first 15 digits of a hash in hexadecimal as a number. It orders as the hash does, but for ties of these digits."""
    return F.conv(F.substring(text_hash, 1, 15), 16, 10).cast("bigint")


def one_per_key_in_two_phases(df: DataFrame, keys, workspace: Workspace, rank: Column | None = None, order=()) -> DataFrame:
    """The same rows as :func:`one_per_key`, for a *held* table in which few keys have several rows.

    First a hash aggregate of numbers, the count and the smallest ``rank`` of each key, finds the keys with several rows. Measured as few,
    they are broadcast: all other rows pass as they are, without a shuffle or a sort. Of the rest only rows of the smallest rank
    go on, copies of a row collapse in a hash aggregate without sorting, and what then remains, hardly more than a row per key, is compared
    as a whole. ``rank`` must not contradict the order. Otherwise all rows take the one aggregate.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranked = F.lit(0).cast("bigint") if rank is None else rank
    named = [quoted(k).alias(f"__key{i}") for i, k in enumerate(keys)]
    numbers = df.groupBy(*named).agg(F.count(F.lit(1)).alias("__n"), F.min(ranked).alias("__least"))
    repeated = workspace.hold(numbers.where("__n > 1").drop("__n"), f"repeated{uuid.uuid4().hex}")
    if not is_small(repeated):
        return one_per_key(df, keys, order)
    on = [quoted(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)]
    columns = [backticked(c) for c in df.columns]
    alone = df.join(F.broadcast(repeated), on, "left_anti")
    first = df.withColumn("__rank", ranked).join(F.broadcast(repeated), on).where(F.col("__rank").eqNullSafe(F.col("__least"))).select(*columns)
    # Written, lest Spark leave out the aggregate that collapses copies: the next one does not need it, but sorts.
    few = workspace.hold(first.dropDuplicates(), f"first{uuid.uuid4().hex}")
    return alone.unionByName(one_per_key(few, keys, order))


def dedup_row_hash(df: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """One row per ``row_hash``. With a workspace in two phases; ``df`` should be a held table then."""
    return one_per_key(df, "row_hash") if workspace is None else one_per_key_in_two_phases(df, "row_hash", workspace)


def dedup_primary_key(df: DataFrame, key: str, business=None, workspace: Workspace | None = None) -> DataFrame:
    """One row per key: the one with the smallest row hash. With a workspace in two phases; ``df`` should be a held table then."""
    hashed = df.withColumn("__hash", row_hash(business or df.columns))
    if workspace is None:
        return one_per_key(hashed, key, order=["__hash"]).drop("__hash")
    return one_per_key_in_two_phases(hashed, key, workspace, hash_rank(F.col("__hash")), ["__hash"]).drop("__hash")


def dedup_full_row(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
