"""Gapless numbers within each value of a key, without a window over that key."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.text import add_columns, widened
from sievewright.storage import Workspace


def _count(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    seen: dict[int, int] = {}
    for batch in batches:
        value, which, many = np.unique(batch.column(key).to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
        order = np.argsort(which, kind="stable")
        within = np.empty(len(which), dtype=np.int64)
        within[order] = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        base = np.array([seen.get(v, 0) for v in value.tolist()], dtype=np.int64)
        for v, n in zip(value.tolist(), (base + many).tolist()):
            seen[v] = n
        yield add_columns(batch, {
            "__task": pa.array(np.full(len(which), task, dtype=np.int32)),
            "__within": pa.array(within + base[which] if len(which) else within),
        })


def numbered(df: DataFrame, key: str, name: str, space: Workspace, table: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``name``: 0, 1, ... within each value of the integer column ``key``; and the rows of each value.

    Each task counts its rows of each value and the table is written once; only these counts are shuffled. A value
    that holds most rows is spread over as many tasks as its rows are.
    """
    held = space.hold(df.mapInArrow(partial(_count, key=key), widened(df, "`__task` int, `__within` bigint")), table)
    counts = held.groupBy(F.col(key), F.col("__task")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(key).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(key, "__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    placed = held.join(first, [key, "__task"]).withColumn(name, F.col("__first") + F.col("__within"))
    return placed.drop("__task", "__within", "__first"), held.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
