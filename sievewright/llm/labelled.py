"""A bounded sample of labelled documents to fit a model on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, text, label`` of at most ``max_rows`` labelled documents, those with the smallest id hashes.

    The bound makes the ids safe to broadcast, and the sample safe for one task or the driver. Ids with a null label or with
    contradicting labels are left out. Of a labelled id that has several documents, the one with the smallest text hash is taken, each
    task reducing its own first.
    """
    ids = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where(F.col("label") == F.col("other")).select("doc_id", "label")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    found = docs.select(F.col(doc_id).alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")
    return found.groupBy("doc_id", "label").agg(first).select("doc_id", "first.text", "label")
