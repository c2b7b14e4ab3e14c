"""Connected components of a graph of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.storage import Workspace


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"] or 0


def components(links: DataFrame, space: Workspace) -> DataFrame:
    """``node, root`` of every node of ``links`` (columns ``u, v``, bigint) that is not the smallest of its component.

    Each round links every node's larger neighbours to its smallest one, then every node and its smaller neighbours to
    the smallest of these (large-star and small-star, which need a logarithmic number of rounds on common graphs), writes
    the links and goes on from the written table, so that a lost executor costs one round. It ends when a
    round changes nothing: all links then lead to the roots. A centre with most nodes as neighbours is met by
    map-side minima and by joins whose other side has one row per centre, which Spark can split.
    """
    held = space.hold(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "links0")
    state, turn = _state(held), 0
    while state[0]:
        turn += 1
        both = held.unionAll(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = space.hold(large, f"large{turn}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        held = space.hold(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), f"links{turn}")
        state, last = _state(held), state
        if state == last:
            break
    return held.select(F.col("u").alias("node"), F.col("v").alias("root"))
