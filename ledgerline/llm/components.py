"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.store import Shared

#: Steps double the reach; this is beyond any table.
MAX_ROUNDS = 64


def _stars(edges: DataFrame, larger_only: bool) -> DataFrame:
    """For each ``u`` and its least neighbour or itself, ``m``: points its neighbours (those above ``u`` for the large star, those below for the small) at ``m``."""
    if larger_only:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        around = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = around.join(least, "u")
    if larger_only:
        out = joined.filter("v > u").select(F.col("v").alias("b"), F.col("m").alias("a"))
    else:
        out = joined.select(F.col("v").alias("b"), F.col("m").alias("a")).unionByName(least.select(F.col("u").alias("b"), F.col("m").alias("a")))
    return out.filter("a < b").select("a", "b").distinct()


def connected_components(links: DataFrame, shared: Shared) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a < b``): the component's smallest node.

    Every step is a grouping with partial sums and a join that can be split on
    a hub; its rows are written and read back, so a lost executor costs one
    step. The driver sees one count and one checksum a round.
    """
    edges, seen = links.select("a", "b"), None
    for turn in range(MAX_ROUNDS):
        large = shared.keep(_stars(edges, True), f"large{turn}")
        edges = shared.keep(_stars(large, False), f"small{turn}")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        shared.drop(f"large{turn}")
        if turn:
            shared.drop(f"small{turn - 1}")
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
