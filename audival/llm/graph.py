"""Connected components by alternating large and small stars, each round a
pair of grouped minima, written to the shared folder. A node with any number
of neighbours is one partial minimum per task before it is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audival.plans.stage import Stager


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v) with u > v; every node points its larger (or its other)
    neighbours at the smallest of its neighbourhood."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    out = edges.join(low, edges["u"] == low["c"]).select("v", "m", "c")
    if large:
        out = out.filter("v > c").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def components(edges: DataFrame, store: Stager, name: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an
    edge list (a, b). Self-loops and repeated edges are ignored."""
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    now, before, turn = store.write(now, f"{name}-0"), None, 0
    while True:
        turn += 1
        now = store.write(_stars(_stars(now, large=True), large=False), f"{name}-{turn}")
        state = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if tuple(state) == before or not state["n"]:
            break
        before = tuple(state)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
