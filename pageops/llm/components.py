"""Connected components of an edge table, by alternating large-star and
small-star steps (each a grouped minimum and a join on the node)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], int(r[1] or 0)


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) -> (node, comp): the smallest node reachable.
    Nodes without edges are absent.  Every step writes its edges to the shared
    folder; one row of two numbers reaches the driver per step."""
    e = keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        # Large star: link every larger neighbour to the node's smallest neighbour.
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # Small star: link the node and its smaller neighbours to the smallest.
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        e = (e.join(low, "a").select(F.explode(F.array(
                F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("x"))
             .select("x.a", "x.b").filter("a <> b").distinct())
        e = keep(e, "edges")
        now = _state(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(roots)
