"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelog.llm.common import discard, materialise


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of edges (a, b); component is the smallest node that can be reached.

    Only minima are gathered per node, so a node with very many edges costs a map-side aggregate and a join that can be
    split. Every round is written to the shared folder, then the round before is deleted.
    """
    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    told = None
    for _ in range(most_rounds):
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionAll(down.select("a", F.col("m").alias("b"))).distinct()
        after = materialise(small, "edges")
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(now)
        now = after
        if tuple(seen) == told:
            break
        told = tuple(seen)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
