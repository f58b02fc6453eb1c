"""Connected components by alternating large-star and small-star rounds.

Every round is a grouped minimum and a join on the node, written to the shared
folder; a hub's neighbours are never gathered in one place (partial minima, and
a join that Spark may split)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.tables import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u").toDF("u", "v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (u, v), the root being the
    smallest node of its component; roots are listed with themselves."""
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "edges")
    state = None
    while True:
        after = written(_small_star(_large_star(now)), "edges")
        found = after.select(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = after
        if tuple(found) == state:
            break
        state = tuple(found)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
