"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolepulse.llm.texts import stored


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Each node hands the least of its neighbours and itself to its larger neighbours; an edge gives at most one, repeats stay."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.where("v > u").join(_minima(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Each node hands the least of its smaller neighbours to the others of them and itself; v < u in every edge."""
    least = _minima(edges)
    handed = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.union(least.select("u", F.col("m").alias("v"))).distinct()


def are_stars(edges: DataFrame) -> bool:
    """Whether each v is the least of its component and joined with all the rest of it; edges are distinct, v < u in every one."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below"))
            .union(edges.select(F.col("v").alias("node"), F.lit(0).alias("above"), F.lit(1).alias("below"))))
    others = ends.groupBy("node").agg((F.sum("above") + F.max("below")).alias("n")).where("n > 1")
    return others.agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, least node of its component) for every node of ``edges`` (u, v) that is not the least itself.

    Each turn is written to the shared folder; the number of turns grows with the logarithm of
    the number of nodes, and is none if the edges are stars already.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    while not are_stars(now):
        now = stored(small_star(large_star(now)), name)
    return now.select(F.col("u").alias("node"), F.col("v").alias("least"))
