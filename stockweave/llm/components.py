"""Connected components by alternating large and small stars, in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of a node to the smallest of it and its neighbours."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.filter(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter(F.col("u") != F.col("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these; u > v in every edge."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter(F.col("u") != F.col("v")).unionAll(
        least.select("u", F.col("m").alias("v"))
    ).distinct()


def _unfinished(edges: DataFrame) -> bool:
    """Whether some node points at two others, or is pointed at and points on."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("hit"))
    ends = ends.unionAll(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("hit"))
    )
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("hit").alias("hit"))
    return bool(nodes.filter((F.col("out") > 1) | (F.col("out") + F.col("hit") > 1)).head(1))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes in `edges` (u, v): the label is the smallest node it reaches.

    Nulls and loops are ignored. Every round is written to shared scratch space and removed when
    the next one is written; the number of rounds grows with the logarithm of the longest chain.
    """
    now = edges.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    with Scratch(edges.sparkSession) as scratch:
        now = scratch.store(now.distinct(), "edges")
        while _unfinished(now):
            now = scratch.store(_small_star(_large_star(now)), "stars")
            scratch.release(keep=1)
        stars = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        return durable(
            stars.unionAll(
                now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            ),
            "components",
        )
