"""Connected components of an edge table by alternating star contractions.

Rounds are DataFrame joins whose results go to the shared folder; neither edges
nor labels reach the driver. The number of rounds grows with the logarithm of
the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import settled


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(low, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return near.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long, a <> b). Returns vertex, label: label is the smallest
    vertex of the component; the smallest vertices themselves have no row."""
    edges = settled(edges.select("a", "b").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("label"))
        before = state
        edges = settled(_small_star(_large_star(edges)), "edges")
