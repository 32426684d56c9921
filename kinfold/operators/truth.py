"""Ground truth: pairs, coverage, injection, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions.text import id_list


def _listed(truth: DataFrame, left: DataFrame) -> DataFrame:
    known = truth.join(left.select(F.col("entity_id").alias("source1_entity_id")).distinct(), "source1_entity_id", "left_semi")
    return known.select(F.col("source1_entity_id").alias("s1_id"), F.explode(id_list(F.col("matched_entity_ids"), strip=True)).alias("r_id"))


def first_of_each(right: DataFrame, order: str = "_row") -> DataFrame:
    """The first row of each entity_id."""
    nth = F.row_number().over(Window.partitionBy("entity_id").orderBy(order))
    return right.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def true_pairs(truth: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct true pairs whose records are both loaded."""
    ids = right.select(F.col("entity_id").alias("r_id")).distinct()
    return _listed(truth, left).join(ids, "r_id", "left_semi").select("s1_id", "r_id").distinct()


def out_of_scope(truth: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many listed identifiers aren't among the right records."""
    ids = right.select(F.col("entity_id").alias("r_id")).distinct()
    return _listed(truth, left).join(ids, "r_id", "left_anti").agg(F.count(F.lit(1)).alias("outside"))


def coverage(true: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: true pairs, those among the candidates, their share."""
    hit = pairs.select("s1_id", "r_id").distinct().withColumn("hit", F.lit(1))
    got = true.join(hit, ["s1_id", "r_id"], "left")
    return got.agg(F.count(F.lit(1)).alias("true_pairs"), F.count("hit").alias("found"), F.coalesce(F.avg(F.coalesce("hit", F.lit(0))), F.lit(0.0)).alias("recall"))


def training_pool(true: DataFrame, pairs: DataFrame) -> DataFrame:
    """s1_id, r_id, natural, label: candidates and the true pairs they miss."""
    natural = pairs.select("s1_id", "r_id", F.lit(True).alias("natural"))
    missed = true.join(natural, ["s1_id", "r_id"], "left_anti").select("s1_id", "r_id", F.lit(False).alias("natural"))
    marks = true.select("s1_id", "r_id", F.lit(1).alias("label"))
    return natural.unionByName(missed).join(marks, ["s1_id", "r_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))
