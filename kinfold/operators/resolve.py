"""Decisions and output lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 9


def _ranked(left: DataFrame, scored: DataFrame) -> DataFrame:
    """For each left record its candidates, best first; an identifier listed twice
    keeps its best place."""
    p = scored.select("s1_id", "r_id", F.round("probability", DIGITS).alias("p"))
    best = F.row_number().over(Window.partitionBy("s1_id", "r_id").orderBy(F.desc("p")))
    once = p.withColumn("nth", best).where("nth = 1")
    lists = once.groupBy("s1_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("m"), "r_id"))).alias("ranked"))
    return left.select("entity_id", "_row").join(lists.withColumnRenamed("s1_id", "entity_id"), "entity_id", "left")


def decided(left: DataFrame, scored: DataFrame, threshold: float) -> DataFrame:
    """entity_id, _row, candidates and matches (arrays, best first). A match is a
    candidate whose probability reaches the threshold: none, one or many."""
    got = _ranked(left, scored).withColumn("ranked", F.coalesce("ranked", F.array().cast("array<struct<m:double,r_id:string>>")))
    return got.select("entity_id", "_row", F.col("ranked.r_id").alias("candidates"), F.transform(F.filter("ranked", lambda x: -x["m"] >= threshold), lambda x: x["r_id"]).alias("matches"))


def matching_table(lists: DataFrame) -> DataFrame:
    return lists.select(F.col("entity_id").alias("source1_entity_id"), F.array_join("matches", ",").alias("matched_entity_ids"), "_row")


def candidate_table(lists: DataFrame) -> DataFrame:
    return lists.select(F.col("entity_id").alias("source1_entity_id"), F.array_join("candidates", ",").alias("candidate_entity_ids"), "_row")


def run_summary(lists: DataFrame) -> DataFrame:
    return lists.agg(
        F.count(F.lit(1)).alias("total_entities"),
        F.count_if(F.size("matches") > 0).alias("matched_entities"),
        F.coalesce(F.sum(F.size("candidates").cast("long")), F.lit(0)).alias("candidate_pairs"),
        F.coalesce(F.sum(F.size("matches").cast("long")), F.lit(0)).alias("final_matches"),
    )


def by_country(lists: DataFrame, left: DataFrame) -> DataFrame:
    """Total and matched records of each raw country; empty is Unknown."""
    rows = lists.join(left.select("entity_id", "country"), "entity_id")
    name = F.when(F.coalesce("country", F.lit("")) == "", F.lit("Unknown")).otherwise(F.col("country"))
    return rows.groupBy(name.alias("country")).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.size("matches") > 0).alias("matched"))
