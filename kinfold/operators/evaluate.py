"""F-beta, evaluation at a threshold, and the threshold sweep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions import fixed as X


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def f_beta(precision: Column, recall: Column, beta: float = X.F_BETA) -> Column:
    under = F.lit(beta * beta) * precision + recall
    return F.when(under > 0, F.lit(1 + beta * beta) * precision * recall / F.when(under > 0, under)).otherwise(F.lit(0.0))


def _measures(df: DataFrame, total: Column) -> DataFrame:
    df = df.withColumn("fn", total - F.col("tp")).withColumn("precision", _share(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", _share(F.col("tp"), total))
    return df.withColumn("f0_5", f_beta(F.col("precision"), F.col("recall")))


def evaluate(scored: DataFrame, threshold: float, total_true: int) -> DataFrame:
    """scored: label, probability. One row; recall is over all true pairs."""
    hit = F.col("probability") >= threshold
    got = scored.agg(F.count_if(hit & (F.col("label") == 1)).alias("tp"), F.count_if(hit & (F.col("label") == 0)).alias("fp"))
    return _measures(got, F.lit(total_true).cast("long")).select(F.lit(threshold).alias("threshold"), "precision", "recall", "f0_5", "tp", "fp", "fn")


def sweep(scored: DataFrame, total_true: int) -> DataFrame:
    """A row for each threshold of the grid: scores are counted once into the grid's
    steps and summed from above, so one pass serves all thresholds."""
    spark = scored.sparkSession
    n = len(X.THRESHOLDS)
    grid = F.array(*[F.lit(t) for t in X.THRESHOLDS])
    # place: how many thresholds the probability reaches
    place = F.size(F.filter(grid, lambda t: t <= F.col("probability")))
    bins = scored.select(place.alias("place"), "label").groupBy("place").agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("q"))
    steps = spark.range(1, n + 1).select(F.col("id").cast("int").alias("place"), F.element_at(grid, F.col("id").cast("int")).alias("threshold"))
    above = Window.orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # n rows
    got = steps.join(bins, "place", "left").select("place", "threshold", F.coalesce("p", F.lit(0)).alias("p"), F.coalesce("q", F.lit(0)).alias("q"))
    got = got.withColumn("tp", F.sum("p").over(above)).withColumn("fp", F.sum("q").over(above))
    return _measures(got, F.lit(total_true).cast("long")).select("threshold", "precision", "recall", "f0_5", "tp", "fp", "fn")


def best_threshold(swept: DataFrame) -> DataFrame:
    """The middle row of the best plateau (within 1e-9; the later of two middles)."""
    all_rows = Window.partitionBy(F.lit(0))  # the grid's rows
    plateau = swept.withColumn("top", F.max("f0_5").over(all_rows)).where(F.col("f0_5") >= F.col("top") - 1e-9)
    plateau = plateau.withColumn("nth", F.row_number().over(all_rows.orderBy("threshold"))).withColumn("n", F.count(F.lit(1)).over(all_rows))
    return plateau.where(F.col("nth") == F.floor(F.col("n") / 2) + 1).drop("top", "nth", "n")


def entity_split(pool: DataFrame, fraction: float = X.VALIDATION_FRACTION, seed: int = X.SEED) -> DataFrame:
    """Adds `held`: all pairs of an S1 record fall on one side, decided by its hash."""
    return pool.withColumn("held", F.pmod(F.xxhash64(F.lit(seed), F.col("s1_id")), F.lit(10_000)) < F.lit(int(fraction * 10_000)))
