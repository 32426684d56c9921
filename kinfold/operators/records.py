"""Record tables: required columns, normalised columns, tagged union, head limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.functions import text as N

REQUIRED = ("entity_id", "business_name", "business_address", "country")
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in REQUIRED])


def check_columns(df: DataFrame) -> None:
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def with_base(df: DataFrame) -> DataFrame:
    """Nulls become empty; _name, _addr and _ctry hold the base forms."""
    check_columns(df)
    df = df.withColumns({c: N.filled(F.col(c).cast("string")) for c in REQUIRED[1:]})
    return df.withColumns({"_name": N.base_normal("business_name"), "_addr": N.base_normal("business_address"), "_ctry": N.base_normal("country")})


def normalised(df: DataFrame) -> DataFrame:
    """Adds the normalised columns; the originals stay."""
    df = with_base(df)
    df = df.withColumn("country_clean", N.clean_country(F.col("_ctry"))).withColumn("business_name_clean", N.clean_name(F.col("_name")))
    df = df.withColumn("business_address_clean", N.clean_address(F.col("_addr"), F.col("country_clean"))).withColumn("_core", N.core_tokens(F.col("business_name_clean")))
    return df.withColumns(
        {
            "name_core": F.array_join("_core", " "),
            "name_core_sorted": F.array_join(F.array_sort("_core"), " "),
            "name_squashed": F.array_join("_core", ""),
            "address_sorted": F.array_join(F.array_sort(N.tokens(F.col("business_address_clean"))), " "),
        }
    ).drop("_name", "_addr", "_ctry", "_core")


def combined(second: DataFrame, third: DataFrame) -> DataFrame:
    """All rows of both with their source; bag union."""
    return second.withColumn("source", F.lit("S2")).unionByName(third.withColumn("source", F.lit("S3")))


def head(df: DataFrame, limit: int | None, order: str = "_row") -> DataFrame:
    """The first rows in file order; 0 or None keeps all."""
    return df.where(F.col(order) < limit) if limit else df


def with_order(df: DataFrame) -> DataFrame:
    """Adds _row, the place in reading order, counted per partition: no row moves."""
    parts = df.withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    counts = {r["_p"]: r["count"] for r in parts.groupBy("_p").count().collect()}  # one row a partition
    start, offsets = 0, {}
    for p in sorted(counts):
        offsets[p] = start
        start += counts[p]
    if not offsets:
        return df.withColumn("_row", F.lit(0).cast("long"))
    table = F.create_map(*[F.lit(x).cast("long") for kv in offsets.items() for x in kv])
    within = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    return parts.withColumn("_row", F.element_at(table, F.col("_p").cast("long")) + within).drop("_p", "_m")


def record_view(docs: DataFrame) -> DataFrame:
    """Documents seen as business records (see README, fixtures)."""
    return docs.select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.substring("text", 1, 60).alias("business_name"),
        F.substring("text", 61, 80).alias("business_address"),
        F.col("lang").alias("country"),
        F.col("doc_id").alias("_row"),
    )


def whole_view(docs: DataFrame) -> DataFrame:
    """Whole documents as business records: the first line is the name, all behind it the address."""
    line = F.substring_index("text", "\n", 1)
    return docs.select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("entity_id"),
        line.alias("business_name"),
        F.substr("text", F.length(line) + 2).alias("business_address"),
        F.col("lang").alias("country"),
        F.col("doc_id").alias("_row"),
    )


def sides(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Source 1, and sources 2 and 3 tagged, by the row number modulo 3."""
    third = lambda k: records.where(F.pmod(F.col("_row"), F.lit(3)) == k)
    return third(0), combined(third(1), third(2))
