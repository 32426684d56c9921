"""Tables in the folder that all executors share, where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, kind: str) -> str:
    """A new place in spark.checkpoint.dir. Only a local session may do without."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = "file://" + tempfile.mkdtemp(prefix="kinfold-")
        spark.conf.set("spark.checkpoint.dir", place)
    return f"{place.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str = "table") -> DataFrame:
    """df written once and read back: what follows never computes it again."""
    place = folder(df.sparkSession, kind)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)
