"""Places and cuts of lineage that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only a local session may do without: on a
    cluster each machine would write to its own disk."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = "file://" + tempfile.mkdtemp(prefix="kinfold-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def settled(df: DataFrame, kind: str = "table") -> DataFrame:
    """Write df to the shared folder and read it back: what follows survives the
    loss of executors and never computes df again."""
    spark = df.sparkSession
    place = new_folder(spark, kind)
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def drop_folder(spark: SparkSession, place: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
