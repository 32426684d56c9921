"""Record files that keep arriving: the batch normalisation as a stream.

Normalisation has no state, so the stream is the batch projection; scoring needs
the run's whole vectors and stays a batch job over what the stream has written.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from kinfold.operators.records import SCHEMA, normalised


def normalise_stream(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Every TSV file of the source folder, once, into Parquet; ends when all that
    is there has been read."""
    raw = spark.readStream.schema(SCHEMA).options(sep="\t", header=True, quote='"', escape='"').csv(source)
    return normalised(raw).writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", target).outputMode("append").trigger(availableNow=True).start()
