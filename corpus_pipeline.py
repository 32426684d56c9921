"""From raw documents to encoded text: the stages of one corpus build.

quality rules drop rejected rows; the n-gram Jaccard join keeps the row that names
each component; secret scans replace secrets in the texts; mixing
samples documents by calibrated probabilities; segmentation encodes what is left.
No stage can be written as one SQL statement over whole tables (hashed n-gram
models, signatures, raking), so ORACLE_SQL is None and the tests hold run()
against a brute-force version.

Nulls: a null text counts as empty, fails the quality rules and goes; null languages
and sources are categories of the mix; rows with a null doc_id are judged like others
and stay only where no row of their component has an identifier. Empty texts fail the
quality rules. Repeated rows and ties: one row stays, the one written first. Very long
texts are treated whole in every stage. Stages but the last return the columns of
documents as they come, n_chars set anew where a secret is replaced. An empty table
gives an empty table in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.jaccard import jaccard_classes
from kinfold.llm.mixing import mix_sources
from kinfold.llm.quality import quality_rules
from kinfold.llm.queries import piece_model
from kinfold.llm.secrets import redact_secrets
from kinfold.llm.segment import encode_documents
from kinfold.llm.shared import new_folder, settled

#: Up to this many row numbers are sent to all executors; beyond, joins shuffle.
BROADCAST_IDS = 500_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row by its own verdict, which the row carries."""
    verdict = quality_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=tuple(docs.columns))
    return verdict.where("kept").select(*[F.col(f"kept_{c}").alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: that of the least doc_id (nulls last), of repeated
    rows the one written first."""
    # The row number holds from here on, because the rows are written.
    rows = settled(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    named = rows.withColumn("_key", F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.col("_row").alias("row")))
    classes = jaccard_classes(named, n=5, num=80, den=100, id_col="_key")
    copies = settled(classes.where("component_id.row <> doc_id.row").select(F.col("doc_id.row").alias("_row")), "copies")
    few = copies.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(copies) if few else copies, "_row", "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs).where("_selected").select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = encode_documents(docs, piece_model(), n_best=3)
    return encoded.select("doc_id", "n_bytes", F.size("ids").cast("long").alias("n_pieces"), "ids", "other_ids", "scores", "round_trip")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("encoding", encoding)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        place = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
