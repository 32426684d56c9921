"""The contract queries of this package: thin views over its operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.jaccard import jaccard_classes
from kinfold.llm.langid import identify_languages
from kinfold.llm.media import media_columns
from kinfold.llm.mixing import mix_sources
from kinfold.llm.quality import quality_rules
from kinfold.llm.secrets import secret_report
from kinfold.llm.segment import LARGE, encode_documents
from kinfold.llm.shards import kd_shards
from kinfold.llm.substrings import remove_repeats
from kinfold.llm.tokencount import count_tokens


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), piece_model(), limit=4096)


def op2_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kd_shards(documents(spark, sf_dir), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir), n=5, num=80, den=100)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), width=200)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(documents(spark, sf_dir))
    return out.select("doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"), F.round("_prob", 6).alias("prob"), F.col("_selected").alias("selected"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(documents(spark, sf_dir))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    return identify_languages(documents(spark, sf_dir), held_out=held_out)


def op9_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_documents(documents(spark, sf_dir), piece_model(), n_best=3, memo=LARGE)
    # Joined by commas: their JSON without brackets. A lambda over the ids isn't compiled.
    crc = lambda ids: F.crc32(F.substr(F.to_json(ids).cast("binary"), F.lit(2), F.octet_length(F.to_json(ids)) - 2))
    other = lambda k: crc(F.try_element_at("other_ids", F.lit(k)))
    score = lambda k: F.round(F.try_element_at("scores", F.lit(k)), 3)
    return out.select("doc_id", "n_bytes", F.size("ids").cast("long").alias("n_pieces"), crc(F.col("ids")).alias("ids_crc32"), other(1).alias("second_ids_crc32"), other(2).alias("third_ids_crc32"), score(1).alias("best_score"), score(2).alias("second_score"), score(3).alias("third_score"), "round_trip")


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = media_columns(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.col("length").alias("media_bytes"), "media_sha256", "feature", "digest", "shard", "offset", "length")


def queries() -> dict:
    return {f.__name__: f for f in (op1_token_counts, op2_kd_shards, op3_jaccard_join, op4_substring_dedup, op5_mixing, op6_quality, op7_secrets, op8_language, op9_segmentation, op10_media)}


def oracle_sql() -> dict[str, str]:
    return {}
