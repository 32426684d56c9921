"""Summaries, searches and distributions over the output lists.

`lists` has entity_id, _row, candidates and matches (arrays). Functions return
DataFrames; bad arguments raise RequestError (400), unusable files DataError (503).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions import fixed as X


class RequestError(ValueError):
    status = 400


class DataError(RuntimeError):
    status = 503


class UnsupportedError(DataError):
    """What is asked for doesn't exist for this kind of model."""

    status = 422


def answered(make) -> tuple[dict, int]:
    """(document, status) of a request: what make() returns, or the error it ends with.
    An unknown name (KeyError) is 404, an error of no kind of ours 500."""
    try:
        return make(), 200
    except (RequestError, DataError) as e:
        return {"error": str(e)}, e.status
    except KeyError as e:
        return {"error": f"unknown: {e.args[0] if e.args else ''}"}, 404
    except Exception as e:  # noqa: BLE001  whatever it is, the caller gets an answer
        return {"error": str(e)}, 500


def rows(lists: DataFrame) -> DataFrame:
    n = F.size("matches")
    return lists.select("_row", F.col("entity_id").alias("source1_entity_id"), "matches", n.cast("long").alias("match_count"), F.size("candidates").cast("long").alias("candidate_count"), F.when(n > 0, F.lit("Matched")).otherwise(F.lit("Unmatched")).alias("status"))


def overview(lists: DataFrame) -> DataFrame:
    """One row of totals."""
    got = rows(lists).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("match_count") > 0).alias("matched"),
        F.count_if(F.col("match_count") == 0).alias("unmatched"),
        F.coalesce(F.sum("candidate_count"), F.lit(0)).alias("candidate_pairs"),
        F.coalesce(F.sum("match_count"), F.lit(0)).alias("final_matches"),
    )
    average = lambda a: F.when(F.col("total") > 0, F.round(F.col(a) / F.col("total"), 2)).otherwise(F.lit(0.0))
    rate = lambda a, b: F.when(F.col(b) > 0, F.round(F.lit(100.0) * F.col(a) / F.col(b), 2)).otherwise(F.lit(0.0))
    return got.withColumns({"avg_candidates": average("candidate_pairs"), "match_rate": rate("matched", "total"), "pair_match_rate": rate("final_matches", "candidate_pairs")})


def match_histogram(lists: DataFrame) -> DataFrame:
    """Records with 0, 1, 2, 3, 4 and 5 or more matches, zeros included."""
    have = lists.groupBy(F.least(F.size("matches"), F.lit(5)).cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return lists.sparkSession.range(6).withColumnRenamed("id", "bucket").join(have, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def _filtered(lists: DataFrame, status: str, query: str) -> DataFrame:
    if status not in ("all", "matched", "unmatched"):
        raise RequestError("status is all, matched or unmatched")
    got = rows(lists)
    if status != "all":
        got = got.where(F.lower("status") == status)
    q = query.strip().lower()
    if q:
        has = lambda c: F.contains(F.lower(c), F.lit(q))
        got = got.where(has(F.col("source1_entity_id")) | F.exists("matches", has))
    return got


def matches_page(lists: DataFrame, status: str = "all", query: str = "", page: int | str = 1, page_size: int | str = 25) -> tuple[DataFrame, dict]:
    """A page in file order, and its figures. Pages start at 1; sizes are held to
    1 to 200; there is at least one page."""
    try:
        page, page_size = max(1, int(page)), min(200, max(1, int(page_size)))
    except ValueError as e:
        raise RequestError("page and page_size are integers") from e
    got = _filtered(lists, status, query)
    total = got.count()
    return got.orderBy("_row").offset((page - 1) * page_size).limit(page_size), {"total": total, "page": page, "page_size": page_size, "pages": max(1, math.ceil(total / page_size))}


def search(lists: DataFrame, query: str) -> tuple[DataFrame, int]:
    """The first 100 rows that hold the query, and how many do."""
    if len(query.strip()) < 2:
        raise RequestError("a query has two characters or more")
    got = _filtered(lists, "all", query)
    return got.orderBy("_row").limit(100), got.count()


def candidate_overview(lists: DataFrame) -> DataFrame:
    n, m = F.size("candidates").cast("long"), F.size("matches").cast("long")
    got = lists.agg(F.count(F.lit(1)).alias("entities"), F.coalesce(F.sum(n), F.lit(0)).alias("candidate_pairs"), F.coalesce(F.sum(m), F.lit(0)).alias("accepted"), F.coalesce(F.round(F.avg(n), 2), F.lit(0.0)).alias("avg_candidates"), F.coalesce(F.max(n), F.lit(0)).alias("max_candidates"), F.coalesce(F.min(n), F.lit(0)).alias("min_candidates"))
    return got.withColumn("rejected", F.col("candidate_pairs") - F.col("accepted"))


#: fixed values: upper ends of the candidate count buckets
BUCKETS = [("0", 0), ("1-10", 10), ("11-25", 25), ("26-50", 50)]


def bucket(n: Column) -> Column:
    out = F.lit("51+")
    for name, top in reversed(BUCKETS):
        out = F.when(n <= top, F.lit(name)).otherwise(out)
    return out


def candidate_buckets(lists: DataFrame) -> DataFrame:
    have = lists.groupBy(bucket(F.size("candidates")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    names = F.explode(F.array(*[F.lit(x) for x in [b for b, _ in BUCKETS] + ["51+"]]))
    return lists.sparkSession.range(1).select(names.alias("bucket")).join(have, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def top_entities(lists: DataFrame, k: int = 10) -> DataFrame:
    """The k records with most candidates; equal counts stay in file order."""
    return lists.select("_row", F.col("entity_id").alias("source1_entity_id"), F.size("candidates").cast("long").alias("candidate_count"), F.size("matches").cast("long").alias("match_count")).orderBy(F.desc("candidate_count"), "_row").limit(k)


def model_metrics(document: dict) -> dict:
    """The metrics without the run's own part, with the earlier baseline."""
    out = {k: v for k, v in document.items() if k != "prediction"} | {"baseline": X.BASELINE}
    if "threshold" in document:
        out["threshold_confidence"] = 1 - abs(float(document["threshold"]) - 0.5) * 2
    return out
