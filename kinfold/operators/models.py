"""Classifiers over the pair features, with MLlib."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions import fixed as X
from kinfold.operators import forest
from kinfold.operators.analytics import DataError, UnsupportedError
from kinfold.operators.evaluate import best_threshold, sweep
from kinfold.operators.features import FEATURES


def with_class_weights(pool: DataFrame) -> DataFrame:
    """Adds weight: n / (2 n_class), so both classes weigh the same."""
    n, pos = pool.agg(F.count(F.lit(1)), F.sum("label")).first()
    pos = pos or 0
    w1, w0 = n / (2 * pos) if pos else 1.0, n / (2 * (n - pos)) if n > pos else 1.0
    return pool.withColumn("weight", F.when(F.col("label") == 1, F.lit(w1)).otherwise(F.lit(w0)))


def classifiers(n_rows: int, trees: int = 200, depth: int = 16, rounds: int = 300) -> dict:
    """The three compared kinds. Boosting here grows trees by depth (5, about the 31
    leaves of a leaf-wise tree), has no L2 term, and stops early when a round no longer
    helps on a tenth of the pairs; the logistic penalty is 1 / (2 n)."""
    common = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    return {
        "RandomForest": RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=3, featureSubsetStrategy="sqrt", seed=X.SEED, **common),
        "HistGradientBoosting": GBTClassifier(maxIter=rounds, stepSize=0.08, maxDepth=5, validationIndicatorCol="stopping", validationTol=1e-4, seed=X.SEED, **common),
        "LogisticRegression": LogisticRegression(standardization=True, regParam=1 / (2.0 * max(1, n_rows)), elasticNetParam=0.0, maxIter=1000, **common),
    }


def fit(classifier, pool: DataFrame) -> PipelineModel:
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    # Which pairs only measure a boosting round; other kinds learn from all.
    stopping = F.pmod(F.xxhash64("s1_id", "r_id", F.lit(X.SEED)), F.lit(10)) == 0
    pool = pool.withColumn("label", F.col("label").cast("double"))
    model = forest.fitted(classifier, pool, FEATURES) if isinstance(classifier, RandomForestClassifier) else None
    if model:
        return PipelineModel(stages=[assembler, model])
    return Pipeline(stages=[assembler, classifier]).fit(pool.withColumn("stopping", stopping))


def score(model: PipelineModel, pairs: DataFrame) -> DataFrame:
    """pairs and their probability of a match."""
    got = model.transform(pairs.withColumn("label", F.col("label").cast("double")) if "label" in pairs.columns else pairs)
    return got.withColumn("probability", vector_to_array("probability")[1]).drop("features", "rawPrediction", "prediction")


def compare(train: DataFrame, held: DataFrame, total_true: int, kinds: dict | None = None) -> tuple[list[dict], dict[str, PipelineModel]]:
    """Fits each kind and finds its best threshold on the held-out natural pairs;
    results come in order of their kinds."""
    train = with_class_weights(train).cache()
    kinds = kinds or classifiers(train.count())
    results, fitted = [], {}
    for name, kind in kinds.items():
        fitted[name] = fit(kind, train)
        scored = score(fitted[name], held).select("label", "probability")
        results.append(best_threshold(sweep(scored, total_true)).first().asDict() | {"model": name})
    train.unpersist()
    return results, fitted


def select(results: list[dict]) -> dict:
    """The highest F0.5; the first of equals."""
    return max(results, key=lambda r: r["f0_5"])


def importances(model: PipelineModel) -> list[tuple[str, float]]:
    """Features by importance (absolute coefficients of a linear model), largest first."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray().tolist()
    elif hasattr(last, "coefficients"):
        values = [abs(x) for x in last.coefficients.toArray().tolist()]
    else:
        raise UnsupportedError("this kind of model has no importances")
    return [(f, round(v, 6)) for f, v in sorted(zip(FEATURES, values, strict=True), key=lambda x: -x[1])]


def save(model: PipelineModel, name: str, threshold: float, path: str) -> None:
    model.write().overwrite().save(f"{path}/pipeline")
    Path(path, "model.json").write_text(json.dumps({"model_name": name, "threshold": threshold, "features": FEATURES}))


def load(path: str) -> tuple[PipelineModel, dict]:
    side = Path(path, "model.json")
    if not side.exists():
        raise DataError(f"no model in {path}: train first")
    return PipelineModel.load(f"{path}/pipeline"), json.loads(side.read_text())
