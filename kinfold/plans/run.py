"""Whole runs: train, predict, validate."""

from __future__ import annotations

import datetime
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions import fixed as X
from kinfold.operators import blocking, evaluate, features, models, records, resolve, truth, validate
from kinfold.operators.analytics import DataError
from kinfold.operators.lineage import written
from kinfold.operators.vectors import SPACES, known
from kinfold.sources import files


def featured(left: DataFrame, right: DataFrame, pairs_of) -> tuple[DataFrame, DataFrame]:
    """(feature rows, natural candidates) of normalised records. Document frequencies are
    of this run's records; pairs_of turns the candidates into s1_id, r_id, natural, ..."""
    freq = known(blocking.all_records(left, right), list(SPACES))
    natural = written(blocking.candidate_pairs(blocking.signal_pairs(left, right, freq=freq)), "pairs")
    pool = pairs_of(natural).select("s1_id", "r_id", "natural")
    return features.list_features(features.features_of(pool, left, right, freq)), natural


def train(spark: SparkSession, s1: DataFrame, s2: DataFrame, s3: DataFrame, truth_table: DataFrame, model_path: str, metrics_path: str, *, limit: int | None = None, kinds: dict | None = None) -> dict:
    left, right = records.normalised(s1), records.normalised(records.combined(s2, s3))
    true = truth.true_pairs(truth_table, left, right).persist()
    n_true = true.count()
    if not n_true:
        raise SystemExit("no true pair lies inside the loaded records; cannot train")
    outside = truth.out_of_scope(truth_table, left, right).first()[0]
    rows, natural = featured(left, right, lambda n: truth.training_pool(true, n))
    labels = truth.training_pool(true, natural).select("s1_id", "r_id", "label")
    pool = evaluate.entity_split(rows.join(labels, ["s1_id", "r_id"])).persist()
    held_true = evaluate.entity_split(true).where("held").join(pool.select("s1_id").distinct(), "s1_id", "left_semi").count()
    results, fitted = models.compare(pool.where("not held"), pool.where("held and natural"), held_true, kinds)
    best = models.select(results)
    models.save(fitted[best["model"]], best["model"], best["threshold"], model_path)
    short = lambda r: {k: round(v, 4) if isinstance(v, float) else v for k, v in r.items()}
    facts = pool.agg(F.count(F.lit(1)), F.sum("label")).first()
    document = short(best) | {
        "threshold": round(best["threshold"], 2),
        "model_comparison": [short(r) for r in results],
        "training": {
            "record_limit": limit,
            "source1_records": left.count(),
            "source23_records": right.count(),
            "true_pairs_in_scope": n_true,
            "true_pairs_outside_scope": outside,
            "blocking_recall": round(truth.coverage(true, natural).first()["recall"], 4),
            "candidate_pairs": natural.count(),
            "training_pairs": facts[0],
            "positive_pairs": facts[1],
            "feature_count": len(features.FEATURES),
            "validation_split": f"grouped by source 1 entity, {int(X.VALIDATION_FRACTION * 100)}% of entities",
            "trained_at": datetime.datetime.now().isoformat(timespec="seconds"),
        },
    }
    files.write_metrics(metrics_path, document)
    return document


def predict(spark: SparkSession, s1: DataFrame, s2: DataFrame, s3: DataFrame, model_path: str, matching_path: str, candidate_path: str, metrics_path: str) -> dict:
    model, side = models.load(model_path)
    left, right = records.normalised(s1), records.normalised(records.combined(s2, s3))
    rows, _ = featured(left, right, lambda n: n.withColumn("natural", F.lit(True)))
    lists = resolve.decided(left, models.score(model, rows), side["threshold"]).persist()
    files.write_tsv(resolve.matching_table(lists), files.MATCHING, matching_path)
    files.write_tsv(resolve.candidate_table(lists), files.CANDIDATE, candidate_path)
    summary = resolve.run_summary(lists).first().asDict()
    summary["by_country"] = {r["country"]: {"total": r["total"], "matched": r["matched"]} for r in resolve.by_country(lists, left).collect()}
    return files.merge_metrics(metrics_path, summary)


def check(spark: SparkSession, matching_path: str, candidate_path: str, left: DataFrame | None, right: DataFrame | None, expected_rows: int | None = None) -> dict:
    errors: list[str] = []
    m = files.read_output(spark, matching_path, files.MATCHING, errors)
    c = files.read_output(spark, candidate_path, files.CANDIDATE, errors)
    if m is None or c is None:
        return {"ok": False, "errors": errors, "warnings": [], "counts": {}}
    return validate.validate(m, c, left, right, expected_rows)


def submit(checked: dict, metrics_path: str, template: str, folder: str, wanted: list[str], target: str) -> str:
    """The package of a run: only of outputs that check() found valid and of metrics
    that hold a prediction. Files are gathered in a stage beside the target, with the
    filled template among them, and the stage goes away whatever happens."""
    if not checked["ok"]:
        raise DataError(f"not packaged, the outputs are not valid: {checked['errors']}")
    document = files.read_metrics(metrics_path)
    if "prediction" not in document:
        raise DataError(f"{metrics_path} has no prediction: predict first")
    values = {k.upper(): v for part in (document, document.get("training", {}), document["prediction"]) for k, v in part.items() if not isinstance(v, (dict, list))}
    with tempfile.TemporaryDirectory(dir=Path(target).parent) as stage:
        for name in wanted:
            Path(stage, name).parent.mkdir(parents=True, exist_ok=True)
            shutil.copy2(Path(folder, name), Path(stage, name))
        Path(stage, "Documentation.md").write_text(files.fill_template(template, values | {"COMPARISON_ROWS": files.comparison_rows(document)}), encoding="utf-8")
        return files.package(stage, target, [*wanted, "Documentation.md"])
