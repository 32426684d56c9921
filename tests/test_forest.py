"""The packed random forest against MLlib's."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler

from kinfold.operators import forest, models
from kinfold.operators.features import FEATURES


@pytest.fixture(scope="module")
def pool(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.random((1500, len(FEATURES))), 2)
    x[:, 7] = x[:, 3] > 0.5
    x[500:] = x[:1000] * (rng.random((1000, 1)) < 0.5) + x[500:] * 0.5  # copies and others
    label = ((x[:, 3] + 0.7 * x[:, 12] + 0.3 * rng.random(1500)) > 1.1).astype(int)
    table = pa.table({"s1_id": [f"a{k % 97}" for k in range(1500)], "r_id": [f"b{k}" for k in range(1500)], "label": label} | {c: x[:, k] for k, c in enumerate(FEATURES)})
    return models.with_class_weights(spark.createDataFrame(table)).cache()


def _kind(depth, trees=80):
    return models.classifiers(1500, trees=trees, depth=depth)["RandomForest"]


def test_same_law_as_mllib(pool):
    own, theirs = models.fit(_kind(6), pool), Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), _kind(6)]).fit(pool)
    a, b = dict(models.importances(own)), dict(models.importances(theirs))
    assert sum(a.values()) == pytest.approx(1, abs=1e-4) and max(abs(a[f] - b[f]) for f in FEATURES) < 0.06
    p, q = (np.array([r["probability"] for r in models.score(m, pool).orderBy("r_id").select("probability").collect()]) for m in (own, theirs))
    assert np.corrcoef(p, q)[0, 1] > 0.98 and abs(p - q).mean() < 0.04
    m, n = own.stages[-1], theirs.stages[-1]
    assert len(m.trees) == 80 and max(t.depth for t in m.trees) <= 6 and 0.8 < m.totalNumNodes / n.totalNumNodes < 1.25


def test_rows_are_read_once_whatever_the_depth(spark, pool):
    jobs = []
    for depth in (2, 9):
        spark.sparkContext.setJobGroup(f"depth {depth}", "")
        model = models.fit(_kind(depth, 20), pool)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"depth {depth}")))
    spark.sparkContext.setJobGroup("", "")
    assert max(t.depth for t in model.stages[-1].trees) > 4 and jobs[0] == jobs[1]


def test_splits_and_tree_by_hand():
    # All midpoints where they fit; else as much weight apart.
    assert forest.splits_of(np.array([1.0, 0.0, 1.0, 3.0]), np.ones(4), 32).tolist() == [0.5, 2.0]
    assert forest.splits_of(np.arange(8.0), np.ones(8), 4).tolist() == [1.5, 3.5, 5.5]
    # Of feature 0's bins 0, 1, 2 only the last is true; feature 1 says nothing.
    x, y = np.array([[0, 1, 2], [0, 0, 0]], np.uint8), np.array([0, 0, 1], np.uint8)
    tree = forest._Tree(x, y, [3, 1], np.array([1.0, 2.0]), np.random.default_rng(1), 5, 3, 2)
    root = tree.grow(np.arange(3), np.array([4.0, 4.0, 4.0]))
    assert root[5:7] == (0, 1) and root[4] == pytest.approx(0.5) and root[3] == 12
    assert [r["nodeData"]["split"] for r in forest.node_rows(0, root, [np.array([0.5, 1.5]), np.empty(0)])][0] == {"featureIndex": 0, "leftCategoriesOrThreshold": [1.5], "numCategories": -1}
    tree.least = 5  # no side may have fewer rows than that
    assert tree.grow(np.arange(3), np.array([4.0, 4.0, 4.0]))[7] is None


def test_same_model_whatever_the_partitions(pool):
    one, other = (models.importances(models.fit(_kind(5, 12), df)) for df in (pool.coalesce(1), pool.repartition(7)))
    assert one == other


def test_what_stays_with_mllib(pool, monkeypatch):
    assert forest.fitted(_kind(3, 4).setImpurity("entropy"), pool, FEATURES) is None
    assert forest.fitted(_kind(3, 4), pool.where("label = 1"), FEATURES) is None
    monkeypatch.setattr(forest, "HELD_ROWS", 10)
    assert forest.fitted(_kind(3, 4), pool, FEATURES) is None
    assert isinstance(_kind(3, 4), RandomForestClassifier) and models.importances(models.fit(_kind(3, 4), pool))
