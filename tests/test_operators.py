"""Operators against hand-worked cases and brute force."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kinfold.operators import analytics, blocking, evaluate, features, models, resolve, truth, validate
from kinfold.operators.records import combined, head, normalised, with_order
from kinfold.operators.vectors import SPACES, posting_table, vectors
from kinfold.plans import catalog, run

REC = "entity_id string, business_name string, business_address string, country string, _row long"


@pytest.fixture(scope="module")
def small(spark):
    left = [("a1", "Blue River Foods Ltd", "12 Oak St", "US", 0), ("a2", "Café Noir SARL", "5 Rue du Bac", "France", 1), ("a3", "", "", "US", 2)]
    right = [("b1", "blue river food", "12 Oak Street", "usa", 0), ("b2", "Cafe Noir", "5 rue du bac", "france", 1), ("b3", "Green Hill", "9 Elm Rd", "US", 2)]
    l, r = normalised(spark.createDataFrame(left, REC)), normalised(spark.createDataFrame(right, REC).withColumn("source", F.lit("S2")))
    return l.cache(), r.cache()


def _grams(text, kind):
    if kind == "word":
        return text.split()
    if kind == "char":
        return [text[i : i + n] for n in (3, 4) for i in range(len(text) - n + 1)]
    return [w[i : i + n] for t in text.split() for w in [f" {t} "] for n in (2, 3, 4) for i in range(len(w) - n + 1)]


def _cosines(left, right, space):
    column, kind = SPACES[space]
    rows = {r["entity_id"]: Counter(_grams(r[column], kind)) for r in left.collect() + right.collect()}
    n, df = len(rows), Counter(t for c in rows.values() for t in c)
    vec = {k: {t: (1 + math.log(c)) * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in v.items()} for k, v in rows.items()}
    vec = {k: {t: w / math.sqrt(sum(x * x for x in v.values())) for t, w in v.items()} for k, v in vec.items()}
    return lambda a, b: sum(w * vec[b].get(t, 0) for t, w in vec[a].items())


@pytest.mark.parametrize("space", list(SPACES))
def test_vectors_are_unit_and_agree(small, space):
    left, right = small
    both = blocking.all_records(left, right)
    for r in vectors(both, [space]).collect():
        assert sum(w * w for w in r["weights"]) == pytest.approx(1)
        assert list(r["terms"]) == sorted(r["terms"])
    dot = _cosines(left, right, space)
    for r in blocking.cosine_scores(left, right, space, posting_table(both, [space])).collect():
        assert r["raw"] == pytest.approx(dot(r["s1_id"], r["r_id"]), abs=1e-12)


def test_kernel_is_the_join(spark, data):
    left, right = catalog.both(spark, data)
    signals = blocking.signal_pairs(left, right, vectors(blocking.all_records(left, right), list(blocking.SEARCHED))).cache()
    for s in ("name_word", "combined"):
        got = {(r["s1_id"], r["r_id"], round(r["score"], 7)) for r in signals.where(F.col("signal") == s).collect()}
        want = {(r["s1_id"], r["r_id"], round(r["score"], 7)) for r in blocking.topk_by_join(left, right, s).collect()}
        assert got == want


def test_blocks_do_not_change_results(spark, data, monkeypatch):
    left, right = catalog.both(spark, data)
    one = {tuple(r) for r in blocking.candidates(left, right).collect()}
    monkeypatch.setattr(blocking, "LEFT_BLOCK", 10)
    monkeypatch.setattr(blocking, "RIGHT_BLOCK", 25)
    assert {tuple(r) for r in blocking.candidates(left, right).collect()} == one


def test_features_of_small_pairs(spark, small):
    left, right = small
    vec = vectors(blocking.all_records(left, right))
    pairs = spark.createDataFrame([("a1", "b1", True), ("a3", "b3", True), ("a1", "b3", False)], "s1_id string, r_id string, natural boolean")
    rows = features.list_features(features.pair_features(pairs, features.record_features(left, vec), features.record_features(right, vec)))
    got = {(r["s1_id"], r["r_id"]): r.asDict() for r in rows.collect()}
    x = got["a1", "b1"]
    assert (x["name_shared_tokens"], x["name_word_jaccard"], x["name_prefix_ratio"], x["name_first_token_equal"]) == (2.0, 0.4, 1.0, 1.0)
    assert (x["addr_exact"], x["addr_numeric_shared"], x["same_country"], x["cand_rank"], x["cand_count"]) == (1.0, 1.0, 1.0, 1.0, 1.0)
    y = got["a3", "b3"]
    assert (y["name_overlap_ratio"], y["addr_missing"], y["combined_score"], y["name_prefix_ratio"]) == (0.0, 1.0, 0.0, 0.0)
    z = got["a1", "b3"]  # injected: ranked against the natural list
    assert (z["cand_rank"], z["cand_count"]) == (2.0, 1.0) and z["cand_gap_to_best"] > 0


def test_candidate_ranks(spark):
    rows = [("s", "a", True, 0.9), ("s", "b", True, 0.9), ("s", "c", True, 0.5), ("t", "a", True, 0.9), ("t", "b", True, 0.5), ("t", "x", False, 0.7), ("t", "y", False, 0.95), ("u", "z", False, 0.4)]
    df = spark.createDataFrame(rows, "s1_id string, r_id string, natural boolean, combined_score double")
    for c in features.FEATURES:
        if c not in df.columns and c not in features.LIST:
            df = df.withColumn(c, F.lit(0.0))
    got = {(r["s1_id"], r["r_id"]): (r["cand_rank"], round(r["cand_gap_to_best"], 6), r["cand_count"]) for r in features.list_features(df).collect()}
    assert [got["s", x][0] for x in "abc"] == [1, 1, 3]
    assert got["t", "x"] == (2, 0.2, 2) and got["t", "y"] == (1, -0.05, 2) and got["u", "z"] == (1, 0, 0)


def test_f_beta_and_evaluate(spark):
    rows = [(1, 0.9)] * 10 + [(0, 0.9)] * 2 + [(1, 0.1)] * 1
    r = evaluate.evaluate(spark.createDataFrame(rows, "label int, probability double"), 0.5, 13).first()
    assert (r["tp"], r["fp"], r["fn"]) == (10, 2, 3)
    assert (round(r["precision"], 4), round(r["recall"], 4), round(r["f0_5"], 4)) == (0.8333, 0.7692, 0.8197)


@pytest.mark.parametrize(("scores", "want"), [([0.1, 0.2, 0.3], 0.2), ([0.1, 0.2], 0.2)])
def test_plateau_takes_the_later_middle(spark, scores, want):
    df = spark.createDataFrame([(t, 0.8) for t in scores] + [(0.9, 0.1)], "threshold double, f0_5 double")
    assert evaluate.best_threshold(df).first()["threshold"] == want


def test_sweep_is_91_evaluations(spark):
    df = spark.createDataFrame([(k % 3 == 0, k / 40) for k in range(40)], "l boolean, probability double").select(F.col("l").cast("int").alias("label"), "probability")
    rows = {r["threshold"]: r for r in evaluate.sweep(df, 20).collect()}
    assert len(rows) == 91
    for t in (0.05, 0.5, 0.95):
        one = evaluate.evaluate(df, t, 20).first()
        assert (rows[t]["tp"], rows[t]["fp"], rows[t]["f0_5"]) == (one["tp"], one["fp"], one["f0_5"])


def test_lists_keep_the_best_place(spark):
    left = spark.createDataFrame([("a", 0), ("b", 1)], "entity_id string, _row long")
    scored = spark.createDataFrame([("a", "x", 0.4), ("a", "x", 0.9), ("a", "y", 0.5)], "s1_id string, r_id string, probability double")
    got = {r["entity_id"]: (r["candidates"], r["matches"]) for r in resolve.decided(left, scored, 0.5).collect()}
    assert got == {"a": (["x", "y"], ["x", "y"]), "b": ([], [])}


def test_truth_pool(spark):
    t = spark.createDataFrame([("a", " x, y,,q"), ("zz", "x")], "source1_entity_id string, matched_entity_ids string")
    left, right = spark.createDataFrame([("a",), ("b",)], "entity_id string"), spark.createDataFrame([("x",), ("y",), ("x",)], "entity_id string")
    true = truth.true_pairs(t, left, right)
    assert {tuple(r) for r in true.collect()} == {("a", "x"), ("a", "y")}
    assert truth.out_of_scope(t, left, right).first()[0] == 1
    pool = truth.training_pool(true, spark.createDataFrame([("a", "x"), ("b", "x")], "s1_id string, r_id string"))
    assert {tuple(r) for r in pool.collect()} == {("a", "x", True, 1), ("b", "x", True, 0), ("a", "y", False, 1)}


def _tables(spark, match, cand):
    m = spark.createDataFrame([(a, b, k) for k, (a, b) in enumerate(match)], "source1_entity_id string, matched_entity_ids string, _row long")
    c = spark.createDataFrame([(a, b, k) for k, (a, b) in enumerate(cand)], "source1_entity_id string, candidate_entity_ids string, _row long")
    left = spark.createDataFrame([("a", 0), ("b", 1)], "entity_id string, _row long")
    right = spark.createDataFrame([("x",), ("y",)], "entity_id string")
    return m, c, left, right


GOOD = [("a", "x"), ("b", "")], [("a", "x,y"), ("b", "")]


@pytest.mark.parametrize(
    ("match", "cand", "says"),
    [
        (*GOOD, None),
        ([("a", "x"), ("a", "")], GOOD[1], "repeated source 1"),
        ([("a", "x,x"), ("b", "")], GOOD[1], "twice"),
        ([("a", "x"), ("b", "y")], GOOD[1], "not candidates"),
        (GOOD[0], [("a", "x,w"), ("b", "")], "unknown"),
        (GOOD[0], [("a", "x,y"), ("c", "")], "one table only"),
        ([("b", ""), ("a", "x")], GOOD[1], "order"),
        (GOOD[0][:1], GOOD[1], "rows, expected"),
    ],
)
def test_planted_faults(spark, match, cand, says):
    got = validate.validate(*_tables(spark, match, cand), None)
    assert got["ok"] == (says is None)
    assert says is None or any(says in e for e in got["errors"])


def test_without_test_records(spark):
    m, c, _, _ = _tables(spark, *GOOD)
    got = validate.validate(m, c, None, None, 2)
    assert got["ok"] and got["warnings"]


def test_pages(spark):
    none = spark.createDataFrame([], "entity_id string, _row long, candidates array<string>, matches array<string>")
    _, info = analytics.matches_page(none, "all", "", 0, 500)
    assert info == {"total": 0, "page": 1, "page_size": 200, "pages": 1}
    with pytest.raises(analytics.RequestError):
        analytics.matches_page(none, "other")
    with pytest.raises(analytics.RequestError):
        analytics.search(none, "d")


def test_order_and_limit(spark):
    df = spark.range(100).repartition(5)
    got = with_order(df.drop("_row"))
    assert sorted(r["_row"] for r in got.collect()) == list(range(100))
    assert head(got, 7).count() == 7 and head(got, 0).count() == 100


def test_train_predict_check(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    raw = catalog.records.record_view(docs)
    third = lambda k: raw.where(F.pmod(F.col("_row"), F.lit(3)) == k)
    at = lambda n: str(tmp_path / n)
    kinds = {"LogisticRegression": models.classifiers(100)["LogisticRegression"]}
    doc = run.train(spark, third(0), third(1), third(2), catalog.truth_table(spark, data), at("model"), at("m.json"), kinds=kinds)
    assert doc["model"] == "LogisticRegression" and doc["training"]["feature_count"] == 32
    out = run.predict(spark, third(0), third(1), third(2), at("model"), at("match"), at("cand"), at("m.json"))
    assert out["prediction"]["total_entities"] == third(0).count() and out["model"] == "LogisticRegression"
    left, right = third(0), combined(third(1), third(2))
    left = with_order(left.orderBy("entity_id").drop("_row"))
    assert run.check(spark, at("match"), at("cand"), None, right, third(0).count())["ok"]
    assert [f for f, _ in models.importances(models.load(at("model"))[0])]
