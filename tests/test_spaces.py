"""Array kernels of the term spaces, and what is built on them."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinfold.functions.spaces import Known, Terms
from kinfold.operators import blocking, features, packed
from kinfold.operators import vectors as V
from kinfold.plans import catalog
from tests.test_operators import _grams

TEXTS = ["blue river", "", "a", "the the a", "x𝒜b été é", "blue", " a  b "]


@pytest.mark.parametrize("once", [False, True])
@pytest.mark.parametrize("kind", ["word", "char", "char_wb"])
def test_terms(kind, once):
    terms = Terms(pa.array(TEXTS), kind, once)
    read = terms.read().to_pylist()
    doc, term, times = terms.counts()
    want = {(i, t): n for i, text in enumerate(TEXTS) for t, n in Counter(_grams(text, kind)).items()}
    got = {(i, read[t]): n for i, t, n in zip(doc.tolist(), term.tolist(), times.tolist(), strict=True)}
    assert got == want if not once else set(got) == set(want)
    for none in ([], ["", ""]):
        assert not len(Terms(pa.array(none, pa.string()), kind, once).counts()[0])


def test_frequencies_are_counted_within_tasks(spark, data, monkeypatch):
    """Before, every term of every text was a row of its own in a shuffle."""
    records = catalog.records.normalised(catalog.whole(spark, data))
    monkeypatch.setattr(V, "HELD", 300)
    got = V.frequencies(records, list(V.SPACES))
    plan = got._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Generate explode" not in plan
    want = V.document_frequency(V.term_counts(records, list(V.SPACES)))
    assert not got.exceptAll(want).count() and not want.exceptAll(got).count()
    assert not V.frequencies(records.limit(0), ["name_word"]).count()
    many = V.frequencies(records.withColumn("name_core", F.repeat(F.lit("ab cd "), 50_000)).limit(3), ["name_word", "name_squash"])
    assert {r["df"] for r in many.collect()} == {3}


def test_blocks_travel_as_texts(spark, data):
    """Before, copies of vectors were shuffled for every block of the other side, and
    joined to every pair."""
    left, right = catalog.both(spark, data)
    for got in (blocking.signal_pairs(left, right), catalog.feature_rows(spark, data)):
        plan = got._jdf.queryExecution().toString()
        assert "weights" not in plan and "name_char_w" not in plan


def test_pieces_do_not_change_a_block(spark, data, monkeypatch):
    left, right = catalog.both(spark, data)
    freq = V.known(blocking.all_records(left, right), list(blocking.SEARCHED))
    table = lambda df: df.selectExpr("entity_id AS id", "name_core", "business_address_clean").toArrow()
    a, b = table(left), table(right)
    want = blocking.search_block(a, b, freq, blocking.SIGNALS).to_pylist()
    assert {r["signal"] for r in want} == set(blocking.SIGNALS)
    for name, x in (("PIECE", 17), ("ROWS", 3), ("DENSE", 0.4), ("CELLS", 20)):
        monkeypatch.setattr(blocking, name, x)
    got = blocking.search_block(a, b, freq, blocking.SIGNALS).to_pylist()
    near = lambda rows: {(r["s1_id"], r["r_id"], r["signal"]): round(r["score"], 8) for r in rows}
    assert near(got) == near(want) and len(got) == len(want)


def test_more_terms_than_may_be_sent(spark, data, monkeypatch):
    left, right = catalog.both(spark, data)
    want = {tuple(r) for r in blocking.candidates(left, right).collect()}
    monkeypatch.setattr(V, "KNOWN_TERMS", 5)
    assert V.known(blocking.all_records(left, right), ["name_word"]) is None
    assert {tuple(r) for r in blocking.candidates(left, right).collect()} == want


def test_cosines_of_texts_are_those_of_vectors(spark, data):
    left, right = catalog.both(spark, data)
    both = blocking.all_records(left, right)
    vec, freq = V.vectors(both), V.known(both, list(V.SPACES))
    pairs = blocking.candidates(left, right).withColumn("natural", F.lit(True))
    a = features.pair_features(pairs, features.record_features(left, vec), features.record_features(right, vec))
    b = features.pair_features(pairs, features.record_features(left), features.record_features(right), freq)
    six = lambda df: {(r["s1_id"], r["r_id"]): [round(r[c], 7) for c in features.COSINES] for r in df.collect()}
    assert six(a) == six(b)


def test_blocks_are_scored_in_single_precision_and_the_best_again(spark, data):
    """Before, all pairs were scored in double precision, at twice the time."""
    left, right = catalog.both(spark, data)
    freq = V.known(blocking.all_records(left, right), ["name_char"])
    names = right.select("name_core").toArrow()["name_core"].combine_chunks()
    own = blocking.Rows(names, "name_char", freq["name_char"])
    codes = own.codes(len(freq["name_char"].keys))
    own = own.recoded(codes)
    piece = blocking._Piece(own, len(names), int(codes.max()) + 1)
    grid = piece.scores(own, 0, len(names))
    row, doc = (x.ravel() for x in np.indices(grid.shape))
    exact = piece.exact(own, row, doc).reshape(grid.shape)
    assert grid.dtype == np.float32 and abs(grid - exact).max() < blocking.ERROR / 2
    dense = np.zeros((len(names), piece.wide))
    dense[own.doc, own.term] = own.weight
    assert abs(exact - dense @ dense.T).max() < 1e-12


def test_copies_are_scored_once(spark, monkeypatch):
    """Before, each of many copies of a name was scored for each of many others."""
    texts = pa.array(["ab cd", "ab ce", "xy zz"])
    freq = Known(np.unique(Terms(texts, "char_wb").keys), np.full(len(np.unique(Terms(texts, "char_wb").keys)), 2), 3)
    own = blocking.Rows(pa.array(["ab cd", "ab ce"] * 40), "name_char", freq)
    piece = blocking._Piece(own, 80, len(freq.keys))
    seen, inner = [], piece._exact
    monkeypatch.setattr(piece, "_exact", lambda left, row, doc: seen.append(len(row)) or inner(left, row, doc))
    row, doc = (x.ravel() for x in np.indices((80, 80)))
    got = piece.exact(own, row, doc)
    assert seen == [4] and np.allclose(got[(row + doc) % 2 == 0], 1) and (got[(row + doc) % 2 == 1] < 0.99).all()


def test_pairs_travel_with_texts(spark, data):
    """Before, sets and tokens travelled with every pair."""
    for side in catalog.both(spark, data):
        assert {kind for _, kind in features.record_features(side).dtypes} == {"string"}


def test_a_block_is_searched_in_parts(spark, data, monkeypatch):
    """Before, a left block was as small as the vectors a task can hold, and a right text
    was copied once for each of those."""
    left, right = catalog.both(spark, data)
    freq = V.known(blocking.all_records(left, right), list(blocking.SEARCHED))
    table = lambda df: df.selectExpr("entity_id AS id", "name_core", "business_address_clean").toArrow()
    a, b, held, make = table(left), table(right), [], blocking.Rows
    want = blocking.search_block(a, b, freq, blocking.SIGNALS).to_pylist()
    monkeypatch.setattr(blocking, "SOME_LEFT", 7)
    monkeypatch.setattr(blocking, "PIECE", 5)
    monkeypatch.setattr(blocking, "Rows", lambda texts, *x: held.append(len(texts)) or make(texts, *x))
    got = blocking.search_block(a, b, freq, blocking.SIGNALS).to_pylist()
    near = lambda rows: {(r["s1_id"], r["r_id"], r["signal"]): round(r["score"], 8) for r in rows}
    assert near(got) == near(want) and len(got) == len(want) and max(held) <= 7
    assert blocking.LEFT_BLOCK > 8000
    assert blocking.search_block(a.slice(0, 0), b, freq, blocking.SIGNALS).num_rows == 0
    assert blocking.search_block(a, b.slice(0, 0), freq, blocking.SIGNALS).num_rows == 0


def test_no_block_is_copied_on_disk(spark, data, monkeypatch):
    """Before, a right text was shuffled once for each left block of its country, and
    lists that need no merging once more."""
    left, right = catalog.both(spark, data)
    near = lambda df: {(r["s1_id"], r["r_id"], r["signal"]): round(r["score"], 8) for r in df.collect()}
    one = blocking.signal_pairs(left, right)
    plan = one._jdf.queryExecution().toString()
    assert "CartesianProduct" in plan and "explode" not in plan and "row_number" not in plan
    want = near(one)
    for name, x in (("LEFT_BLOCK", 9), ("RIGHT_BLOCK", 10), ("SMALL", 4), ("RIGHT_PARTS", 3), ("RIGHT_BLOCKS", 2)):
        monkeypatch.setattr(blocking, name, x)
    many = blocking.signal_pairs(left, right)
    assert "row_number" in many._jdf.queryExecution().toString()
    got = many.select("s1_id", "r_id", "signal", "score")
    assert near(got) == want and got.count() == len(want) == one.count()
    alone = blocking.signal_pairs(left.limit(0), right)
    assert not alone.count() and not blocking.signal_pairs(left, right.limit(0)).count()


def test_pairs_meet_texts_by_blocks(spark, data, monkeypatch):
    """Before, the left record's texts were shuffled with every pair."""
    left, right = catalog.both(spark, data)
    pairs = spark.createDataFrame([("D0", "D1", True), ("D0", "D2", False), ("D3", "D1", True), ("D3", "none", True)], "s1_id string, r_id string, natural boolean")
    a = left.selectExpr("entity_id AS a_entity_id", "name_core AS a_name_core", "_row AS a_row")
    b = right.selectExpr("entity_id AS b_entity_id", "name_core AS b_name_core")
    b = b.unionByName(b.where("b_entity_id = 'D1'"))  # a repeated record is met each time
    want = pairs.join(a, F.col("s1_id") == F.col("a_entity_id")).join(b, F.col("r_id") == F.col("b_entity_id"))
    for name, x in (("LEFT_BLOCK", 10), ("RIGHT_BLOCK", 20), ("ROWS", 2)):
        monkeypatch.setattr(packed, name, x)
    got = packed.joined(pairs, a, b)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 5
    assert not packed.joined(pairs.limit(0), a, b).count() and not packed.joined(pairs, a, b.limit(0)).count()
    freq = V.known(blocking.all_records(left, right), list(V.SPACES))
    plan = features.features_of(pairs, left, right, freq)._jdf.queryExecution().toString()
    assert "CartesianProduct" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
