import json
import zipfile

import pytest
from pyspark.sql import functions as F

from kinfold.operators import analytics
from kinfold.operators.analytics import DataError
from kinfold.plans import run
from kinfold.sources import files
from kinfold.streaming.normalise import normalise_stream


def test_tsv_keeps_strings_and_empties(spark, tmp_path):
    p = tmp_path / "a.tsv"
    p.write_text('entity_id\tbusiness_name\n1\t"say ""hi"""\nNA\t\n003\tnull\n')
    rows = [tuple(r) for r in files.read_tsv(spark, str(p)).orderBy("_row").collect()]
    assert rows == [("1", 'say "hi"', 0), ("NA", "", 1), ("003", "null", 2)]
    assert files.read_tsv(spark, str(p), 2).count() == 2
    with pytest.raises(FileNotFoundError):
        files.read_tsv(spark, str(tmp_path / "none.tsv"))


def test_strict_reader(spark, tmp_path):
    p = tmp_path / "m.tsv"
    p.write_text("source1_entity_id\tmatched_entity_ids\na\tx,y\nb\n")
    assert [tuple(r)[:2] for r in files.read_strict(spark, str(p), files.MATCHING).orderBy("_row").collect()] == [("a", "x,y"), ("b", "")]
    p.write_text("source1_entity_id\tmatched_entity_ids\na\tx\ty\n")
    with pytest.raises(DataError, match="line 2"):
        files.read_strict(spark, str(p), files.MATCHING)
    p.write_text("wrong\n")
    with pytest.raises(DataError, match="header"):
        files.read_strict(spark, str(p), files.MATCHING)


def test_output_reader_collects_errors(spark, tmp_path):
    errors = []
    assert files.read_output(spark, str(tmp_path / "none"), files.MATCHING, errors) is None and len(errors) == 1


def test_write_and_read_back(spark, tmp_path):
    t = spark.createDataFrame([("b", "", 1), ("a", "x,y", 0)], "source1_entity_id string, matched_entity_ids string, _row long")
    files.write_tsv(t, files.MATCHING, str(tmp_path / "out"))
    back = files.read_tsv(spark, str(tmp_path / "out")).orderBy("_row")
    assert [tuple(r)[:2] for r in back.collect()] == [("a", "x,y"), ("b", "")]


def test_metrics_documents(tmp_path):
    p = str(tmp_path / "m.json")
    with pytest.raises(DataError):
        files.read_metrics(p)
    files.write_metrics(p, {"f0_5": 0.5})
    assert files.merge_metrics(p, {"n": 1}) == {"f0_5": 0.5, "prediction": {"n": 1}} == files.read_metrics(p)
    (tmp_path / "m.json").write_text("{")
    assert files.merge_metrics(p, {"n": 2}) == {"prediction": {"n": 2}}


def test_package_and_template(tmp_path):
    (tmp_path / "a.txt").write_text("x")
    assert files.fill_template("{{A}} {{B}}", {"A": 1}) == "1 {{B}}"
    files.package(str(tmp_path), str(tmp_path / "z.zip"), ["a.txt"])
    with pytest.raises(FileNotFoundError):
        files.package(str(tmp_path), str(tmp_path / "z.zip"), ["b.txt"])
    got = files.system_status({"a": str(tmp_path / "a.txt")}, str(tmp_path / "model"))
    assert not got["all_ok"] and json.dumps(got)


def test_only_valid_runs_are_packaged(tmp_path):
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "a.txt").write_text("x")
    metrics, target = str(tmp_path / "m.json"), str(tmp_path / "z.zip")
    pack = lambda ok: run.submit({"ok": ok, "errors": ["row 3"]}, metrics, "{{MODEL}} {{TOTAL}}\n{{COMPARISON_ROWS}}", str(tmp_path / "out"), ["a.txt"], target)
    files.write_metrics(metrics, {"model": "RF", "model_comparison": [{"model": "RF", "threshold": 0.5, "precision": 1.0, "recall": 0.25, "f0_5": 0.625}]})
    with pytest.raises(DataError, match="row 3"):
        pack(False)
    with pytest.raises(DataError, match="predict first"):
        pack(True)
    files.merge_metrics(metrics, {"total": 7})
    with zipfile.ZipFile(pack(True)) as z:
        assert sorted(z.namelist()) == ["Documentation.md", "a.txt"]
        assert z.read("Documentation.md").decode() == "RF 7\n| RF | 0.5000 | 1.0000 | 0.2500 | 0.6250 |"
    assert sorted(x.name for x in tmp_path.iterdir()) == ["m.json", "out", "z.zip"]


def test_answers_and_their_status(tmp_path):
    def fail(e):
        raise e

    assert analytics.answered(lambda: {"a": 1}) == ({"a": 1}, 200)
    kinds = ((analytics.RequestError("x"), 400), (KeyError("n"), 404), (analytics.UnsupportedError("x"), 422), (ValueError("x"), 500), (DataError("x"), 503))
    assert all(analytics.answered(lambda e=e: fail(e))[1] == status for e, status in kinds)
    got = analytics.model_metrics({"threshold": 0.75, "prediction": {}, "f0_5": 0.9})
    assert got["threshold_confidence"] == 0.5 and "prediction" not in got and "baseline" in got and got["f0_5"] == 0.9
    (tmp_path / "a").write_text("")
    assert files.health({"a": str(tmp_path / "a"), "b": str(tmp_path / "b")}) == {"a": True, "b": False, "all_ok": False}


def test_stream_is_the_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n1\tCafé Ltd\t1 Oak St\tUSA\n")
    q = normalise_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    row = spark.read.parquet(str(tmp_path / "out")).select("name_core", "business_address_clean", "country_clean", F.col("entity_id")).first()
    assert tuple(row) == ("cafe", "1 oak street", "us", "1")
