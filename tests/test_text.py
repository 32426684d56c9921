"""Normalisation rules: expectations come from the rules, not from our output."""

import pytest
from pyspark.sql import functions as F

from kinfold.functions import text as N
from kinfold.operators import records


@pytest.mark.parametrize(
    ("text", "want"),
    [("प्राइवेट लिमिटेड", "praivet limited"), ("१२", ""), ("Straße", "Strasse"), ("Ørsted", "Ørsted"), ("", ""), (None, ""), ("ﬁn", "fin"), ("é̀", "e")],
)
def test_base_form(text, want):
    assert N.base_form(text) == want


def column(spark, values, make):
    df = spark.createDataFrame([(k, *v) if isinstance(v, tuple) else (k, v) for k, v in enumerate(values)], "k int, a string" + (", b string" if isinstance(values[0], tuple) else ""))
    return [r["x"] for r in df.select("k", make().alias("x")).orderBy("k").collect()]


def test_names(spark):
    got = column(spark, ["https://www.foo-bar.co.in", "foo.bar.com", "A&B", "  Ünited,  Co. "], lambda: N.clean_name(N.base_normal("a")))
    assert got == ["foo bar", "foo bar", "a and b", "united co"]


def test_core_falls_back(spark):
    assert column(spark, ["a and b", "praivet limited", ""], lambda: F.array_join(N.core_tokens(F.col("a")), " ")) == ["a b", "praivet limited", ""]


def test_countries(spark):
    assert column(spark, ["U.S.A.", "GB", "India", ""], lambda: N.clean_country(N.base_normal("a"))) == ["us", "uk", "india", ""]


def test_addresses(spark):
    rows = [("1 Main St, CA", "us"), ("1 Main St, CA 94105", "us"), ("1 Main St, ca", "us"), ("1 Main St, CA", "uk"), ("21st Ave", "us"), ("Apt 4, Nr Park", "uk"), ("", "us")]
    got = column(spark, rows, lambda: N.clean_address(N.base_normal("a"), F.col("b")))
    assert got == ["1 main street california", "1 main street ca 94105", "1 main street ca", "1 main street ca", "21 avenue", "4 near park", ""]


def test_id_lists(spark):
    assert column(spark, ["a,,b", " a , b,", "", None], lambda: F.array_join(N.id_list(F.col("a"), strip=True), "|")) == ["a|b", "a|b", "", ""]


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="country"):
        records.normalised(spark.createDataFrame([("1", "n", "a")], "entity_id string, business_name string, business_address string"))


def test_empty_table_and_nulls(spark):
    schema = "entity_id string, business_name string, business_address string, country string, extra int"
    assert records.normalised(spark.createDataFrame([], schema)).count() == 0
    row = records.normalised(spark.createDataFrame([("1", None, None, None, 3)], schema)).first()
    assert (row["name_core"], row["business_address_clean"], row["country_clean"], row["extra"]) == ("", "", "", 3)
