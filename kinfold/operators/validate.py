"""Integrity rules of the output tables (strings: id, comma list, _row)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions.text import id_list


def with_lists(table: DataFrame, column: str) -> DataFrame:
    return table.select(F.col("source1_entity_id").alias("s1_id"), id_list(F.col(column)).alias("ids"), "_row")


def repeated_ids(lists: DataFrame) -> DataFrame:
    return lists.agg((F.count("s1_id") - F.count_distinct("s1_id")).alias("repeated"))


def rows_with_repeats(lists: DataFrame) -> DataFrame:
    return lists.agg(F.count_if(F.size("ids") != F.size(F.array_distinct("ids"))).alias("rows_with_repeats"))


def outside_candidates(matches: DataFrame, cands: DataFrame) -> DataFrame:
    """Matched identifiers that aren't in the record's candidate list (the last list
    of a record counts)."""
    last = F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc("_row")))
    known = cands.withColumn("nth", last).where("nth = 1").select("s1_id", F.col("ids").alias("known"))
    j = matches.join(known, "s1_id", "left").withColumn("known", F.coalesce("known", F.array().cast("array<string>")))
    out = F.size(F.filter("ids", lambda x: ~F.array_contains(F.col("known"), x)))
    return j.agg(F.coalesce(F.sum(out.cast("long")), F.lit(0)).alias("outside"))


def unknown_ids(lists: DataFrame, right: DataFrame) -> DataFrame:
    each = lists.select(F.explode("ids").alias("entity_id"))
    return each.join(right.select("entity_id").distinct(), "entity_id", "left_anti").agg(F.count(F.lit(1)).alias("unknown"))


def different_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    """Identifiers that only one of the tables has."""
    x, y = a.select("s1_id").distinct().withColumn("x", F.lit(1)), b.select("s1_id").distinct().withColumn("y", F.lit(1))
    return x.join(y, "s1_id", "full").agg(F.count_if(F.col("x").isNull() | F.col("y").isNull()).alias("different"))


def out_of_order(lists: DataFrame, left: DataFrame) -> DataFrame:
    """Rows whose identifier isn't that of the same place in the test file. Places
    are _row ranks, so both are compared by one join."""
    j = left.select(F.col("_row"), F.col("entity_id").alias("want")).join(lists.select("_row", "s1_id"), "_row", "full")
    return j.agg(F.count_if(~F.col("want").eqNullSafe(F.col("s1_id"))).alias("out_of_order"))


def sizes(lists: DataFrame) -> DataFrame:
    return lists.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.size("ids") == 0).alias("n_empty"), F.count_if(F.size("ids") > 0).alias("n_filled"))


def validate(matching: DataFrame, candidate: DataFrame, left: DataFrame | None, right: DataFrame | None, expected_rows: int | None) -> dict:
    """All rules at once: errors, warnings and counts. left and right are the test
    records; without them the rules on identifiers are skipped with a warning."""
    m, c = with_lists(matching, "matched_entity_ids"), with_lists(candidate, "candidate_entity_ids")
    one = lambda df: df.first()[0]
    errors, warnings = [], []
    for name, t in (("matching", m), ("candidate", c)):
        if n := one(repeated_ids(t)):
            errors.append(f"{name}: {n} repeated source 1 identifiers")
        if n := one(rows_with_repeats(t)):
            errors.append(f"{name}: {n} rows list an identifier twice")
    if n := one(outside_candidates(m, c)):
        errors.append(f"{n} matched identifiers are not candidates")
    if n := one(different_keys(m, c)):
        errors.append(f"{n} source 1 identifiers are in one table only")
    if left is None or right is None:
        warnings.append("test records are absent: identifiers were not checked")
        want = expected_rows
    else:
        for name, t in (("matching", m), ("candidate", c)):
            if n := one(unknown_ids(t, right)):
                errors.append(f"{name}: {n} unknown identifiers")
            if n := one(out_of_order(t, left)):
                errors.append(f"{name}: {n} rows differ from the test file's order")
        want = left.count()
    counts = {name: sizes(t).first().asDict() for name, t in (("matching", m), ("candidate", c))}
    for name, got in counts.items():
        if want and got["n_rows"] != want:
            errors.append(f"{name}: {got['n_rows']} rows, expected {want}")
    return {"ok": not errors, "errors": errors, "warnings": warnings, "counts": counts}
