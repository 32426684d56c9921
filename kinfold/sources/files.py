"""TSV and JSON sources and sinks."""

from __future__ import annotations

import json
import os
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators.analytics import DataError
from kinfold.operators.records import check_columns, head, with_order

_TSV = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": True, "mode": "FAILFAST"}
MATCHING, CANDIDATE = ("source1_entity_id", "matched_entity_ids"), ("source1_entity_id", "candidate_entity_ids")


def read_tsv(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """All columns as strings, empty fields kept as empty, rows in file order.
    The file is one unit of order; limit keeps its first rows (0 or None: all)."""
    if "://" not in path and not os.path.exists(path):
        raise FileNotFoundError(f"required data file not found: {path}")
    df = spark.read.options(**_TSV).csv(path)
    df = df.select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])
    return head(with_order(df), limit)


def training_sources(spark: SparkSession, folder: str, limit: int | None) -> dict[str, DataFrame]:
    """The three limited training sources and the unlimited truth."""
    got = {f"s{k}": read_tsv(spark, f"{folder}/train_source{k}.tsv", limit) for k in (1, 2, 3)}
    for df in got.values():
        check_columns(df)
    return got | {"truth": read_tsv(spark, f"{folder}/train_ground_truth.tsv")}


def write_tsv(table: DataFrame, columns: tuple[str, str], path: str) -> None:
    """One ordered file in a folder: the format asks for input order, so this sink
    alone sorts and coalesces. Identifiers are written unquoted."""
    rows = table.orderBy("_row").select(*columns).coalesce(1)
    rows.write.mode("overwrite").options(sep="\t", header=True, quote="\u0000", emptyValue="").csv(path)


def read_output(spark: SparkSession, path: str, columns: tuple[str, str], errors: list[str]) -> DataFrame | None:
    """An output table with _row, or None and an error in the list."""
    try:
        df = read_tsv(spark, path)
        names = tuple(c for c in df.columns if c != "_row")
    except Exception as e:  # noqa: BLE001  any unreadable file is a finding
        errors.append(f"{path}: {str(e).splitlines()[0]}")
        return None
    if names != columns:
        errors.append(f"{path}: header {list(names)}, expected {list(columns)}")
        return None
    return df


def read_strict(spark: SparkSession, path: str, columns: tuple[str, str]) -> DataFrame:
    """Line by line: the exact header, one or two fields a line (one: the second is
    empty). Raises DataError with the first bad line's number."""
    if "://" not in path and not os.path.exists(path):
        raise DataError(f"{path} is missing")
    lines = with_order(spark.read.text(path))
    first = lines.where("_row = 0").first()
    if first is None:
        raise DataError(f"{path} is empty")
    if first["value"].rstrip("\r").split("\t") != list(columns):
        raise DataError(f"{path}: unexpected header")
    rows = lines.where("_row > 0 and value <> ''").withColumn("f", F.split(F.regexp_replace("value", "\r$", ""), "\t"))
    bad = rows.where(F.size("f") > 2).agg(F.min("_row")).first()[0]
    if bad is not None:
        raise DataError(f"{path}: line {bad + 1} has more than two fields")
    return rows.select(F.col("f")[0].alias(columns[0]), F.coalesce(F.try_element_at("f", F.lit(2)), F.lit("")).alias(columns[1]), (F.col("_row") - 1).alias("_row"))


_cache: dict[tuple[str, tuple], tuple[float, DataFrame]] = {}


def cached(spark: SparkSession, path: str, columns: tuple[str, str]) -> DataFrame:
    """read_strict, read again only after the file changed."""
    if not os.path.exists(path):
        raise DataError(f"{path} is missing")
    changed = os.stat(path).st_mtime_ns
    old = _cache.get((path, columns))
    if not old or old[0] != changed:
        if old:
            old[1].unpersist()
        _cache[path, columns] = changed, read_strict(spark, path, columns).cache()
    return _cache[path, columns][1]


def write_metrics(path: str, document: dict) -> None:
    """Replaces the whole document."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(document, indent=2, default=str), encoding="utf-8")


def merge_metrics(path: str, prediction: dict) -> dict:
    """Sets `prediction`; the rest stays. An unreadable document counts as empty."""
    try:
        document = json.loads(Path(path).read_text(encoding="utf-8"))
        document = document if isinstance(document, dict) else {}
    except (OSError, ValueError):
        document = {}
    document["prediction"] = prediction
    write_metrics(path, document)
    return document


def read_metrics(path: str) -> dict:
    try:
        document = json.loads(Path(path).read_text(encoding="utf-8"))
    except OSError as e:
        raise DataError(f"{path} is missing") from e
    except ValueError as e:
        raise DataError(f"{path} is not valid JSON") from e
    if not isinstance(document, dict):
        raise DataError(f"{path} does not hold an object")
    return document


def health(files: dict[str, str]) -> dict:
    got = {name: os.path.exists(p) for name, p in files.items()}
    return got | {"all_ok": all(got.values())}


def system_status(files: dict[str, str], model_path: str) -> dict:
    """Which outputs are there, and the saved model's name."""
    items = [{"name": n, "ok": os.path.exists(p), "detail": "Found" if os.path.exists(p) else "Missing"} for n, p in files.items()]
    side = Path(model_path) / "model.json"
    if side.exists():
        try:
            items.append({"name": "model", "ok": True, "detail": json.loads(side.read_text())["model_name"]})
        except (ValueError, KeyError) as e:
            items.append({"name": "model", "ok": False, "detail": str(e)})
    else:
        items.append({"name": "model", "ok": False, "detail": "Missing"})
    return {"components": items, "all_ok": all(x["ok"] for x in items)}


def fill_template(text: str, values: dict) -> str:
    """{{KEY}} becomes the value of KEY; unknown keys stay."""
    for key, value in values.items():
        text = text.replace("{{" + key + "}}", str(value))
    return text


def comparison_rows(document: dict) -> str:
    """The compared models as rows of a table."""
    cell = lambda r, c: f"{r[c]:.4f}" if isinstance(r.get(c), float) else str(r.get(c, ""))
    return "\n".join("| " + " | ".join(cell(r, c) for c in ("model", "threshold", "precision", "recall", "f0_5")) + " |" for r in document.get("model_comparison", []))


def package(folder: str, target: str, wanted: list[str]) -> str:
    """Zips the wanted files of folder, tests the archive and its list of names."""
    missing = [w for w in wanted if not (Path(folder) / w).exists()]
    if missing:
        raise FileNotFoundError(f"not packaged, missing: {missing}")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for w in wanted:
            z.write(Path(folder) / w, w)
    with zipfile.ZipFile(target) as z:
        if z.testzip() or sorted(z.namelist()) != sorted(wanted):
            raise DataError(f"{target} is damaged or holds unwanted files")
    return target


