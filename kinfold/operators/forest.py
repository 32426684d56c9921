"""The random forest, grown tree by tree over packed rows.

MLlib keeps a count of every tree beside every row (800 bytes of 200 trees) and reads
all rows once a level. Here features are binned first, as MLlib bins them; equal rows
become one with its number, packed into blocks; and each tree is grown whole by one
task, which fetches all blocks. A row that stands for m draws its times in a bag from
Poisson(m), the law of the sum of m draws of Poisson(1), so nothing is lost by that.
The trees are written in MLlib's own form and loaded as its model. More rows than
HELD_ROWS, where a task would hold too much, are left to MLlib.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators.lineage import folder, written
from kinfold.operators.packed import released

#: Distinct binned rows that a task holds at most, rows of a block about, and tasks at least.
HELD_ROWS, BLOCK, TASKS = 8_000_000, 32_768, 24
#: Rows that MLlib chooses its bins from, at least.
BIN_ROWS = 10_000
NODES = "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"


def splits_of(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """MLlib's thresholds of a continuous feature: at most bins - 1 midpoints of
    neighbouring values, about as much weight apart."""
    value, at = np.unique(values + 0.0, return_inverse=True)
    count = np.bincount(at, weights)
    middle = (value[:-1] + value[1:]) / 2
    if len(middle) <= bins - 1:
        return middle
    out, stride = [], float(count.sum()) / bins
    target, upto = stride, float(count[0])
    for k in range(1, len(value)):
        before, upto = upto, upto + float(count[k])
        if abs(before - target) < abs(upto - target):
            out.append(middle[k - 1])
            target += stride
    return np.array(out[: bins - 1])


def _gini(stats: np.ndarray) -> np.ndarray:
    total = stats.sum(axis=-1)
    share = stats / np.where(total > 0, total, 1.0)[..., None]
    return np.where(total > 0, 1.0 - (share * share).sum(axis=-1), 0.0)


class _Tree:
    """One tree: nodes are (prediction, impurity, stats, raw, gain, feature, threshold's place, left, right)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, n_bins: list[int], weights: np.ndarray, rng: np.random.Generator, depth: int, least: int, some: int):
        self.x, self.y, self.n_bins, self.weights, self.rng = x, y, n_bins, weights, rng
        self.depth, self.least, self.some = depth, least, some
        self.wide = max(n_bins)

    def features(self) -> list[int]:
        """Some features, of equal chances; of equal gains the first one's split is taken,
        so they come in no order (by a reservoir, as in MLlib)."""
        got = list(range(self.some))
        for k, place in enumerate(self.rng.integers(0, np.arange(self.some + 1, len(self.x) + 1)).tolist(), self.some):
            if place < self.some:
                got[place] = k
        return got

    def best(self, at: np.ndarray, times: np.ndarray, impurity: float, total: float) -> tuple | None:
        """The split of most gain among some features: gain, feature, place."""
        found = None
        mine = self.y[at]
        for f in self.features():
            if self.n_bins[f] < 2:
                continue
            key = self.x[f][at].astype(np.intp)
            key += mine * np.intp(self.wide)
            raw = np.bincount(key, times, 2 * self.wide).reshape(2, self.wide).T[: self.n_bins[f]]
            left = np.cumsum(raw, axis=0)[:-1]
            right = raw.sum(axis=0) - left
            a, b = left * self.weights, right * self.weights
            gain = impurity - (a.sum(axis=1) * _gini(a) + b.sum(axis=1) * _gini(b)) / total
            gain = np.where((left.sum(axis=1) >= self.least) & (right.sum(axis=1) >= self.least), gain, -1.0)
            k = int(np.argmax(gain))
            if gain[k] > 0 and (found is None or gain[k] > found[0]):
                found = float(gain[k]), int(f), k
        return found

    def grow(self, at: np.ndarray, times: np.ndarray, level: int = 0) -> tuple:
        raw = np.bincount(self.y[at], times, 2)
        stats = raw * self.weights
        impurity = float(_gini(stats))
        leaf = (float(np.argmax(stats)), impurity, stats, int(raw.sum()), -1.0, -1, -1, None, None)
        found = self.best(at, times, impurity, float(stats.sum())) if level < self.depth and impurity > 2.0**-52 else None
        if not found:
            return leaf
        gain, f, k = found
        low = self.x[f][at] <= k
        left, right = self.grow(at[low], times[low], level + 1), self.grow(at[~low], times[~low], level + 1)
        if left[7] is None and right[7] is None and left[0] == right[0]:  # as MLlib: a split that decides nothing
            return leaf
        return (*leaf[:4], gain, f, k, left, right)


def node_rows(tree: int, root: tuple, splits: list[np.ndarray]) -> list[dict]:
    """A tree's nodes in MLlib's form, parents first."""
    out: list[dict] = []

    def add(node: tuple) -> int:
        prediction, impurity, stats, raw, gain, f, k, left, right = node
        own = {"id": len(out), "prediction": prediction, "impurity": impurity, "impurityStats": stats.tolist(), "rawCount": raw, "gain": gain}
        out.append({"treeID": tree, "nodeData": own})
        own["split"] = {"featureIndex": f, "leftCategoriesOrThreshold": [float(splits[f][k])] if left else [], "numCategories": -1}
        own["leftChild"], own["rightChild"] = (add(left), add(right)) if left else (-1, -1)
        return own["id"]

    add(root)
    return out


def packed_rows(pool: DataFrame, features: list[str], splits: list[np.ndarray], n: int) -> DataFrame:
    """block, n, label_bins: distinct binned rows with their label and their number, in an
    order that follows from them alone."""
    wide, blocks = len(features), max(1, -(-n // BLOCK))
    mix = np.random.default_rng(0).integers(1, 2**63, wide + 1, np.uint64) | np.uint64(1)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.empty((batch.num_rows, wide + 1), np.uint8)
            for k, s in enumerate(splits):
                rows[:, k] = np.searchsorted(s, batch.column(k).to_numpy(zero_copy_only=False), "left")
            rows[:, wide] = batch.column(wide).to_numpy(zero_copy_only=False)
            block = ((rows.astype(np.uint64) @ mix) >> np.uint64(20)) % np.uint64(blocks)
            flat = pa.Array.from_buffers(pa.binary(wide + 1), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), flat], ["block", "row"])

    def pack(table: pa.Table) -> pa.Table:
        got = table.group_by("row", use_threads=False).aggregate([([], "count_all")]).sort_by("row")
        rows = np.frombuffer(b"".join(got["row"].to_pylist()), np.uint8).reshape(-1, wide + 1)
        times = got["count_all"].to_numpy().astype(np.int32)
        return pa.table({"block": table["block"].slice(0, 1), "n": pa.array([len(rows)]), "rows": pa.array([np.ascontiguousarray(rows.T).tobytes()], pa.binary()), "times": pa.array([times.tobytes()], pa.binary())})

    each = pool.select(*[F.col(c).cast("double") for c in features], F.col("label").cast("int")).mapInArrow(binned, "block int, row binary")
    return written(each.groupBy("block").applyInArrow(pack, "block int, n bigint, rows binary, times binary"), "binned")


def _grown(kind: RandomForestClassifier, blocks: DataFrame, splits: list[np.ndarray], weights: np.ndarray) -> DataFrame:
    spark, wide = blocks.sparkSession, len(splits)
    sizes = sorted((r["block"], r["n"]) for r in blocks.select("block", "n").collect())  # one of BLOCK rows
    start = dict(zip([b for b, _ in sizes], np.cumsum([0] + [n for _, n in sizes]).tolist(), strict=False))
    n, n_bins = sum(n for _, n in sizes), [len(s) + 1 for s in splits]
    trees, seed, depth, least = kind.getNumTrees(), kind.getSeed() & (2**63 - 1), kind.getMaxDepth(), kind.getMinInstancesPerNode()
    groups = min(trees, max(TASKS, 2 * spark.sparkContext.defaultParallelism))
    some = math.ceil(math.sqrt(wide))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, m, group = np.empty((wide, n), np.uint8), np.empty(n, np.uint8), np.empty(n, np.int32), None
        for batch in batches:
            for g, block, rows, times in zip(*[batch.column(k) for k in range(4)], strict=True):
                group, a = g.as_py(), start[block.as_py()]
                own = np.frombuffer(times.as_buffer(), np.int32)
                part = np.frombuffer(rows.as_buffer(), np.uint8).reshape(wide + 1, -1)
                x[:, a : a + len(own)], y[a : a + len(own)], m[a : a + len(own)] = part[:wide], part[wide], own
        if group is None:
            return
        for tree in range(group, trees, groups):
            rng = np.random.default_rng((seed, tree))
            times = rng.poisson(m).astype(np.int32)
            at = np.flatnonzero(times).astype(np.int32)
            root = _Tree(x, y, n_bins, weights, rng, depth, least, some).grow(at, times[at].astype(float))
            yield from pa.Table.from_pylist(node_rows(tree, root, splits), NODE_SCHEMA).to_batches()

    tasks = spark.range(0, groups, 1, groups).select(F.col("id").cast("int").alias("group"))
    met = tasks.hint("shuffle_replicate_nl").crossJoin(blocks.drop("n").repartition(1))
    return met.mapInArrow(released(grow), NODES)


_SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
_NODE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", _SPLIT)])
NODE_SCHEMA = pa.schema([("treeID", pa.int32()), ("nodeData", _NODE)])


def fitted(kind: RandomForestClassifier, pool: DataFrame, features: list[str]) -> RandomForestClassificationModel | None:
    """The model of pool (s1_id, r_id, features, label 0 or 1, weight of the label); None
    where this way isn't for it."""
    spark = pool.sparkSession
    # Other settings than those of models.classifiers stay with MLlib.
    plain = (kind.getFeatureSubsetStrategy(), kind.getBootstrap(), kind.getSubsamplingRate(), kind.getImpurity(), kind.getMinInfoGain(), kind.getMinWeightFractionPerNode(), kind.isSet("thresholds"))
    if plain != ("sqrt", True, 1.0, "gini", 0.0, 0.0, False) or kind.getMaxBins() > 128:
        return None
    classes = pool.groupBy("label", "weight").agg(F.count(F.lit(1)).alias("n")).limit(3).collect()
    if sorted(r["label"] for r in classes) != [0, 1]:
        return None
    n, weights = sum(r["n"] for r in classes), np.array([r["weight"] for r in sorted(classes, key=lambda r: r["label"])])
    # MLlib, too, takes its bins from about so many rows; the trees learn from all.
    share, values = max(kind.getMaxBins() ** 2, BIN_ROWS) / n, [F.col(c).cast("double") for c in features]
    seen = pool if share >= 1 else pool.where(F.pmod(F.xxhash64("s1_id", "r_id", F.lit(kind.getSeed() + 1)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    table = seen.select(*values, F.col("weight").cast("double")).toArrow()
    splits = [splits_of(table[c].to_numpy(), table["weight"].to_numpy(), kind.getMaxBins()) for c in features]
    blocks = packed_rows(pool, features, splits, n)
    if blocks.agg(F.sum("n")).first()[0] > HELD_ROWS:
        return None
    # The parameters as MLlib writes them: those of a forest of two rows.
    place, label = folder(spark, "forest"), kind.getLabelCol()
    tiny = spark.createDataFrame([(Vectors.dense([float(k)] * len(features)), float(k), 1.0) for k in range(2)], [kind.getFeaturesCol(), label, kind.getWeightCol()])
    kind.fit(tiny).save(place)
    _grown(kind, blocks, splits, weights).write.mode("overwrite").parquet(f"{place}/data")
    return RandomForestClassificationModel.load(place)
