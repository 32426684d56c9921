"""K-d tree sharding with DataFrame operations only.

The metadata space has four dimensions (language, source, size, identifier),
each quantised to 20 bits. A node that must hold several shards is split along
its widest dimension at the weighted median (the byte quantile that divides its
shards between the children). Medians come from histograms of 12 bits of the
composite key (coordinate, then a hash of identifier and checksum, then a row's own
digits, which part repeated rows) refined digit by digit, so only bounded tables
ever reach the driver: one row per node.

Nulls: a null text has no bytes (size 1, CRC 0), null metadata is a value of its
own, a null identifier sorts first. Repeated rows are placed one by one, so any
number of them is cut at a median like other rows; which of them goes where makes no
difference. Ties of a coordinate are cut by the hash. A very long text is one row:
it may fill the bytes of several shards, which then stay small. Copies of a text under
several identifiers are placed one by one too: law `bytes` could not hold otherwise
where a group has more bytes than a shard. Slots depend on the rows and `salts` alone.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import settled

COORD_BITS, DIGIT_BITS = 20, 12
TIE_BITS, OWN_BITS = 40, 24
DIMS = ("lang", "source", "size", "ident")


def _coordinates(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(text).cast("long") + F.lit(1)
    low20 = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << COORD_BITS))
    top = F.lit((1 << COORD_BITS) - 1).cast("long")
    ident = F.col(id_col).cast("string")
    return docs.select(
        F.col(id_col).alias("doc_id"),
        size.alias("size"),
        F.crc32(text).alias("text_crc32"),
        low20(F.col(lang_col)).alias("d_lang"),
        low20(F.col(source_col)).alias("d_source"),
        F.least(F.floor(F.log2(size.cast("double")) * F.lit(1 << 15)), top).alias("d_size"),
        low20(ident).alias("d_ident"),
        F.pmod(F.xxhash64(F.lit(1), ident, F.crc32(text)), F.lit(1 << TIE_BITS)).alias("tie"),
        # Fixed when the rows are written; it decides between equal keys only.
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << OWN_BITS)).alias("own"),
    )


def _key(dim: Column) -> Column:
    """60-bit key along the chosen dimension: coordinate, then tie."""
    pick = F.coalesce(*[F.when(dim == k, F.col(f"d_{name}")) for k, name in enumerate(DIMS)])
    return F.shiftleft(pick, TIE_BITS).bitwiseOR(F.col("tie"))


def _lookup(node: Column, values: dict[int, int]) -> Column:
    """A small driver-side table as an expression (nodes are fewer than shards)."""
    pairs = [x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast("long"))]
    return F.element_at(F.create_map(*pairs), node)


def kd_shards(
    docs: DataFrame,
    *,
    shards: int | None = None,
    target_bytes: int | None = None,
    salts: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot. Give shards, or target_bytes (then
    as many shards as keep the mean leaf at or under that)."""
    spark = docs.sparkSession
    points = settled(_coordinates(docs, id_col, text_col, lang_col, source_col), "kdpoints")
    n, total = points.agg(F.count(F.lit(1)), F.sum("size")).first()
    if shards is None:
        shards = max(1, math.ceil((total or 0) / target_bytes))
    # node -> (first shard, shards); children of one split take the first and the rest
    leaves: dict[int, tuple[int, int]] = {0: (0, shards)}
    rows = points.withColumn("node", F.lit(0))
    spread = {}
    while n and any(c > 1 for _, c in leaves.values()):
        open_nodes = [k for k, (_, c) in leaves.items() if c > 1]
        stats = rows.where(F.col("node").isin(open_nodes)).groupBy("node").agg(F.sum("size").alias("b"), *[F.max(f"d_{d}") - F.min(f"d_{d}") for d in DIMS]).collect()
        if not spread:
            spread = {k: max(1, stats[0][2 + k]) for k in range(len(DIMS))}
        dims, goal = {}, {}
        for r in stats:
            width = [r[2 + k] / spread[k] for k in range(len(DIMS))]
            dims[r["node"]] = max(range(len(DIMS)), key=lambda k: (width[k], -k))
            goal[r["node"]] = r["b"] * (leaves[r["node"]][1] // 2) / leaves[r["node"]][1]
        cuts, own_cuts = _medians(rows, dims, goal)
        nxt, moves = dict(leaves), {}
        for node in dims:
            first, count = leaves[node]
            left = count // 2
            nxt[node] = (first, left)
            new = first + left  # a node is named by its first shard
            nxt[new] = (new, count - left)
            moves[node] = new
        # Nodes that no row reached keep their name and have nothing to split.
        leaves = {k: v if k in moves or k not in open_nodes else (v[0], 1) for k, v in nxt.items()}
        node = F.col("node")
        key, cut = _key(_lookup(node, dims)), _lookup(node, cuts)
        right = (key > cut) | ((key == cut) & (F.col("own") >= _lookup(node, own_cuts)))
        rows = rows.withColumn("node", F.when(node.isin(list(dims)) & right, _lookup(node, moves)).otherwise(node).cast("int"))
        rows = settled(rows, "kdnodes")  # short lineage; a level reads no earlier level's splits
    placed = rows.select("doc_id", "size", "text_crc32", "tie", F.col("node").alias("shard"))
    placed = placed.withColumn("salt", F.pmod(F.xxhash64(F.lit(2), "tie"), F.lit(salts)).cast("int"))
    before = (
        placed.groupBy("shard", "salt")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
        .select("shard", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    )
    nth = F.row_number().over(Window.partitionBy("shard", "salt").orderBy("doc_id", "text_crc32", "size"))
    # One row per shard and salt, both parameters: bounded, so it is sent whole.
    out = placed.withColumn("nth", nth).join(F.broadcast(before), ["shard", "salt"])
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("nth") - 1).alias("slot"))


def _medians(rows: DataFrame, dims: dict[int, int], goal: dict[int, float]) -> tuple[dict[int, int], dict[int, int]]:
    """For each node the key, and the row's own digits, at which its bytes pass the
    goal, digit by digit."""
    node = F.col("node")
    keyed = rows.where(node.isin(list(dims))).select("node", "size", _key(_lookup(node, dims)).alias("key"), "own")
    low, rest = {"key": dict.fromkeys(dims, 0), "own": dict.fromkeys(dims, 0)}, dict(goal)
    for name, bits in (("key", COORD_BITS + TIE_BITS), ("own", OWN_BITS)):
        inside = F.lit(True) if name == "key" else F.col("key") == _lookup(node, low["key"])
        for shift in range(bits - DIGIT_BITS, -1, -DIGIT_BITS):
            here = inside & (F.shiftright(F.col(name), shift + DIGIT_BITS) == F.shiftright(_lookup(node, low[name]), shift + DIGIT_BITS))
            digit = F.shiftright(F.col(name), shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
            got = keyed.where(here).groupBy("node", digit.alias("digit")).agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
            upto = F.sum("b").over(Window.partitionBy("node").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0))
            got = got.withColumn("upto", upto).withColumn("last", F.max("digit").over(Window.partitionBy("node")))
            hit = got.where((F.col("upto") > _lookup_float(node, rest)) | (F.col("digit") == F.col("last")))
            hit = hit.groupBy("node").agg(F.min_by(F.struct("digit", "upto", "b", "n"), "digit").alias("h"))
            alone = True
            for r in hit.collect():  # at most one row for each node
                low[name][r["node"]] |= r["h"]["digit"] << shift
                rest[r["node"]] = max(0.0, rest[r["node"]] - (r["h"]["upto"] - r["h"]["b"]))
                alone &= r["h"]["n"] == 1
            if alone:
                return low["key"], low["own"]
    return low["key"], low["own"]


def _lookup_float(node: Column, values: dict[int, float]) -> Column:
    pairs = [x for k, v in values.items() for x in (F.lit(k), F.lit(float(v)))]
    return F.element_at(F.create_map(*pairs), node)
