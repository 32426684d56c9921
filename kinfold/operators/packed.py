"""Blocks of rows packed into one row each, which meet without copies on disk.

A block is an Arrow stream in a binary column. Blocks lie on disk once, where a shuffle
has put them; every pair of a left and a right partition is a task that fetches both.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Records of a block at most, and blocks of the left side at least, if they have SMALL
#: records, so that small inputs use all cores.
LEFT_BLOCK, RIGHT_BLOCK, SMALL, BLOCKS = 16_384, 131_072, 1000, 48
#: Joined rows that leave a task at once.
ROWS = 4096


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(rows: pa.BinaryScalar) -> pa.Table:
    with pa.ipc.open_stream(rows.as_buffer()) as stream:
        return stream.read_all().combine_chunks()


def _places(pairs: pa.Table, left: pa.Table, right: pa.Table) -> list[np.ndarray]:
    """Of each joined row its places in pairs, left and right, in the order of pairs."""
    numbered = lambda t, keys, name: pa.table({k: t[c] for k, c in keys.items()} | {name: np.arange(t.num_rows)})
    got = numbered(pairs, {"a": "s1_id", "b": "r_id"}, "p").join(numbered(right, {"b": "b_entity_id"}, "r"), "b", join_type="inner", use_threads=False)
    got = got.join(numbered(left, {"a": "a_entity_id"}, "l"), "a", join_type="inner", use_threads=False).sort_by("p")
    return [got[c].to_numpy() for c in "plr"]


def released(run: Callable) -> Callable:
    """run, a function of a task's batches, for mapInArrow: once the task is over, what it
    has freed goes back to the system, as workers stay for later tasks of other stages."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if hasattr(ctypes.CDLL(None), "malloc_trim"):
                ctypes.CDLL(None).malloc_trim(0)

    return task


def joined(pairs: DataFrame, left: DataFrame, right: DataFrame, more: Sequence[str] = (), values: Callable[[pa.Table], list[pa.Array]] | None = None) -> DataFrame:
    """The inner join of pairs (s1_id, r_id, ...) with left (a_entity_id, ...) and right
    (b_entity_id, ...). Pairs meet left records by blocks of those, and then right blocks;
    neither a pair's nor a record's texts are shuffled by pair. more: names of double
    columns whose values a function of some joined rows gives."""
    n_l, n_r = left.count(), right.count()
    n_l = max(1, -(-n_l // LEFT_BLOCK), min(-(-n_l // SMALL), BLOCKS))
    n_r = max(1, -(-n_r // RIGHT_BLOCK))
    dealt = lambda df, key, n: df.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
    of_pairs, of_left, of_right = (df.columns for df in (pairs, left, right))

    def with_left(some: pa.Table, records: pa.Table) -> pa.Table:
        if not some.num_rows or not records.num_rows:
            return pa.table({"block": pa.array([], pa.int32()), "pairs": pa.array([], pa.binary()), "lefts": pa.array([], pa.binary())})
        return pa.table({"block": some["_block"].slice(0, 1), "pairs": pa.array([pack(some.select(of_pairs).sort_by("s1_id"))], pa.binary()), "lefts": pa.array([pack(records.select(of_left))], pa.binary())})

    def alone(records: pa.Table) -> pa.Table:
        return pa.table({"r_block": records["_block"].slice(0, 1), "rights": pa.array([pack(records.select(of_right))], pa.binary())})

    lefts = dealt(pairs, "s1_id", n_l).groupBy("_block").cogroup(dealt(left, "a_entity_id", n_l).groupBy("_block")).applyInArrow(with_left, "block int, pairs binary, lefts binary")
    rights = dealt(right, "b_entity_id", n_r).groupBy("_block").applyInArrow(alone, "r_block int, rights binary")
    met = lefts.repartitionById(n_l, F.col("block")).hint("shuffle_replicate_nl").crossJoin(rights.repartitionById(n_r, F.col("r_block")))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                tables = [unpack(batch.column(c)[k]) for c in range(3)]  # one pair of blocks at once
                places = _places(*tables)
                for at in range(0, len(places[0]), ROWS):
                    parts = [t.take(pa.array(x[at : at + ROWS])) for t, x in zip(tables, places, strict=True)]
                    got = pa.table([c for t in parts for c in t.columns], [c for t in parts for c in t.column_names]).combine_chunks()
                    for name, value in zip(more, values(got) if values else [], strict=True):
                        got = got.append_column(name, value)
                    yield from got.to_batches()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for df in (pairs, left, right) for f in df.schema) + "".join(f", `{c}` double" for c in more)
    return met.select("pairs", "lefts", "rights").mapInArrow(released(rows), kinds)
