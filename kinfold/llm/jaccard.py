"""N-gram Jaccard self-join with PartEnum signatures.

A document's set is its distinct n-word shingles (64-bit hashes; words are
lower-cased in A-Z). Two documents link when den * |intersection| >= num *
|union|. Sets are put in size bands whose upper end is the lower end over the
similarity, so linked sets lie in the same or in neighbouring bands and differ in
a bounded number of shingles. The shingle domain is partitioned twice: into n1
parts, of which some differ in k2 shingles at most, each into n2 pieces of which
n2 - k2 must then agree. A signature is the hash of what a set has in n2 - k2
pieces of a part; sets that link share one that isn't empty, or, if a set has
too few full pieces for that (rare by the choice of n1 and n2), an empty one.

Before that, equal sets are merged into classes, and classes are dropped which
provably link with nothing: more than (1 - similarity) of the set occurs in no
other set, counted over the half of the shingle space that is odd.

Round one takes the signatures of a few parts and links each group's members to
its first one, so most copies get one label. Round two takes all signatures and
keeps the groups with two labels or more; their members meet with parity sketches,
and pairs of two labels that sizes and sketches allow are candidates. Groups over
`block` members are dealt into blocks that meet two by two in tasks of their own;
signatures of over `hot_key` sets go there at once, never through one task. Every
candidate passes the exact comparison of whole sets.

Nulls and texts without words have an empty set and link with nothing. A null
identifier takes part but never names a component. Repeated rows and equal sets
are copies: one class, one component. Ties don't arise (links are symmetric, the
least identifier names). A very long text is one large set; memory follows the
longest text. Extra columns are ignored, whatever their names; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb, exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.components import components
from kinfold.llm.shared import settled
from kinfold.llm.textbytes import chunks, mix, released, shingle_sets

#: Up to this many keys are sent to all executors; beyond, the join shuffles.
BROADCAST_ROWS = 500_000
SKETCH_WORDS = 8
SKETCH = [f"s{k}" for k in range(SKETCH_WORDS)]
#: So many of its groups a set carries, to meet another in few of those they share.
LEAST = 8
#: Parts whose signatures the first round takes.
FIRST_PARTS = 4
#: Of unrelated sets, one in so many may share an empty signature.
RARE = 3000
#: Texts are read so many bytes at a time, and entries leave a task so many at a time.
READ_BYTES, HELD = 512 << 10, 1 << 19


def bands(most: int, num: int, den: int) -> list[tuple[int, int]]:
    """Size bands up to most and one more."""
    out, low = [], 1
    while not out or out[-1][0] <= most:
        high = max(low, low * den // num)
        out.append((low, high))
        low = high + 1
    return out


def _at_least(n: int, p: float, least: int) -> float:
    """P(Binomial(n, p) >= least); beyond 200 trials its Chernoff bound."""
    if least <= 0 or p >= 1:
        return 1.0
    if least > n:
        return 0.0
    if n <= 200:
        return sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(least, n + 1))
    a = least / n
    if a <= p:
        return 1.0
    return exp(-n * (a * log(a / p) + ((1 - a) * log((1 - a) / (1 - p)) if a < 1 else 0)))


def differences(n: int, high: int, num: int, den: int) -> int:
    """In so many shingles can a set of n differ from one of high or fewer that it links with."""
    return (min(n * den // num, high) + n) * (den - num) // (den + num)


def _empty_share(n: int, n1: int, n2: int, k2: int, most: int) -> float:
    """The chance that a set of n shingles sends one given empty signature."""
    few = min(k2, most)
    if n1 == 1:  # all shingles lie in few of the k2 pieces that the choice leaves out
        return comb(k2, few) * (few / n2) ** n
    bare = (1 - 1 / (n1 * n2)) ** n
    hole = sum(comb(n2, f) * (1 - bare) ** f * bare ** (n2 - f) for f in range(few + 1))
    return bare ** (n2 - k2) * _at_least(n1 - 1, hole, n1 - most // (k2 + 1) - 1)


@cache
def plan(low: int, high: int, num: int, den: int) -> tuple[int, int, int]:
    """(n1, n2, k2) for sets of low to high shingles: sets that link differ in at most
    k shingles, so in more than k2 in at most k // (k2 + 1) of the n1 parts. Taken is
    the plan with the fewest signatures whose empty ones are rare."""
    k = (den - num) * 2 * high // (den + num)
    options = []
    for k2 in {min(k, 1), k} if k <= 8 else {1}:
        bad = k // (k2 + 1)
        for n2 in range(k2 + 1, 13):
            for slack in {0, 1, 2, 3, 4, 6, 8, *(bad // x for x in (4, 6, 8, 12, 16))} if bad else {0}:
                n1 = bad + 1 + slack
                worst = max(_empty_share(n, n1, n2, k2, differences(n, high, num, den)) for n in (low, (low + high) // 2, int(0.8 * high), high) if n)
                full = high * (n2 - k2) / (n1 * n2)
                options.append((worst * RARE > 1, bad > 0 and full < 5.5, n1 * comb(n2, k2), n1, n2, k2))
    return min(options)[3:]


def plans(most: int, num: int, den: int) -> list[tuple[int, int, int, int]]:
    """(band's high end, n1, n2, k2) of all bands."""
    ends = bands(most, num, den)
    return [(high, *plan(ends[max(0, i - 1)][0], high, num, den)) for i, (_, high) in enumerate(ends)]


def signatures(feats: np.ndarray, num: int, den: int, every: list[tuple[int, int, int, int]], parts: int = 0) -> np.ndarray:
    """Signatures of one sorted distinct non-empty set; parts: of the first parts only."""
    own = int(np.searchsorted([x[0] for x in every], len(feats)))
    out = []
    for i in range(own, min(own + 2, len(every))):
        high, n1, n2, k2 = every[i]
        most = differences(len(feats), high, num, den)
        spot = mix(feats + np.uint64(0x51ED + i))
        piece = ((spot >> np.uint64(32)) % np.uint64(n1 * n2)).astype(np.int64)
        order = np.argsort(piece, kind="stable")
        at = piece[order]
        heads = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        sums = np.zeros(n1 * n2, np.uint64)
        sums[at[heads]] = np.add.reduceat(mix(spot ^ np.uint64(0xA5A5A5A5))[order], heads)
        full = np.zeros(n1 * n2, bool)
        full[at[heads]] = True
        sums, full = sums.reshape(n1, n2), full.reshape(n1, n2)
        # A part with as few full pieces as may differ might share an empty choice only;
        # with fewer such parts than surely good ones some other part is shared.
        holes = int((full.sum(axis=1) <= min(k2, most)).sum())
        bare = holes >= n1 - most // (k2 + 1)
        take = min(parts, n1) if parts else n1
        name = np.arange(take, dtype=np.uint64) + (np.uint64(i) << np.uint64(40))
        for j, chosen in enumerate(combinations(range(n2), n2 - k2)):
            s = mix(name + (np.uint64(j) << np.uint64(52)))
            for x in chosen:
                s = mix(s * np.uint64(3) + sums[:take, x])
            out.append(s if bare else s[full[:take, list(chosen)].any(axis=1)])
    return np.concatenate(out)


def signed_as(n: int, every: list[tuple[int, int, int, int]]) -> int:
    """How many signatures a set of n shingles has, empty ones included."""
    own = int(np.searchsorted([x[0] for x in every], n))
    return sum(n1 * comb(n2, k2) for _, n1, n2, k2 in every[own : own + 2])


def sketch(feats: np.ndarray) -> np.ndarray:
    """Parities of the set over 64 * SKETCH_WORDS cells: two sketches differ in
    no more bits than the sets differ in elements."""
    bits = np.bincount((feats >> np.uint64(11)).astype(np.int64) & (64 * SKETCH_WORDS - 1), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _set_name(feats: np.ndarray) -> tuple[int, int]:
    a = int(mix(feats ^ np.uint64(0x1F123BB5)).sum(dtype=np.uint64))
    b = int(mix(feats + np.uint64(0x7F4A7C159E37)).sum(dtype=np.uint64))
    return [x - (1 << 64) if x >= 1 << 63 else x for x in (a, b)]


#: Entries of a run at most.
LONGEST = 255
BLOBS = "bucket int, keys binary, owners binary, labels binary, runs binary"


class _Sender:
    """Holds (key, owner, label) entries and gives them out by bucket: the low 32 bits
    of the keys, and the owners and labels as runs. The more buckets, the shorter are the
    runs and the more of what is sent names them: so a run's size is one byte (longer
    ones are split), and a label is sent as what it differs in from its owner, which is
    nothing for most and shrinks when written."""

    def __init__(self, buckets: int):
        self.buckets, self.held, self.keys, self.facts = buckets, 0, [], []

    def add(self, keys: np.ndarray, owner: int, label: int | None = None) -> Iterator[pa.RecordBatch]:
        """Without a label the owner is its own."""
        self.keys.append(keys)
        self.facts.append((owner, 0 if label is None else owner ^ label))
        self.held += len(keys)
        if self.held >= HELD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            each = np.repeat(np.arange(len(self.keys)), [len(x) for x in self.keys])
            keys, facts = np.concatenate(self.keys), np.array(self.facts, np.int64)
            bucket = ((keys >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket, keys, each = bucket[order], keys[order].astype(np.uint32), each[order]
            ends = (np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True)) + 1).tolist()
            rows = []
            for a, b in zip([0, *ends[:-1]], ends, strict=True):
                heads = a + np.flatnonzero(np.concatenate(([True], each[a + 1 : b] != each[a : b - 1])))
                size = np.diff(np.append(heads, b))
                times = -(-size // LONGEST)  # of a run of 600: 255, 255 and 90
                heads, left = np.repeat(heads, times), np.full(times.sum(), LONGEST)
                left[np.cumsum(times) - 1] = size - (times - 1) * LONGEST
                own = facts[each[heads]]
                rows.append((int(bucket[a]), keys[a:b].tobytes(), own[:, 0].tobytes(), own[:, 1].tobytes(), left.astype(np.uint8).tobytes()))
            kinds = (pa.int32(), *[pa.binary()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], ["bucket", "keys", "owners", "labels", "runs"])
        self.held, self.keys, self.facts = 0, [], []


def _shared(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (key, owner) entries of a bucket and their labels whose key has two
    owners or more, sorted by key and owner."""
    got = {c: [np.frombuffer(x, t) for x in table.column(c).to_pylist()] for c, t in (("keys", np.uint32), ("owners", np.int64), ("labels", np.int64), ("runs", np.uint8))}
    keys, runs = np.concatenate(got["keys"]), np.concatenate(got["runs"])
    owners, labels = (np.repeat(np.concatenate(got[c]), runs) for c in ("owners", "labels"))
    labels = labels ^ owners
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    head = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    many = np.repeat(np.minimum.reduceat(owners, head) != np.maximum.reduceat(owners, head), np.diff(np.append(head, len(keys))))
    keys, owners, labels = keys[many], owners[many], labels[order[many]]
    order = np.lexsort((owners, keys))
    keys, owners, labels = keys[order], owners[order], labels[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    return keys[new], owners[new], labels[new]


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and size of each run of equal keys."""
    head = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return head, np.diff(np.append(head, len(keys)))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _allowed(table: pa.Table, num: int, den: int) -> pa.Table:
    """Pairs of two labels that sizes and sketches allow, of all groups of a bucket.
    Within a group of blocks x < y only members of different sides meet. A pair that
    is known to share a lesser group (by its sets' least ones) is left to that one."""
    empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    got = {c: table.column(c).to_numpy() for c in ("gid", "x", "y", "side", "v", "label", "n")}
    sketches = np.stack([table.column(c).to_numpy() for c in SKETCH], 1).view(np.uint64)
    order = np.lexsort((got["v"], got["y"], got["x"], got["gid"]))
    gid, x, y, side, v, label, n = (got[c][order] for c in ("gid", "x", "y", "side", "v", "label", "n"))
    sketches = sketches[order]
    most = np.iinfo(np.int64).max
    least = np.array([(x + [most] * LEAST)[:LEAST] for x in table.column("least").to_pylist()], np.int64).reshape(-1, LEAST)[order]
    start = np.ones(len(gid), bool)
    start[1:] = (gid[1:] != gid[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    head = np.flatnonzero(start)
    size, own = np.diff(np.append(head, len(gid))), x == y
    found = []

    def near(i: np.ndarray, j: np.ndarray) -> None:
        a, b = n[i], n[j]
        keep = (label[i] != label[j]) & (own[i] | (side[i] != side[j])) & (np.minimum(a, b) * den >= np.maximum(a, b) * num)
        i, j, both = i[keep], j[keep], (a + b)[keep]
        bits = np.bitwise_count(sketches[i] ^ sketches[j]).sum(axis=1, dtype=np.int64)
        keep = bits * (den + num) <= both * (den - num)
        i, j = i[keep], j[keep]
        before = (least[i][:, :, None] == least[j][:, None, :]) & (least[i] < gid[i][:, None])[:, :, None]
        here = ~before.any(axis=(1, 2))
        found.append(np.stack((v[i[here]], v[j[here]]), 1))

    for s in np.unique(size).tolist():
        heads = head[size == s]
        for lag in range(1, s):  # members lag places apart, of all groups of this size
            step = max(1, (1 << 18) // (s - lag))
            for k in range(0, len(heads), step):
                i = (heads[k : k + step, None] + np.arange(s - lag)).ravel()
                near(i, i + lag)
    pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
    if not len(pairs):
        return empty
    pairs = np.unique(np.sort(pairs, axis=1), axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _few(df: DataFrame) -> DataFrame:
    """Marked to be sent whole if its rows, counted, are within the bound."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def jaccard_classes(docs: DataFrame, *, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", block: int = 2048, hot_key: int = 1 << 18) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))

    def name_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in chunks(batch.column(1), READ_BYTES):
                got = []
                for feats in shingle_sets(raw, offsets, n):
                    odd = int((feats & np.uint64(1)).sum())
                    got.append((len(feats), *_set_name(feats), odd - len(feats) * (den - num) // den))
                cols = [pa.array(x, pa.int64()) for x in zip(*got, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), *cols], ["doc_id", "th", "n", "v", "w", "need"])

    hashed = source.withColumn("th", F.xxhash64("text"))
    sets = settled(hashed.mapInArrow(released(name_sets), f"doc_id {kind}, th long, n long, v long, w long, need long"), "sets")
    classes = settled(sets.where("n > 0").groupBy("v", "w", "n", "need").agg(F.min("doc_id").alias("low"), F.min("th").alias("th")), "classes")
    total, most, held = classes.agg(F.sum("n"), F.max("n"), F.count(F.lit(1))).first()
    if not total:
        return sets.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    every = plans(int(most), num, den)
    buckets = max(least, int(total) // (3 << 20))

    # Which classes share enough of the odd half with others to have a link?
    def odd_half(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sender = _Sender(buckets)
        for batch in batches:
            for _, _, raw, offsets in chunks(batch.column(0), READ_BYTES):
                for feats in shingle_sets(raw, offsets, n):
                    if len(feats) and (v := _set_name(feats)[0]) not in seen:
                        seen.add(v)
                        yield from sender.add(mix(feats[(feats & np.uint64(1)) == 1]), v)
                if len(seen) > 1 << 18:
                    seen.clear()
        yield from sender.flush()

    ranges = max(least, int(held) >> 20)

    def shared_count(table: pa.Table) -> pa.Table:
        """A bucket's counts, for each range of sets in one row."""
        v, count = np.unique(_shared(table)[1], return_counts=True)
        part = (v.astype(np.uint64) % np.uint64(ranges)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        head, size = _groups(part[order])
        cut = [order[a : a + n] for a, n in zip(head.tolist(), size.tolist(), strict=True)]
        return pa.table({"part": pa.array(part[order][head], pa.int32()), "v": pa.array([v[x].tobytes() for x in cut], pa.binary()), "times": pa.array([count[x].astype(np.uint32).tobytes() for x in cut], pa.binary())})

    def summed(table: pa.Table) -> pa.Table:
        every, times = (np.concatenate([np.frombuffer(x, kind) for x in table.column(c).to_pylist()]) for c, kind in (("v", np.int64), ("times", np.uint32)))
        v, at = np.unique(every, return_inverse=True)
        return pa.table({"v": v, "shared": np.bincount(at, times, len(v)).astype(np.int64)})

    halves = source.select("text").mapInArrow(released(odd_half), BLOBS)
    counted = halves.groupBy("bucket").applyInArrow(shared_count, "part int, v binary, times binary")
    shared = counted.groupBy("part").applyInArrow(summed, "v long, shared long")
    live = classes.where("need <= 0").select("v", "th").unionByName(classes.where("need > 0").join(shared, "v").where("shared >= need").select("v", "th"))
    live = settled(live, "live")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, raw, offsets in chunks(batch.column(0), READ_BYTES):
                rows = []
                for feats in shingle_sets(raw, offsets, n):
                    if len(feats) and (v := _set_name(feats)[0]) not in seen:
                        seen.add(v)
                        rows.append((v, len(feats), signed_as(len(feats), every), feats.tobytes(), sketch(feats)))
                if rows:
                    v, size, count, blob, sk = zip(*rows, strict=True)
                    cols = [*[pa.array(x, pa.int64()) for x in (v, size, count)], pa.array(blob, pa.binary()), *[pa.array(c) for c in np.array(sk).T]]
                    yield pa.RecordBatch.from_arrays(cols, ["v", "n", "signs", "feats", *SKETCH])

    # Of equal texts the rows with the least identifier are read.
    lows = sets.groupBy("th").agg(F.min("doc_id").alias("doc_id")).join(live.select("th").distinct(), "th", "left_semi")
    wanted = hashed.join(_few(settled(lows, "lows")).toDF("_th", "_id"), (F.col("th") == F.col("_th")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")
    loaded = wanted.mapInArrow(released(load), "v long, n long, signs long, feats binary, " + ", ".join(f"{c} long" for c in SKETCH))
    loaded = settled(loaded.withColumn("id", F.monotonically_increasing_id()), "feats")
    # Equal texts in several tasks give a set again: only the rows to leave out move.
    first = loaded.groupBy("v").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("times")).where("times > 1")
    again = settled(loaded.select("v", "id").join(first, "v").where("id > low").select("id"), "again")
    feats = loaded.join(_few(again), "id", "left_anti").drop("id")
    facts = feats.drop("feats", "signs")
    signs = int(feats.agg(F.sum("signs")).first()[0] or 0)
    rooms = max(least, signs >> 20)

    # Round one: each group's members to its first, over the signatures of a few parts;
    # and how often a task meets the keys it meets often.
    def sign_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, keys, held = _Sender(least), [], 0

        def often() -> Iterator[pa.RecordBatch]:
            key, count = np.unique(np.concatenate(keys), return_counts=True)
            key, count = key[count * 256 >= min(hot_key, held)], count[count * 256 >= min(hot_key, held)]
            none = pa.array([None] * len(key), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), -1, np.int32)), none, none, none, none, pa.array(_signed(key)), pa.array(count.astype(np.int64))], names)

        names = ["bucket", "keys", "owners", "labels", "runs", "key", "times"]

        def wide(out: pa.RecordBatch) -> pa.RecordBatch:
            none = pa.array([None] * out.num_rows, pa.int64())
            return pa.RecordBatch.from_arrays([*out.columns, none, none], names)

        for batch in batches:
            for v, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(blob, np.uint64)
                yield from map(wide, sender.add(signatures(x, num, den, every, FIRST_PARTS), v))
                keys.append(signatures(x, num, den, every))
                held += len(keys[-1])
                if held >= HELD:
                    yield from often()
                    keys, held = [], 0
        if keys:
            yield from often()
        yield from map(wide, sender.flush())

    begun = settled(feats.select("v", "feats").mapInArrow(released(sign_first), BLOBS + ", key long, times long"), "signed")
    hot = settled(begun.where("bucket < 0").groupBy("key").agg(F.sum("times").alias("times")).where(F.col("times") >= hot_key), "hot")

    def stars(table: pa.Table) -> pa.Table:
        keys, owners, _ = _shared(table)
        head, size = _groups(keys)
        hub = np.repeat(owners[head], size)
        pairs = np.unique(np.stack((hub, owners), 1)[hub != owners], axis=0).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    # Hot keys have no star: their members meet in blocks.
    near = begun.where("bucket >= 0").select("bucket", "keys", "owners", "labels", "runs").groupBy("bucket").applyInArrow(stars, "a long, b long").distinct()

    def verified(near: DataFrame) -> DataFrame:
        """Candidate pairs (a, b) that link: sizes and sketches first, then whole sets."""
        a, b = (facts.select(F.col("v").alias(x), F.col("n").alias(f"n_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in SKETCH]) for x in "ab")
        bits = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in SKETCH), F.lit(0))
        fits = (F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num) & (bits * (den + num) <= (F.col("n_a") + F.col("n_b")) * (den - num))
        near = settled(_few(settled(near, "near")).join(a, "a").join(b, "b").where(fits).select("a", "b"), "close")
        # Sets stay where they are read if the pairs are few enough to be sent: then
        # only the second members' sets, and each hub's once, meet in a shuffle.
        side = lambda x: feats.select(F.col("v").alias(x), F.col("feats").alias(f"{x}_feats"))
        sent = _few(near)
        firsts = side("a").join(_few(near.select("a").distinct()), "a", "left_semi")
        both = side("b").join(sent, "b").join(firsts, "a")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    z = np.sort(np.concatenate((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))))
                    both = int((z[1:] == z[:-1]).sum())
                    keep.append(den * both >= num * (len(z) - both))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return both.select("a", "b", "a_feats", "b_feats").mapInArrow(released(compare), "a long, b long")

    joined = components(settled(verified(near), "links"))
    labels = settled(joined, "labels")
    labelled = feats.select("v", "feats").join(_few(labels).withColumnRenamed("vertex", "v"), "v", "left").select("v", F.coalesce("label", "v").alias("label"), "feats")
    # At least hot_key entries each, so few among all.
    hot_keys = {int(k) for (k,) in hot.select("key").collect()}

    # Round two: all signatures; groups of two labels or more meet.
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Kinds by bucket: entries of keys, or (-1) a member of a hot key's group."""
        sender, apart = _Sender(rooms), np.array(sorted(hot_keys), np.int64)
        for batch in batches:
            for v, label, blob in zip(*[batch.column(j).to_pylist() for j in range(3)], strict=True):
                keys = signatures(np.frombuffer(blob, np.uint64), num, den, every)
                if len(apart):
                    is_hot = np.isin(_signed(keys), apart)
                    for key in np.unique(keys[is_hot]):
                        own = np.int64(v).tobytes()
                        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), *[pa.array([x], pa.binary()) for x in (key.tobytes(), own, own, b"")]], ["bucket", "keys", "owners", "labels", "runs"])
                    keys = keys[~is_hot]
                yield from sender.add(keys, v, label)
        yield from sender.flush()

    def mixed(table: pa.Table) -> pa.Table:
        """Members of groups with two labels or more, each set of members once: its
        name, its size, the member."""
        keys, owners, labels = _shared(table)
        head, size = _groups(keys)
        if not len(head):
            return pa.table({c: pa.array([], pa.int64()) for c in ("gid", "size", "v")})
        keep = np.minimum.reduceat(labels, head) != np.maximum.reduceat(labels, head)
        name = np.add.reduceat(mix(owners.view(np.uint64)), head)
        _, first = np.unique(np.where(keep, name, 0), return_index=True)
        chosen = np.zeros(len(head), bool)
        chosen[first] = True
        chosen &= keep
        at = np.repeat(chosen, size)
        return pa.table({"gid": np.repeat(_signed(name[chosen]), size[chosen]), "size": np.repeat(size[chosen], size[chosen]).astype(np.int64), "v": owners[at]})

    signed = labelled.mapInArrow(released(sign), BLOBS)
    if hot_keys:
        signed = settled(signed, "signed")
    places = signed.where("bucket >= 0").groupBy("bucket").applyInArrow(mixed, "gid long, size long, v long")
    if hot_keys:
        long_of = lambda c: F.conv(F.hex(F.reverse(F.col(c))), 16, -10).cast("long")
        members = signed.where("bucket < 0").select(long_of("keys").alias("gid"), long_of("owners").alias("v"))
        places = places.unionByName(members.join(F.broadcast(hot), F.col("gid") == F.col("key")).select("gid", F.col("times").alias("size"), "v"))
    places = settled(places.distinct(), "places")

    # Groups of many members as pairs of blocks, then groups dealt into buckets by their size.
    count, = places.agg(F.sum(F.ceil(F.col("size") / block))).first()
    tasks = max(least, int(count or 0) // 200_000)
    blocks, own = F.ceil(F.col("size") / block).cast("int"), F.pmod(F.xxhash64("v"), F.ceil(F.col("size") / block)).cast("int")
    dealt = places.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("v", "gid", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"))
    described = facts.join(_few(labels).withColumnRenamed("vertex", "v"), "v", "left").withColumn("label", F.coalesce("label", "v"))
    least_groups = places.groupBy("v").agg(F.slice(F.array_sort(F.collect_list("gid")), 1, LEAST).alias("least"))
    met = dealt.join(described.join(least_groups, "v"), "v").withColumn("bucket", F.pmod(F.xxhash64("gid", "x", "y"), F.lit(tasks)))
    near = met.groupBy("bucket").applyInArrow(lambda t: _allowed(t, num, den), "a long, b long").distinct()

    edges = labels.select(F.col("vertex").alias("a"), F.col("label").alias("b")).unionByName(settled(verified(near), "links"))
    found = settled(components(edges).withColumnRenamed("vertex", "v"), "found")
    named = classes.select("v", "w", "n", "low").join(_few(found), "v", "left").select("v", "w", "n", "low", F.coalesce("label", "v").alias("label"))
    named = settled(named, "named")
    lows = named.groupBy("label").agg(F.min("low").alias("component_id"))
    names = named.join(lows, "label").select("v", "w", "n", "component_id")
    # Copies of one text meet in a join whose other side has one row: Spark splits that.
    out = sets.where("n > 0").join(names, ["v", "w", "n"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(empty)
