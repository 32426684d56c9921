"""Removal of repeated byte strings, ordered by deep-shallow sorting.

Every window of `width` bytes has a canonical anchor: the leftmost of its least
hashed GRAM-byte strings. Equal windows have equal anchors at equal distance, so
only windows whose anchor occurs twice or more (in the distinct texts) can be
repeated, and equal windows meet in the anchor's group. There their suffixes are
sorted to `width`: multikey quicksort by words of 8 bytes down to SHALLOW bytes,
then blind tries, whose branches are found from common-prefix lengths with a
leading suffix without ordering the bytes in between. Windows that no suffix
shares drop out; leaves that hold several are repeated.

Windows at anchors of more than HOT places are sorted the same way where they are
read: of equal ones in a chunk one is sent on, the others are marked there. Their
groups are divided by half a window of bytes behind or before the anchor, which equal
windows share too. So a string that all documents hold costs one window a chunk and
no window is judged without comparing bytes; HOT decides where work is done, not the
result. Equal texts (by 64-bit hash and SHA-256) are one text with a count: all of a
text of `width` bytes or more that occurs twice is removed.

A null counts as empty. Repeated rows are copies, so they are removed whole from
`width` bytes on; texts that repeat themselves lose both places. Ties don't arise:
all places of a repeated window go. Memory follows the longest text. Extra columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import settled
from kinfold.llm.textbytes import BYTE_VALUE, buffers, chunks, mix, prefix_hash, span_hash

GRAM, SHALLOW, HOT = 32, 32, 1024
BROADCAST_ROWS = 500_000
_LOW = np.uint64((1 << 24) - 1)


def anchors(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(hash, place, first window, last window) of each canonical anchor of a
    chunk, and the prefix hash. Windows and places count from the chunk's start."""
    reach = width - GRAM + 1
    prefix = prefix_hash(BYTE_VALUE[raw])
    none = np.empty(0, np.int64)
    m = len(raw) - GRAM + 1
    if len(raw) < width:
        return none.astype(np.uint64), none, none, none, prefix
    at = np.arange(m)
    h = mix(span_hash(prefix, at, at + GRAM))
    key = (h & ~_LOW) | (at.astype(np.uint64) & _LOW)
    blocks = -(-m // reach)
    padded = np.full(blocks * reach, np.iinfo(np.uint64).max, np.uint64)
    padded[:m] = key
    grid = padded.reshape(blocks, reach)
    upto = np.minimum.accumulate(grid, axis=1).ravel()
    since = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(raw) - width + 1
    least = np.minimum(since[:n], upto[reach - 1 : reach - 1 + n])
    valid = np.zeros(len(raw) + 1, np.int32)
    long = offsets[1:] - offsets[:-1] >= width
    np.add.at(valid, offsets[:-1][long], 1)
    np.add.at(valid, offsets[1:][long] - width + 1, -1)
    s = np.flatnonzero(np.cumsum(valid)[:n] > 0)
    if not len(s):
        return none.astype(np.uint64), none, none, none, prefix
    place = s + ((least[s] - s.astype(np.uint64)) & _LOW).astype(np.int64)
    head = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (s[1:] != s[:-1] + 1))))
    first, last = s[head], s[np.append(head[1:], len(s)) - 1]
    return h[place[head]], place[head], first, last, prefix


def repeated_windows(buf: np.ndarray, start: np.ndarray, group: np.ndarray, width: int) -> np.ndarray:
    """For each window (starts in buf, sorted by group) the first one that equals it in
    its group, -1 if none does. Deep-shallow sorting; buf has 8 spare bytes behind."""
    words = np.lib.stride_tricks.as_strided(buf[:8].view(np.uint64), (len(buf) - 7,), (1,))
    out = np.full(len(start), -1)
    live = np.arange(len(start))

    def regroup(live: np.ndarray, group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Split groups by value and drop what is alone."""
        head = _heads(group)
        size = np.diff(np.append(head, len(group)))
        same = value == np.repeat(value[head], size)
        split = np.repeat(~np.logical_and.reduceat(same, head), size)
        if split.any():
            rows = np.flatnonzero(split)
            order = np.lexsort((live[rows], value[rows], group[rows]))
            live, group, value = live.copy(), group.copy(), value.copy()
            live[rows], value[rows] = live[rows[order]], value[rows[order]]
            fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (split[1:] & (value[1:] != value[:-1]))))
            group = np.cumsum(fresh)
        return _without_singles(live, group)

    live, group = _without_singles(live, group)
    for depth in range(0, min(SHALLOW, width - 7), 8):  # shallow: multikey by words
        if not len(live):
            return out
        live, group = regroup(live, group, words[start[live] + depth])
    known = np.full(len(live), min(SHALLOW, (width // 8) * 8))
    while len(live):  # deep: one level of all blind tries at a time
        head = _heads(group)
        size = np.diff(np.append(head, len(group)))
        lead = np.repeat(start[live[head]], size)
        own = start[live]
        lcp = known.copy()
        go = np.arange(len(live))
        while len(go):
            go = go[lcp[go] < width]
            diff = words[own[go] + lcp[go]] ^ words[lead[go] + lcp[go]]
            equal = diff == 0
            some = ~equal
            low = diff[some] & (~diff[some] + np.uint64(1))  # the lowest differing bit
            lcp[go[some]] += (np.log2(low.astype(np.float64)).astype(np.int64)) >> 3
            go = go[equal]
            lcp[go] += 8
        lcp = np.minimum(lcp, width)
        low = np.minimum.reduceat(lcp, head)
        done = np.repeat(low >= width, size)
        out[live[done]] = np.repeat(np.minimum.reduceat(live, head), size)[done]
        live, group, known = live[~done], group[~done], np.repeat(low, size)[~done]
        if len(live):
            byte = buf[start[live] + known]
            at_depth = np.empty(len(start), np.int64)
            at_depth[live] = known
            live, group = regroup(live, group, byte.astype(np.uint64))
            known = at_depth[live]
    return out


def _heads(group: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.empty(0, np.int64)


def _heads_by(kind: np.ndarray, place: np.ndarray) -> np.ndarray:
    """First places of runs of one kind whose places follow one another."""
    if not len(kind):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], (kind[1:] != kind[:-1]) | (place[1:] != place[:-1] + 1))))


def _tails(head: np.ndarray, n: int) -> list[int]:
    return [*head[1:].tolist(), n] if len(head) else []


def _without_singles(live: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    head = _heads(group)
    size = np.diff(np.append(head, len(group)))
    keep = np.repeat(size > 1, size)
    return live[keep], group[keep]


def _runs(owner: np.ndarray, s: np.ndarray, width: int) -> Iterator[tuple[int, bytes]]:
    """Byte spans of repeated windows for each owner (input sorted by both)."""
    if not len(s):
        return
    head = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (s[1:] > s[:-1] + width))))
    begin, end = s[head], s[np.append(head[1:], len(s)) - 1] + width
    own = owner[head]
    cut = np.flatnonzero(np.append(own[1:] != own[:-1], True)) + 1
    a = 0
    for b in cut.tolist():
        yield int(own[a]), np.stack((begin[a:b], end[a:b]), 1).astype(np.int64).tobytes()
        a = b


def _column(table: pa.Table, name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]


def _marks(rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"t": pa.array([r[0] for r in rows], pa.int64()), "spans": pa.array([r[1] for r in rows], pa.binary())})


def remove_repeats(docs: DataFrame, *, width: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("t", F.xxhash64("text"))
    named = settled(source.select("doc_id", "t", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.encode("text", "utf-8"), 256).alias("sha")), "texts")
    classes = named.groupBy("t", "sha").agg(F.count(F.lit(1)).alias("copies"))
    total = named.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(parts, total // (256 << 20))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            names = batch.column(1).to_numpy()
            for a, b, raw, offsets in chunks(batch.column(0)):
                h, place, _, _, _ = anchors(raw, offsets, width)
                doc = np.searchsorted(offsets, place, "right") - 1
                fresh = np.array([not (x in seen or seen.add(x)) for x in names[a:b].tolist()])
                keep = fresh[doc]
                if len(seen) > 1 << 20:
                    seen.clear()
                h, place, doc = h[keep], place[keep], doc[keep]
                bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                bucket, h, pos, own = bucket[order], h[order].astype(np.uint32), (place - offsets[doc])[order], names[a:b][doc[order]]
                head = _heads(bucket)
                rows = [(int(bucket[x]), h[x:y].tobytes(), own[x:y].tobytes(), pos[x:y].astype(np.uint32).tobytes()) for x, y in zip(head.tolist(), _tails(head, len(h)), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["bucket", "h", "t", "pos"])

    def shared(table: pa.Table) -> pa.Table:
        h, t, pos = (np.concatenate(_column(table, c, k)) for c, k in (("h", np.uint32), ("t", np.int64), ("pos", np.uint32)))
        order = np.lexsort((pos, t, h))
        h, t, pos = h[order], t[order], pos[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (t[1:] != t[:-1]) | (pos[1:] != pos[:-1])))
        h, t, pos = h[new], t[new], pos[new]
        head = _heads(h)
        size = np.repeat(np.diff(np.append(head, len(h))), np.diff(np.append(head, len(h))))
        many = size > 1
        t, note = t[many], pos[many].astype(np.int64) * 2 + (size[many] > HOT)
        order = np.argsort(t, kind="stable")
        t, note = t[order], note[order]
        head = _heads(t)
        return pa.table({"t": t[head], "places": pa.array([note[x:y].tobytes() for x, y in zip(head.tolist(), _tails(head, len(t)), strict=True)], pa.binary())})

    found = source.select("text", "t").mapInArrow(find, "bucket int, h binary, t binary, pos binary")
    places = settled(found.groupBy("bucket").applyInArrow(shared, "t long, places binary").groupBy("t").agg(F.collect_list("places").alias("places")), "places")
    # One row of each text that has such an anchor; beyond the bound the join shuffles.
    wanted = named.groupBy("t").agg(F.min("doc_id").alias("doc_id")).join(places.select("t"), "t", "left_semi")
    n = wanted.limit(BROADCAST_ROWS + 1).count()
    picked = source.join(F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted, (source["t"] == wanted["t"]) & source["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi")
    texts = settled(picked.select("t", "text"), "suspects")  # repeated rows may give a text twice
    n_places = places.agg(F.sum(F.aggregate("places", F.lit(0).cast("long"), lambda x, y: x + F.octet_length(y)))).first()[0] or 0
    groups = max(parts, n_places // 8 * (width + 76) // (8 << 20))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        for batch in batches:
            notes = batch.column(2).to_pylist()
            names = batch.column(0).to_numpy()
            for a, b, raw, offsets in chunks(batch.column(1)):
                h, place, first, last, prefix = anchors(raw, offsets, width)
                wanted = [np.frombuffer(x, np.int64) for x in (b"".join(n) for n in notes[a:b])]
                doc = np.repeat(np.arange(b - a), [len(x) for x in wanted])
                flat = np.concatenate(wanted)
                base = (flat >> 1) + offsets[doc]
                order = np.argsort(base)
                base, hot = base[order], (flat[order] & 1).astype(bool)
                at = np.minimum(np.searchsorted(base, place), len(base) - 1)
                hit = base[at] == place
                h, place, first, last, hot = h[hit], place[hit], first[hit], last[hit], hot[at[hit]]
                doc = np.searchsorted(offsets, place, "right") - 1
                rows = []
                bucket = ((h >> np.uint64(32)) % np.uint64(groups)).astype(np.int32)
                for x in _by_bucket(bucket, ~hot):
                    body = [raw[i : j + width].tobytes() for i, j in zip(first[x].tolist(), last[x].tolist(), strict=True)]
                    own = names[a:b][doc[x]]
                    shape = np.stack((first[x] - offsets[doc[x]], last[x] - first[x] + 1, place[x] - first[x]), 1).astype(np.int64)
                    rows.append((0, int(bucket[x[0]]), h[x].tobytes(), own.tobytes(), shape.tobytes(), b"".join(body)))
                if hot.any():
                    h, place, first, last, doc = h[hot], place[hot], first[hot], last[hot], doc[hot]
                    size = last - first + 1
                    each = np.repeat(np.arange(len(size)), size)
                    s = first[each] - (np.cumsum(size) - size)[each] + np.arange(len(each))
                    reach = place[each] - s
                    group = mix(h[each] + reach.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    order = np.argsort(group, kind="stable")
                    twin = np.empty(len(order), np.int64)
                    got = repeated_windows(np.concatenate((raw, np.zeros(16, np.uint8))), s[order], group[order], width)
                    twin[order] = np.where(got >= 0, order[got], -1)
                    # Known here already: marked now, and one of them is sent.
                    known = np.flatnonzero(twin >= 0)
                    known = known[np.lexsort((s[known], doc[each[known]]))]
                    for k, spans in _runs(doc[each[known]], s[known], width):
                        spans = (np.frombuffer(spans, np.int64) - offsets[k]).tobytes()
                        rows.append((2, 0, b"", np.array([names[a + k]], np.int64).tobytes(), spans, b""))
                    sent = np.flatnonzero((twin < 0) | (twin == np.arange(len(twin))))
                    # Runs of one anchor and one side of it; the side names the group.
                    half = (width - GRAM) // 2
                    after = reach[sent] <= half
                    head = _heads_by(each[sent] * 2 + after, s[sent])
                    lead = sent[head]
                    at, after = place[each[lead]], after[head]
                    key = mix(span_hash(prefix, np.where(after, at, at - half - 1), np.where(after, at + width - half, at + GRAM)) + after.astype(np.uint64))
                    count = np.diff(np.append(head, len(sent)))
                    bucket = ((key >> np.uint64(32)) % np.uint64(groups)).astype(np.int32)
                    own_doc = doc[each[lead]]
                    for x in _by_bucket(bucket, np.ones(len(lead), bool)):
                        body = [raw[i : i + n + width - 1].tobytes() for i, n in zip(s[lead[x]].tolist(), count[x].tolist(), strict=True)]
                        shape = np.stack((s[lead[x]] - offsets[own_doc[x]], count[x], reach[lead[x]]), 1).astype(np.int64)
                        rows.append((0, int(bucket[x[0]]), key[x].tobytes(), names[a:b][own_doc[x]].tobytes(), shape.tobytes(), b"".join(body)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], ["kind", "bucket", "h", "t", "shape", "body"])

    def sort_windows(table: pa.Table) -> pa.Table:
        h, t = (np.concatenate(_column(table, c, k)) for c, k in (("h", np.uint64), ("t", np.int64)))
        shape = np.concatenate(_column(table, "shape", np.int64)).reshape(-1, 3)
        buf = np.frombuffer(b"".join(table.column("body").to_pylist()) + bytes(16), np.uint8)
        s0, count, reach = shape.T
        body = np.concatenate(([0], np.cumsum(count + width - 1)[:-1]))
        # The same text may have come twice (repeated rows): keep one of each place.
        order = np.lexsort((s0, t))
        new = np.concatenate(([True], (t[order][1:] != t[order][:-1]) | (s0[order][1:] != s0[order][:-1])))
        keep = order[new]
        h, t, s0, count, reach, body = h[keep], t[keep], s0[keep], count[keep], reach[keep], body[keep]
        each = np.repeat(np.arange(len(count)), count)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        # Equal windows have equal distance to their anchor.
        group = mix(h[each] + (reach[each] - step).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(group, kind="stable")
        start = (body[each] + step)[order]
        got = np.zeros(len(order), bool)
        got[order] = repeated_windows(buf, start, group[order], width) >= 0
        owner, s = t[each[got]], (s0[each] + step)[got]
        order = np.lexsort((s, owner))
        return _marks(list(_runs(owner[order], s[order], width)))

    sent = settled(texts.join(places, "t").select("t", "text", "places").mapInArrow(spread, "kind int, bucket int, h binary, t binary, shape binary, body binary"), "windows")
    kind = "t long, spans binary"
    sorted_ = sent.where("kind = 0").groupBy("bucket").applyInArrow(sort_windows, kind)
    known = sent.where("kind = 2").select("t", F.col("shape").alias("spans")).mapInArrow(_unpack, kind)
    marks = sorted_.unionByName(known).groupBy("t").agg(F.collect_list("spans").alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            rows = []
            for k, spans in enumerate(batch.column(2).to_pylist()):
                own = raw[offsets[k] : offsets[k + 1]]
                edge = np.zeros(len(own) + 1, np.int32)
                pairs = np.frombuffer(b"".join(spans), np.int64).reshape(-1, 2)
                np.add.at(edge, pairs[:, 0], 1)
                np.add.at(edge, pairs[:, 1], -1)
                gone = np.cumsum(edge)[:-1] > 0
                rows.append((hashlib.sha256(own.tobytes()).hexdigest(), int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(own[~gone].tobytes()).hexdigest()))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3])], ["t", "sha", "n_removed", "n_spans", "kept"])

    cuts = texts.join(marks, "t").select("t", "text", "spans").mapInArrow(cut, "t long, sha string, n_removed long, n_spans long, kept string").groupBy("t", "sha").agg(F.first("n_removed").alias("n_removed"), F.first("n_spans").alias("n_spans"), F.first("kept").alias("kept"))
    facts = classes.join(cuts, ["t", "sha"], "left").where("copies > 1 or n_removed is not null")
    out = named.join(facts, ["t", "sha"], "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= width)
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )


def _by_bucket(bucket: np.ndarray, mask: np.ndarray) -> Iterator[np.ndarray]:
    rows = np.flatnonzero(mask)
    rows = rows[np.argsort(bucket[rows], kind="stable")]
    head = _heads(bucket[rows])
    for x, y in zip(head.tolist(), _tails(head, len(rows)), strict=True):
        yield rows[x:y]


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        t = np.concatenate([np.frombuffer(x, np.int64) for x in batch.column(0).to_pylist()]) if batch.num_rows else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(t), batch.column(1)], ["t", "spans"])
