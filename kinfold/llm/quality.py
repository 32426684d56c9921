"""Quality rules: counted rules, then a hashed n-gram log-likelihood ratio.

The trusted target is a bounded sample of labelled good documents (the bound is
a parameter); the raw corpus is every byte n-gram of every document. A document's
verdict is the mean, over its n-grams, of log(p_target / p_raw), against a fixed
threshold. Without trusted documents the verdict is that of the counted rules.

A null text counts as empty and fails the counted rules. Repeated rows get equal
rows. A score equal to the threshold is kept. A very long text is judged whole, memory
follows the longest. Extra columns are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.textbytes import BYTE_VALUE, SPACE, chunks, mix, prefix_hash, released, span_hash, window_hashes, words

#: Fixed values of the counted rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED, REPEAT_WINDOW = 50, 50, 3

BUCKETS = 1 << 16
NGRAM = 4
#: Raw counts are smoothed by SMOOTH a bucket, the target by BLEND of its own size.
SMOOTH, BLEND = 2.0, 0.05

_is_symbol = np.zeros(256, bool)
_is_symbol[list(SYMBOLS)] = True
_rng = np.random.default_rng(7919)
_CELLS = _rng.integers(0, BUCKETS, (NGRAM, 256), dtype=np.uint16)


def _per_doc(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _again(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: does its value occur twice or more; did it occur before."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    later = np.concatenate(([False], same))
    many = later | np.append(same, False)
    out_many, out_later = np.empty(len(h), bool), np.empty(len(h), bool)
    out_many[order], out_later[order] = many, later
    return out_many, out_later


def counted(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counted figures of each document of a chunk."""
    starts, ends, first = words(raw, offsets)
    n_words = np.diff(first)
    ink = ~SPACE[raw]
    prefix = prefix_hash(BYTE_VALUE[raw])
    w = mix(span_hash(prefix, starts, ends) + (ends - starts).astype(np.uint64))
    doc = np.repeat(np.arange(len(n_words), dtype=np.uint64), n_words)
    covered = np.zeros(len(w), bool)
    tri = window_hashes(w, REPEAT_WINDOW)
    if len(tri):
        inside = doc[REPEAT_WINDOW - 1 :] == doc[: len(tri)]
        at = np.flatnonzero(inside)
        many, _ = _again(mix(tri[at] + doc[at] * np.uint64(0x9E3779B97F4A7C15)))
        for j in range(REPEAT_WINDOW):
            covered[at[many] + j] = True
    # Lines end at a newline or at the document's end.
    breaks = np.flatnonzero(raw == 10)
    line_starts = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    line_starts = line_starts[line_starts < len(raw)]
    line_ends = np.append(line_starts[1:], len(raw))
    ends_nl = line_ends > line_starts
    line_ends = line_ends - (ends_nl & (raw[np.maximum(line_ends - 1, 0)] == 10)) if len(raw) else line_ends
    with_word = np.concatenate(([0], np.cumsum(ink)))
    real = with_word[line_ends] > with_word[line_starts]
    line_starts, line_ends = line_starts[real], line_ends[real]
    line_doc = np.searchsorted(offsets, line_starts, "right") - 1
    # Empty documents share an offset; the last of them owns the bytes.
    lh = mix(span_hash(prefix, line_starts, line_ends) + (line_ends - line_starts).astype(np.uint64)) + line_doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    _, later = _again(mix(lh))
    return {
        "n_words": n_words,
        "word_chars": _per_doc(ink & ((raw & 0xC0) != 0x80), offsets),
        "n_symbols": _per_doc(_is_symbol[raw], offsets),
        "n_dup_lines": np.bincount(line_doc[later], minlength=len(n_words)),
        "n_repeat_words": _per_doc(covered, first),
    }


def cells(raw: np.ndarray) -> np.ndarray:
    """Bucket of the n-gram that starts at each byte (len(raw) - NGRAM + 1)."""
    m = max(0, len(raw) - NGRAM + 1)
    out = _CELLS[0][raw[:m]]
    for j in range(1, NGRAM):
        out ^= _CELLS[j][raw[j : j + m]]
    return out


def _ngram_bounds(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - (NGRAM - 1))


def fit_ratio(docs: DataFrame, labels: DataFrame, *, most_labelled: int, id_col: str, text_col: str) -> np.ndarray | None:
    """log(p_target / p_raw) for each bucket, or None without trusted documents.

    One pass over all documents; at most most_labelled labelled rows (those of
    least hash) are marked as trusted, so that list is sent whole."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    sample = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled).select(F.col("doc_id").alias("_good"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("_good"), "left").select("text", F.col("_good").isNotNull().alias("good"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw_n, good_n = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            good = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for a, b, raw, offsets in chunks(batch.column(0)):
                c = cells(raw)
                lo, hi = _ngram_bounds(offsets)
                edge = np.zeros(len(raw) + 1, np.int32)
                np.add.at(edge, lo, 1)
                np.add.at(edge, hi, -1)
                inside = np.cumsum(edge)[: len(c)] > 0
                raw_n += np.bincount(c[inside], minlength=BUCKETS)
                if good[a:b].any():
                    mark = np.zeros(len(raw) + 1, np.int32)
                    np.add.at(mark, lo[good[a:b]], 1)
                    np.add.at(mark, hi[good[a:b]], -1)
                    good_n += np.bincount(c[np.cumsum(mark)[: len(c)] > 0], minlength=BUCKETS)
        some = np.flatnonzero(raw_n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(raw_n[some]), pa.array(good_n[some])], ["bucket", "raw_n", "good_n"])

    counts = marked.mapInArrow(released(run), "bucket int, raw_n long, good_n long").groupBy("bucket").agg(F.sum("raw_n").alias("raw_n"), F.sum("good_n").alias("good_n")).toArrow()
    raw_n, good_n = np.zeros(BUCKETS), np.zeros(BUCKETS)  # at most BUCKETS rows came
    at = counts["bucket"].to_numpy()
    raw_n[at], good_n[at] = counts["raw_n"].to_numpy(), counts["good_n"].to_numpy()
    if not good_n.sum():
        return None
    # The target is smoothed towards the raw corpus, which has every n-gram.
    p_raw = (raw_n + SMOOTH) / (raw_n.sum() + SMOOTH * BUCKETS)
    p_good = (good_n / good_n.sum() + BLEND * p_raw) / (1 + BLEND)
    return np.log(p_good / p_raw).astype(np.float32)


def quality_rules(docs: DataFrame, labels: DataFrame, *, threshold: float = -0.38, most_labelled: int = 20_000, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the counted figures, base_failed, llr, kept; kept_<column> for each of keep."""
    ratio = fit_ratio(docs, labels, most_labelled=most_labelled, id_col=id_col, text_col=text_col)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in chunks(batch.column(1)):
                got = counted(raw, offsets)
                score = np.zeros(b - a)
                if ratio is not None:
                    lo, hi = _ngram_bounds(offsets)
                    total = np.concatenate(([0.0], np.cumsum(ratio[cells(raw)], dtype=np.float64)))
                    hi, lo = np.minimum(hi, len(total) - 1), np.minimum(lo, len(total) - 1)
                    score = (total[hi] - total[lo]) / np.maximum(hi - lo, 1)
                failed = (got["n_words"] < LEAST_WORDS) | (100 * got["n_repeat_words"] > MOST_REPEATED * got["n_words"])
                score = np.round(score, 9)
                cols = [pa.array(x.astype(np.int64)) for x in got.values()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *cols, pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold)), *[batch.column(at[c]).slice(a, b - a) for c in keep]], ["doc_id", *got, "base_failed", "llr", "kept", *names])

    names = [f"kept_{c}" for c in keep]
    # The text travels once, as it is: the kernels read a null as empty.
    at = {c: k + 2 for k, c in enumerate(c for c in keep if c != text_col)} | {text_col: 1}
    more = "".join(f", `{name}` {docs.schema[c].dataType.simpleString()}" for name, c in zip(names, keep, strict=True))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"kept_{c}") for c in at if c != text_col]).mapInArrow(released(run), f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, llr double, kept boolean{more}")
