"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of order ORDER over the bytes of whole texts, across
word borders (a text begins behind ORDER spaces). A byte costs the escapes of the
longer contexts that the language has seen without it, then its own code length in
the longest context that has it (method C: n / (N + D), escape D / (N + D)); at the
bottom all bytes are equal. The statistics are frozen before scoring, and each
distinct context of a chunk is scored once.

Training takes a bounded sample: of each language the documents whose hash lies under
a share that follows from the language's counted bytes, so that all languages together
train on about train_bytes (a parameter), at least some documents each. Model size and
what reaches the driver are bounded by it, whatever the size and the number of texts.

A null text, one without a letter, or a corpus without training documents gives `und`
and score 0. Among languages of equal code length the first by name is taken.
Repeated rows get equal rows; a very long text is scored whole, memory follows the
longest; extra columns are ignored, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.textbytes import chunks

ORDER = 5
READ_BYTES = 512 << 10
#: Documents of a language that training takes at least, as expected.
LEAST_DOCS = 20
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def context_keys(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte of a chunk of texts the ORDER bytes before it in its text, and
    the byte itself in the low byte."""
    key = raw.astype(np.uint64)
    place = np.arange(len(raw)) - np.repeat(offsets[:-1], np.diff(offsets))
    for j in range(1, ORDER + 1):
        before = np.full(len(raw), 32, np.uint64)
        before[j:] = raw[:-j]
        before[place < j] = 32
        key |= before << np.uint64(8 * j)
    return key


def _low(key: np.ndarray, count: int) -> np.ndarray:
    """The low bytes of a key."""
    return key & np.uint64((1 << 8 * count) - 1)


class ContextTrees:
    """Frozen code lengths in bits: for each order the (context, byte) keys seen in
    any language, with one cost for each language, and the contexts' escapes."""

    def __init__(self, langs: list[str], counts: tuple[np.ndarray, np.ndarray, np.ndarray]):
        """counts: language, key of the longest context, and how often."""
        self.langs = langs
        n_langs = len(langs)
        self.keys, self.cost, self.contexts, self.escape = [], [], [], []
        lang, longest, n = counts
        for order in range(ORDER + 1):
            keys, place = np.unique(_low(longest, order + 1), return_inverse=True)
            seen = np.zeros((len(keys), n_langs))
            np.add.at(seen, (place, lang), n)
            contexts, at = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((len(contexts), n_langs)), np.zeros((len(contexts), n_langs))
            np.add.at(total, at, seen)
            np.add.at(kinds, at, seen > 0)
            some = total > 0
            escape = np.where(some, -np.log2(np.where(some, kinds, 1) / np.where(some, total + kinds, 1)), 0).astype(np.float32)
            below = self.bits(_low(keys, order), order - 1) if order else np.full((len(keys), n_langs), 8.0)
            with np.errstate(divide="ignore"):
                cost = np.where(seen > 0, -np.log2(np.where(seen > 0, seen, 1) / np.maximum(total + kinds, 1)[at]), escape[at] + below).astype(np.float32)
            self.keys.append(keys)
            self.cost.append(cost)
            self.contexts.append(contexts)
            self.escape.append(escape)

    def bits(self, key: np.ndarray, order: int) -> np.ndarray:
        """Code length of each key's byte in its context, for each language."""
        out = np.zeros((len(key), len(self.langs)))
        todo = np.arange(len(key))
        for o in range(order, -1, -1):
            k = _low(key[todo], o + 1)
            found = self._find(self.keys[o], k)
            hit = found >= 0
            out[todo[hit]] += self.cost[o][found[hit]]
            todo, k = todo[~hit], k[~hit]
            if not len(todo):
                return out
            context = self._find(self.contexts[o], k >> np.uint64(8))
            known = context >= 0
            out[todo[known]] += self.escape[o][context[known]]
        out[todo] += 8.0
        return out

    @staticmethod
    def _find(table: np.ndarray, key: np.ndarray) -> np.ndarray:
        if not len(table):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(table, key), len(table) - 1)
        return np.where(table[at] == key, at, -1)

    def text_bits(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each text in each language."""
        key, back = np.unique(context_keys(raw, offsets), return_inverse=True)
        each, owner = self.bits(key, ORDER), np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        return np.stack([np.bincount(owner, each[:, k][back], len(offsets) - 1) for k in range(len(self.langs))], 1)


def train(docs: DataFrame, lang: Column, usable: Column, *, train_bytes: int, id_col: str, text_col: str) -> ContextTrees | None:
    """Count contexts over the sample, which a hash of the identifier chooses."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), lang.alias("lang")).where(usable & F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    known = base.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.octet_length("text")).alias("bytes")).collect()  # one row a language
    if not known:
        return None
    each = train_bytes / len(known)
    share = {r["lang"]: min(1.0, max(each / max(r["bytes"], 1), LEAST_DOCS / r["docs"])) for r in known}
    shares = F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(v))])
    chosen = base.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.element_at(shares, F.col("lang")) * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in chunks(batch.column(0), READ_BYTES):
                names = np.repeat(np.array(batch.column(1).slice(a, b - a).to_pylist(), object), np.diff(offsets))
                keys = context_keys(raw, offsets)
                for name in sorted(set(names.tolist())):
                    key, n = np.unique(keys[names == name], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(key)), pa.array(key.view(np.int64)), pa.array(n)], ["lang", "key", "n"])

    # Bounded by train_bytes: no more keys than bytes.
    got = chosen.select("text", "lang").mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    if not got.num_rows:
        return None
    langs = sorted(set(got["lang"].to_pylist()))
    which = np.searchsorted(np.array(langs), np.array(got["lang"].to_pylist()))
    return ContextTrees(langs, (which, got["key"].to_numpy().view(np.uint64), got["n"].to_numpy().astype(float)))


def identify_languages(docs: DataFrame, *, held_out: Column, train_bytes: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score (the posterior of lang_pred under equal
    priors) and bits_per_byte."""
    trees = train(docs, F.col(lang_col), ~held_out, train_bytes=train_bytes, id_col=id_col, text_col=text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in chunks(batch.column(2), READ_BYTES):
                n = b - a
                letters = np.concatenate(([0], np.cumsum(_LETTER[raw])))
                spoken = letters[offsets[1:]] > letters[offsets[:-1]]
                for k in np.flatnonzero(~spoken & (offsets[1:] > offsets[:-1])).tolist():
                    spoken[k] = any(map(str.isalpha, raw[offsets[k] : offsets[k + 1]].tobytes().decode()))
                pred, score, rate = np.full(n, "und", object), np.zeros(n), np.zeros(n)
                if trees:
                    bits = np.round(trees.text_bits(raw, offsets), 4)
                    best = bits.argmin(axis=1)
                    least = bits[np.arange(n), best]
                    pred[spoken] = np.array(trees.langs, object)[best[spoken]]
                    score = np.where(spoken, 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1), 0.0)
                    rate = np.where(spoken, least / np.maximum(np.diff(offsets), 1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, n), batch.column(1).slice(a, n), pa.array(pred.tolist(), pa.string()), pa.array(np.round(score, 9)), pa.array(np.round(rate, 6))], ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text.alias("text")).mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, bits_per_byte double")
