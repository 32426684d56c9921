"""Token counts of BPE piece models by rank-synchronous array merging.

Pre-tokens are held as one ragged array of symbols; each round finds every
sequence's lowest-rank adjacent pair and applies it to all sequences at once.
What survives is counted. Sequences of over SHORT_ROW symbols in which a pair could
interact with its own result (a run of one letter, say) go through a queue instead,
lowest rank first, then leftmost: the same counts, without a round an occurrence. Among
equal ranks the leftmost pair is merged first, as the library does.

Nulls and empty texts have 0 tokens; a very long text is counted whole, memory follows
the longest; extra columns are ignored, whatever their names; repeated rows give
repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEVER = np.int32(2**31 - 1)
#: Sequences of up to this many symbols apply a pair that could interact with
#: its own result one occurrence a round; longer ones use a queue.
SHORT_ROW = 64
#: What a worker remembers: words, and characters in all.
MEMO_WORDS, MEMO_CHARS = 400_000, 8_000_000


class PieceMerger:
    """Merge table of a BPE piece model; counts tokens as its own library does."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = {
            sp.id_to_piece(i): sp.get_score(i)
            for i in range(sp.vocab_size())
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        }
        symbols = sorted({c for p in pieces for c in p} | set(pieces))
        self.index = {s: k for k, s in enumerate(symbols, 1)}  # 0: a character of no piece
        self.n = len(symbols) + 1
        level = {s: k for k, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        rank_of = np.full(self.n, NEVER, np.int32)
        pairs = {}
        for p, score in pieces.items():
            rank_of[self.index[p]] = level[score]
            for k in range(1, len(p)):
                x, y = self.index.get(p[:k]), self.index.get(p[k:])
                if x and y:
                    pairs[x * self.n + y] = (level[score], self.index[p])
        self.keys = np.array(sorted(pairs), np.int64)
        self.rank = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], np.int32)
        self.pairs = pairs
        # A rank is free when no pair that holds its result comes before it or
        # ties with it: only then do its occurrences not interact.
        self.free = np.ones(len(level), bool)
        for side in (self.keys // self.n, self.keys % self.n):
            own = rank_of[side]
            self.free[own[(own < NEVER) & (self.rank <= own)]] = False
        self.weight = np.array([0] + [1 if s in pieces else len(s.encode()) for s in symbols], np.int64)
        self.symbol_at = np.zeros(0x110000, np.int32)
        for s, k in self.index.items():
            if len(s) == 1:
                self.symbol_at[ord(s)] = k
        self.joins = np.array(sorted({self.index[a] * self.n + self.index[b] for p in pieces for a, b in pairwise(p)}), np.int64)
        self.splits_at_space = not any(re.search("[^▁]▁", p) for p in pieces)
        self.memo: dict[str, int] = {}
        self.held = 0

    def pretokens(self, text: str) -> list[str]:
        if not text:
            return []
        text = " " + text.replace("▁", " ")
        return re.findall(" *[^ ]+| +", text) if self.splits_at_space else [text]

    def count(self, texts: list[str | None]) -> list[int]:
        out = []
        rows = [self.pretokens(t or "") for t in texts]
        if len(self.memo) > MEMO_WORDS or self.held > MEMO_CHARS:
            self.memo.clear()
            self.held = 0
        new = list({w for row in rows for w in row if w not in self.memo})
        for k in range(0, len(new), 65536):
            part = new[k : k + 65536]
            self.memo.update(zip(part, self.merge(part).tolist(), strict=True))
            self.held += sum(map(len, part))
        for row in rows:
            out.append(sum(map(self.memo.__getitem__, row)))
        return out

    def merge(self, words: list[str]) -> np.ndarray:
        """Surviving symbols of each non-empty word."""
        code = np.frombuffer("".join(words).replace(" ", "▁").encode("utf-32-le"), np.uint32)
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        sym = self.symbol_at[code]
        total = np.zeros(len(words), np.int64)
        lost = sym == 0
        np.add.at(total, word[lost], 1 + (code[lost] > 0x7F) + (code[lost] > 0x7FF) + (code[lost] > 0xFFFF))
        # Long sequences also end where no piece holds both neighbours.
        cut = (word[1:] != word[:-1]) | lost[1:] | lost[:-1]
        wide = np.flatnonzero((np.bincount(word, minlength=len(words)) > SHORT_ROW)[word[:-1]] & ~cut)
        cut[wide] = ~self._among(sym[wide].astype(np.int64) * self.n + sym[wide + 1], self.joins)[0]
        row = np.concatenate(([0], np.cumsum(cut)))
        sym, row, word = sym[~lost], row[~lost], word[~lost]
        rank = self._ranks(sym, row, np.arange(len(sym)))
        while len(sym):
            head = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            size = np.diff(np.append(head, len(sym)))
            low = np.minimum.reduceat(rank, head)
            ended = low == NEVER
            if ended.any():
                gone = np.repeat(ended, size)
                np.add.at(total, word[gone], self.weight[sym[gone]])
                keep = ~gone
                sym, row, word, rank = sym[keep], row[keep], word[keep], rank[keep]
                if not len(sym):
                    break
                low, size = low[~ended], size[~ended]
                head = np.concatenate(([0], np.cumsum(size)[:-1]))
            at = np.flatnonzero(rank == np.repeat(low, size))
            owner = row[at]
            first = np.concatenate(([True], owner[1:] != owner[:-1]))
            if not first.all():
                # Overlaps are taken from the left; a pair that isn't free once.
                run = np.concatenate(([True], (at[1:] != at[:-1] + 1) | first[1:]))
                place = np.arange(len(at))
                even = (place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0
                many = np.flatnonzero(~first & ~self.free[rank[at]])
                long = np.unique(owner[many[np.isin(owner[many], row[head[size > SHORT_ROW]])]])
                at = at[first | (even & self.free[rank[at]])]
                if len(long):
                    out = np.isin(row, long)
                    for r in long.tolist():
                        own = np.flatnonzero(row == r)
                        total[word[own[0]]] += self._queued(sym[own].tolist())
                    at = at[~out[at]]
                    at = at - np.cumsum(out)[at]
                    sym, row, word, rank = sym[~out], row[~out], word[~out], rank[~out]
                    if not len(at):
                        continue
            sym = sym.copy()
            sym[at] = self.merged[np.searchsorted(self.keys, sym[at].astype(np.int64) * self.n + sym[at + 1])]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # each merge before it removed one symbol
            sym, row, word, rank = sym[keep], row[keep], word[keep], rank[keep]
            rank[at] = self._ranks(sym, row, at)
            before = at[at > 0] - 1
            rank[before] = self._ranks(sym, row, before)
        return total

    def _ranks(self, sym: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at these places."""
        out = np.full(len(at), NEVER, np.int32)
        fit = np.flatnonzero(at + 1 < len(sym))
        fit = fit[row[at[fit]] == row[at[fit] + 1]]
        hit, k = self._among(sym[at[fit]].astype(np.int64) * self.n + sym[at[fit] + 1], self.keys)
        out[fit[hit]] = self.rank[k[hit]]
        return out

    @staticmethod
    def _among(key: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, key), max(len(table) - 1, 0))
        return (table[at] == key if len(table) else np.zeros(len(key), bool)), at

    def _queued(self, sym: list[int]) -> int:
        """Surviving symbols of one long sequence, lowest rank first, then leftmost."""
        n = len(sym)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (found := self.pairs.get(sym[i] * self.n + sym[j])):
                heapq.heappush(heap, (found[0], i, j, sym[i], sym[j], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, a, b, m = heapq.heappop(heap)
            if sym[i] != a or sym[j] != b or right[i] != j:
                continue
            sym[i], sym[j] = m, 0
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            left[j] = right[j] = -2
            offer(left[i], i)
            offer(i, right[i])
        return int(self.weight[np.array(sym)].sum())


_loaded: dict[str, PieceMerger] = {}


def merger(model_file: str) -> PieceMerger:
    if model_file not in _loaded:
        _loaded[model_file] = PieceMerger(model_file)
    return _loaded[model_file]


def count_tokens(docs: DataFrame, model_file: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit. One pass, no shuffle; model_file is
    a path that every executor has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = merger(model_file)
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                n = pa.array(counter.count(part.column(1).to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), n], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    got = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    got = got.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return got.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
