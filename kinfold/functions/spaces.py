"""Array kernels over the terms of texts: occurrences, document frequencies, vectors.

A term is named by a 64-bit key, the sum of its code points times fixed random
numbers by place; two of a million terms share a key with odds of about 1 in 10^7.
Texts are normalised ones: tokens parted by single blanks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Sizes of the character terms by kind.
SIZES = {"char": (3, 4), "char_wb": (2, 3, 4)}


def factors(n: int, first: int = 0) -> np.ndarray:
    """Odd random numbers of the places first, first + 1, ..."""
    x = (np.arange(first + 1, first + n + 1, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts end to end, and where each text starts (and ends)."""
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
    return points, np.concatenate(([0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))))


def runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an ordered array, and how often each occurs."""
    head = np.flatnonzero(np.concatenate((np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1])))
    return ordered[head], np.diff(np.append(head, len(ordered)))


def coded(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, a place of each, and which of them every key is."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.concatenate((np.ones(min(1, len(keys)), bool), ordered[1:] != ordered[:-1]))
    at = np.empty(len(keys), np.int64)
    at[order] = np.cumsum(new) - 1
    return ordered[new], order[new], at


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every range, end to end."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The text and the word (a place in the distinct words) of every token."""
    lists = pc.split_pattern(texts, " ")
    doc, word = pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists)
    some = pc.not_equal(word, "")
    coded = word.filter(some).dictionary_encode()
    return doc[some.to_numpy(zero_copy_only=False)].astype(np.int64), coded.indices.to_numpy().astype(np.int64), coded.dictionary


def word_keys(words: pa.Array) -> np.ndarray:
    points, at = code_points(words)
    if not len(points):
        return np.zeros(len(words), np.uint64)
    size = np.diff(at)
    place = np.arange(len(points)) - np.repeat(at[:-1], size)
    return np.add.reduceat((points.astype(np.uint64) + np.uint64(1)) * factors(int(size.max()))[place], at[:-1])


def grams_of(texts: pa.Array, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, key, start, size, code points) of every substring of the given sizes,
    ordered by owner."""
    points, at = code_points(texts)
    wide, f = points.astype(np.uint64) + np.uint64(1), factors(max(sizes))
    left = np.repeat(at[1:], np.diff(at)) - np.arange(len(points))  # characters from here to the text's end
    own = np.repeat(np.arange(len(texts)), np.diff(at))
    parts, key = [], wide * f[0]
    for n in range(2, max(sizes) + 1):  # a longer term's key goes on from the shorter one's
        key = key[:-1] + wide[n - 1 :] * f[n - 1]
        if n in sizes:
            spot = np.flatnonzero(left[: len(key)] >= n)
            parts.append((own[spot], key[spot], spot, np.full(len(spot), n)))
    owner, key, start, size = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(owner, kind="stable")
    return owner[order], key[order], start[order], size[order], points


class Terms:
    """Occurrences of the terms of texts: doc, term (a place in keys), and how the
    distinct terms read. `once` leaves out repetitions of a word within a text."""

    def __init__(self, texts: pa.Array, kind: str, once: bool = False):
        if kind == "char":
            self.doc, key, start, size, points = grams_of(texts, SIZES[kind])
        else:
            doc, word, words = words_of(texts)
            if once:
                both, _ = runs(np.sort(doc * max(1, len(words)) + word))
                doc, word = np.divmod(both, max(1, len(words)))
            if kind == "word":
                self.doc, self.term, self.keys, self.read = doc, word, word_keys(words), lambda: words
                return
            padded = pc.binary_join_element_wise("", words, "", " ")
            owner, key, start, size, points = grams_of(padded, SIZES[kind])
        self.keys, first, term = coded(key)
        start, size = start[first], size[first]
        self.read = lambda: pa.array(_spelled(points, start, size), pa.string())
        if kind == "char":
            self.term = term
            return
        at = np.searchsorted(owner, np.arange(len(words) + 1))
        n = np.diff(at)
        self.doc, self.term = np.repeat(doc, n[word]), term[spread(at[word], n[word])]

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc, term, times: one of each term of a text, ordered."""
        wide = max(1, len(self.keys))
        both, times = runs(np.sort(self.doc * wide + self.term))
        doc, term = np.divmod(both, wide)
        return doc, term, times


def _spelled(points: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[str]:
    text = points.tobytes().decode("utf-32-le")
    return [text[a : a + n] for a, n in zip(start.tolist(), size.tolist(), strict=True)]


class Known:
    """Document frequencies of one space: ordered keys of the terms of two records or
    more, their weights, and that of all others (terms of one record)."""

    def __init__(self, keys: np.ndarray, df: np.ndarray, n_records: int):
        order = np.argsort(keys)
        self.keys = keys[order]
        weight = lambda df: np.log((1.0 + n_records) / (1.0 + df)) + 1.0
        self.idf, self.alone = weight(df[order].astype(float)), weight(1.0)

    def vectors(self, texts: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc, term (a place in the known keys), weight, ordered by doc and term:
        L2-normalised vectors over all terms, without the entries that no other record shares."""
        terms = Terms(texts, kind)
        doc, term, times = terms.counts()
        spot = np.minimum(np.searchsorted(self.keys, terms.keys), max(0, len(self.keys) - 1))
        met = self.keys[spot] == terms.keys if len(self.keys) else np.zeros(len(terms.keys), bool)
        idf = np.where(met, self.idf[spot] if len(self.keys) else 0.0, self.alone)
        w = (1.0 + np.log(times)) * idf[term]
        norm = np.sqrt(np.bincount(doc, w * w, len(texts)))
        on = met[term]
        doc, term, w = doc[on], spot[term[on]], w[on]
        if kind == "word":  # its keys come in no order
            order = np.lexsort((term, doc))
            doc, term, w = doc[order], term[order], w[order]
        return doc, term, w / norm[doc]
