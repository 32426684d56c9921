"""N-best piece segmentation and decoding over a piece lattice.

A text is cut where no piece crosses (which is verified on the pieces). In each
part's lattice the forward Viterbi scores are exact completions, so a backward A-star
search from the end takes partial paths in the order of their final scores and
yields segmentations best first. As all completions of two partial paths differ, no
more of them are kept than segmentations are still wanted: memory and time are
linear in a part. For the same reason only the N least edges into a place matter, which
are found once. Parts are remembered, so each distinct part of a batch is searched
once; short parts are searched together, one step of all of them at a time. A text's N best combine its parts' N best: only the N - 1 parts with the least
loss for their second choice can differ from the best.

Texts are cut and parts are looked up by array kernels, by 64-bit hashes; the letters of
each part are then compared with those remembered, so a collision changes no result.

Scores are unigram log-probabilities of the pieces in whole micro-units, so sums are
exact. Tokenizers are not trained here: the probabilities follow from the order of
the given model's pieces (rank_scores). Among equal scores the path whose last pieces begin
earlier comes first.

Characters of no piece become byte pieces, and so does the sign that stands for a
space in pieces, so decoding gives the very text. Nulls and empty texts have no
pieces; repeated rows get equal rows; a text without any cut is one part, however
long; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.textbytes import chunks, mix, prefix_hash, released, span_hash

#: What a worker remembers: ids of pieces in all, and parts. LARGE takes about 100 MB
#: more, for a run that has a worker's memory to itself.
MEMO, LARGE = (2_000_000, 150_000), (8_000_000, 500_000)
READ_BYTES = 512 << 10
MICRO = 1_000_000
NEVER = -(1 << 62)
#: Characters taken as signs: ASCII and Latin-1 signs, digits and controls, general punctuation.
SIGNS = r"\x00-@\[-`{-\xa9\xab-\xb4\xb6-\xb9\xbb-\xbfˆ-˟‐-⁯"
CUTS = (rf"▁*(?:[{SIGNS}]+|[^{SIGNS}▁]+)|▁+", "▁*[^▁]+|▁+")
UNKNOWN_PENALTY, BARRED = 10 * MICRO, -1e8
#: Stands for the sign ▁ of a text; no UTF-8 text holds it.
OWN_SIGN = "\udc81"
#: Parts of up to so many characters are searched together.
TOGETHER, SHUT = 60, 1 << 62
#: Letters that are hashed and compared at a time, unless one part has more.
SLAB = 256 << 10


class Growing:
    """An array that grows by half, so what it holds is seldom copied."""

    def __init__(self, kind: type, *shape: int):
        self.room, self.used = np.empty((1024, *shape), kind), 0

    def __len__(self) -> int:
        return self.used

    @property
    def rows(self) -> np.ndarray:
        return self.room[: self.used]

    def add(self, rows: np.ndarray) -> None:
        end = self.used + len(rows)
        if end > len(self.room):
            old, self.room = self.rows, np.empty((max(end, len(self.room) * 3 // 2), *self.room.shape[1:]), self.room.dtype)
            self.room[: self.used] = old
        self.room[self.used : end] = rows
        self.used = end


class Numbers:
    """Consecutive numbers of 64-bit keys that are mixed well."""

    def __init__(self):
        self.keys, self.slots = Growing(np.uint64), np.full(1 << 12, -1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 for none."""
        held, last = self.keys.room, len(self.slots) - 1
        at = (keys & np.uint64(last)).astype(np.int64)
        out = self.slots[at]
        left = np.flatnonzero((out >= 0) & (held[out] != keys))
        at, keys = at[left], keys[left]
        while len(left):
            at = (at + 1) & last
            out[left] = got = self.slots[at]
            on = (got >= 0) & (held[got] != keys)
            left, at, keys = left[on], at[on], keys[on]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Give the next numbers to these keys. Of equal keys only one is found again."""
        first = len(self.keys)
        self.keys.add(keys)
        if 2 * len(self.keys) > len(self.slots):
            self.slots = np.full(1 << (4 * len(self.keys)).bit_length(), -1, np.int32)
            first, keys = 0, self.keys.rows
        number, last = np.arange(first, len(self.keys), dtype=np.int32), len(self.slots) - 1
        at = (keys & np.uint64(last)).astype(np.int64)
        while len(number):
            free = self.slots[at] < 0
            self.slots[at[free]] = number[free]
            lost = self.slots[at] != number
            number, at = number[lost], (at[lost] + 1) & last


def rank_scores(sp) -> dict[int, float]:
    """Log-probabilities by the order of the model's pieces: a share of 1 / (rank + 10)
    each. A merge table's scores are ranks, whose sums would prefer short pieces."""
    order = sorted((i for i in range(sp.vocab_size())), key=lambda i: -sp.get_score(i))
    total = sum(1 / (k + 10) for k in range(len(order)))
    return {i: -math.log((k + 10) * total) for k, i in enumerate(order)}


class PieceLattice:
    def __init__(self, model_file: str, n_best: int, memo: tuple[int, int] = MEMO):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        shares = rank_scores(sp)
        free = [i for i in range(sp.vocab_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.names = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        self.bytes_of = {i: b for b, i in enumerate(self.byte_id)}
        # Pieces that their model bars by an extreme score cost as much as an unknown.
        scores = {i: round(shares[i] * MICRO) for i in free if sp.get_score(i) > BARRED}
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        #: piece: (score, id)
        self.pieces = {self.names[i]: (scores.get(i, self.unknown), i) for i in free}
        self.n_best, self.memo = n_best, memo
        # The finest cut that leaves every piece whole: at changes between
        # signs and letters, else before each run of spaces, else none.
        cut = next((c for c in CUTS if all(re.findall(c, p) == [p] for p in self.pieces)), None)
        #: 0 for signs, 1 for letters, 2 for spaces; None: no cuts
        self.kinds = None if cut is None else np.ones(0x110000, np.uint8)
        if cut == CUTS[0]:
            self.kinds[[m.start() for m in re.finditer(f"[{SIGNS}]", np.arange(0x110000, dtype=np.uint32).tobytes().decode("utf-32-le", "surrogatepass"))]] = 0
        if cut:
            self.kinds[ord("▁")] = 2
        self.index()

    def index(self) -> None:
        #: every beginning of a piece: its score, or None where it isn't a piece itself
        self.begins: dict[str, int | None] = {p[:k]: None for p in self.pieces for k in range(1, len(p))}
        self.begins |= {p: s for p, (s, _) in self.pieces.items()}
        self.longest = max(map(len, self.pieces))
        # The same as arrays: codes of characters, and a node's child by node and code.
        letters = sorted(p for p in self.begins if len(p) == 1)
        self.code = np.zeros(0x110000, np.int32)
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.single = np.array([False] + [c in self.pieces for c in letters])
        node = {"": 0} | {p: k for k, p in enumerate(self.begins, 1)}
        edge = np.array([node[p[:-1]] * (len(letters) + 1) + self.code[ord(p[-1])] for p in self.begins])
        self.edges = Numbers()  # mixed, which is one to one; an edge's child is its number + 1
        self.edges.add(mix(edge.astype(np.uint64)))
        self.node_score = np.array([NEVER] + [NEVER if s is None else s for s in self.begins.values()])
        self.node_id = np.array([-1] + [self.pieces[p][1] if p in self.pieces else -1 for p in self.begins], np.int32)
        self.name_end = np.cumsum([0, *map(len, self.names)])
        self.name_codes = _codepoints("".join(self.names))
        self.forget()

    def forget(self) -> None:
        self.known = Numbers()
        self.letters, self.letter_place = Growing(np.uint32), Growing(np.int64)
        self.flat = Growing(np.int32)
        self.facts = [Growing(k, self.n_best) for k in (np.int32, np.int32, np.int64)]  # place, length (-1: none) and score by rank
        self.right = Growing(bool)

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Letters of all texts, as in pieces; where parts begin, and the end; and each
        text's number of parts."""
        size = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        codes = _codepoints("".join([" " + t for t in texts if t])).copy()
        codes[codes == ord("▁")] = ord(OWN_SIGN)
        codes[codes == ord(" ")] = ord("▁")
        opens = np.zeros(len(codes), bool)
        if self.kinds is not None:
            kind = self.kinds[codes]
            opens[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != 2)
        end = np.cumsum(size)
        opens[(end - size)[size > 0]] = True
        start = np.append(np.flatnonzero(opens), len(codes))
        return codes, start, np.diff(np.searchsorted(start[:-1], np.append(0, end)))

    def parts(self, text: str) -> list[str]:
        codes, start, _ = self.cut([text])
        return _strings(codes, start[:-1], np.diff(start))

    def forward(self, part: str) -> list[int]:
        """Viterbi scores of all places of a part."""
        n, get, unknown = len(part), self.begins.get, self.unknown
        alpha = [NEVER] * (n + 1)
        alpha[0] = 0
        for i in range(n):
            here, single = alpha[i], False
            for j in range(i + 1, n + 1):
                score = get(part[i:j], 0)
                if score is None:  # the beginning of longer pieces only
                    continue
                if not score:  # scores are below zero
                    break
                single |= j == i + 1
                if here + score > alpha[j]:
                    alpha[j] = here + score
            if not single and here + unknown > alpha[i + 1]:
                alpha[i + 1] = here + unknown
        return alpha

    def best(self, part: str, n_best: int = 0) -> list[tuple[int, tuple[int, ...]]]:
        """Up to n_best (score, ids) of one part, best first, by backward A-star. A partial
        path is (loss against the best, place, order, (from, to, rest of the path))."""
        want, get, longest, unknown = n_best or self.n_best, self.pieces.get, self.longest, self.unknown
        alpha, out, order = self.forward(part), [], 0
        open_: list[tuple] = [(0, len(part), 0, None)]
        while open_ and want:
            loss, at, _, path = open_.pop(0)
            if not at:
                out.append((alpha[-1] - loss, self._ids(part, path)))
                want -= 1
                continue
            base = loss + alpha[at]
            for i in range(at - 1, max(at - longest, 0) - 1, -1):
                found = get(part[i:at])
                if found:
                    score = found[0]
                elif i == at - 1:
                    score = unknown
                else:
                    continue
                # Every partial path completes with its loss, each in its own way.
                order += 1
                entry = (base - alpha[i] - score, i, order, (i, at, path))
                if len(open_) < want:
                    insort(open_, entry)
                elif entry < open_[-1]:
                    open_.pop()
                    insort(open_, entry)
        return out

    def _ids(self, part: str, path: tuple | None) -> tuple[int, ...]:
        ids: list[int] = []
        while path:
            i, j, path = path
            found = self.pieces.get(part[i:j])
            if found:
                ids.append(found[1])
            else:
                ids.extend([self.byte_id[b] for b in ("▁" if part[i] == OWN_SIGN else part[i]).encode()])
        return tuple(ids)

    def search(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """best() of many parts: all ids; place among them, length (-1: no such rank)
        and score by part and rank; and whether all decode right.
        Short parts of known letters are searched together, one step of all at a time."""
        n, none = len(parts), np.full((len(parts), self.n_best), -1)
        size, codes = np.array([len(p) for p in parts], np.int64), self.code[_codepoints("".join(parts))]
        first = np.cumsum(size) - size
        plain = np.logical_and.reduceat(self.single[codes], first) & (size <= TOGETHER) if n else np.empty(0, bool)
        place, length, score, right = none.copy(), none.copy(), none.copy(), np.zeros(n, bool)
        ids, used = [np.empty(0, np.int32)], 0
        for k in np.flatnonzero(~plain).tolist():
            got, text = self.best(parts[k]), parts[k].replace("▁", " ").replace(OWN_SIGN, "▁")
            right[k] = all([self._plain(x) == text for _, x in got])
            for r, (s, x) in enumerate(got):
                place[k, r], length[k, r], score[k, r] = used, len(x), s
                ids.append(np.array(x, np.int32))
                used += len(x)
        order = np.flatnonzero(plain)
        order = order[np.argsort(-size[order], kind="stable")]
        for k in range(0, len(order), 4096):
            which = order[k : k + 4096]
            flat, many, row, rank, points, right[which] = self._together(codes, first[which], size[which])
            place[which[row], rank], length[which[row], rank], score[which[row], rank] = used + np.cumsum(many) - many, many, points
            ids.append(flat)
            used += len(flat)
        return np.concatenate(ids), place, length, score, right

    def _together(self, codes: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Backward A-star over parts of falling length; an entry is one number: loss,
        place, step that made it, and length of its edge, compared in this order."""
        n, top, width, letters = len(size), self.n_best, min(self.longest, int(size[0])), np.uint64(len(self.single))
        owner = np.repeat(np.arange(n), size)
        start = np.cumsum(size) - size
        own = codes[np.repeat(first - start, size) + np.arange(size.sum())]
        base = start + np.arange(n)  # a part has one place more than letters
        # Edges by length and end.
        edge, piece = np.full((width, len(own) + n), NEVER), np.full((width, len(own) + n), -1, np.int32)
        at, node, end = np.arange(len(own)), np.zeros(len(own), np.int64), (start + size)[owner]
        for d in range(1, width + 1):
            inside = at + d <= end[at]
            at, node = at[inside], node[inside]
            node = self.edges.find(mix(node.astype(np.uint64) * letters + own[at + d - 1].astype(np.uint64))) + 1
            at, node = at[node > 0], node[node > 0]
            here = at + owner[at] + d
            edge[d - 1, here], piece[d - 1, here] = self.node_score[node], self.node_id[node]
        alpha, back = np.zeros(len(own) + n, np.int64), np.arange(1, width + 1)[:, None]
        for p in range(1, int(size[0]) + 1):
            g = base[: int((size >= p).sum())] + p
            w = min(p, width)
            alpha[g] = (alpha[g - back[:w]] + edge[:w, g]).max(axis=0)
        # The least edges into each place, as the entries they add to that of their end.
        where = np.arange(len(own) + n) - np.repeat(base, size + 1)
        least = np.full((top, len(own) + n), SHUT)
        for d in range(1, width + 1):
            lost = alpha[d:] - alpha[:-d] - edge[d - 1, d:]
            _insert(least[:, d:], np.where(edge[d - 1, d:] > NEVER, (lost << 25) | ((where[d:] - d) << 18) | d, SHUT))
        open_ = np.full((top, n), SHUT)
        open_[0] = size << 18
        live, popped, out, found = np.arange(n), [np.zeros(n, np.int64)], np.zeros((n, top), np.int64), np.zeros(n, np.int64)
        while len(live):
            step, now = len(popped), open_[:, live]
            head = now[0].copy()
            popped.append(np.zeros(n, np.int64))
            popped[-1][live] = head
            at = (head >> 18) & 127
            ended = live[at == 0]
            out[ended, found[ended]] = step
            found[ended] += 1
            now[:-1] = now[1:]
            now[-1] = SHUT
            # Nothing ends at place 0, so an ended path adds only what is shut.
            for made in least[:, base[live] + at]:
                _insert(now, made + ((head >> 25 << 25) | (step << 6)))
            open_[:, live] = now
            live = live[(found[live] < top) & (now[0] < SHUT)]
        # Read the paths back, first piece first.
        row, rank = np.nonzero(np.arange(top) < found[:, None])
        popped, step = np.stack(popped), out[row, rank]
        lost = popped[step, row] >> 25
        tokens, live = np.full((len(row), int(size[0])), -1, np.int32), np.arange(len(row))
        for k in range(int(size[0]) + 1):
            entry = popped[step[live], row[live]]
            live, entry = live[(entry & 63) > 0], entry[(entry & 63) > 0]
            if not len(live):
                break
            tokens[live, k] = piece[(entry & 63) - 1, base[row[live]] + ((entry >> 18) & 127) + (entry & 63)]
            step[live] = (entry >> 6) & 4095
        many = (tokens >= 0).sum(axis=1)
        flat = tokens[tokens >= 0]
        # Decoding: the pieces' letters must be the part's.
        letters = self.name_end[flat + 1] - self.name_end[flat]
        said = np.add.reduceat(letters, np.cumsum(many) - many) == size[row]
        if said.all():
            got = self.code[self.name_codes[_spans(self.name_end[flat], letters)]]
            text = own[_spans(start[row], size[row])]
            said = np.logical_and.reduceat(got == text, np.cumsum(size[row]) - size[row])
        fine = np.ones(n, bool)
        np.logical_and.at(fine, row, said)
        return flat, many, row, rank, alpha[base + size][row] - lost, fine

    def remember(self, parts: list[str]) -> int:
        """Keep the ranked segmentations of new parts; the number of the first."""
        ids, place, length, score, right = self.search(parts)
        number, size = len(self.right), np.array([len(p) for p in parts], np.int64)
        self.letter_place.add(len(self.letters) + np.cumsum(size) - size)
        self.letters.add(_codepoints("".join(parts)))
        for held, new in zip(self.facts, (place + len(self.flat), length, score), strict=True):
            held.add(new)
        self.flat.add(ids)
        self.right.add(right)
        return number

    def numbers(self, codes: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Number of each part; new ones are searched and remembered."""
        out, k = np.empty(len(start) - 1, np.int64), 0
        while k < len(out):
            end = max(int(np.searchsorted(start, start[k] + SLAB, "right")) - 1, k + 1)
            out[k:end] = self._numbers(codes[start[k] : start[end]], start[k : end + 1] - start[k])
            k = end
        return out

    def _numbers(self, codes: np.ndarray, start: np.ndarray) -> np.ndarray:
        start, size = start[:-1], np.diff(start)
        keys = _keys(codes, start, size)
        number = self.known.find(keys).astype(np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            own, pick, back = np.unique(keys[new], return_index=True, return_inverse=True)
            number[new] = self.remember(_strings(codes, start[new[pick]], size[new[pick]])) + back
            self.known.add(own)
        # Equal keys of different letters: such parts are searched on their own.
        same = np.diff(np.append(self.letter_place.rows, len(self.letters)))[number] == size
        fit = np.flatnonzero(same)
        got = self.letters.rows[_spans(self.letter_place.rows[number[fit]], size[fit])]
        wrong = got != (codes if len(fit) == len(same) else codes[_spans(start[fit], size[fit])])
        if wrong.any():
            same[fit] = ~np.logical_or.reduceat(wrong, np.cumsum(size[fit]) - size[fit])
        odd = np.flatnonzero(~same)
        if len(odd):
            parts = _strings(codes, start[odd], size[odd])
            own = dict.fromkeys(parts)
            first = self.remember(list(own))
            self.known.add(np.zeros(len(own), np.uint64))  # numbers stay in step
            own = dict(zip(own, range(first, first + len(own)), strict=True))
            number[odd] = [own[p] for p in parts]
        return number

    def encode_texts(self, texts: list[str]) -> tuple[list[list[np.ndarray]], list[list[float]], list[bool]]:
        """Of each text the ids of its n_best segmentations, best first, their scores,
        and whether each of them decodes to the text."""
        if len(self.flat) > self.memo[0] or len(self.right) > self.memo[1]:
            self.forget()
        codes, begin, many = self.cut(texts)
        number = self.numbers(codes, begin)
        flat = self.flat.rows
        place, length, score = (x.rows for x in self.facts)
        # Of each part of the chunk: its first choice and the second's loss.
        size, points = length[:, 0][number], score[:, 0][number]
        loss = np.where(length[:, 1][number] < 0, -NEVER, points - score[:, 1][number]) if self.n_best > 1 else points
        right = self.right.rows[number]
        start = np.cumsum(size) - size
        best = flat[_spans(place[:, 0][number], size)]
        lists, scores, same = [], [], []
        end = 0
        for own in many.tolist():
            a, end = end, end + own
            if not own:
                lists.append([])
                scores.append([])
                same.append(True)
                continue
            x, spots = number[a:end], []
            if self.n_best > 1:
                lost = loss[a:end]
                few = min(self.n_best - 1, len(x))
                # Of equal losses the first parts: the result doesn't depend on the sort.
                spots = np.flatnonzero(lost <= np.partition(lost, few - 1)[few - 1])
                spots = [k for k in spots[np.argsort(lost[spots], kind="stable")][:few].tolist() if lost[k] < -NEVER]
            total, origin = int(points[a:end].sum()), int(start[a])
            first = best[origin : start[end - 1] + size[end - 1]]
            ids, own_scores = [], []
            for less, pick in self._combined([score[x[k]][length[x[k]] >= 0].tolist() for k in spots]):
                out = first
                for k, r in sorted(zip(spots, pick, strict=True), reverse=True):  # later parts first: earlier places hold
                    if r:
                        at, here = place[x[k], r], start[a + k] - origin
                        out = np.concatenate((out[:here], flat[at : at + length[x[k], r]], out[here + size[a + k] :]))
                ids.append(out)
                own_scores.append((total - less) / MICRO)
            lists.append(ids)
            scores.append(own_scores)
            same.append(bool(right[a:end].all()))
        return lists, scores, same

    def _combined(self, options: list[list[int]]) -> list[tuple[int, tuple[int, ...]]]:
        """The n_best (loss, ranks) over the choices at some parts, best first."""
        start = (0,) * len(options)
        heap, seen, out = [(0, start)], {start}, []
        while heap and len(out) < self.n_best:
            less, pick = heapq.heappop(heap)
            out.append((less, pick))
            for j, own in enumerate(options):
                if pick[j] + 1 < len(own):
                    nxt = (*pick[:j], pick[j] + 1, *pick[j + 1 :])
                    if nxt not in seen:
                        seen.add(nxt)
                        heapq.heappush(heap, (less + own[pick[j]] - own[nxt[j]], nxt))
        return out

    def _plain(self, ids: list[int]) -> str:
        names, byte = self.names, self.bytes_of
        if not any([i in byte for i in ids]):
            return "".join([names[i] for i in ids]).replace("▁", " ")
        return b"".join([bytes([byte[i]]) if i in byte else names[i].replace("▁", " ").encode() for i in ids]).decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        text = self._plain(ids)
        return text[1:] if text[:1] == " " else text


def _codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of runs of these sizes, one run after another."""
    end = np.cumsum(size)
    return np.repeat(first - (end - size), size) + np.arange(end[-1] if len(end) else 0)


def _strings(codes: np.ndarray, first: np.ndarray, size: np.ndarray) -> list[str]:
    text = codes[_spans(first, size)].tobytes().decode("utf-32-le", "surrogatepass")
    end = np.cumsum(size)
    return [text[a:b] for a, b in zip((end - size).tolist(), end.tolist(), strict=True)]


def _keys(codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each part's letters."""
    return mix(span_hash(prefix_hash(codes.astype(np.uint64)), start, start + size) + size.astype(np.uint64))


def _insert(ranked: np.ndarray, entries: np.ndarray) -> None:
    """Put one entry a column among its ranked ones, of which the largest is lost."""
    for own in ranked:
        over = np.maximum(own, entries)
        np.minimum(own, entries, out=own)
        entries = over


_loaded: dict[tuple, PieceLattice] = {}


def lattice(model_file: str, n_best: int, memo: tuple[int, int] = MEMO) -> PieceLattice:
    if (model_file, n_best, memo) not in _loaded:
        _loaded[model_file, n_best, memo] = PieceLattice(model_file, n_best, memo)
    return _loaded[model_file, n_best, memo]


def unload(model_file: str, n_best: int, memo: tuple[int, int]) -> None:
    _loaded.pop((model_file, n_best, memo), None)


def encode_documents(docs: DataFrame, model_file: str, *, n_best: int = 3, id_col: str = "doc_id", text_col: str = "text", memo: tuple[int, int] = MEMO) -> DataFrame:
    """doc_id, n_bytes, ids (best segmentation), other_ids (the second to the n-th),
    scores (n best, best first) and round_trip: decoding each of the n id lists gives
    the text."""
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(model_file, n_best, memo)
        for batch in batches:
            for a, b, _, _ in chunks(batch.column(1), READ_BYTES):
                part = batch.slice(a, b - a)
                lists, scores, same = model.encode_texts(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), _lists([x[0] if x else x for x in lists]), _nested([x[1:] for x in lists]), pa.array(scores, pa.list_(pa.float64())), pa.array(same, pa.bool_())], ["doc_id", "n_bytes", "ids", "other_ids", "scores", "round_trip"])
        if memo < LARGE:  # the worker goes on to other stages
            unload(model_file, n_best, memo)

    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.mapInArrow(released(run), f"doc_id {kind}, n_bytes long, ids array<int>, other_ids array<array<int>>, scores array<double>, round_trip boolean")


def _lists(arrays: list) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate([np.asarray(x, np.int32) for x in arrays]) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def _nested(rows: list[list]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _lists([x for r in rows for x in r]))
