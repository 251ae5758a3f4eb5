"""Token counts by rank-synchronous merging of ragged numpy arrays.

The vocabulary is a BPE model of the sentencepiece kind: symbols are characters, a pair may merge if
its joined text is a piece, the better score first and the leftmost among equals; a character that
stays outside the vocabulary counts as its UTF-8 bytes. No piece has a space marker after another
character, so a text falls into pre-tokens (markers, then other characters) that merge on their own.

All new pre-tokens of a batch lie in one flat array. Each round finds the lowest rank of every
sequence and merges that pair at all its places at once, from the left without overlap; then only
the changed pairs are looked up again. Where a merge might make a pair of lower or equal rank (known
from the vocabulary beforehand) only the leftmost place is merged in that round, as one at a time
would do. A sequence of more than ``LONG`` characters is merged with a heap, since its
rounds would each touch the whole sequence.

A null text is empty and has no tokens. Repeated rows give equal counts, an empty table no rows, and a very long text
is split like any other. Workers keep the counts of ``KEEP`` pre-tokens at most.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column
from pyspark.sql import functions as F

from sprintmart.llm.kept import Kept, claim, keeper

MARK = "▁"
KEEP = 800_000
KEEP_CHARS = 64
LONG = 512

#: Pre-tokens that are merged together; their arrays fit into a processor's cache.
GROUP = 4_000
_NONE = np.iinfo(np.int64).max
_WORDS = re.compile(f"{MARK}+[^{MARK}]*")


class Counter:
    """Counts tokens under one model file."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = {i for i in range(model.get_piece_size())
                   if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        pieces = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if i not in special}
        self._check(model, pieces)
        self.scores = pieces
        levels = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        symbols = sorted(set(pieces) | {c for p in pieces for c in p})
        self.number = {s: i for i, s in enumerate(symbols)}
        self.known = np.array([s in pieces for s in symbols])
        self.bytes = np.array([len(s.encode()) for s in symbols], np.int64)
        self.size = len(symbols) + 1  # the last one stands for characters that no piece has
        rank = np.array([levels[pieces[s]] if s in pieces else -1 for s in symbols], np.int64)
        rows = [
            (self.number[p[:i]] * self.size + self.number[p[i:]], levels[score], self.number[p])
            for p, score in pieces.items()
            for i in range(1, len(p))
            if p[:i] in self.number and p[i:] in self.number
        ]
        rows.sort()
        self.keys, self.ranks, self.joined = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        # A merge of this level may open a pair of no higher level.
        self.careful = np.zeros(len(levels), bool)
        for part in (self.keys // self.size, self.keys % self.size):
            below = rank[part] >= self.ranks
            self.careful[rank[part][below]] = True
        self.kept = Kept(KEEP)

    @staticmethod
    def _check(model, pieces: dict[str, float]) -> None:
        probe = "a  b\tc\nﬁ "
        if model.normalize(probe) != (MARK + probe).replace(" ", MARK):
            raise ValueError("the model changes texts before it splits them")
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece has a space marker inside")

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and joined symbol of each pair; no rank: the largest number."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (self.keys[at] == key) & (left < self.size - 1) & (right < self.size - 1)
        return np.where(found, self.ranks[at], _NONE), np.where(found, self.joined[at], -1)

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        sizes = np.array([len(w) for w in words], np.int64)
        text = "".join(words)
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        distinct, inverse = np.unique(chars, return_inverse=True)
        other = self.size - 1
        symbol = np.array([self.number.get(chr(c), other) for c in distinct], np.int64)[inverse]
        width = np.array([len(chr(c).encode()) for c in distinct], np.int64)[inverse]
        owner = np.repeat(np.arange(len(words)), sizes)
        cost = np.where((symbol < other) & np.append(self.known, False)[symbol], 1, width)
        total = np.zeros(len(words), np.int64)
        rank, joined = self._pairs(symbol, owner)
        while len(symbol):
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            lowest = np.minimum.reduceat(rank, first)
            done = lowest == _NONE
            if done.any():
                total[owner[first[done]]] = np.add.reduceat(cost, first)[done]
                stay = np.repeat(~done, np.diff(np.append(first, len(symbol))))
                symbol, owner, rank, joined, cost = (a[stay] for a in (symbol, owner, rank, joined, cost))
                continue
            group = np.cumsum(np.concatenate(([False], owner[1:] != owner[:-1])))
            take = rank == lowest[group]
            at = np.flatnonzero(take)
            take[at[self._dropped(at, group[at], self.careful[rank[at]])]] = False
            at = np.flatnonzero(take)
            symbol[at] = joined[at]
            cost[at] = 1
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            symbol, owner, rank, joined, cost = (a[stay] for a in (symbol, owner, rank, joined, cost))
            at = moved[at]
            changed = np.unique(np.concatenate((at, at[at > 0] - 1)))
            rank[changed], joined[changed] = self._pairs(symbol, owner, changed)
        return total

    def _pairs(self, symbol: np.ndarray, owner: np.ndarray, at: np.ndarray | None = None):
        at = np.arange(len(symbol)) if at is None else at
        after = np.minimum(at + 1, len(symbol) - 1)
        rank, joined = self.find(symbol[at], symbol[after])
        alone = (after == at) | (owner[at] != owner[after])
        rank[alone], joined[alone] = _NONE, -1
        return rank, joined

    @staticmethod
    def _dropped(at: np.ndarray, group: np.ndarray, careful: np.ndarray) -> np.ndarray:
        """Places that wait: those overlapping the one before, and all but the first of careful ranks."""
        fresh = np.concatenate(([True], (np.diff(at) > 1) | (np.diff(group) > 0)))
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        overlap = (np.arange(len(at)) - start) % 2 == 1
        later = np.concatenate(([False], np.diff(group) == 0))
        return overlap | (careful & later)

    def count_long(self, word: str) -> int:
        """Tokens of one pre-token, merged pair by pair from a heap."""
        n = len(word)
        scores = self.scores
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(-scores[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in scores]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or after[i] >= n or end[after[i]] != stop:
                continue
            j = after[i]
            alive[j] = False
            after[i], end[i] = after[j], stop
            if stop < n:
                before[stop] = i
                if (word[i : end[stop]]) in scores:
                    heapq.heappush(heap, (-scores[word[i : end[stop]]], i, end[stop]))
            if before[i] >= 0 and word[before[i] : stop] in scores:
                heapq.heappush(heap, (-scores[word[before[i] : stop]], before[i], stop))
        return sum(
            1 if word[i : end[i]] in scores else len(word[i : end[i]].encode()) for i in range(n) if alive[i]
        )

    def learn(self, words: set[str]) -> dict[str, int]:
        """Counts of new pre-tokens; short ones are kept for later batches."""
        fresh = self.kept.missing(words)
        short = [w for w in fresh if len(w) <= LONG]
        found: dict[str, int] = {}
        for first in range(0, len(short), GROUP):
            group = short[first : first + GROUP]
            found.update(zip(group, self.counts(group).tolist(), strict=True))
        found |= {w: self.count_long(w) for w in fresh if len(w) > LONG}
        self.kept.update((w, c) for w, c in found.items() if len(w) <= KEEP_CHARS)
        return found


def split(text: str) -> list[str]:
    """Pre-tokens of a text."""
    if not text:
        return []
    marked = (MARK + text).replace(" ", MARK)
    if MARK + MARK in marked:
        return _WORDS.findall(marked)
    return [MARK + w for w in marked[1:].split(MARK)]


_counters: dict[str, Counter] = {}
keeper("token_counts", _counters.clear)


def counter(path: str) -> Counter:
    """The counter of this worker process."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


#: Characters whose pre-tokens are merged together.
_CHUNK_CHARS = 1 << 20


def count_texts(own: Counter, texts: Iterator[str]) -> list[int]:
    out: list[int] = []
    held: list[list[str]] = []
    size = 0

    def flush() -> None:
        extra = own.learn({w for words in held for w in words})
        kept = own.kept
        for words in held:
            try:
                out.append(sum(map(kept.__getitem__, words)))
            except KeyError:
                out.append(sum(kept[w] if w in kept else extra[w] for w in words))
        held.clear()

    for text in texts:
        held.append(split(text))
        size += len(text)
        if size >= _CHUNK_CHARS:
            flush()
            size = 0
    flush()
    return out


def count_tokens(text: Column, path: str) -> Column:
    """Tokens of a text under the model at ``path``, without begin, end or added special tokens."""

    @F.arrow_udf("bigint")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        claim("token_counts")
        own = counter(path)
        for texts in batches:
            yield pa.array(count_texts(own, (t.as_py() or "" for t in texts)), pa.int64())

    return tokens(text)
