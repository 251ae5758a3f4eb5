"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are equal), at least ``MIN_LENGTH`` and
``REPEATS`` * q words long, that no neighbouring word extends. The texts of a piece are worked on together:

1. Words become numbers, and prefix doubling sorts the suffixes of every text by their first 1, 2, 4, ... words.
   Only suffixes that still share a prefix with another one of their text are sorted on, so prose
   drops out after a few words. A class of equal prefixes is a range of the suffix array.
2. A dyadic block of 2**j words asks for its occurrences at a distance of 2**j to 2**(j+1) (the smallest
   blocks, of 8 words, for all distances below 16). A wavelet tree over the suffix array answers by range
   successor: the next position in the block's range of the array.
3. Up to two occurrences are candidate periods as they are. Three or more are an arithmetic progression, whose
   difference p is the block's own period; a longer period then carries the end of one p-periodic stretch
   to the end of another, or start to start, which leaves two candidates.
4. Each candidate is extended to both sides through the tables of prefix classes, and kept if it is long enough.

A run with period q holds a block of 2**j <= q words (8 words for q < 8) together with its copy q words on, so
none is missed. Words are compared as such, not by hashes, and no result depends on the other texts of a batch.

A null or empty text has no words and no runs; its collapsed text is empty. Repeated rows give equal results, an
empty table none. A very long text is a piece of its own: some 150 bytes a word are held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from sprintmart.llm.flat import flat_texts, pieces
from sprintmart.llm.kept import release

MIN_LENGTH = 24
REPEATS = 3

#: The smallest block is of 2**BASE words: a run of 24 words with a period up to 8 holds one and its copy.
BASE = 3

#: Tables of prefix classes are kept up to 2**TABLES words; longer extensions take several steps.
TABLES = 12

#: Blocks asked for at once.
ASKED = 1 << 15


class Suffixes:
    """Suffixes of the texts of a flat array of word numbers, sorted within their text by prefix doubling.

    ``array`` is the suffix array, ``tables[j][i]`` the class of the 2**j words from i on (the place of its first
    member in the array), ``blocks`` the dyadic blocks that occur again: level, start, and their range. A prefix
    that reaches beyond its text is in a class of its own.
    """

    def __init__(self, ids: np.ndarray, offsets: np.ndarray) -> None:
        n = len(ids)
        lengths = np.diff(offsets)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        text_end = offsets[1:][owner]
        key = owner * (int(ids.max(initial=0)) + 1) + ids
        self.array = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        end = np.empty(n, np.int64)
        member = self._divide(key[self.array], self.array, np.arange(n), rank, end)
        self.tables = [self._table(rank)]
        self.blocks: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        self.shared = np.zeros(0, np.int64)
        longest = int(lengths.max(initial=0))
        level = 0
        while len(member) and (REPEATS << level + 1) <= max(longest, REPEATS << BASE):
            at = self.array[member]
            behind = at + (1 << level)
            inside = behind < text_end[at]
            second = np.where(inside, rank[np.where(inside, behind, 0)], -1)
            key = rank[at] * (n + 1) + second + 1
            order = np.argsort(key, kind="stable")
            at = at[order]
            self.array[member] = at
            member = self._divide(key[order], at, member, rank, end)
            level += 1
            if level <= TABLES:
                self.tables.append(self._table(rank))
            if level == BASE:
                self.shared = member
            if level >= BASE:
                start = np.arange(0, n, 1 << level)
                low = rank[start]
                again = end[low] - low > 1
                self.blocks.append((level, start[again], low[again], end[low[again]]))

    @staticmethod
    def _table(rank: np.ndarray) -> np.ndarray:
        """Classes of all places, and one behind the last that equals none of them."""
        return np.append(rank, -1).astype(np.int32 if len(rank) < 2**31 else np.int64)

    @staticmethod
    def _divide(key: np.ndarray, at: np.ndarray, slot: np.ndarray, rank: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Set rank and class end of sorted suffixes ``at``, which stand in the slots; the slots of classes with
        several members."""
        if not len(key):
            return slot
        head = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(head)
        size = np.diff(np.append(first, len(key)))
        rank[at] = np.repeat(slot[first], size)
        end[slot[first]] = slot[first] + size
        return slot[np.repeat(size, size) > 1]

    def forward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from x on equal those from y on (x < y, same text)."""
        return self._extend(x, y, 1)

    def backward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words before x equal those before y (x < y, same text)."""
        return self._extend(x, y, -1)

    def _extend(self, x: np.ndarray, y: np.ndarray, way: int) -> np.ndarray:
        n = len(self.array)
        moved = np.zeros(len(x), np.int64)

        def step(table: np.ndarray, size: int, who: np.ndarray) -> np.ndarray:
            a, b = x[who] + way * moved[who], y[who] + way * moved[who]
            if way < 0:
                a, b = a - size, b - size
            fits = a >= 0
            same = fits & (table[np.where(fits, a, n)] == table[np.minimum(np.where(fits, b, 0), n)])
            return who[same]

        top = len(self.tables) - 1
        who = np.arange(len(x))
        while len(who := step(self.tables[top], 1 << top, who)):
            moved[who] += 1 << top
        everyone = np.arange(len(x))
        for level in range(top - 1, -1, -1):
            moved[step(self.tables[level], 1 << level, everyone)] += 1 << level
        return moved


class WaveletTree:
    """Numbers in their order, by bits from the highest: counts and successors within ranges of the sequence."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.levels = []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            words = np.zeros(len(one) // 64 + 1, np.uint64)
            packed = np.packbits(one, bitorder="little")
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
            self.levels.append((words, before, int(len(one) - one.sum())))
            values = np.concatenate((values[~one], values[one]))

    @staticmethod
    def _ones(level: tuple, at: np.ndarray) -> np.ndarray:
        words, before, _ = level
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & mask)

    def less(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many numbers of each range are below x."""
        found = np.zeros(len(low), np.int64)
        for k, level in enumerate(self.levels):
            a, b = self._ones(level, low), self._ones(level, high)
            one = (x >> (self.bits - 1 - k) & 1).astype(bool)
            found += np.where(one, (high - b) - (low - a), 0)
            low, high = np.where(one, level[2] + a, low - a), np.where(one, level[2] + b, high - b)
        return np.where(x >> self.bits > 0, high - low + found, found)

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number with k smaller ones in its range."""
        out = np.zeros(len(low), np.int64)
        for level in self.levels:
            a, b = self._ones(level, low), self._ones(level, high)
            zeros = (high - b) - (low - a)
            one = k >= zeros
            k = np.where(one, k - zeros, k)
            out = out << 1 | one
            low, high = np.where(one, level[2] + a, low - a), np.where(one, level[2] + b, high - b)
        return out

    def successor(self, low: np.ndarray, high: np.ndarray, x: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The least number of each range from x up to below the limit, or -1."""
        found = np.full(len(low), -1, np.int64)
        k = np.where(x >> self.bits > 0, high - low, 0)
        within = x >> self.bits == 0
        k[within] = self.less(low[within], high[within], x[within])
        some = np.flatnonzero(k < high - low)
        value = self.smallest(low[some], high[some], k[some])
        found[some] = np.where(value < limit[some], value, -1)
        return found


def _candidates(
    suffixes: Suffixes, tree: WaveletTree, level: int, start: np.ndarray, low: np.ndarray, high: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and candidate periods of the blocks of one level."""
    size = 1 << level
    if level == BASE:
        limit, at = start + 2 * size, start
        while len(start):
            at = tree.successor(low, high, at + 1, limit)
            found = at >= 0
            start, low, high, limit, at = start[found], low[found], high[found], limit[found], at[found]
            yield start, at - start
        return
    limit = start + 2 * size
    first = tree.successor(low, high, start + size, limit)
    found = first >= 0
    start, low, high, limit, first = start[found], low[found], high[found], limit[found], first[found]
    second = tree.successor(low, high, first + 1, limit)
    third = np.full(len(start), -1, np.int64)
    two = np.flatnonzero(second >= 0)
    third[two] = tree.successor(low[two], high[two], second[two] + 1, limit[two])
    few = third < 0
    yield start[few], first[few] - start[few]
    both = few & (second >= 0)
    yield start[both], second[both] - start[both]
    s, f, p = start[~few], first[~few], (second - first)[~few]
    last = (f + suffixes.forward(f, f + p)) - (s + suffixes.forward(s, s + p))
    opening = (f - suffixes.backward(f, f + p)) - (s - suffixes.backward(s, s + p))
    for period in (last, opening):
        fits = (period >= size) & (period < 2 * size)
        yield s[fits], period[fits]


def find_runs(
    ids: np.ndarray, offsets: np.ndarray, min_length: int = MIN_LENGTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs of the texts, by start, then period. Starts count through all texts."""
    suffixes = Suffixes(ids, offsets)
    place = suffixes.shared
    tree = WaveletTree(suffixes.array[place])
    found = [np.zeros((0, 3), np.int64)]
    for level, starts, lows, highs in suffixes.blocks:
        for a in range(0, len(starts), ASKED):
            part = slice(a, a + ASKED)
            low, high = np.searchsorted(place, lows[part]), np.searchsorted(place, highs[part])
            for s, period in _candidates(suffixes, tree, level, starts[part], low, high):
                left, right = suffixes.backward(s, s + period), suffixes.forward(s, s + period)
                length = left + period + right
                long = length >= np.maximum(min_length, REPEATS * period)
                # A multiple of a run's period has the run's ends; the smallest period is the run's.
                found.append(_smallest_periods(np.stack((s - left, length, period), 1)[long]))
    start, length, period = _smallest_periods(np.concatenate(found)).T
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _smallest_periods(runs: np.ndarray) -> np.ndarray:
    """One row a stretch (start, length), with its smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    return runs[new]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RESULT = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


def _piece(texts: list[bytes], min_length: int) -> tuple[np.ndarray, list, list[str]]:
    """Number of words, runs and collapsed text of each text."""
    words = [t.split() for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    flat = pa.array([w for own in words for w in own], pa.binary()).dictionary_encode()
    ids = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    start, length, period = find_runs(ids, offsets, min_length)
    depth = np.zeros(len(ids) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    gone = np.cumsum(depth[:-1]) > 0
    cuts = np.searchsorted(start, offsets)
    runs, collapsed = [], []
    for i, own in enumerate(words):
        part = slice(cuts[i], cuts[i + 1])
        runs.append([
            {"start": int(s - offsets[i]), "length": int(n), "period": int(q)}
            for s, n, q in zip(start[part], length[part], period[part], strict=True)
        ])
        if runs[-1]:
            drop = gone[offsets[i] : offsets[i + 1]]
            own = [w for w, d in zip(own, drop, strict=True) if not d]
        collapsed.append(b" ".join(own).decode())
    return lengths, runs, collapsed


def periodic_runs(text: Column, min_length: int = MIN_LENGTH) -> Column:
    """A struct of a text: ``n_words``, its ``runs`` (start and period in words, by start, then period) and the
    ``collapsed`` text: the words that no run holds after its first period, with one space between them.

    ``min_length`` must be 24 at least: shorter runs may fall between the blocks.
    """
    if min_length < MIN_LENGTH:
        raise ValueError(f"runs of fewer than {MIN_LENGTH} words are not looked for")

    @F.arrow_udf(_RESULT)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            data, offsets = flat_texts(column)
            raw = data.tobytes()
            parts = [
                _piece([raw[offsets[i] : offsets[i + 1]] for i in range(a, b)], min_length) for a, b in pieces(offsets)
            ]
            counts, runs, collapsed = ([v for p in parts for v in p[k]] for k in range(3))
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(collapsed, pa.string())],
                ["n_words", "runs", "collapsed"],
            )
        release()

    return find(text)


def best_run(runs: str) -> Column:
    """The run with the greatest length in periods, ties by smallest start, then period; null without runs."""
    return F.expr(f"""
        aggregate(slice({runs}, 2, greatest(size({runs}) - 1, 0)), try_element_at({runs}, 1),
                  (b, r) -> if(r.length * b.period > b.length * r.period, r, b))
    """)


def run_lines(runs: str) -> Column:
    """Every run as ``start,length,period`` and a line break."""
    return F.expr(f"array_join(transform({runs}, r -> concat(concat_ws(',', r.start, r.length, r.period), '\\n')), '')")
