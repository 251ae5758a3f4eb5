"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of its bytes. Every neighbouring pair whose joined bytes are in the
vocabulary is filed by its rank: the bucket of a rank holds list positions. Three levels of bitmap
words say which buckets are not empty, so find-first-set gives the lowest rank in three steps
whatever the number of waiting pairs. Within a bucket the leftmost position comes first. Entries are
never removed early; one whose pair has changed meanwhile is skipped when it comes up. Encoding
takes time in proportion to a pre-token's length, so a megabyte without a gap is no special case.
Many short pre-tokens go through one queue together, which opens few buckets for many merges.

The pattern splits a text into pre-tokens; one that is itself in the vocabulary is one token, as in
the tiktoken library. A null text is an empty one and has no tokens; repeated rows get equal ids, an empty table gives
no rows. Workers keep the tokens of
``KEEP`` pre-tokens at most, of ``KEEP_CHARS`` characters each at most, which changes no result.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from sprintmart.llm.kept import Kept, claim, keeper

KEEP = 600_000
KEEP_CHARS = 64

#: Bytes of new pre-tokens that are merged together, and characters of texts that are split together.
GROUP_BYTES = 8 << 10
CHUNK_CHARS = 512 << 10

#: The widest word of a bitmap.
_BITS = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Buckets of positions by rank; the lowest bucket that is not empty comes out first, sorted."""

    def __init__(self, n_ranks: int) -> None:
        n = -(-n_ranks // _BITS)
        self._low = [0] * n
        self._mid = [0] * -(-n // _BITS)
        self._top = 0
        self.buckets: dict[int, list[int]] = {}

    def open(self, rank: int, positions: list[int]) -> None:
        """File positions under a rank that has no bucket."""
        self.buckets[rank] = positions
        word = rank >> 6
        group = word >> 6
        self._low[word] |= 1 << (rank & 63)
        self._mid[group] |= 1 << (word & 63)
        self._top |= 1 << group

    def pop(self) -> tuple[int, list[int]] | None:
        """The lowest rank with its positions from left to right."""
        if not self._top:
            return None
        group = (self._top & -self._top).bit_length() - 1
        bits = self._mid[group]
        word = (group << 6) | ((bits & -bits).bit_length() - 1)
        bits = self._low[word]
        rank = (word << 6) | ((bits & -bits).bit_length() - 1)
        self._low[word] = bits & (bits - 1)
        if not self._low[word]:
            self._mid[group] &= self._mid[group] - 1
            if not self._mid[group]:
                self._top &= self._top - 1
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


class Encoder:
    """Token ids of pre-tokens under one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.pairs = {token: rank for token, rank in ranks.items() if len(token) > 1}
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.byte_pairs = np.full(1 << 16, -1, np.int32)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.byte_pairs[token[0] << 8 | token[1]] = rank
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.kept = Kept(KEEP)

    def _file_bytes(self, text: bytes, bounds: np.ndarray) -> list[int]:
        """File all pairs of neighbouring bytes of one pre-token; the rank at each position."""
        data = np.frombuffer(text, np.uint8).astype(np.int64)
        rank = self.byte_pairs[data[:-1] << 8 | data[1:]]
        rank[bounds[1:-1] - 1] = -1
        order = np.argsort(rank, kind="stable")
        order = order[np.searchsorted(rank[order], 0) :]
        if len(order):
            filed = rank[order]
            cuts = np.flatnonzero(np.diff(filed)) + 1
            for at, positions in zip([0, *cuts.tolist()], np.split(order, cuts), strict=True):
                self.queue.open(int(filed[at]), positions.tolist())
        return [*rank.tolist(), -1]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of pre-tokens that are not empty. All share the queue, which is empty before and after.

        Pre-tokens don't touch each other, so taking the lowest rank of all of them takes the lowest
        of each. A pair opened below the rank at hand goes first; the rest of the bucket waits.
        """
        text = b"".join(words)
        n = len(text)
        bounds = np.cumsum([0, *map(len, words)])
        edge = bytearray(n + 1)  # 1 where a pre-token starts, and behind the last
        for at in bounds.tolist():
            edge[at] = 1
        end = list(range(1, n + 1))  # of the symbol that starts here
        back = list(range(-1, n))  # start of the symbol before
        ids = self.byte_ids[np.frombuffer(text, np.uint8)].tolist()  # of the symbol that starts here
        get, queue = self.pairs.get, self.queue
        buckets, file = queue.buckets, queue.open
        pair = self._file_bytes(text, bounds)  # rank of the pair that starts here; -1: none
        while (entry := queue.pop()) is not None:
            rank, bucket = entry
            for k, i in enumerate(bucket):
                if pair[i] != rank:
                    continue  # stale: one of the two symbols has grown or gone
                middle = end[i]
                end[i] = stop = end[middle]
                ids[i] = rank
                pair[i] = pair[middle] = -1
                below = False
                if not edge[stop]:
                    back[stop] = i
                    found = get(text[i : end[stop]])
                    if found is not None:
                        pair[i] = found
                        if found in buckets:
                            buckets[found].append(i)
                        else:
                            file(found, [i])
                        below = found < rank
                if not edge[i]:
                    before = back[i]
                    found = get(text[before:stop], -1)
                    pair[before] = found
                    if found >= 0:
                        if found in buckets:
                            buckets[found].append(before)
                        else:
                            file(found, [before])
                        below |= found < rank
                if below and k + 1 < len(bucket):
                    file(rank, bucket[k + 1 :])
                    break
        out = []
        ranks = self.ranks
        for word, start, stop in zip(words, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if word in ranks:
                out.append(array("i", (ranks[word],)).tobytes())
                continue
            own = []
            while start < stop:
                own.append(ids[start])
                start = end[start]
            out.append(array("i", own).tobytes())
        return out

    def _merged(self, words: list[str]) -> dict[str, bytes]:
        """Packed ids of pre-tokens, in groups of about ``GROUP_BYTES``."""
        out: dict[str, bytes] = {}
        group: list[bytes] = []
        names: list[str] = []
        size = 0
        for word in [*words, None]:
            if names and (word is None or size >= GROUP_BYTES):
                out.update(zip(names, self.merge(group), strict=True))
                group, names, size = [], [], 0
            if word is not None:
                names.append(word)
                group.append(word.encode())
                size += len(group[-1])
        return out

    def packed(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        split = [self.split(text) for text in texts]
        kept = self.kept
        found = self._merged(kept.missing(set(chain.from_iterable(split))))
        long = {word: ids for word, ids in found.items() if len(word) > KEEP_CHARS}
        kept.update((word, ids) for word, ids in found.items() if len(word) <= KEEP_CHARS)
        for words in split:
            if long:
                yield b"".join(long[w] if w in long else kept[w] for w in words)
            else:
                yield b"".join(map(kept.__getitem__, words))


_encoders: dict[tuple[str, str], Encoder] = {}
_decoders: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
keeper("bpe", lambda: (_encoders.clear(), _decoders.clear()))


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of this worker process."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(read_ranks(path), pattern)
    return _encoders[path, pattern]


def decoder(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All token bytes after one another, and the start and length of each id's; length -1: no such id."""
    if path not in _decoders:
        ranks = read_ranks(path)
        tokens = sorted(ranks, key=ranks.get)
        size = max(ranks.values(), default=-1) + 1
        start, length = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        ids = np.array([ranks[t] for t in tokens], np.int64)
        sizes = np.array([len(t) for t in tokens], np.int64)
        start[ids], length[ids] = np.cumsum(sizes) - sizes, sizes
        _decoders[path] = np.frombuffer(b"".join(tokens), np.uint8), start, length
    return _decoders[path]


def decode_ids(ids: np.ndarray, path: str) -> bytes:
    """Bytes of a sequence of ids; an unknown id is an error."""
    data, start, length = decoder(path)
    if len(ids) and (ids.min() < 0 or ids.max() >= len(length) or length[ids].min() < 0):
        raise ValueError("an id is not in the vocabulary")
    sizes = length[ids]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.arange(total) + np.repeat(start[ids] - ends + sizes, sizes)].tobytes()


def _chunks(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in order, about ``CHUNK_CHARS`` characters together."""
    chunk: list[str] = []
    size = 0
    for text in texts:
        chunk.append(text.as_py() or "")
        size += len(chunk[-1])
        if size >= CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _lists(parts: list[bytes]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) // 4 for p in parts], dtype=np.int64)))
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def encode(text: Column, path: str, pattern: str) -> Column:
    """Token ids of a text as an array of integers; a null text gives an empty array."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        claim("bpe")
        own = encoder(path, pattern)
        for texts in batches:
            for chunk in _chunks(texts):
                yield _lists(list(own.packed(chunk)))

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """Bytes of an array of token ids; a null or empty array gives no bytes."""

    @F.arrow_udf("binary")
    def data(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            for first in range(0, len(lists), 256):
                part = lists[first : first + 256]
                yield pa.array([decode_ids(_numbers(part, k), path) for k in range(len(part))], pa.binary())

    return data(ids)


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """A struct of :func:`encode`'s ids and the bytes that :func:`decode` makes of them, in one pass."""

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        claim("bpe")
        own = encoder(path, pattern)
        for texts in batches:
            for chunk in _chunks(texts):
                packed = list(own.packed(chunk))
                decoded = [decode_ids(np.frombuffer(ids, "<i4"), path) for ids in packed]
                yield pa.StructArray.from_arrays([_lists(packed), pa.array(decoded, pa.binary())], ["ids", "decoded"])

    return both(text)


def _numbers(lists: pa.ListArray, k: int) -> np.ndarray:
    item = lists[k]
    return item.values.to_numpy(zero_copy_only=False) if item.is_valid else np.zeros(0, np.int32)
