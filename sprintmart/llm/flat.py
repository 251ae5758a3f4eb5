"""Texts of an Arrow batch as one flat byte array, for vector work on many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once, so that the arrays made of them stay small; a longer text is a piece of its own.
PIECE_BYTES = 512 << 10

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def flat_texts(column: pa.Array, nothing: str | bytes = "") -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (or a binary one, with ``nothing`` b"") and the offsets of its texts; a null is
    an empty text."""
    column = column.fill_null(nothing).cast(pa.large_string() if nothing == "" else pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return whole, offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` bytes together, as half-open index ranges."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = values ^ (values >> np.uint64(30))
    x = x * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans. Eight bytes at a time are mixed with their place in the span and added up, so equal
    bytes give equal hashes, and structure in the bytes gives none in the sums."""
    size = end - start
    loads = (size + 7) >> 3
    out = size.astype(np.uint64) * _ODD
    total = int(loads.sum())
    if not total:
        return mix(out)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))
    first = np.cumsum(loads) - loads
    place = np.arange(total) - np.repeat(first, loads)
    left = np.repeat(size, loads) - 8 * place
    values = eight[np.repeat(start, loads) + 8 * place]
    short = np.flatnonzero(left < 8)
    values[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
    values = mix(values + mix((place + 1).astype(np.uint64) * _ODD))
    some = np.flatnonzero(loads)
    out[some] += np.add.reduceat(values, first[some])
    return mix(out)


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    done = 1
    while done <= n:
        part = min(done, n + 1 - done)
        out[done : done + part] = out[:part] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += part
    return out


class Rolling:
    """Rolling hashes of a sequence of 64-bit hashes: any span in constant time. Two polynomials modulo primes, since
    those modulo a power of two give sequences like Thue and Morse's equal hashes whatever the base."""

    PRIMES = (2**31 - 1, 2**31 - 19)

    def __init__(self, base: int) -> None:
        self._bases = [base % p for p in self.PRIMES]
        self.forget()

    def forget(self) -> None:
        """Drop the tables of powers."""
        self._tables = [(np.zeros(0, np.uint64),) * 2] * 2

    def _reserve(self, n: int) -> None:
        have = len(self._tables[0][0])
        if have <= n:
            size = max(n, 2 * have, 1 << 16)
            self._tables = [
                (_powers(b, p, size), _powers(pow(b, -1, p), p, size)) for b, p in zip(self._bases, self.PRIMES, strict=True)
            ]

    def sums(self, values: np.ndarray) -> list[np.ndarray]:
        """Prefix sums that :meth:`spans` needs, one array a prime."""
        n = len(values)
        self._reserve(n + 1)
        out = []
        for k, p in enumerate(self.PRIMES):
            half = (values >> np.uint64(32 * k)) & np.uint64(0xFFFFFFFF)
            sums = np.zeros(n + 1, np.uint64)
            # Terms below 2**31: their sum fits for sequences of 2**32 values.
            np.cumsum((half + np.uint64(1)) % np.uint64(p) * self._tables[k][0][:n] % np.uint64(p), out=sums[1:])
            out.append(sums)
        return out

    def spans(self, sums: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hashes of the spans; equal content gives equal values wherever it stands."""
        raw = np.zeros(len(start), np.uint64)
        for k, p in enumerate(self.PRIMES):
            part = (sums[k][end] - sums[k][start]) % np.uint64(p) * self._tables[k][1][start] % np.uint64(p)
            raw = raw << np.uint64(31) | part
        return mix(raw ^ ((end - start).astype(np.uint64) * _ODD))


def runs(inside: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values, cut at the positions ``breaks``."""
    n = len(inside)
    cut = np.zeros(n + 1, bool)
    cut[breaks] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return start, end


#: Fixed set: the white space of the word rule ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes as they are with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def code_points(data: np.ndarray) -> np.ndarray:
    """True at the first byte of each character."""
    return (data & 0xC0) != 0x80


def joined(table: pa.Table, column: str, kind: str) -> np.ndarray:
    """The numbers packed into a column of binary values, one after the other."""
    return np.frombuffer(b"".join(v.as_py() for v in table.column(column)), kind)
