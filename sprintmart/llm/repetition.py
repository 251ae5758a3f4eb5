"""Quality rules on repetition: characters inside repeated n-grams and lines, from rolling hashes.

Works on the flat bytes of many texts at once. Every word and line gets a 64-bit hash of its bytes, every n-gram a
rolling one from prefix sums over the word hashes modulo two primes, so several lengths share one pass. Hashes are
salted with the text, sorted, and those that occur twice mark the words they cover. Equality is that of 62 bits: two
different n-grams of one text of a million words are taken for equal about once in ten million such texts.

A null text is an empty one: it has no words, lines or symbols, and all shares are 0. Words are
``[^\\x20\\x09-\\x0D]+``; lines end at ``\\n`` and count if they have a word. Repeated rows give equal counts, an empty
table no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from sprintmart.llm.flat import SPACE, Rolling, code_points, flat_texts, mix, pieces, runs, span_hashes

#: Length in words of the windows of the base rule.
BASE_WINDOW = 8

#: n-gram lengths with the largest share of word characters that repeated n-grams may cover.
COVERAGE = {5: 0.40, 8: 0.33, 10: 0.30}

#: The largest share of word characters in lines that repeat an earlier line.
LINE_COVERAGE = 0.30

_WORDS = Rolling(0xC2B2AE3D27D4EB4F)

#: Fixed set: the symbols of the base rule.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]
_RESULT = (
    "struct<" + ",".join(f"{name}:bigint" for name in _COUNTS) + ",dup_ngram_chars:array<bigint>>"
)


def _per_text(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, weights=values, minlength=n).astype(np.int64)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True for values that occur at least twice."""
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return twice


def _later(keys: np.ndarray) -> np.ndarray:
    """True for values equal to an earlier one."""
    first = np.unique(keys, return_index=True)[1]
    later = np.ones(len(keys), bool)
    later[first] = False
    return later


def measure(data: np.ndarray, offsets: np.ndarray, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Counts of each text of a flat byte array; ``dup_ngram_chars`` has a column a length."""
    n = len(offsets) - 1
    out = {name: np.zeros(n, np.int64) for name in _COUNTS}
    out["dup_ngram_chars"] = np.zeros((n, len(lengths)), np.int64)
    if not len(data):
        return out
    salt = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    space = SPACE[data]
    symbols = np.flatnonzero(_SYMBOL[data])
    out["n_symbols"] = np.bincount(np.searchsorted(offsets, symbols, "right") - 1, minlength=n)
    start, end = runs(~space, offsets)
    if not len(start):
        return out
    owner = np.searchsorted(offsets, start, "right") - 1
    chars_before = np.concatenate(([0], np.cumsum(code_points(data))))
    word_chars = chars_before[end] - chars_before[start]
    out["n_words"] = np.bincount(owner, minlength=n)
    out["word_chars"] = _per_text(word_chars, owner, n)

    breaks = np.unique(np.concatenate((offsets[:-1], np.flatnonzero(data == 10) + 1)))
    line_of_word = np.searchsorted(breaks, start, "right") - 1
    lines, first_word = np.unique(line_of_word, return_index=True)
    line_start = breaks[lines]
    line_end = np.append(breaks, len(data))[lines + 1]
    # The line break itself is no part of the line; a text's last line has none.
    line_end = np.where(data[line_end - 1] == 10, line_end - 1, line_end)
    line_owner = owner[first_word]
    later = _later(span_hashes(data, line_start, line_end) ^ salt[line_owner])
    out["n_dup_lines"] = np.bincount(line_owner[later], minlength=n)
    out["dup_line_chars"] = _per_text(np.add.reduceat(word_chars, first_word)[later], line_owner[later], n)

    word_sums = _WORDS.sums(span_hashes(data, start, end))
    for size in sorted({*lengths, BASE_WINDOW}):
        first = np.arange(len(start) - size + 1)
        first = first[owner[first] == owner[first + size - 1]] if len(first) else first
        twice = first[_repeated(_WORDS.spans(word_sums, first, first + size) ^ salt[owner[first]])] if len(first) else first
        depth = np.zeros(len(start) + 1, np.int32)
        depth[twice] += 1
        depth[twice + size] -= 1
        covered = np.cumsum(depth[:-1]) > 0
        if size == BASE_WINDOW:
            out["n_repeat_words"] = np.bincount(owner[covered], minlength=n)
        if size in lengths:
            out["dup_ngram_chars"][:, lengths.index(size)] = _per_text(word_chars[covered], owner[covered], n)
    return out


def repetition(text: Column, lengths: tuple[int, ...] = tuple(COVERAGE)) -> Column:
    """A struct of counts of one text: words, characters in words, symbols, repeated lines and their
    characters, words in repeated 8-word windows, and characters in repeated n-grams by length."""

    @F.arrow_udf(_RESULT)
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            data, offsets = flat_texts(column)
            parts = [
                measure(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lengths)
                for a, b in pieces(offsets)
            ]
            columns = [
                pa.array(np.concatenate([p[name] for p in parts]) if parts else [], pa.int64()) for name in _COUNTS
            ]
            grams = np.concatenate([p["dup_ngram_chars"] for p in parts]) if parts else np.zeros((0, len(lengths)))
            columns.append(pa.array(list(grams.astype(np.int64)), pa.list_(pa.int64())))
            yield pa.StructArray.from_arrays(columns, [*_COUNTS, "dup_ngram_chars"])

    return counts(text)


def base_failed(counts: str) -> Column:
    """Fewer than 20 words, or over 30 % of them in repeated 8-word windows."""
    c = F.col(counts)
    return (c["n_words"] < 20) | (c["n_repeat_words"] * 100 > c["n_words"] * 30)


def repetitive(counts: str, limits: dict[int, float] = COVERAGE, lines: float = LINE_COVERAGE) -> Column:
    """Repeated n-grams or lines hold more of the word characters than their limit. ``counts`` must
    stem from :func:`repetition` with the lengths of ``limits`` in the same order."""
    c = F.col(counts)
    verdict = c["dup_line_chars"] > c["word_chars"] * lines
    for k, limit in enumerate(limits.values()):
        verdict = verdict | (c["dup_ngram_chars"][k] > c["word_chars"] * limit)
    return verdict
