"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items.

Items and documents are normalised alike: A-Z in lower case, every other ASCII character that is no
letter or digit is a gap between words, all other characters are kept. Patterns are runs of
``WINDOW`` item words (a shorter item is one pattern), bounded by gaps. A text is scanned once.
Normalising never changes a text's length in bytes, so a word found in it has the same bytes in the
original, and spans are given in characters of the original text.

The automaton reads words, not letters: each word that an item has is a number, all others are 0, and a pattern is a
sequence of ``WINDOW`` numbers. So it has about 13 nodes for each word of an item, 160 MB for 1 MB of item text, and one
automaton holds ``BLOCK_BYTES`` of it. Tasks get the items' text and build the automaton themselves, once a worker. A
larger benchmark is dealt into several automata, and each document passes through all of them as one row. A worker
holds them all, and the driver their text, so beyond ``MAX_BYTES`` a benchmark is refused with an error.

Nulls, empty texts and texts without words have no words and no hits. An item without words has no
pattern. Repeated items are all named where they occur; an item without an id hits, but is not named. Repeated rows
get equal results, an empty table none.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintmart.llm.flat import code_points
from sprintmart.llm.kept import claim, keeper

WINDOW = 13
BLOCK_BYTES = 2 << 20
MAX_BYTES = 4 << 20

_RESULT = (
    "struct<n_words:bigint,n_hit:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>,"
    "hit_words:array<bigint>>"
)
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

_TABLE = bytearray(range(256))
for _b in range(128):
    if not (48 <= _b <= 57 or 97 <= _b <= 122):
        _TABLE[_b] = _b + 32 if 65 <= _b <= 90 else 32
_TABLE = bytes(_TABLE)


def normal_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text."""
    return (text or "").encode().translate(_TABLE).split()


class Machine:
    """One automaton over the windows of items (id, text); each pattern carries its items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        self.number: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            words = normal_words(text)
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found[tuple(ids[i : i + window])].update(() if item is None else (item,))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern, names in found.items():
            self.automaton.add_word(pattern, (len(pattern), tuple(sorted(names))))
        self.automaton.make_automaton()

    def matches(self, words: list[bytes]) -> list[tuple[int, tuple[int, tuple[str, ...]]]]:
        """(last word, (number of words, items)) of every pattern found."""
        number = self.number
        if not number:
            return []
        return list(self.automaton.iter(tuple([number.get(w, 0) for w in words])))


_held: dict[bytes, Machine] = {}
keeper("decontaminate", _held.clear)


def _machine(key: bytes, items: list[tuple[str | None, str | None]], window: int) -> Machine:
    """An automaton of this worker process, kept for the next batches and tasks."""
    if key not in _held:
        _held[key] = Machine(items, window)
    return _held[key]


def scan(machine: Machine, text: str) -> tuple[int, np.ndarray, list[tuple[int, int]], list[str]]:
    """Number of words, indexes of the hit words, their spans in the text, and the items found."""
    plain = text.encode().translate(_TABLE)
    words = plain.split()
    matches = machine.matches(words) if words else []
    if not matches:
        return len(words), np.zeros(0, np.int64), [], []
    last = np.array([end for end, _ in matches]) + 1
    size = np.array([n for _, (n, _) in matches])
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, last - size, 1)
    np.add.at(change, last, -1)
    hit = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    items = sorted({item for _, (_, names) in matches for item in names})
    return len(words), hit, spans_of(plain, hit), items


def spans_of(plain: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Character spans of runs of neighbouring hit words."""
    data = np.frombuffer(plain, np.uint8)
    inside = np.concatenate(([False], data != 32, [False]))
    start = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    end = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    chars = np.concatenate(([0], np.cumsum(code_points(data))))
    first = hit[np.concatenate(([True], np.diff(hit) > 1))]
    last = hit[np.concatenate((np.diff(hit) > 1, [True]))]
    return list(zip(chars[start[first]].tolist(), chars[end[last]].tolist(), strict=True))


def _merged(texts: pa.Array, before: pa.Array | None, machine) -> pa.Array:
    out = []
    for k, text in enumerate(texts):
        text = text.as_py() or ""
        n_words, hit, spans, items = scan(machine, text)
        if before is not None and (old := before[k].as_py())["hit_words"]:
            hit = np.union1d(hit, np.array(old["hit_words"], np.int64))
            items = sorted({*items, *old["items"]})
            spans = spans_of(text.encode().translate(_TABLE), hit)
        out.append((n_words, len(hit), spans, items, hit.tolist()))
    columns = list(zip(*out, strict=True)) or [()] * 5
    names = ["n_words", "n_hit", "spans", "items", "hit_words"]
    kinds = [pa.int64(), pa.int64(), _SPAN, pa.list_(pa.string()), pa.list_(pa.int64())]
    return pa.StructArray.from_arrays(
        [pa.array(_values(n, c), k) for n, c, k in zip(names, columns, kinds, strict=True)],
        names,
    )


def _values(name: str, column: tuple) -> list:
    if name != "spans":
        return list(column)
    return [[{"start": a, "end": b} for a, b in spans] for spans in column]


def _scanner(items: list[tuple[str | None, str | None]], window: int, chained: bool):
    key = hashlib.sha256(repr((items, window)).encode()).digest()

    if chained:
        def more(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            claim("decontaminate")
            machine = _machine(key, items, window)
            for texts, before in batches:
                yield _merged(texts, before, machine)

        return F.arrow_udf(more, _RESULT)

    def first(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        claim("decontaminate")
        # The machines of another benchmark go before the first one of this is built.
        if key not in _held:
            _held.clear()
        machine = _machine(key, items, window)
        for texts in batches:
            yield _merged(texts, None, machine)

    return F.arrow_udf(first, _RESULT)


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """Items in blocks of bounded size, each collected on its own."""
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t") + F.coalesce(F.octet_length("i"), F.lit(0)))).first()[0] or 0
    if total > MAX_BYTES:
        raise ValueError(f"a benchmark of {total} bytes; the driver holds {MAX_BYTES} at most")
    n = max(1, -(-total // block_bytes))
    for block in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == block)
        yield sorted(((r["i"], r["t"]) for r in part.collect()), key=repr)


def mark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    into: str = "hits",
) -> DataFrame:
    """``docs`` with a struct ``into``: n_words, n_hit, spans (original characters) and items found.

    A column of that name is replaced; all others stay as they are.
    """
    found: Column | None = None
    for items in _blocks(benchmark, item, item_text, block_bytes):
        found = _scanner(items, window, found is not None)(F.col(text), *([] if found is None else [found]))
    return docs.withColumn(into, found).withColumn(into, F.col(into).dropFields("hit_words"))


def is_contaminated(hits: str = "hits", one_in: int = 20) -> Column:
    """At least one hit word, and at least one in ``one_in`` of all words."""
    return (F.col(hits)["n_hit"] > 0) & (F.col(hits)["n_hit"] * one_in >= F.col(hits)["n_words"])
