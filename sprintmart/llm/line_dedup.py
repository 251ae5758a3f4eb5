"""Line dedup by content-defined chunks of lines, compared byte by byte before anything goes.

A word with the white space behind it is a unit, so a passage of ``MIN_WORDS`` words holds ``MIN_WORDS`` - 1 units. A line
ends with a unit that breaks the line, and inside a longer line with the unit whose hash is least among some ``FOLD``
neighbours, so that a passage in mid-line has lines of its own. Lines are hashed, and a rolling hash runs over
``LINES`` lines in a row: where it is least among some ``SPREAD`` neighbours, a chunk of these lines starts. All of this
depends on the bytes near by alone, and each passage of ``MIN_WORDS`` words holds a chunk wherever it stands.

1. Each chunk goes, by bucket, with its place and with hashes of the stretches around it: ``STEP`` - 1 units shorter than a
   passage, at every ``STEP``-th position of the chunk in it. Two equal passages agree in one of them at least.
2. Occurrences that agree in the chunk and in a stretch point to the first of them, or to the one before in their
   own document. "First" is the smallest document key (a hash of id and text), then position; each map task settles
   its own occurrences first, so a chunk that a third of all documents have comes once from each task.
3. A chunk that agrees with an occurrence in two stretches shares a passage with it, and needs no other one. Chunks
   of a document that point to one stretch of another are joined to regions; the texts of both, the other one's
   in fixed pieces of ``PART`` words, are fetched and compared byte by byte.
4. Runs of at least ``MIN_WORDS`` equal words are removed, with the white space behind them. The first
   occurrence stays where it is.

Words are ``[^\\x20\\x09-\\x0D]+``. A passage of fewer than ``MIN_WORDS`` words is no repeat, by definition. A null text stays
null, an empty one empty, an empty table gives no rows. Rows equal in id and text are one document and fare alike.
Passages repeated inside one document are removed as well. Of a very long text only chunks and the pieces to
compare are moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintmart.llm.flat import SPACE, Rolling, flat_texts, joined, mix, pieces, runs, span_hashes
from sprintmart.llm.kept import claim, keeper, release
from sprintmart.llm.membership import may_have
from sprintmart.llm.stored import stored

MIN_WORDS = 50
#: Units among which one ends a line, lines of a chunk, and chunks of which one is used: a passage of 49 units has lines
#: of its own from the fifth unit to the 46th, 14 at least, and so 13 chunks.
FOLD, LINES, SPREAD = 3, 2, 13
STEP = 12
#: Words of a piece of an earlier text.
PART = 512

MIN_BUCKETS = 64
#: Bytes of text for each bucket, and bytes whose chunks are packed together.
BUCKET_BYTES = 32 << 20
PACK_BYTES = 16 << 20

_UNITS = Rolling(0x8EBC6AF09C88C6E3)
_STEP = np.uint64(0x589965CC75374CC3)
keeper("line_dedup", _UNITS.forget)


def document_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(doc_id, text)


def _sliding(choose: np.ufunc, values: np.ndarray, size: int) -> np.ndarray:
    """``choose`` (least or greatest) over each run of ``size`` values, at the run's start."""
    width = 1
    while 2 * width <= size:
        values = choose(values[:-width], values[width:])
        width *= 2
    return choose(values[: len(values) - (size - width)], values[size - width :]) if size > width else values


def _least_of_some(values: np.ndarray, group: np.ndarray, size: int) -> np.ndarray:
    """True for values that are least in some run of ``size`` neighbours of one group (groups stand in order). A group
    of fewer values than that has none."""
    out = np.zeros(len(values), bool)
    if len(values) < size:
        return out
    values = values | np.uint64(1)
    least = _sliding(np.minimum, values, size)
    least[group[: len(least)] != group[size - 1 :]] = 0
    nothing = np.zeros(size - 1, np.uint64)
    best = _sliding(np.maximum, np.concatenate((nothing, least, nothing)), size)
    return (values == best) & (best != 0)


def _line_ends(data: np.ndarray, start: np.ndarray, end: np.ndarray, last: np.ndarray, units: np.ndarray) -> np.ndarray:
    """True for units that end a line; ``last`` marks the last word of each text, which ends one too."""
    breaks = np.concatenate(([0], np.cumsum(data == 10)))
    following = np.append(start[1:], len(data))
    ends = (breaks[following] > breaks[end]) | last
    line = np.cumsum(ends) - ends
    return ends | _least_of_some(units, line, FOLD)


def stretches(chunk: np.ndarray, min_words: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Units before and behind a chunk of so many units, for each stretch."""
    rest = np.maximum(min_words - 1 - chunk, 0)
    most = max(min_words - 1 - LINES, 0)
    before = [np.minimum(i, rest) for i in range(0, most + 1, STEP)]
    return [(b, np.maximum(rest - b - (STEP - 1), 0)) for b in before]


#: Stretches of a chunk.
SIDES = len(stretches(np.array([LINES]), MIN_WORDS))


def chunks(data: np.ndarray, offsets: np.ndarray, min_words: int) -> tuple[np.ndarray, ...]:
    """Chunks of lines: text, hash, first word (counted in its text), number of words, and a column of hashes of the
    stretches around it (0 where the text is too short for one)."""
    n = len(offsets) - 1
    start, end = runs(~SPACE[data], offsets)
    sides = len(stretches(np.array([LINES]), min_words))
    if len(start) < min_words:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.uint64, np.int64, np.int64)) + (
            np.zeros((sides, 0), np.uint64),
        )
    owner = np.searchsorted(offsets, start, "right") - 1
    last = np.append(owner[1:] != owner[:-1], True)
    # The last word of a text has no white space to count; it is in no unit that is used.
    units = span_hashes(data, start, np.where(last, end, np.append(start[1:], len(data))))
    line_end = np.flatnonzero(_line_ends(data, start, end, last, units)) + 1
    line_start = np.concatenate(([0], line_end[:-1]))
    sums = _UNITS.sums(units)
    lines = _UNITS.spans(sums, line_start, line_end)
    first = np.arange(max(0, len(line_end) - LINES + 1))
    rolled = lines[: len(first)]
    for k in range(1, LINES):
        rolled = mix(rolled * _STEP + lines[k : k + len(first)])
    of = owner[line_start[first]]
    rolled[of != owner[line_end[first + LINES - 1] - 1]] = np.uint64(2**64 - 1)
    spread = SPREAD if min_words == MIN_WORDS else max(1, (min_words - 6) // FOLD - LINES)
    used = np.flatnonzero(_least_of_some(rolled, of, spread) & (rolled != np.uint64(2**64 - 1)))
    a, b = line_start[used], line_end[used + LINES - 1]
    who = of[used]
    text_first = np.searchsorted(owner, np.arange(n))
    # Units end before the last word.
    text_last = np.searchsorted(owner, np.arange(n), "right") - 1
    b = np.minimum(b, text_last[who])
    hash_ = rolled[used]
    around = np.zeros((sides, len(a)), np.uint64)
    for k, (before, behind) in enumerate(stretches(b - a, min_words)):
        fits = (a - before >= text_first[who]) & (b + behind <= text_last[who])
        around[k, fits] = _UNITS.spans(sums, (a - before)[fits], (b + behind)[fits]) | np.uint64(1)
    return who, hash_, a - text_first[who], b - a + 1, around


_PAIR = ["key", "at", "n", "to", "to_at", "sure"]
_PAIR_KINDS = ["<i8", "<u4", "<u1", "<i8", "<u4", "<u1"]


def settle(hash_: np.ndarray, side: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of entries in the order of key and place: those that agree with an earlier one in chunk and stretch, which one
    each is compared with, and all that are first. That is the one before in the same document, or else the first of
    all; so a periodic text repeats itself at one distance. A stretch of 0 agrees with nothing."""
    use = np.flatnonzero(side != 0)
    group = mix(hash_[use] ^ mix(side[use].astype(np.uint64)))
    order = np.argsort(group, kind="stable")
    group, order = group[order], use[order]
    head = np.ones(len(order), bool)
    head[1:] = group[1:] != group[:-1]
    if not len(order):
        return order, order, order
    partner = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    own = np.flatnonzero(~head[1:] & (key[order[1:]] == key[order[:-1]])) + 1
    partner[own] = order[own - 1]
    return order[~head], partner[~head], order[head]


def _settled(entries: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Pairs (key, at, n, to, to_at, sure) of agreeing occurrences, and the entries that are first in chunk and stretch.
    A pair that agrees in two stretches shares a passage for sure: they reach ``STEP`` units further together."""
    key, at = entries[-3], entries[-2]
    order = np.lexsort((at, key))
    # A place that came several times is one place.
    new = np.ones(len(key), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (at[order][1:] != at[order][:-1])
    entries = [c[order[new]] for c in entries]
    hash_, *sides, key, at, n = entries
    found = [settle(hash_, side, key) for side in sides]
    x, y = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    # Several stretches often agree with the same occurrence.
    once, times = np.unique(x * len(key) + y, return_counts=True)
    x, y = once // max(1, len(key)), once % max(1, len(key))
    heads = np.unique(np.concatenate([f[2] for f in found]))
    return [key[x], at[x], n[x], key[y], at[y], times > 1], [c[heads] for c in entries]


_ENTRY = ["hashes", *(f"side{k}" for k in range(SIDES)), "keys", "ats", "ns"]
_ENTRY_KINDS = ["<u8", *["<u4"] * SIDES, "<i8", "<u4", "<u1"]
_COLUMNS = [*_ENTRY, *(f"p_{c}" for c in _PAIR)]
_PACKED = "bucket int, " + ", ".join(f"{c} binary" for c in _COLUMNS)
_PACKED_FIELDS = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in _COLUMNS)])


def _dealt(bucket: np.ndarray, columns: list[np.ndarray], kinds: list[str]) -> dict[int, list[bytes]]:
    """The columns packed by bucket, buckets that have none left out."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    columns = [c[order].astype(k) for c, k in zip(columns, kinds, strict=True)]
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(bucket) else [0]
    return {int(bucket[a]): [c[a:b].tobytes() for c in columns] for a, b in zip(cuts[:-1], cuts[1:], strict=True)}


def _packed(entries: list[np.ndarray], pairs: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """Entries and settled pairs by bucket; pairs only pass through, to the bucket of their document."""
    own = _dealt((entries[0] >> np.uint64(20)) % np.uint64(buckets), entries, _ENTRY_KINDS)
    done = _dealt(pairs[0].view(np.uint64) % np.uint64(buckets), pairs, _PAIR_KINDS)
    rows = [
        (bucket, *own.get(bucket, [b""] * len(_ENTRY)), *done.get(bucket, [b""] * len(_PAIR)))
        for bucket in sorted(own.keys() | done.keys())
    ]
    columns = list(zip(*rows, strict=True)) or [()] * len(_PACKED_FIELDS)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _PACKED_FIELDS, strict=True)], schema=_PACKED_FIELDS
    )


def pack_chunks(texts: DataFrame, buckets: int, min_words: int) -> DataFrame:
    """All chunks of (key, text), a row for each bucket and ``PACK_BYTES`` of text."""

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("line_dedup")
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            keys = batch.column(0).to_numpy()
            data, offsets = flat_texts(batch.column(1))
            for a, b in pieces(offsets):
                who, hash_, at, n, around = chunks(
                    data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], min_words
                )
                sides = [(s & np.uint64(0xFFFFFFFF)).astype(np.uint32) for s in around]
                sides += [np.zeros(len(at), np.uint32)] * (SIDES - len(sides))
                held.append([hash_, *sides, keys[a:b][who], at, n])
                size += int(offsets[b] - offsets[a])
                if size >= PACK_BYTES:
                    yield _close(held, buckets)
                    held, size = [], 0
        if held:
            yield _close(held, buckets)
            held.clear()
        release()

    return texts.mapInArrow(packs, _PACKED)


def _close(held: list[list[np.ndarray]], buckets: int) -> pa.RecordBatch:
    # Only the first occurrence of each chunk and stretch goes on; a later one is settled already.
    pairs, first = _settled([np.concatenate(c) for c in zip(*held, strict=True)])
    return _packed(first, pairs, buckets)


_MATCH = "part int, " + ", ".join(f"p_{c} binary" for c in _PAIR)
_MATCH_FIELDS = pa.schema([("part", pa.int32()), *((f"p_{c}", pa.binary()) for c in _PAIR)])


def _matches_of_bucket(parts: int):
    """Pairs of occurrences of a bucket's chunks, dealt out by document."""

    def match(table: pa.Table) -> pa.Table:
        release()
        entries = [joined(table, c, k) for c, k in zip(_ENTRY, _ENTRY_KINDS, strict=True)]
        own, _ = _settled(entries)
        done = [joined(table, f"p_{c}", k) for c, k in zip(_PAIR, _PAIR_KINDS, strict=True)]
        pairs = [np.concatenate(c) for c in zip(own, done, strict=True)]
        dealt = _dealt(pairs[0].view(np.uint64) % np.uint64(parts), pairs, _PAIR_KINDS)
        columns = list(zip(*((p, *c) for p, c in dealt.items()), strict=True)) or [()] * len(_MATCH_FIELDS)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _MATCH_FIELDS, strict=True)], schema=_MATCH_FIELDS)

    return match


def _few_partners(
    key: np.ndarray, at: np.ndarray, n: np.ndarray, to: np.ndarray, shift: np.ndarray, sure: np.ndarray
) -> list[np.ndarray]:
    """The pairs without those that another one makes needless: a chunk that shares a passage for sure with some
    occurrences is compared with one of them, in the stretch that most chunks of its text share."""
    order = np.lexsort((shift, to, key))
    new = np.ones(len(key), bool)
    new[1:] = (np.diff(key[order]) != 0) | (np.diff(to[order]) != 0) | (np.diff(shift[order]) != 0)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(key)))
    common = np.empty(len(key), np.int64)
    common[order] = np.repeat(size, size)
    order = np.lexsort((shift, to, -common, 1 - sure, at, key))
    key, at, n, to, shift, sure = (c[order] for c in (key, at, n, to, shift, sure))
    head = np.ones(len(key), bool)
    head[1:] = (np.diff(key) != 0) | (np.diff(at) != 0)
    settled = np.repeat(sure[head] > 0, np.diff(np.append(np.flatnonzero(head), len(key))))
    use = head | ~settled
    return [c[use] for c in (key, at, n, to, shift)]


_REGION = "key bigint, first bigint, last bigint, to bigint, to_first bigint, to_last bigint, skip bigint"
_REGION_NAMES = [c.split()[0] for c in _REGION.split(", ")]


def _regions_of_part(min_words: int):
    around = min_words - LINES

    def regions(table: pa.Table) -> pa.Table:
        """Neighbouring chunks that point to one stretch, as one region in words with what a passage may add on both
        sides, cut at the pieces of the earlier text (first, last). ``skip`` words of the piece come before."""
        pairs = [joined(table, f"p_{c}", k).astype(np.int64) for c, k in zip(_PAIR, _PAIR_KINDS, strict=True)]
        pairs[4] = pairs[1] - pairs[4]
        key, at, n, to, shift = _few_partners(*pairs)
        order = np.lexsort((at, shift, to, key))
        key, at, n, to, shift = (c[order] for c in (key, at, n, to, shift))
        end = at + n
        new = np.ones(len(key), bool)
        new[1:] = (
            (key[1:] != key[:-1]) | (to[1:] != to[:-1]) | (shift[1:] != shift[:-1]) | (at[1:] > end[:-1] + 2 * around)
        )
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(key)) - 1
        before = np.minimum(around, np.minimum(at[head], at[head] - shift[head])) if len(head) else head
        first, last = at[head] - before, end[tail] + around
        # The pieces overlap by a passage less a word, so each passage lies in one of them.
        overlap = min_words - 1
        low, high = (first - shift[head]) // PART, np.maximum(last - shift[head] - overlap - 1, 0) // PART
        count = np.maximum(high, low) - low + 1
        k = np.repeat(np.arange(len(head)), count)
        piece = low[k] + np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count)
        to_first, to_last = piece * PART, piece * PART + PART + overlap
        off = shift[head][k]
        a, b = np.maximum(first[k], to_first + off), np.minimum(last[k], to_last + off)
        columns = [key[head][k], a, b, to[head][k], to_first, to_last, a - off - to_first]
        return pa.table([pa.array(c.astype(np.int64)) for c in columns], names=_REGION_NAMES)

    return regions


def _word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    return runs(~SPACE[data], np.array([0, len(data)])) if len(data) else (np.zeros(0, int), np.zeros(0, int))


def cut_out(text: Column, wanted: Column) -> Column:
    """The bytes of stretches of words (first, last) of a text, from the first word's start to the last
    one's end; a stretch ends with the text."""

    @F.arrow_udf("array<binary>")
    def pick(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, asked in batches:
            data, offsets = flat_texts(texts)
            raw = data.tobytes()
            of = np.repeat(np.arange(len(asked)), pc.list_value_length(asked).fill_null(0).to_numpy(zero_copy_only=False))
            flat = asked.flatten()
            first, last = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            out: list[list[bytes]] = [[] for _ in range(len(asked))]
            at = 0
            for a, b in pieces(offsets):
                here = slice(at, at := int(np.searchsorted(of, b)))
                start, end = runs(~SPACE[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a])
                cuts = np.searchsorted(start, offsets[a : b + 1] - offsets[a])
                own = of[here] - a
                begin = start[np.minimum(cuts[own] + first[here], len(start) - 1)] + offsets[a]
                stop = end[np.minimum(cuts[own] + last[here], cuts[own + 1]) - 1] + offsets[a]
                for k, x, y in zip(of[here].tolist(), begin.tolist(), stop.tolist(), strict=True):
                    out[k].append(raw[x:y])
            yield pa.array(out, pa.list_(pa.binary()))
        release()

    return pick(text, wanted)


def _equal_parts(
    x: np.ndarray, xs: np.ndarray, xe: np.ndarray, y: np.ndarray, ys: np.ndarray, ye: np.ndarray
) -> np.ndarray:
    """Whether part i of x, from xs[i] to xe[i], has the bytes of part i of y. Compares eight bytes at a time."""
    size = xe - xs
    same = size == ye - ys
    at = np.flatnonzero(same & (size > 0))
    if len(at):
        sizes = size[at]
        loads = (sizes + 7) >> 3
        first = np.cumsum(loads) - loads
        step = 8 * (np.arange(int(loads.sum())) - np.repeat(first, loads))
        left = np.repeat(sizes, loads) - step
        differ = _eight(x)[np.repeat(xs[at], loads) + step] ^ _eight(y)[np.repeat(ys[at], loads) + step]
        short = np.flatnonzero(left < 8)
        differ[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        same[at] = ~np.logical_or.reduceat(differ != 0, first)
    return same


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as numbers."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))


def equal_runs(
    x: np.ndarray, x_offsets: np.ndarray, y: np.ndarray, y_offsets: np.ndarray, skip: np.ndarray, min_words: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of at least ``min_words`` words that text i of x has byte by byte, with the white space between them, where text
    i of y has them ``skip[i]`` words later: number of the text, first word and behind the last word in x."""
    xs, xe = runs(~SPACE[x], x_offsets)
    ys, ye = runs(~SPACE[y], y_offsets)
    x_first, y_first = np.searchsorted(xs, x_offsets), np.searchsorted(ys, y_offsets)
    n = np.maximum(np.minimum(np.diff(x_first), np.diff(y_first) - skip), 0)
    of = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    i, j = x_first[of] + inner, y_first[of] + skip[of] + inner
    same = _equal_parts(x, xs[i], xe[i], y, ys[j], ye[j])
    linked = np.zeros(len(of), bool)
    inside = np.flatnonzero(of[1:] == of[:-1])
    linked[inside + 1] = _equal_parts(x, xe[i[inside]], xs[i[inside + 1]], y, ye[j[inside]], ys[j[inside + 1]])
    first, last = runs(same, np.flatnonzero(~linked))
    long = last - first >= min_words
    first, last = first[long], last[long]
    return of[first], inner[first], inner[last - 1] + 1


def compared(x: Column, y: Column, skip: Column, min_words: int) -> Column:
    kind = pa.struct([("a", pa.int64()), ("b", pa.int64())])

    @F.arrow_udf("array<struct<a:bigint,b:bigint>>")
    def test(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for xs, ys, skips in batches:
            (x_data, x_offsets), (y_data, y_offsets) = flat_texts(xs, b""), flat_texts(ys, b"")
            skipped = skips.to_numpy(zero_copy_only=False)
            counts, firsts, lasts = [], [], []
            for a, b in pieces(x_offsets):
                of, first, last = equal_runs(
                    x_data[x_offsets[a] : x_offsets[b]], x_offsets[a : b + 1] - x_offsets[a],
                    y_data[y_offsets[a] : y_offsets[b]], y_offsets[a : b + 1] - y_offsets[a], skipped[a:b], min_words,
                )
                counts.append(np.bincount(of, minlength=b - a))
                firsts.append(first)
                lasts.append(last)
            flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (counts, firsts, lasts)]
            ends = np.concatenate(([0], np.cumsum(flat[0]))).astype(np.int32)
            values = pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in flat[1:]], fields=list(kind))
            yield pa.ListArray.from_arrays(pa.array(ends), values)

    return test(x, y, skip)


def strike_words(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The text without the words of the spans and the white space behind each span; the number of words gone."""
    start, end = _word_spans(raw)
    gone = np.zeros(len(start) + 1, np.int64)
    for a, b in spans:
        gone[a] += 1
        gone[min(b, len(start))] -= 1
    inside = np.cumsum(gone[:-1]) > 0
    first, last = runs(inside, np.array([0]))
    out, at = [], 0
    for a, b in zip(first, last, strict=True):
        out.append(raw[at : start[a]])
        at = start[b] if b < len(start) else len(raw)
    out.append(raw[at:])
    return b"".join(out), int(inside.sum())


def struck(text: Column, spans: Column) -> Column:
    @F.arrow_udf("struct<text:string,removed_words:bigint,spans:array<struct<a:bigint,b:bigint>>>")
    def strike(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct(
            [("text", pa.string()), ("removed_words", pa.int64()),
             ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))]
        )
        for texts, wanted in batches:
            out = []
            for t, w in zip(texts, wanted, strict=True):
                found = w.as_py()
                raw = (t.as_py() or "").encode()
                kept, count = strike_words(raw, [(s["a"], s["b"]) for s in found])
                out.append({"text": kept.decode(), "removed_words": count, "spans": found})
            yield pa.array(out, kind)
        release()

    return strike(text, spans)


def repeated_spans(texts: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, spans): runs of words, as half-open ranges, that an earlier place has byte by byte.
    ``texts`` has the columns key and text."""
    if min_words > MIN_WORDS:
        raise ValueError(f"passages of more than {MIN_WORDS} words need more stretches")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-size // BUCKET_BYTES))
    matches = (
        pack_chunks(texts.where("text IS NOT NULL"), buckets, min_words)
        .groupBy("bucket")
        .applyInArrow(_matches_of_bucket(buckets), _MATCH)
    )
    regions = stored(matches.groupBy("part").applyInArrow(_regions_of_part(min_words), _REGION).distinct(), "regions")
    # Stretches of a later text and of an earlier one are kept apart: each join moves its own kind only.
    later = regions.select("key", "first", "last", F.lit(False).alias("earlier"))
    wanted = later.unionByName(
        regions.select(
            F.col("to").alias("key"), F.col("to_first").alias("first"), F.col("to_last").alias("last"),
            F.lit(True).alias("earlier"),
        )
    )
    # Of an earlier text these are fixed pieces, and of a later one as many as its own chunks ask for.
    per_text = stored(
        wanted.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("first", "last", "earlier"))).alias("stretches")),
        "wanted",
    )
    affected = texts.where(may_have(per_text, "key")(F.col("key")))
    cut = affected.join(per_text, "key").select("key", "stretches", cut_out(F.col("text"), F.col("stretches")).alias("c"))
    parts = stored(
        cut.select("key", F.explode(F.arrays_zip("stretches", "c")).alias("p"))
        .select("key", "p.stretches.first", "p.stretches.last", "p.stretches.earlier", F.col("p.c").alias("bytes"))
        .dropDuplicates(["key", "first", "last", "earlier"]),
        "stretches",
    )
    kind = lambda earlier, *names: parts.where(F.col("earlier") == earlier).drop("earlier").toDF(*names)
    there = regions.join(kind(True, "to", "to_first", "to_last", "y"), ["to", "to_first", "to_last"])
    both = there.join(kind(False, "key", "first", "last", "x"), ["key", "first", "last"])
    equal = both.select("key", "first", F.explode(compared(F.col("x"), F.col("y"), F.col("skip"), min_words)).alias("r"))
    spans = equal.select("key", (F.col("first") + F.col("r.a")).alias("a"), (F.col("first") + F.col("r.b")).alias("b"))
    return spans.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans"))


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, into: str = "repeats"
) -> DataFrame:
    """``docs`` with a struct ``into``: the text without its repeated passages, the number of words removed and
    their spans in words. A column of that name is replaced; all others stay as they are."""
    key = document_key(doc_id, text)
    spans = stored(repeated_spans(docs.select(key.alias("key"), F.col(text).alias("text")), min_words), "spans")
    kept = [c for c in docs.columns if c != into]
    rows = docs.select(F.struct(*kept).alias("row"), key.alias("key"))
    here = may_have(spans, "key")(F.col("key"))
    # Rows that no passage is removed from are not shuffled.
    marked = rows.where(here).join(spans, "key", "left").unionByName(
        rows.where(~here).withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    )
    row_text = F.col("row")[text]
    nothing = F.array().cast(spans.schema["spans"].dataType)
    # Texts that keep everything need not pass through the function.
    affected = F.col("spans").isNotNull()
    cleaned = marked.select(
        "row", F.when(affected, struck(F.when(affected, row_text), F.coalesce("spans", nothing))).alias("struck")
    )
    return cleaned.select(
        "row.*",
        F.struct(
            F.coalesce("struck.text", row_text).alias("text"),
            F.coalesce("struck.removed_words", F.lit(0).cast("long")).alias("removed_words"),
            F.coalesce("struck.spans", nothing).alias("spans"),
        ).alias(into),
    )
