"""Language-model scores of whole texts: a gated recurrent network over a corpus-wide word model.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, then one end per text. The network predicts
frequent words one by one and all others by a class (of their last bytes); within a class, words have
their corpus frequency, with half a count added and one place for all unseen words. Together that is a
probability of every token after all that stands before it in the text.

1. Texts are packed in blocks with a vocabulary of their own, stored once, and no longer moved as text.
2. Words of all training texts are counted over all blocks; a block asks for the counts of its own
   vocabulary, so a word is shuffled once a block, however often it occurs, and a hot word is no hot key.
3. Training texts, as numbers, are dealt to parts by a hash of id and text and ordered by it, so that weights
   depend on the rows alone and not on how they lie in partitions. Weights start from ``SEED_TOKENS`` tokens of the first
   part; then every part goes on from there with all of its texts, and the weights are averaged, each part with its
   number of tokens. Back-propagation is cut after a few tokens, the state is not.
4. Every text is scored from its first to its last token with the state carried through.

Bounded, whatever the corpus: ``WORDS`` frequent words and the weights (some 70,000 numbers). All counts are
exact and cover all training texts. A null text is an empty one: its end alone is scored. Rows equal in id and text
are counted and scored each, and the network is fitted to one of them, so no part is longer for them. A very long
text is in one part and one block. Without training texts all counts are 0 and the untrained network scores; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintmart.llm import recurrent
from sprintmart.llm.flat import mix
from sprintmart.llm.kept import claim, release
from sprintmart.llm.stored import stored

WORDS = 1024
TAILS = 64
TAIL_BYTES = 3
SEED_TOKENS = 400_000
#: Training tokens of a part, and texts that it is trained on side by side.
PART_TOKENS = 4_000_000
LANES = 512
RATE = 0.02

#: A block ends with the text that brings it to so many bytes.
BLOCK_BYTES = 32 << 20

#: In a block's tokens, a word whose number is this or more; those numbers follow in a column of their own.
WIDE = 0xFFFF

#: Tokens whose values are summed at once.
SUMMED = 1 << 20

#: The token at the end of each text; no word has white space.
END = "\n"

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

_BLOCK = (
    "block bigint, doc_ids array<bigint>, hashes array<bigint>, train array<boolean>, lengths array<bigint>, tokens binary,"
    " wide binary, words array<string>, counts array<bigint>"
)
_BLOCK_FIELDS = pa.schema(
    [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64())),
     ("train", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())), ("tokens", pa.binary()), ("wide", pa.binary()), ("words", pa.list_(pa.string())),
     ("counts", pa.list_(pa.int64()))]
)


def narrowed(tokens: np.ndarray) -> tuple[bytes, bytes]:
    """Word numbers in two bytes each, and those that need more. Words are numbered as they appear, so few do, and the
    row of a block, which is moved and copied as a whole, is half as long."""
    large = tokens >= WIDE
    return np.where(large, WIDE, tokens).astype("<u2").tobytes(), tokens[large].astype("<u4").tobytes()


def widened(low: bytes | pa.Buffer, wide: bytes | pa.Buffer) -> np.ndarray:
    tokens = np.frombuffer(low, "<u2").astype(np.uint32)
    tokens[tokens == WIDE] = np.frombuffer(wide, "<u4")
    return tokens


def blocks(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, train) in blocks: texts as numbers of the block's words, and how often its training
    texts have each word."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("lm_scores")
        part = TaskContext.get().partitionId()
        number: dict[bytes, int] = {END.encode(): 0}
        docs_, hashes, train, texts = [], [], [], []
        size = count = 0

        def close() -> pa.RecordBatch:
            nonlocal size, count
            tokens = np.concatenate(texts)
            lengths = np.array([len(t) for t in texts])
            texts.clear()
            counts = np.bincount(tokens[np.repeat(np.array(train), lengths)], minlength=len(number))
            row = (part << 32 | count, docs_[:], hashes[:], train[:], lengths, *narrowed(tokens),
                   [w.decode() for w in number], counts)
            for kept in (docs_, hashes, train):
                kept.clear()
            number.clear()
            number[END.encode()] = 0
            size, count = 0, count + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, _BLOCK_FIELDS, strict=True)], schema=_BLOCK_FIELDS
            )

        for batch in batches:
            for doc, text, learn, h in zip(*(batch.column(c) for c in ("doc_id", "text", "train", "h")), strict=True):
                raw = (text.as_py() or "").encode()
                words = raw.translate(_LOWER).split()
                for word in set(words).difference(number):
                    number[word] = len(number)
                words.append(END.encode())
                texts.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                docs_.append(doc.as_py())
                hashes.append(h.as_py())
                train.append(bool(learn.as_py()))
                size += len(raw) + 1
                if size >= BLOCK_BYTES:
                    yield close()
                    release()
        if texts:
            yield close()

    return docs.select("doc_id", "text", "train", F.xxhash64("doc_id", "text").alias("h")).mapInArrow(pack, _BLOCK)


def word_counts(packed: DataFrame) -> DataFrame:
    """(word, c) over the training texts of all blocks."""
    rows = packed.select(F.explode(F.arrays_zip("words", "counts")).alias("w"))
    return (
        rows.where("w.counts > 0").groupBy(F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("c"))
    )


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-TAIL_BYTES:]) % TAILS


class Vocabulary:
    """Frequent words, and the mass and size of the classes of all others."""

    def __init__(self, words: list[tuple[str, int]], mass: np.ndarray, kinds: np.ndarray, total: int, size: int) -> None:
        self.number = {w.encode(): i for i, (w, _) in enumerate(words)}
        self.frequent = np.array([c for _, c in words], np.int64)
        self.mass, self.kinds, self.total, self.size = mass, kinds, total, size

    @staticmethod
    def of(counts: DataFrame) -> Vocabulary:
        top = [(r["word"], r["c"]) for r in counts.orderBy(F.desc("c"), "word").limit(WORDS).collect()]
        tail = F.substring(F.encode("word", "utf-8"), -TAIL_BYTES, TAIL_BYTES)
        # SQL counts a substring from before the start for words that are shorter.
        tail = F.when(F.octet_length("word") < TAIL_BYTES, F.encode("word", "utf-8")).otherwise(tail)
        rows = counts.groupBy((F.crc32(tail) % TAILS).alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("n"))
        mass, kinds = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
        for r in rows.collect():
            mass[r["k"]], kinds[r["k"]] = r["c"], r["n"]
        total, size = int(mass.sum()), int(kinds.sum())
        for word, c in top:
            mass[tail_class(word.encode())] -= c
            kinds[tail_class(word.encode())] -= 1
        return Vocabulary(top, mass, kinds, total, size)

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Model ids: the number of a frequent word, else that of its class."""
        n, number = len(self.frequent), self.number
        return np.array([number[w] if w in number else n + tail_class(w) for w in words], np.int64)

    def network(self) -> recurrent.Network:
        net = recurrent.Network(max(1, len(self.frequent)), TAILS)
        net.set_frequencies(np.concatenate((self.frequent if len(self.frequent) else [0], self.mass)))
        return net


_ENCODED = (
    "block bigint, doc_ids array<bigint>, hashes array<bigint>, train array<boolean>, lengths array<bigint>, ids binary,"
    " known array<bigint>, base array<double>, rest array<double>"
)
_ENCODED_FIELDS = pa.schema(
    [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64())),
     ("train", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())), ("ids", pa.binary()), ("known", pa.list_(pa.int64())),
     ("base", pa.list_(pa.float64())), ("rest", pa.list_(pa.float64()))]
)


def _sums(values: np.ndarray, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum of its tokens' values for each text, some texts at a time."""
    ends = np.cumsum(lengths)
    cuts = np.flatnonzero(np.diff(ends // SUMMED)) + 1
    out, at = [], 0
    for some in np.split(lengths, cuts):
        to = at + int(some.sum())
        owner = np.repeat(np.arange(len(some)), some)
        out.append(np.bincount(owner, weights=values[tokens[at:to]], minlength=len(some)))
        at = to
    return np.concatenate(out)


def encoded(packed: DataFrame, counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Blocks in model ids, with what needs no network: known tokens, the unigram score (log10), and the log
    probability of rare words within their classes."""
    asked = packed.select(F.col("block").alias("asker"), F.posexplode("words").alias("at", "word"))
    answered = asked.join(counts, "word").select("asker", "at", "c")

    def encode(left: pa.Table, right: pa.Table) -> pa.Table:
        claim("lm_scores")
        out = []
        for i, row in enumerate(left.select(["block", "doc_ids", "hashes", "train"]).to_pylist()):
            cell = lambda name, i=i: left.column(name)[i]
            words = cell("words").values.cast(pa.binary()).to_pylist()
            count = np.zeros(len(words), np.int64)
            count[right.column("at").to_numpy()] = right.column("c").to_numpy()
            model = vocabulary.ids(words)
            del words
            base = np.log10((count + 0.5) / (vocabulary.total + 0.5 * (vocabulary.size + 1)))
            tail = np.maximum(model - len(vocabulary.frequent), 0)
            inside = np.log((count + 0.5) / (vocabulary.mass[tail] + 0.5 * (vocabulary.kinds[tail] + 1)))
            inside[model < len(vocabulary.frequent)] = 0
            tokens = widened(cell("tokens").as_buffer(), cell("wide").as_buffer())
            lengths = cell("lengths").values.to_numpy()
            known, low, rest = (_sums(v, tokens, lengths) for v in (count > 0, base, inside))
            out.append((row["block"], row["doc_ids"], row["hashes"], row["train"], lengths, model.astype("<u2")[tokens].tobytes(),
                        known.astype(np.int64), low, rest))
        columns = list(zip(*out, strict=True)) or [()] * len(_ENCODED_FIELDS)
        return pa.table(
            [pa.array(list(c), f.type) for c, f in zip(columns, _ENCODED_FIELDS, strict=True)], schema=_ENCODED_FIELDS
        )

    # Counts are the largest column after the tokens and words, and nothing here reads them.
    return packed.drop("counts").groupBy("block").cogroup(answered.groupBy("asker")).applyInArrow(encode, _ENCODED)


_PART = "part bigint, h bigint, ids binary"


def training_texts(texts: DataFrame, parts: int) -> DataFrame:
    """(part, h, ids) of the training texts, those with one hash once."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            lengths = np.array(row["lengths"], np.int64)
            ends = 2 * np.cumsum(lengths)
            which = np.flatnonzero(np.array(row["train"], bool))
            hashes = np.array(row["hashes"], np.int64)[which]
            # The hash is mixed again, so that one part is not one partition of the shuffle before.
            part = (mix(hashes.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
            ids = [row["ids"][ends[i] - 2 * lengths[i] : ends[i]] for i in which]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(hashes), pa.array(ids, pa.binary())], ["part", "h", "ids"])

    return texts.select("train", "hashes", "lengths", "ids").mapInArrow(pick, _PART).dropDuplicates(["part", "h"])


def _training(table: pa.Table, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets of a part's texts by their hash: all of them, or the first ones up to so many tokens (one at
    least)."""
    table = table.sort_by("h")
    raw = [v.as_py() for v in table.column("ids")]
    lengths = np.array([len(r) // 2 for r in raw], np.int64)
    if most is not None:
        raw = raw[: max(1, int(np.searchsorted(np.cumsum(lengths), most, "right")))]
        lengths = lengths[: len(raw)]
    ids = np.frombuffer(b"".join(raw), "<u2").astype(np.int64)
    return ids, np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _shaped(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def trained(texts: DataFrame, vocabulary: Vocabulary) -> recurrent.Network:
    """The network: seeded on the first part, then trained on all parts side by side and averaged."""
    net = vocabulary.network()
    words, tails, start = net.words, net.tails, {k: v.copy() for k, v in net.p.items()}
    parts = max(1, -(-vocabulary.total // PART_TOKENS))
    dealt = stored(training_texts(texts, parts), "training")
    weights = pa.schema([("weights", pa.list_(pa.float32()))])

    def seed(table: pa.Table) -> pa.Table:
        own = recurrent.Network(words, tails, {k: v.copy() for k, v in start.items()})
        ids, offsets = _training(table, SEED_TOKENS)
        for rate in (0.01, 0.005):
            recurrent.train(own, ids, offsets, rate)
        return pa.table([pa.array([_flat(own.p)], weights.field(0).type)], schema=weights)

    # The part with the least number that has texts; with many parts that is the first.
    least = dealt.agg(F.min("part")).first()[0]
    if least is None:
        return net
    found = dealt.where(F.col("part") == least).groupBy("part").applyInArrow(seed, "weights array<float>").collect()
    seeded = _shaped(np.array(found[0]["weights"], np.float32), start)

    def refine(table: pa.Table) -> pa.Table:
        claim("lm_scores")
        own = recurrent.Network(words, tails, {k: v.copy() for k, v in seeded.items()})
        ids, offsets = _training(table)
        recurrent.train(own, ids, offsets, RATE, LANES)
        flat = _flat(own.p).astype(np.float64) * len(ids)
        return pa.table({"at": np.arange(len(flat)), "v": flat, "n": np.full(len(flat), len(ids))})

    refined = dealt.groupBy("part").applyInArrow(refine, "at bigint, v double, n bigint")
    mean = refined.groupBy("at").agg((F.sum("v") / F.sum("n")).alias("v")).collect()
    flat = np.zeros(len(mean))
    for r in mean:
        flat[r["at"]] = r["v"]
    return recurrent.Network(words, tails, _shaped(flat, start))


_SCORES = "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def scored(texts: DataFrame, network: recurrent.Network) -> DataFrame:
    words, tails, parameters = network.words, network.tails, network.p

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = recurrent.Network(words, tails, parameters)
        for row in _rows(batches):
            lengths = np.array(row["lengths"])
            ids = np.frombuffer(row["ids"], "<u2").astype(np.int64)
            likely = net.score(ids, np.concatenate(([0], np.cumsum(lengths))))
            columns = [
                pa.array(row["doc_ids"], pa.int64()), pa.array(row["train"], pa.bool_()), pa.array(lengths),
                pa.array(row["known"], pa.int64()), pa.array(row["base"], pa.float64()),
                pa.array((likely + np.array(row["rest"])) / np.log(10), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _SCORES.split(", ")])

    return texts.mapInArrow(score, _SCORES)


def lm_scores(docs: DataFrame) -> tuple[DataFrame, Vocabulary]:
    """Scores of rows (doc_id, text, train), as ``_SCORES``, learned from those marked ``train``; and the corpus's
    vocabulary, with the number of training tokens."""
    packed = stored(blocks(docs), "blocks")
    counts = stored(word_counts(packed), "word-counts")
    vocabulary = Vocabulary.of(counts)
    texts = stored(encoded(packed, counts, vocabulary), "encoded")
    return scored(texts, trained(texts, vocabulary)), vocabulary
