"""Toxicity by compression distance: windows compressed with an ordinary and with a toxic dictionary.

Two Zstandard dictionaries are trained, one on ordinary text, one on the passages of toxic text that
set it apart (runs of ``GRAM`` bytes found in far more toxic than ordinary texts, whatever their
meaning). Each text is cut into windows of ``WINDOW`` words; each window is compressed with the ordinary
dictionary alone and with the toxic one added to it, and the bytes gained show how much toxic
material it holds. Shares of windows above several gains feed a logistic calibration, fitted on
texts that had no part in the dictionary they are measured with.

Everything is learned from a bounded sample of labelled rows: ``MAX_TOXIC`` and ``MAX_ORDINARY`` texts of at
most ``MAX_TEXT`` bytes, chosen by a hash of their id. The ordinary dictionary takes at most ``MAX_WINDOWS`` of their windows.
All texts, very long ones as well, are scored whole, window by window, in one pass without a
shuffle; repeated rows get equal scores. A null text is an empty one; it has one empty window, no gain, and the score that goes with
that. Without labels of both kinds all scores are the prior of 0.5 (or 0 and 1 where one kind is
missing), and a table without rows gives none.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintmart.llm.kept import claim

WINDOW = 8
GRAM = 6
LEVEL = 3
ORDINARY_BYTES = 32 << 10
TOXIC_BYTES = 3 << 10
MAX_TOXIC = 1500
MAX_ORDINARY = 3000
MAX_TEXT = 32 << 10
#: Windows of the sample, chosen by a fixed shuffle, that the ordinary dictionary is trained on.
MAX_WINDOWS = 40_000

#: A telling run of bytes is in this share of the toxic texts at least, and its surplus there is so many
#: standard errors; that number grows with the root of the sample, so it stands for one size of effect.
MIN_SHARE = 0.03
MIN_Z = 6.0
Z_PER_ROOT = 0.25

#: Gains in bytes from which a window counts.
GAINS = (1, 2, 3, 4, 6)


def normal(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def windows(words: list[bytes]) -> list[bytes]:
    """Runs of words, each with a space before and behind; an empty text has one empty window."""
    return [b" " + b" ".join(words[i : i + WINDOW]) + b" " for i in range(0, len(words), WINDOW)] or [b""]


def telling_grams(toxic: list[bytes], ordinary: list[bytes]) -> set[bytes]:
    """Runs of bytes found in a much larger part of the toxic texts."""
    nt, no = len(toxic), len(ordinary)
    often: Counter[bytes] = Counter()
    for t in toxic:
        often.update({t[i : i + GRAM] for i in range(len(t) - GRAM + 1)})
    often = Counter({gram: a for gram, a in often.items() if a >= max(5, MIN_SHARE * nt)})
    there: Counter[bytes] = Counter()
    for t in ordinary:
        there.update({t[i : i + GRAM] for i in range(len(t) - GRAM + 1)} & often.keys())
    out = set()
    for gram, a in often.items():
        b = there[gram]
        p = (a + b) / (nt + no)
        z = (a / nt - b / no) / (p * (1 - p) * (1 / nt + 1 / no) + 1e-12) ** 0.5
        if z > max(MIN_Z, Z_PER_ROOT * nt**0.5) and a / nt > 4 * b / no:
            out.add(gram)
    return out


def telling_spans(text: bytes, grams: set[bytes]) -> list[bytes]:
    """The longest stretches of a text that are covered by such runs."""
    out, start, end = [], -1, -1
    for i in range(len(text) - GRAM + 1):
        if text[i : i + GRAM] in grams:
            if i > end:
                if start >= 0:
                    out.append(text[start:end])
                start = i
            end = i + GRAM
    if start >= 0:
        out.append(text[start:end])
    return out


def _trained(size: int, samples: list[bytes], k: int, d: int) -> bytes:
    """A trained dictionary's bytes; where there is too little to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=d).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(samples))[-size:]


@dataclass
class Dictionaries:
    ordinary: bytes
    toxic: bytes

    def __post_init__(self) -> None:
        self._plain, self._more = (self._compressor(c) for c in (self.ordinary, self.ordinary + self.toxic))

    def __reduce__(self):
        return Dictionaries, (self.ordinary, self.toxic)

    @staticmethod
    def _compressor(content: bytes):
        data = zstandard.ZstdCompressionDict(content or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress

    def gains(self, text: str | None) -> np.ndarray:
        """Bytes gained in each window by the toxic dictionary."""
        parts = windows(normal(text))
        plain, more = self._plain, self._more
        return np.array([len(plain(p)) - len(more(p)) for p in parts])


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> Dictionaries:
    rng = np.random.default_rng(0)
    bad, good = ([b" " + b" ".join(normal(t)) + b" " for t in dict.fromkeys(texts)] for texts in (toxic, ordinary))
    base = [w for t in good for w in windows(t.split())]
    rng.shuffle(base)
    grams = telling_grams(bad, good) if bad and good else set()
    spans = [s for t in bad for s in telling_spans(t, grams)]
    rng.shuffle(spans)
    return Dictionaries(
        _trained(ORDINARY_BYTES, base[:MAX_WINDOWS], 64, 8), _trained(TOXIC_BYTES, spans, 24, 6) if spans else b""
    )


def features(gains: np.ndarray) -> np.ndarray:
    n = len(gains)
    counts = np.array([(gains >= g).sum() for g in GAINS], float)
    return np.concatenate(([1.0, np.log(n), gains.clip(0).mean(), gains.clip(-3, 0).mean()],
                           np.sqrt(counts / (n + 3)), np.log1p(counts[1:])))


@dataclass
class Model:
    dictionaries: Dictionaries
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, text: str | None) -> float:
        x = (features(self.dictionaries.gains(text)) - self.mean) / self.scale
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights by Newton steps; the first column is the constant, which is not shrunk."""
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(texts: list[str | None], labels: list[int], folds: int = 3) -> Model:
    """Dictionaries of all texts, calibrated on gains measured with dictionaries of the other folds."""
    y = np.array(labels, float)
    n_kinds = len(set(labels))
    if n_kinds < 2:
        prior = np.zeros(len(features(np.zeros(1))))
        prior[0] = 0.0 if not labels else 30.0 * (2 * y[0] - 1)
        own = Dictionaries(b"", b"")
        return Model(own, np.concatenate(([0.0], np.zeros(len(prior) - 1))), np.ones(len(prior)), prior)
    # Equal texts share a fold, or a copy would be measured with its own content.
    fold = np.array([zlib.crc32((t or "").encode()) for t in texts]) % folds
    rows = np.zeros((len(texts), len(features(np.zeros(1)))))
    for f in range(folds):
        part = [(t, v) for t, v, g in zip(texts, labels, fold, strict=True) if g != f]
        own = train_dictionaries([t or "" for t, v in part if v], [t or "" for t, v in part if not v])
        for i in np.flatnonzero(fold == f):
            rows[i] = features(own.gains(texts[i]))
    mean, scale = rows.mean(0), rows.std(0) + 1e-9
    mean[0], scale[0] = 0, 1
    weights = fit_logistic((rows - mean) / scale, y)
    final = train_dictionaries(
        [t or "" for t, v in zip(texts, labels, strict=True) if v],
        [t or "" for t, v in zip(texts, labels, strict=True) if not v],
    )
    return Model(final, mean, scale, weights)


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    max_toxic: int = MAX_TOXIC,
    max_ordinary: int = MAX_ORDINARY,
) -> tuple[list[str], list[int]]:
    """Labelled texts in a fixed order. Labels are thinned first, so at most both limits together are
    broadcast and that many texts of bounded size come back. Of several labels of an id the largest counts."""
    once = (
        labels.where(F.col(toxic).isin(0, 1)).groupBy(F.col(doc_id).alias("id")).agg(F.max(toxic).alias("toxic"))
    )
    order = [F.xxhash64("id"), F.col("id")]
    some = once.where("toxic = 1").orderBy(*order).limit(max_toxic).unionByName(
        once.where("toxic = 0").orderBy(*order).limit(max_ordinary)
    )
    rows = (
        docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
        .where(F.octet_length("text") <= MAX_TEXT)
        .join(F.broadcast(some), "id")
        .dropDuplicates(["id", "toxic"])
        .collect()
    )
    rows.sort(key=lambda r: (r["id"], r["toxic"]))
    return [r["text"] for r in rows], [r["toxic"] for r in rows]


def toxicity(text: Column, model: Model) -> Column:
    """The probability that a text is toxic."""

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        claim("toxicity")
        for texts in batches:
            for first in range(0, len(texts), 1000):
                yield pa.array([model.score(t.as_py()) for t in texts[first : first + 1000]], pa.float64())

    return scores(text)
