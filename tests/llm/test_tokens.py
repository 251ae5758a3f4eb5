"""Token counts and byte-level BPE against the libraries whose files they read."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from sprintmart.llm import bpe, token_counts
from sprintmart.llm.kept import Kept
from tests.llm.conftest import ODD

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def fuzz(n: int) -> list[str]:
    rng = random.Random(3)
    signs = "aAbe  \n\t▁éñ漢字😀\x00<s></s>.,'12  "
    many = ["".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 7, 40, 300, 900]))) for _ in range(n)]
    return [*many, *(" " * k + "x" for k in range(40)), "the" * 400, "ab" * 4_000, "▁" * 600, "aaaa " * 50]


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_equal_the_library():
    texts = [t for t in ODD if t is not None] + fuzz(400)
    own = token_counts.Counter(PIECES)
    expected = [len(ids) for ids in sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(texts)]
    assert token_counts.count_texts(own, iter(texts)) == expected


def test_long_sequences_count_alike_by_rounds_and_by_heap():
    own = token_counts.Counter(PIECES)
    for text in ("▁" + "thering" * 60, "▁" * 300 + "ab", "▁é漢😀" * 40):
        assert own.counts([text])[0] == own.count_long(text)


def test_counts_as_a_column(spark, docs_of):
    got = docs_of(ODD).withColumn("n_words", token_counts.count_tokens(F.col("text"), PIECES)).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert [r.n_words for r in got] == [len(model.encode(t or "")) for t in ODD]
    assert docs_of([]).select(token_counts.count_tokens(F.col("text"), PIECES)).count() == 0


def test_ids_equal_the_library(library):
    texts = [t for t in ODD if t is not None] + fuzz(400)
    own = bpe.Encoder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    got = [np.frombuffer(ids, "<i4") for ids in own.packed(texts)]
    assert [ids.tolist() for ids in got] == [library.encode_ordinary(t) for t in texts]
    assert [bpe.decode_ids(ids, RANKS) for ids in got] == [t.encode() for t in texts]


def test_a_pair_that_opens_below_the_rank_at_hand_goes_first():
    """Ranks no training yields: ab before bc, but abc lower than both."""
    ranks = {bytes([b]): b for b in range(97, 101)} | {b"ab": 300, b"bc": 400, b"abc": 200, b"abcab": 500}
    own = bpe.Encoder(ranks, r"\S+")
    ids = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
    for text in ("abcabcabc", "ababab", "bcbcabc", "cabdabca"):
        assert np.frombuffer(next(own.packed([text])), "<i4").tolist() == ids.encode_ordinary(text)


def test_encode_and_decode_as_columns(docs_of, library):
    docs = docs_of(ODD).select("doc_id", "text", bpe.encode(F.col("text"), RANKS, public_tokenizers.PATTERN).alias("ids"))
    for row in docs.withColumn("back", bpe.decode(F.col("ids"), RANKS)).collect():
        assert row.ids == library.encode_ordinary(row.text or "")
        assert bytes(row.back).decode() == (row.text or "")
    both = docs_of(ODD).select("text", bpe.round_trip(F.col("text"), RANKS, public_tokenizers.PATTERN).alias("t"))
    assert all(bytes(r.t.decoded).decode() == (r.text or "") for r in both.collect())


def test_unknown_ids_are_an_error():
    with pytest.raises(ValueError, match="vocabulary"):
        bpe.decode_ids(np.array([10**6]), RANKS)


def test_the_queue_hands_out_ranks_in_order():
    queue = bpe.RankQueue(200_000)
    for rank in (70_000, 5, 63, 64, 199_999):
        queue.open(rank, [rank + 1, rank])
    assert [queue.pop()[0] for _ in range(5)] == [5, 63, 64, 70_000, 199_999]
    assert queue.pop() is None


def test_the_store_keeps_what_is_asked_for_again():
    kept = Kept(8)
    for start in range(0, 40, 2):
        keys = {0, start, start + 1}
        kept.update((k, k) for k in kept.missing(keys))
        assert keys <= kept.keys()
        assert len(kept) <= 4 + 3
