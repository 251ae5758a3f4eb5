"""Blocks of the language model: the size of their rows, and words beyond two bytes."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from sprintmart.llm import lm_scores

SCHEMA = "doc_id bigint, text string, train boolean"


def test_word_numbers_in_two_bytes_and_more():
    tokens = np.array([0, 1, 65534, 65535, 65536, 7, 4_000_000_000], np.uint32)
    low, wide = lm_scores.narrowed(tokens)
    assert len(low) == 2 * len(tokens) and len(wide) == 4 * 3
    assert (lm_scores.widened(low, wide) == tokens).all()
    assert len(lm_scores.widened(*lm_scores.narrowed(tokens[:0]))) == 0


def test_sums_of_texts_do_not_depend_on_how_many_are_summed_at_once(monkeypatch):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 500, 40)
    tokens, values = rng.integers(0, 90, lengths.sum()), rng.normal(size=90)
    whole = np.bincount(np.repeat(np.arange(40), lengths), weights=values[tokens], minlength=40)
    for some in (1, 700, 1 << 30):
        monkeypatch.setattr(lm_scores, "SUMMED", some)
        assert (lm_scores._sums(values, tokens, lengths) == whole).all()


def test_a_block_is_moved_with_two_bytes_a_token(spark):
    docs = spark.createDataFrame([(i, "one two three " * 2000, True) for i in range(5)], SCHEMA).coalesce(1)
    row = lm_scores.blocks(docs).first()
    sent = sum(len(v) for v in row.asDict().values() if isinstance(v, (bytes, bytearray)))
    assert sent == 2 * sum(row["lengths"]) == 2 * 5 * 6001


def test_words_numbered_beyond_two_bytes_are_scored_by_their_own_counts(spark):
    many = [f"w{i}" for i in range(70_000)]
    texts = {1: [*many, *many[-3:]], 2: many[:10], 3: [many[-1], "unseen"], 4: []}
    rows = [(k, " ".join(v), k < 3) for k, v in texts.items()]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    found = {r["doc_id"]: r for r in lm_scores.lm_scores(docs)[0].collect()}
    count = Counter(w for k in (1, 2) for w in [*texts[k], lm_scores.END])
    total = sum(count.values()) + 0.5 * (len(count) + 1)
    for k, words in texts.items():
        own = [count[w] for w in [*words, lm_scores.END]]
        assert (found[k]["n_tokens"], found[k]["n_known"]) == (len(own), sum(c > 0 for c in own))
        assert found[k]["base_score"] == pytest.approx(sum(np.log10((c + 0.5) / total) for c in own))
