"""Repetition, decontamination, toxicity and language-model scores against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sprintmart.llm import decontaminate, lm_scores, recurrent, repetition, toxicity
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def covered(words: list[str], n: int) -> set[int]:
    count = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return {j for i in range(len(words) - n + 1) if count[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}


def plain_repetition(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    seen, dup, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup += 1
                dup_chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    grams = [sum(len(words[i]) for i in covered(words, n)) for n in repetition.COVERAGE]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered(words, 8)),
            dup_chars, grams)


def test_repetition_equals_the_plain_version(docs_of, prose):
    once = prose(1, 60)
    texts = [*ODD, once, once + "\n" + once, f"{once} ## {once[:200]}\n\nx\nx\n x\nx", "a b\na b\r\na b", "tail line\n"]
    got = docs_of(texts).select("n_words", repetition.repetition(F.col("text")).alias("c")).collect()
    for row, text in zip(got, texts, strict=True):
        c = row.c
        assert (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words, c.dup_line_chars,
                list(c.dup_ngram_chars)) == plain_repetition(text)
        assert row.n_words == "kept"


@pytest.mark.parametrize("joint", ["", " "])
def test_structured_words_and_lines_are_told_apart(docs_of, joint):
    """Sequences that polynomial hashes modulo a power of two take for equal."""
    lines = [joint.join("ab"[bin(i).count("1") + flip & 1] for i in range(2048)) for flip in (0, 1)]
    text = f"{lines[0]}\n{lines[1]}\n{lines[0]} {lines[1]} tail"
    c = docs_of([text]).select(repetition.repetition(F.col("text")).alias("c")).first().c
    assert (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words, c.dup_line_chars,
            list(c.dup_ngram_chars)) == plain_repetition(text)


def test_repetition_verdicts(docs_of, prose):
    fine, twice = prose(2, 200), prose(3, 40)
    docs = docs_of([fine, (twice + "\n") * 2, "few words", None]).withColumn("key", repetition.repetition(F.col("text")))
    got = docs.select(repetition.base_failed("key").alias("base"), repetition.repetitive("key").alias("rep")).collect()
    assert [(r.base, r.rep) for r in got] == [(False, False), (True, True), (True, False), (True, False)]


def item_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_hits(text, items, window=13):
    words, hit, found = item_words(text), set(), set()
    for name, item in items:
        own = item_words(item)
        n = min(window, len(own))
        for i in range(len(own) - n + 1 if own else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == own[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(name))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination_equals_the_plain_version(spark, docs_of, prose, block_bytes):
    items = [(i, prose(40 + i, 12 + 3 * i)) for i in range(6)] + [(7, "Née 3x"), (8, None), (9, "..."), (10, prose(40, 12))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    parts = [t for _, t in items if t]
    texts = [*[t for t in ODD if t is None or len(t) < 30_000], prose(9, 80) + ", " + parts[3].upper().replace(" ", "--") + ". " + prose(8, 30),
             f"x {parts[0]}y {parts[1][:-6]}", "Née, 3x! née 3x", parts[5] * 2]
    got = decontaminate.mark_hits(docs_of(texts), bench, block_bytes=block_bytes, into="key").collect()
    for row, text in zip(got, texts, strict=True):
        assert (row.key.n_words, row.key.n_hit, sorted(row.key["items"])) == plain_hits(text, items)
        inside = [w for s in row.key.spans for w in item_words(text[s.start : s.end])]
        assert len(inside) == row.key.n_hit


def test_decontamination_of_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.mark_hits(docs_of(["some text"]), none).first().hits.n_hit == 0
    some = spark.createDataFrame([(1, "some text")], "item_id long, text string")
    assert decontaminate.mark_hits(docs_of([]), some).count() == 0
    row = decontaminate.mark_hits(docs_of(["Some text"]), some).withColumn("c", decontaminate.is_contaminated()).first()
    assert row.c and row.hits["items"] == ["1"]


def labelled(words, n: int, seed: int):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.randint(40, 200))]
        if i % 3 == 0:
            for k in range(0, len(own), 25):
                own[k] = rng.choice(["blorgface", "wugsnort", "zibblehead"])
        texts.append(" ".join(own))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_toxicity_finds_what_sets_toxic_texts_apart(words):
    model = toxicity.train(*labelled(words, 360, 1))
    texts, labels = labelled(words, 150, 2)
    scores = np.array([model.score(t) for t in texts])
    labels = np.array(labels)
    assert (scores[labels == 1] >= 0.7).mean() > 0.9
    assert (scores[labels == 0] < 0.7).mean() > 0.97


def test_toxicity_of_odd_texts_and_labels(spark, docs_of, words):
    texts, labels = labelled(words, 90, 3)
    docs = docs_of([*texts, *ODD])
    marks = [(i, v) for i, v in enumerate(labels)] + [(0, 0), (1, None), (None, 1), (10**6, 1)]
    table = spark.createDataFrame(marks, "doc_id long, toxic int")
    sample = toxicity.training_sample(docs.union(docs), table)
    assert len(sample[0]) == 90 and sample[1][0] == 1
    assert sample == toxicity.training_sample(docs.repartition(7), table)
    scored = docs.withColumn("key", toxicity.toxicity(F.col("text"), toxicity.train(*sample))).collect()
    assert all(0 <= r.key <= 1 for r in scored) and len({r.key for r in scored[90:92]}) == 1
    for kinds, expected in ((([], []), 0.5), ((["a"], [0]), 0.0), ((["a"], [1]), 1.0)):
        assert toxicity.train(*kinds).score("any") == pytest.approx(expected, abs=1e-6)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = recurrent.Network(70, 5, seed=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.p["x"] *= 5
    inputs, goals = rng.integers(0, 75, (5, 4)), rng.integers(0, 75, (5, 4))
    inputs[2, 1] = net.start
    h = rng.normal(0, 0.3, (4, recurrent.HIDDEN))
    g, _, loss = net.gradients(inputs, goals, h)
    for name in net.p:
        flat = net.p[name].reshape(-1)
        for i in rng.choice(len(flat), 12):
            old, d = flat[i], 1e-5
            flat[i] = old + d
            up = net.gradients(inputs, goals, h)[2]
            flat[i] = old - d
            down = net.gradients(inputs, goals, h)[2]
            flat[i] = old
            assert g[name].reshape(-1)[i] == pytest.approx((up - down) / (2 * d) / 20, abs=2e-5)


def test_probabilities_add_up_and_the_state_is_carried():
    net = recurrent.Network(64, 6, seed=2)
    h = np.random.default_rng(1).normal(0, 0.5, (1, recurrent.HIDDEN)).astype(np.float32)
    every = net.log_likelihoods(np.repeat(h, 70, 0), np.arange(70))
    assert np.exp(every).sum() == pytest.approx(1, abs=1e-4)
    rng = np.random.default_rng(4)
    lengths = [1, 3000, 2, 700, 1]
    ids = rng.integers(0, 70, sum(lengths))
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    gates = net.p["x"] + net.p["b"]
    for got, a, b in zip(net.score(ids, offsets), offsets, offsets[1:], strict=False):
        h, before, total = np.zeros((1, recurrent.HIDDEN), np.float32), net.start, 0.0
        for i in ids[a:b]:
            h = net.step(gates[[before]], h)[0]
            total += net.log_likelihoods(h, np.array([i]))[0]
            before = i
        assert got == pytest.approx(total, rel=1e-4)


def test_language_model_counts_and_gain(spark, words, prose):
    texts = [prose(100 + i, 60) for i in range(150)] + ODD + ["unseen wordform " * 3]
    rows = [(i, t, i % 5 != 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    scores, vocabulary = lm_scores.lm_scores(docs)
    tokens = [[*WORD.findall((t or "").translate(LOWER)), lm_scores.END] for t in texts]
    count = Counter(w for (_, _, train), own in zip(rows, tokens, strict=True) if train for w in own)
    total, size = sum(count.values()), len(count)
    assert (vocabulary.total, vocabulary.size) == (total, size)
    got = {r.doc_id: r for r in scores.collect()}
    for (i, _, train), own in zip(rows, tokens, strict=True):
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (size + 1))) for w in own)
        assert (got[i].train, got[i].n_tokens, got[i].n_known) == (train, len(own), sum(count[w] > 0 for w in own))
        assert got[i].base_score == pytest.approx(base)
        assert math.isfinite(got[i].score) and got[i].score < 0
    prose_ids = [i for i in range(150) if i % 5 == 1]
    assert sum(got[i].score for i in prose_ids) > sum(got[i].base_score for i in prose_ids)


def test_language_model_of_few_texts(spark):
    schema = "doc_id long, text string, train boolean"
    none = lm_scores.lm_scores(spark.createDataFrame([], schema))
    assert none[0].count() == 0 and none[1].total == 0
    alone = lm_scores.lm_scores(spark.createDataFrame([(1, "a b", False), (1, "a b", False)], schema))[0].collect()
    assert [(r.n_tokens, r.n_known) for r in alone] == [(3, 0), (3, 0)]




def test_scores_do_not_depend_on_partitions(spark, words, prose, monkeypatch):
    monkeypatch.setattr(lm_scores, "PART_TOKENS", 1_500)
    monkeypatch.setattr(lm_scores, "BLOCK_BYTES", 20_000)
    rows = [(i, prose(300 + i, 20 + i), i % 5 != 1) for i in range(120)] + [(3, prose(303, 23), True)] * 4 + [(None, None, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    found = []
    for parts in (1, 4):
        scores, vocabulary = lm_scores.lm_scores(docs.repartition(parts))
        assert vocabulary.total > 2 * lm_scores.PART_TOKENS
        found.append(sorted((r.doc_id or -1, r.n_tokens, r.base_score, r.score) for r in scores.collect()))
    assert len(found[0]) == len(rows)
    for x, y in zip(*found, strict=True):
        assert x[:2] == y[:2]
        assert x[2] == pytest.approx(y[2], rel=1e-9)
        assert x[3] == pytest.approx(y[3], rel=1e-6)


def test_every_training_text_reaches_the_network(spark, monkeypatch):
    """With the seed cut to one text, the words of any other text in another order change the weights."""
    monkeypatch.setattr(lm_scores, "SEED_TOKENS", 1)
    vocabulary = lm_scores.Vocabulary([(f"w{i}", 40 - i) for i in range(40)], *np.zeros((2, lm_scores.TAILS), np.int64), 820, 40)
    ids = np.random.default_rng(4).integers(0, 40, (12, 30))

    def weights(changed: int | None) -> np.ndarray:
        own = ids.copy()
        if changed is not None:
            own[changed] = own[changed][::-1]
        row = (0, list(range(12)), [True] * 11 + [False], [30] * 12, own.astype("<u2").tobytes())
        texts = spark.createDataFrame(
            [row], "block bigint, hashes array<bigint>, train array<boolean>, lengths array<bigint>, ids binary"
        )
        return lm_scores._flat(lm_scores.trained(texts, vocabulary).p)

    base = weights(None)
    # The text of the least hash seeds the weights; each of the others counts as well.
    assert [np.array_equal(weights(i), base) for i in range(1, 12)] == [False] * 10 + [True]


def test_an_item_without_an_id_hits_unnamed(spark, docs_of):
    items = spark.createDataFrame([(None, "one two three four"), ("b", "five six seven")], "item_id string, text string")
    docs = docs_of(["so one two three four", "five six seven", "none"])
    for size in (1 << 18, 1):
        rows = decontaminate.mark_hits(docs, items, block_bytes=size).orderBy("doc_id").select("hits.*").collect()
        assert [(r.n_hit, r["items"]) for r in rows] == [(4, []), (3, ["b"]), (0, [])]


def test_a_large_benchmark_is_one_automaton(spark, docs_of, words, monkeypatch):
    """A megabyte of items is scanned for in one pass; beyond its bound a benchmark is refused."""
    rng = random.Random(12)
    texts = [" ".join(rng.choice(words) for _ in range(1_700)) for _ in range(100)]
    assert sum(map(len, texts)) > 1 << 20
    items = spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(texts)], "item_id string, text string")
    passages = [" ".join(texts[k].split()[40 : 40 + n]) for k, n in ((3, 12), (5, 13), (7, 30))]
    docs = docs_of([f"before {p} behind" for p in passages])
    marked = decontaminate.mark_hits(docs, items)
    rows = marked.orderBy("doc_id").select("hits.*").collect()
    assert [(r.n_hit, r["items"]) for r in rows] == [(0, []), (13, ["i5"]), (30, ["i7"])]
    assert marked._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    monkeypatch.setattr(decontaminate, "MAX_BYTES", 1 << 20)
    with pytest.raises(ValueError, match="driver"):
        decontaminate.mark_hits(docs, items)
