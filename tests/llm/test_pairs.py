"""Near duplicates, components and line dedup against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sprintmart.llm import line_dedup, ngram_join
from sprintmart.llm.components import components
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text: str | None) -> set[tuple[str, ...]]:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def root(parent: dict, x):
    while parent[x] != x:
        x = parent[x]
    return x


def plain_components(texts: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    sets = {i: shingle_set(t) for i, t in texts.items()}
    parent = {i: i for i in texts}
    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((root(parent, a), root(parent, b)))
                    parent[y] = x
    return {i: (len(sets[i]), root(parent, i)) for i in texts}


def edited(text: str, rng: random.Random, share: float, words: list[str]) -> str:
    return " ".join(rng.choice(words) if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="module")
def crowd(words, prose):
    """Copies, near copies at all distances, a shared passage, and texts of their own."""
    rng = random.Random(11)
    texts = [prose(i, rng.randint(6, 120)) for i in range(40)]
    base, passage = prose(500, 150), prose(501, 45)
    texts += [base] * 25 + [edited(base, rng, rng.choice([0.005, 0.01, 0.02, 0.03, 0.05]), words) for _ in range(60)]
    texts += [prose(600 + i, 12) + " " + passage for i in range(30)]
    texts += [base.upper(), "  " + base.replace(" ", "\t") + "\n", "one two three", "ONE two\nthree", "one two three four"]
    texts += [t for t in ODD if t is None or len(t) < 20_000]
    rng.shuffle(texts)
    return texts


def test_groups_equal_brute_force(docs_of, crowd):
    docs = docs_of(crowd, first=100)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicate_groups(docs).collect()}
    assert got == plain_components({100 + i: t for i, t in enumerate(crowd)})


def test_one_document_of_each_group_stays(spark, docs_of, crowd):
    docs = docs_of(crowd)
    again = docs.where("doc_id < 30")
    extra = spark.createDataFrame([(None, crowd[0], "kept", "own"), (None, "only here and nowhere else", "kept", "own")], docs.schema)
    kept = ngram_join.keep_one(docs.union(again).union(extra))
    assert kept.columns == docs.columns
    expected = plain_components(dict(enumerate(crowd)))
    with_words = sorted(i for i, (n, c) in expected.items() if n and c == i)
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None and shingle_set(r.text)) == with_words
    assert [r.text for r in rows if r.doc_id is None] == ["only here and nowhere else"]
    wordless = [i for i, (n, _) in expected.items() if not n]
    assert sorted(r.doc_id for r in rows if r.doc_id is not None and not shingle_set(r.text)) == sorted(
        wordless + [i for i in wordless if i < 30]
    )


def test_groups_of_an_empty_table(docs_of):
    assert ngram_join.near_duplicate_groups(docs_of([])).count() == 0
    assert ngram_join.keep_one(docs_of([])).count() == 0
    alone = ngram_join.near_duplicate_groups(docs_of([None, ""])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in alone) == [(0, 0, 0), (1, 0, 1)]


def test_the_filters_let_every_link_pass(words):
    """The integer forms of the prefix, positional and suffix bounds at the very threshold."""
    for n in range(1, 60):
        for k in range(n, 81):
            need = -(-3 * (n + k) // 7)
            if need > n:
                continue
            # With just enough in common, the sets differ in n + k - 2 * need places.
            assert (n + k - 2 * need) * 7 <= n + k
            assert need >= -(-3 * n // 4) or need >= -(-6 * n // 7)
            assert 4 * n >= 3 * k


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(1, 80)] + [(7, 7), (900, 901), (901, 900)]
    edges += [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(90)]
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        x, y = sorted((root(parent, a), root(parent, b)))
        parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    alone = {x for x in parent if all({x} == {a, b} or x not in (a, b) for a, b in edges)}
    assert got == {x: root(parent, x) for x in parent if x not in alone}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def pieces(text: str, n: int) -> list[str]:
    at = [m.span() for m in WORD.finditer(text)]
    return [text[at[i][0] : at[i + n - 1][1]] for i in range(len(at) - n + 1)]


def test_repeated_passages_go_and_nothing_else(docs_of, prose):
    rng = random.Random(4)
    shared = [prose(900 + i, 55 + 12 * i) for i in range(8)]
    short = prose(990, 49)
    texts = []
    for i in range(60):
        own = [prose(2000 + i, rng.randint(5, 90)), prose(3000 + i, rng.randint(5, 90))]
        texts.append(rng.choice([" ", "\n"]).join([own[0], shared[i % 8] if i < 48 else short, own[1]]))
    docs = docs_of([*texts, *ODD])
    rows = sorted(line_dedup.without_repeats(docs, into="key").collect(), key=lambda r: r.doc_id)
    cleaned = [r.key.text for r in rows]
    left = [sum(" ".join(p.split()) in " ".join((t or "").split()) for t in cleaned) for p in shared]
    assert left == [1] * 8
    for i, row in enumerate(rows[:60]):
        count = len(WORD.findall(texts[i]))
        assert row.key.removed_words == count - len(WORD.findall(row.key.text))
        if i >= 48:
            assert row.key.text == texts[i]
    before = {p for t in texts for p in pieces(t, 6)}
    after = {p for t in cleaned if t for p in pieces(t, 6)}
    gone = before - after
    # Only pieces across an edge of a removed passage are gone.
    assert len(gone) <= 40 * 2 * 5
    assert [r.n_words for r in rows] == ["kept"] * len(rows)


def test_copies_and_odd_texts_of_line_dedup(docs_of, prose):
    whole = prose(77, 300)
    docs = docs_of([whole, whole, whole.replace(" ", "  ", 1), None, "", "short text"])
    rows = line_dedup.without_repeats(docs.union(docs.where("doc_id = 3")), into="key").collect()
    rows.sort(key=lambda r: r.doc_id)
    texts = [r.key.text for r in rows]
    assert sorted(len(WORD.findall(t)) > 290 for t in texts[:2]) == [False, True]
    assert texts[3:] == [None, None, "", "short text"]
    assert line_dedup.without_repeats(docs_of([])).count() == 0


def test_rows_equal_in_id_and_text_fare_alike(docs_of, prose):
    docs = docs_of([prose(78, 200)])
    rows = line_dedup.without_repeats(docs.union(docs)).collect()
    assert [r.repeats.removed_words for r in rows] == [0, 0]


def test_equal_runs_compare_bytes():
    def found(pairs, min_words):
        x, y = (b"".join(p[k] for p in pairs) for k in (0, 1))
        offsets = [np.concatenate(([0], np.cumsum([len(p[k]) for p in pairs]))) for k in (0, 1)]
        flat = [np.frombuffer(v, np.uint8) for v in (x, y)]
        skip = np.array([p[2] for p in pairs])
        return list(zip(*(c.tolist() for c in line_dedup.equal_runs(flat[0], offsets[0], flat[1], offsets[1], skip, min_words))))

    x, y = b"a b c  d e f g", b"a b c d e x g"
    assert found([(x, y, 0)], 2) == [(0, 0, 3), (0, 3, 5)]
    assert found([(x, y, 0)], 3) == [(0, 0, 3)]
    longer = b"averylongword that-is-longer-than-eight-bytes a b"
    assert found([(x, y, 0), (longer, b"0 1 " + longer, 2), (b"", b"a", 0), (longer, longer[:-1] + b"c", 0), (b"a", b"a", 5)], 2) == [
        (0, 0, 3), (0, 3, 5), (1, 0, 4), (3, 0, 3)
    ]
    assert line_dedup.strike_words(b" a b\nc d ", [(1, 2), (1, 3)]) == (b" a d ", 2)


def test_contents_do_not_depend_on_partitions(docs_of, crowd):
    docs = docs_of(crowd)
    once, again = (
        {r.doc_id: r.component_id for r in ngram_join.near_duplicate_groups(d).collect()}
        for d in (docs, docs.repartition(9, F.rand(3)))
    )
    assert once == again


def test_every_passage_of_50_words_holds_a_chunk_with_a_stretch():
    """Between other words, in mid-line, over several lines, of few distinct words and periodic: both copies share a
    chunk and a stretch around it."""
    rng = random.Random(11)
    missing = 0
    for _ in range(4_000):
        pool = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([1, 2, 3, 60, 60, 60]))]
        cycle = [rng.choice(pool) + rng.choice([" ", " ", " ", "\n"]) for _ in range(rng.choice([1, 2, 3, 7, 50]))]
        passage = "".join((cycle * 50)[:50]).strip()
        other = lambda: " ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 40)))
        both = [f"{other()} {passage}{rng.choice([' ', chr(10)])}{other()}".strip().encode() for _ in range(2)]
        found = []
        for raw in both:
            _, hash_, _, _, around = line_dedup.chunks(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 50)
            found.append({(int(h), k, int(v)) for k, side in enumerate(around) for h, v in zip(hash_, side) if v})
        missing += not (found[0] & found[1])
    assert missing == 0


def repeated_windows(texts: list[str]) -> int:
    """Windows of 50 words, with their white space, that an earlier place has too."""
    seen, again = set(), 0
    for text in texts:
        for piece in pieces(text, 50):
            again += piece in seen
            seen.add(piece)
    return again


@pytest.mark.parametrize("copies, share", [(50, 0.02), (500, 0.02), (500, 0.03)])
def test_repeated_windows_of_near_copies_go(docs_of, words, prose, copies, share):
    """Each copy changes its own words, so the first one that shares a chunk need not share all of a passage."""
    rng = random.Random(copies)
    base = prose(5, 300)
    docs = docs_of([edited(base, rng, share, words) for _ in range(copies)])
    before = repeated_windows([r.text for r in docs.collect()])
    left = [r.repeats.text for r in line_dedup.without_repeats(docs).collect()]
    assert before > 50 * copies
    assert repeated_windows(left) <= 0.02 * before


def test_a_popular_passage_and_a_long_text(docs_of, prose):
    """Pieces of the earlier text are fixed, also where passages lie across them."""
    long = prose(31, 3_000)
    parts = pieces(long, 120)
    texts = [long] + [f"own{i} words{i} {parts[17 * i]} end{i}" for i in range(160)]
    rows = {r.doc_id: r.repeats for r in line_dedup.without_repeats(docs_of(texts)).collect()}
    left = [rows[i].text for i in range(len(texts))]
    assert repeated_windows(left) == 0
    assert sum(rows[i].removed_words for i in range(len(texts))) >= 160 * 100


def test_a_first_copy_with_other_white_space_hides_no_equal_copies(docs_of, prose):
    passage = prose(77, 120).replace("\n", " ")
    texts = [passage.replace(" ", "  "), *(f"start{i} {passage}" for i in range(6))]
    rows = line_dedup.without_repeats(docs_of(texts)).select("repeats.removed_words").collect()
    assert sum(r.removed_words >= 110 for r in rows) == 5


def thue_morse(n: int, flip: int = 0) -> list[int]:
    return [bin(i).count("1") + flip & 1 for i in range(n)]


@pytest.mark.parametrize("joint", ["", " "])
def test_structured_texts_are_told_apart(docs_of, joint):
    """Sequences that polynomial hashes modulo a power of two take for equal, as letters of a word and as words."""
    texts = [joint.join("ab"[v] for v in thue_morse(2048, flip)) for flip in (0, 1)]
    texts += [joint.join(["alpha", "beta"][v] for v in thue_morse(1024, flip)) for flip in (0, 1)]
    rows = ngram_join.near_duplicate_groups(docs_of(texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain_components(dict(enumerate(texts)))
    assert len({r.key for r in rows}) == 4


def test_pages_of_one_template_form_no_candidates(spark, docs_of):
    """A template of 81 words with 20 own words around: many share all of its shingles, none link."""
    template = " ".join(f"t{i}" for i in range(81))
    own = lambda i, side: " ".join(f"{side}{i}w{k}" for k in range(10))
    docs = docs_of([f"{own(i, 'a')} {template} {own(i, 'b')}" for i in range(400)])
    shared = ngram_join.pack_shingles(docs.select("text"), 4).groupBy("bucket").applyInArrow(
        ngram_join._shared_of_bucket(4), ngram_join._SHARED
    )
    records = shared.groupBy("part").applyInArrow(ngram_join._records_of_part, ngram_join._RECORD).cache()
    entries = ngram_join.prefix_entries(records).cache()
    assert entries.count() > 400
    members = spark.createDataFrame([], "key long, component long")
    assert ngram_join.remaining_pairs(entries, records, members).count() == 0
    # No pair is even met: nothing of the smaller side is indexed.
    assert entries.alias("x").where(ngram_join._indexed("x")).count() == 0
    assert {r.component_id for r in ngram_join.near_duplicate_groups(docs).collect()} == set(range(400))
