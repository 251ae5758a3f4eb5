"""Small corpora for the operators on text."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import SparkSession

from sprintmart.llm.workers import prepare

ODD = ["", None, " ", "\n\t ", "a", "The the THE the the the", "é漢字 😀 x" * 40, "z" * 70_000, "w " * 9_000, "\x00\x01 <s> </s>\r\n"]


@pytest.fixture(autouse=True)
def workers(spark: SparkSession) -> None:
    prepare(spark)


@pytest.fixture(scope="session")
def words() -> list[str]:
    rng = random.Random(5)
    return ["".join(rng.choice(["tha", "re", "on", "sch", "ñó", "el", "ing", "x"]) for _ in range(rng.randint(1, 4))) for _ in range(600)]


@pytest.fixture(scope="session")
def prose(words):
    def make(seed: int, n: int) -> str:
        rng = random.Random(seed)
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", " ", " ", ". ", "\n"]) for _ in range(n)).strip()

    return make


@pytest.fixture
def docs_of(spark):
    """Rows (doc_id, text, n_words, key): the last two are columns of the input that operators use as names too."""

    def make(texts, first: int = 0):
        rows = [(first + i, t, "kept", "own") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, n_words string, key string")

    return make
