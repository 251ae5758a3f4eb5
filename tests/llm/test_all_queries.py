"""Every corpus query over empty tables, and over tables with nulls, repeats and columns of names it uses itself."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sprintmart.llm import queries

#: Names that the operators give to columns of their own.
CLASHES = (
    "key", "n", "at", "h", "part", "block", "train", "score", "size", "row", "spans", "start", "hits", "repeats",
    "group", "vector", "id", "component", "tokens", "slot", "shard", "payload", "first", "last", "next", "words",
)


@pytest.fixture(scope="module")
def tables(spark, words, prose, tmp_path_factory):
    rng = random.Random(17)
    texts = [prose(i, rng.randint(1, 120)) for i in range(50)] + [prose(3, 90)] * 4 + [None, "", " \n", "x" * 900]
    docs = [(i, t, "en", "web", len(t or "")) for i, t in enumerate(texts)] + [(None, prose(9, 40), None, None, None), (2, texts[2], "en", "web", 1)]
    data = {
        "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([(i, i % 2, i % 3 % 2) for i in range(50)] + [(None, None, 1), (1, 0, None)], "doc_id long, quality int, toxic int"),
        "embeddings": ([(i, [rng.gauss(0, 1) for _ in range(5)], 1) for i in range(40)] + [(None, [0.0] * 5, 1), (7, None, None)],
                       "vec_id long, embedding array<float>, label int"),
        "pages": ([(i, f"http://x/{i}", t) for i, t in enumerate(texts)], "page_id long, url string, html string"),
        "benchmark": ([(0, prose(1, 30)), (1, None), (None, prose(2, 20))], "item_id long, text string"),
    }
    roots = {k: str(tmp_path_factory.mktemp(k)) for k in ("plain", "wide", "empty")}
    for name, (rows, schema) in data.items():
        frame = spark.createDataFrame(rows, schema).repartition(3)
        frame.write.parquet(f"{roots['plain']}/{name}.parquet")
        extra = {c: F.lit(i) for i, c in enumerate(CLASHES) if c not in frame.columns}
        frame.withColumns(extra).write.parquet(f"{roots['wide']}/{name}.parquet")
        frame.limit(0).write.parquet(f"{roots['empty']}/{name}.parquet")
    return roots


def rounded(value):
    return round(value, 3) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_other_columns_change_nothing_and_empty_tables_give_nothing(spark, tables, name):
    run = queries.QUERIES[name]
    plain, wide = (
        sorted((tuple(map(rounded, r)) for r in run(spark, tables[k]).collect()), key=repr) for k in ("plain", "wide")
    )
    assert plain == wide and len(plain) > 40
    assert run(spark, tables["empty"]).count() == 0
