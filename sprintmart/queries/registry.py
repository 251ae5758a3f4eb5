"""Registration of queries and their SQL statements."""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Data:
    """The test tables of one scale."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, table: str) -> DataFrame:
        if table not in TABLES:
            raise AttributeError(table)
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Rows of an input statement; ``{name}`` stands for a table."""
        names = {name for _, name, _, _ in Formatter().parse(text) if name}
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})


def plain(text: str) -> str:
    """The same input statement for the other engine."""
    return text.format(**{t: t for t in TABLES})


def query(name: str, oracle: str | None = None):
    """Register a function of :class:`Data` under ``name``."""

    def register(make: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: make(Data(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return make

    return register
