"""Five stages that turn ``documents`` into training data, each over all that the one before has kept.

``STAGES`` lists them as (name, function of (spark, docs, sf_dir)); the result of each is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of ``documents``.

Rows that are equal in all columns fare alike, except that near-duplicate removal keeps one of them. A null
or an empty text is never toxic, repeated, a near duplicate or contaminated; it has no tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sprintmart.llm import bpe, decontaminate, line_dedup, ngram_join, toxicity
from sprintmart.llm.stored import stored
from sprintmart.llm.workers import prepare

#: Documents from this score on are rejected.
TOXIC_FROM = 0.7

#: The stages pass through Python functions and joins of hashed rows, which SQL has no words for.
ORACLE_SQL = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance model rejects go. It learns from the labels of two thirds of
    the documents, as the single query does. Texts without words stay."""
    prepare(spark)
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 3
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold != 1)
    model = toxicity.train(*toxicity.training_sample(docs, labels))
    score = toxicity.toxicity(F.col("text"), model)
    kept = docs.withColumn("_score", score).where((F.col("_score") < TOXIC_FROM) | ~F.coalesce("text", F.lit("")).rlike(r"\S"))
    return kept.select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand at an earlier place go; a document that consists of such passages alone goes with
    them. ``n_chars`` follows the text."""
    prepare(spark)
    cleaned = line_dedup.without_repeats(docs, into="_repeats")
    emptied = (F.col("_repeats.removed_words") > 0) & ~F.col("_repeats.text").rlike(r"[^\x20\x09-\x0D]")
    changed = F.col("_repeats.removed_words") > 0
    return cleaned.where(~emptied).select(
        *(
            F.col("_repeats.text").alias("text") if c == "text"
            else F.when(changed, F.char_length("_repeats.text").cast("long")).otherwise(F.col(c)).alias(c)
            if c == "n_chars"
            else F.col(c)
            for c in docs.columns
        )
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    prepare(spark)
    marked = decontaminate.mark_hits(docs, table(spark, sf_dir, "benchmark"), into="_hits")
    return marked.where(~decontaminate.is_contaminated("_hits")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    prepare(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = docs.select("doc_id", "lang", "source", bpe.round_trip(F.col("text"), path, public_tokenizers.PATTERN).alias("t"))
    return both.select(
        "doc_id",
        "lang",
        "source",
        F.size("t.ids").cast("long").alias("n_tokens"),
        F.col("t.ids").alias("ids"),
        F.col("t.decoded").cast("string").alias("text"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_passages),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
