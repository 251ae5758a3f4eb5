"""The dealt operators as queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sprintmart.llm import (
    bpe,
    decontaminate,
    line_dedup,
    lm_scores,
    ngram_join,
    periodic_runs,
    repetition,
    sharding,
    token_counts,
    toxicity,
    warc,
    whitening,
    winnowing,
)
from sprintmart.llm.workers import prepare
from sprintmart.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOXIC_FROM = 0.7
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(name: str, oracle: str | None = None):
    """Register a function of (spark, sf_dir)."""

    def register(make: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return make(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return make

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, n: int):
    """The fold of a document: crc32 of its id as text, modulo n. A null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")), F.lit(0)) % n


@query("op1_toxicity")
def toxicity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(remainder("doc_id", 3) != 1)
    model = toxicity.train(*toxicity.training_sample(docs, labels))
    return docs.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        toxicity.toxicity(F.col("text"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


@query("op2_token_counts")
def token_count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = docs.withColumn("n_tokens", token_counts.count_tokens(F.col("text"), PIECES))
    return counted.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 4096).alias("over_limit"),
    )


@query("op4_byte_bpe")
def byte_bpe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = docs.select(
        "doc_id", bpe.round_trip(F.col("text"), RANKS, public_tokenizers.PATTERN).alias("tokens")
    ).select("doc_id", "tokens.*")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op10_decontaminate")
def decontaminate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_hits(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("hits.items")), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


@query("op8_repetition")
def repetition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = docs.select("doc_id", repetition.repetition(F.col("text")).alias("counts"))
    return counted.select(
        "doc_id",
        *(f"counts.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        repetition.base_failed("counts").alias("base_failed"),
        (~repetition.base_failed("counts") & ~repetition.repetitive("counts")).alias("kept"),
        F.col("counts.dup_line_chars").alias("dup_line_chars"),
        *(F.col("counts.dup_ngram_chars")[k].alias(f"dup_{n}gram_chars") for k, n in enumerate(repetition.COVERAGE)),
    )


SHARDS = 16


@query("op7_virtual_slots")
def virtual_slot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "documents").select(
        "doc_id", sharding.text_size("text").alias("size"), sharding.text_crc32("text").alias("text_crc32")
    )
    key = ["doc_id", "size", "text_crc32"]
    records = records.withColumn("vslot", sharding.virtual_slot(key))
    totals = sharding.slot_totals(records)
    path = scratch_dir(spark, "slot-map")
    owner = sharding.first_map(sharding.SLOTS, SHARDS)
    sharding.store_map(spark, path, sharding.map_rows(1, owner, totals))
    owner = sharding.rebalance(owner, totals, SHARDS)
    sharding.store_map(spark, path, sharding.map_rows(2, owner, totals))
    placed = sharding.place(records, sharding.latest_map(spark, path), key)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("vslot").alias("virtual_slot"),
    )


@query("op6_warc")
def warc_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = warc.plan_records(table(spark, sf_dir, "pages"))
    path = scratch_dir(spark, "archives")
    # The archives are compressed already.
    warc.write_archives(planned, "2024-01-01T00:00:00Z").write.option("compression", "none").parquet(path)
    records = warc.read_archives(spark.read.parquet(path))
    return records.select(
        "page_id",
        "payload_bytes",
        F.coalesce(F.sha2("payload", 256), "payload_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


ORACLES["op6_warc"] = """
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
             min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
      FROM pages)
"""


@query("op5_ngram_join")
def ngram_join_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngram_join.near_duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


@query("op9_line_dedup")
def line_dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = line_dedup.without_repeats(docs)
    return cleaned.select(
        "doc_id",
        "repeats.removed_words",
        F.size("repeats.spans").cast("long").alias("n_passages"),
        F.sha2(F.coalesce("repeats.text", F.lit("")), 256).alias("text_sha256"),
    )


@query("op3_recurrent_lm")
def recurrent_lm_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", (remainder("doc_id", 5) != 1).alias("train")
    )
    scores, vocabulary = lm_scores.lm_scores(docs)
    return scores.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """The text; where h = crc32 of the id ends in 0 and there are n > 0 words, its words from g % n on (g = h div 10)
    repeat with a period that the contract fixes. A null id plants nothing, a null text is an empty one."""

    @F.arrow_udf("string")
    def plant(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, texts in batches:
            out = texts.fill_null("").to_pylist()
            for k, i in enumerate(ids.to_pylist()):
                h = 1 if i is None else zlib.crc32(str(i).encode())
                if h % 10 == 0 and (words := out[k].encode().split()):
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    period = words[a : a + p]
                    tail = (period * (-(-(n - a) // p)))[: n - a]
                    out[k] = b" ".join(words[:a] + tail).decode()
            yield pa.array(out, pa.string())

    return plant(doc_id, text)


@query("op11_periodic_runs")
def periodic_run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    planted = with_planted_period(F.col("doc_id"), F.col("text"))
    found = docs.select("doc_id", periodic_runs.periodic_runs(planted).alias("p"))
    found = found.select("doc_id", "p.n_words", "p.runs", "p.collapsed", periodic_runs.best_run("p.runs").alias("best"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(periodic_runs.run_lines("runs"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


@query("op12_whitening")
def whitening_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query("op13_winnowing")
def winnowing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = winnowing.edited_pairs(table(spark, sf_dir, "documents"))
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.as_text("hashes").alias("fingerprint"),
        winnowing.as_text("edited_hashes").alias("edited_fingerprint"),
        winnowing.likeness("hashes", "edited_hashes").alias("near_edited"),
        winnowing.likeness("hashes", "next_hashes").alias("near_next"),
        "next_id",
        F.expr("aggregate(gaps, 0, (a, g) -> a + g)").alias("last_position"),
    )
