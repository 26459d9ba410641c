"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from kickflow.llm import (
    alignment,
    bpe,
    cotraining,
    decontamination,
    exact_dedup,
    near_dedup,
    periodic,
    sharding,
    suffix_dedup,
    toxicity,
    url_filter,
    warc,
    word_bpe,
)
from kickflow.llm.common import stored
from kickflow.session import shared_folder

RANKS = "byte_bpe_multi_50k.tiktoken"
WORDS = "word_bpe_49k.json"
ALIGNED_PAIR = ("byte_bpe_50k.json", "piece_bpe_32k.model")
URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def training_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Labelled documents that are not held out: ``id``, ``text``, ``label``.

    A document with several labels counts once, with the highest.
    """
    labels = labels.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label).alias("label"))
    # The labels are as many as the documents in the end; a broadcast would only suit small ones.
    labels = labels.where("label IS NOT NULL").hint("merge")
    return docs.select("doc_id", "text").join(labels, "doc_id").select(
        F.col("doc_id").alias("id"), "text", "label"
    )


def held_out(id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(id.cast("string")) % 3 == 1, F.lit(False))


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op2_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.with_full_payloads(warc.read_warc(spark, path)).select(
        warc.page_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_id("refers_to").alias("refers_to"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    found = cotraining.quality(
        table(spark, sf_dir, "documents"), labels.where(~held_out(F.col("doc_id")))
    )
    return found.withColumns(
        {
            "held_out": held_out(F.col("doc_id")),
            "predicted": (F.col("score") >= cotraining.THRESHOLD).cast("int"),
        }
    )


def op6_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return found.select("doc_id", "keep_id", "group_size", "kept", digest)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(RANKS)
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = toxicity.train(training_rows(docs, table(spark, sf_dir, "labels"), "toxic"))
    return toxicity.score(docs, index).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "evidence",
    )


def looped(id: F.Column, text: F.Column) -> F.Column:
    """A tenth of the texts, by id, from some word on with a stretch of words again and again."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.nullif(F.size(words), F.lit(0)).cast("long")
    hash = F.crc32(id.cast("string"))
    turn = F.floor(hash / 10).cast("long")
    first = turn % n
    times = 3 + turn % 8
    period = 1 + F.floor((n - first) / times).cast("long")
    cycle = F.slice(words, (first + 1).cast("int"), period.cast("int"))
    # The period is longer than that part of the rest, so it fits less often than that.
    rest = F.slice(F.flatten(F.array_repeat(cycle, times.cast("int"))), F.lit(1), (n - first).cast("int"))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), first.cast("int")), rest), " ")
    return F.when((hash % 10 == 0) & n.isNotNull(), made).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.periodic_runs(docs).withColumn(
        "best",
        # Runs come by start, then period: the first of the greatest exponent stays.
        F.reduce(
            "runs",
            F.get("runs", F.lit(0)),
            lambda a, b: F.when(b.length * a.period > a.length * b.period, b).otherwise(a),
        ),
    )
    line = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", *[r[x].cast("string") for x in ("start", "length", "period")]), F.lit("\n"))
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = word_bpe.round_trip(docs, public_tokenizers.path(WORDS))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = map(public_tokenizers.path, ALIGNED_PAIR)
    found = alignment.aligned(docs, *paths, public_tokenizers.PATTERN).drop("text")
    groups = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    found = alignment.linked(stored(found.withColumn("groups", groups), "aligned"))
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )


QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_repeated_strings": op2_repeated_strings,
    "op3_warc": op3_warc,
    "op4_sharding": op4_sharding,
    "op5_quality": op5_quality,
    "op6_exact_duplicates": op6_exact_duplicates,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_url_filter": op8_url_filter,
    "op9_decontamination": op9_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_word_bpe": op12_word_bpe,
    "op13_alignment": op13_alignment,
}
