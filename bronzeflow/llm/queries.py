"""The registered queries of this subpackage; their rows are those of the contracts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.llm import (
    automata,
    bpe,
    codes,
    dialogues,
    minhash,
    mixing,
    neighbours,
    quality,
    sharding,
    simhash,
    suffixes,
    tokens,
    toxicity,
)
from bronzeflow.llm.common import count_words, scratch, table, whole_text
from bronzeflow.llm.oracle import ORACLE_SQL  # noqa: F401

N_SHARDS = 40
#: Context length that a document is held against.
TOKEN_LIMIT = 1024
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))
    return tokens.count_tokens(docs, VOCABULARY).select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = suffixes.without_repeats(docs)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return kept.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept_text")).alias("n_removed"),
        F.coalesce(F.size("kept_text_spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, VOCABULARY))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), N_SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", _held_out().alias("held_out"))
    # One label per document: toxic if any of its rows says so.
    labels = table(spark, sf_dir, "labels").where("toxic IN (0, 1)")
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labelled = docs.where(~F.col("held_out")).join(labels, "doc_id").select("text", "toxic")
    return toxicity.score(docs, labelled).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def _held_out() -> Column:
    """Remainder 0 of the id's checksum by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.aggregate(
        "kept_words_spans", F.lit(0), lambda n, x: n + x["end"] - x["start"]
    )
    n_removed = F.coalesce(removed, F.lit(0)).cast("long")
    return automata.without_held_passages(docs).select(
        "doc_id",
        (count_words(F.col("kept_words")) + n_removed).alias("n_words"),
        n_removed.alias("n_removed"),
        F.sha2("kept_words", 256).alias("kept_sha256"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return judged.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        "source",
    )


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = dialogues.repair(damaged(table(spark, sf_dir, "conversations")))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return dialogues.summaries(pieces).select(
        F.when(F.col("name") != "", F.substring("name", 2, 64).cast("long")).alias("conv_id"), *counts
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by the checksum of id and turn; nulls are one space."""
    conv, turn, role, text = (
        F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")
    )
    fault = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit(""))
        .when(fault == 2, F.regexp_replace(text, r"[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    coded, books = codes.compress(vectors, carry=["vec_id", "label"])
    coded = scratch(coded.select("row.vec_id", "row.label", "code", "error"), "op12-codes")
    # Sums beyond a long end at it. Names of their own, since both sides are one table.
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(codes.MOST))
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(
        total.cast("long").alias("label_error")
    )
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_bpe": op4_bpe,
    "op5_sharding": op5_sharding,
    "op6_toxicity": op6_toxicity,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op10_minhash": op10_minhash,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_vector_codes": op12_vector_codes,
    "op13_simhash": op13_simhash,
}
