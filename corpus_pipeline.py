"""From raw documents to token ids: five stages, each the work of one operator.

Every stage takes what its predecessor kept and gives documents again, the last
one the encoded documents. Between stages the documents are written, so a lost
executor costs the running stage only.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.llm import bpe, minhash, mixing, quality, suffixes
from bronzeflow.llm.common import scratch, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.kept_documents(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.deduplicated(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand elsewhere too go; a document may end up empty."""
    kept = suffixes.without_repeats(docs, as_text=True)
    changed = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumns(changed).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of the ids, and of the text that they decode to."""
    return bpe.digests(bpe.round_trip(docs.select("doc_id", "text"), VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]

#: Estimation, sampling and tokenizing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
