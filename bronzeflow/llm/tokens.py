"""Token counts, huge texts being encoded in overlapping chunks.

A chunk runs a stretch past the start of the next one. In that overlap both
encodings report, with offsets, where the words start that they cut the text
into. A start that both have is a proven stable boundary: how the tokenizer goes
on from the start of a word depends on what follows only, and the left chunk
sees enough of that, since the last few characters of its overlap are not used.
The counts are spliced there. Where the two do not meet (one word may be longer
than the overlap), the text is encoded again with chunks and overlaps four times
as wide, and at last as one chunk.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Encoding, Tokenizer

from bronzeflow.llm.common import free_name, partitions, scratch, whole_text

#: Characters of a chunk, and of its overlap with the next one.
CHUNK, OVERLAP = 32_768, 1024
#: Characters at the end of a chunk where its words are not settled: a special
#: token or the look-ahead of the split may need what follows.
UNSETTLED = 64
WIDER = 4

#: Of the word starts of an overlap: where they are, and the tokens before each.
SEAM = "struct<at:array<long>, before:array<long>>"


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def count_tokens(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    count_col: str = "n_tokens",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``docs`` with one more column, the number of tokens of the whole text.

    * Null and empty texts have none. Special strings in a text are special
      tokens, as the library takes them by default; nothing is added or cut.
    * Texts of more than ``chunk`` characters go through as chunks, equal ones
      once, however often they are repeated.
    * Other columns pass through; if one is called ``count_col`` already, the new
      one has underscores in front. An empty table gives no rows.
    """
    name = free_name(docs, count_col)
    huge = F.length(whole_text(text_col)) > chunk
    short = _counted(docs.where(~huge), path, text_col, name)
    keyed, key = docs.where(huge), free_name(docs, "text_key")
    keyed = keyed.withColumn(key, F.sha2(text_col, 256))
    texts = keyed.groupBy(F.col(key).alias("key")).agg(F.first(text_col).alias("text"))
    counts = _count_huge(texts, path, chunk, overlap)
    if counts is None:
        return short
    counts = counts.withColumnsRenamed({"key": f"_{key}", "tokens": name})
    joined = keyed.join(counts, F.col(key) == F.col(f"_{key}")).drop(key, f"_{key}")
    return short.unionByName(joined)


def _counted(docs: DataFrame, path: str, text_col: str, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            counts: list[int] = []
            for lo in range(0, len(texts), 256):
                part = [x or "" for x in texts.slice(lo, 256).to_pylist()]
                counts += map(len, own.encode_batch_fast(part, add_special_tokens=False))
            columns = [*batch.columns, pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, name])

    fields = [*docs.schema.fields, T.StructField(name, T.LongType())]
    return docs.mapInArrow(run, T.StructType(fields))


def _count_huge(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame | None:
    """``(key, tokens)`` of ``(key, text)``; None if there is no text."""
    pending = scratch(texts, "tokens-huge")
    found = None
    while not pending.isEmpty():
        spliced = scratch(_spliced(pending, path, chunk, overlap), "tokens-spliced")
        done = spliced.where("tokens IS NOT NULL")
        found = done if found is None else found.unionByName(done)
        failed = spliced.where("tokens IS NULL").select("key")
        pending = scratch(pending.join(failed, "key", "left_semi"), "tokens-huge")
        chunk, overlap = chunk * WIDER, overlap * WIDER
    return found


def _spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``(key, tokens)``, null where two neighbours share no settled word start."""
    spark = texts.sparkSession
    chunks = texts.mapInArrow(
        _cutter(chunk, overlap),
        "key string, n int, start long, last boolean, reaches_end boolean, piece string",
    )
    # By chunk, so that those of one text go to many tasks.
    dealt = chunks.repartition(partitions(spark), "key", "n")
    encoded = dealt.mapInArrow(
        _seam_finder(path, chunk, overlap),
        f"key string, n int, last boolean, tokens long, entry {SEAM}, exit {SEAM}",
    )
    none = F.lit(None).cast(SEAM)
    seams = encoded.select(
        "key",
        F.explode(
            F.array(
                F.struct(
                    F.col("n").alias("seam"),
                    none.alias("left"),
                    F.col("entry").alias("right"),
                    F.lit(0).cast("long").alias("tail"),
                ),
                F.struct(
                    (F.col("n") + 1).alias("seam"),
                    F.col("exit").alias("left"),
                    none.alias("right"),
                    F.when(F.col("last"), F.col("tokens")).otherwise(0).alias("tail"),
                ),
            )
        ).alias("s"),
    ).select("key", "s.*")
    met = seams.groupBy("key", "seam").agg(
        F.first("left", ignorenulls=True).alias("left"),
        F.first("right", ignorenulls=True).alias("right"),
        F.sum("tail").alias("tail"),
    )
    total = F.when(
        F.count("gain") == F.count(F.lit(1)), F.sum(F.col("gain") + F.col("tail"))
    )
    gains = met.select("key", "tail", _splice().alias("gain"))
    return gains.groupBy("key").agg(total.alias("tokens"))


def _splice() -> Column:
    """Tokens left of the first common start, less those the right chunk has before it.

    0 at either end of the text, where there is one side only.
    """
    common = F.array_min(F.array_intersect("left.at", "right.at"))
    before = lambda side: F.element_at(
        f"{side}.before", F.nullif(F.array_position(f"{side}.at", common), F.lit(0)).cast("int")
    )
    inner = F.col("left").isNotNull() & F.col("right").isNotNull()
    return F.when(inner, before("left") - before("right")).otherwise(0)


def _cutter(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "n", "start", "last", "reaches_end", "piece"]
        types = [pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        for batch in batches:
            for i in range(batch.num_rows):
                key, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for n, start in enumerate(range(0, len(text), chunk)):
                    last = start + chunk >= len(text)
                    piece = text[start : start + chunk + overlap]
                    row = [key, n, start, last, start + len(piece) == len(text), piece]
                    columns = [pa.array([v], t) for v, t in zip(row, types)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _seam_finder(path: str, chunk: int, overlap: int):
    """Of each chunk, the word starts in its two overlaps and the tokens before each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        numbers = pa.list_(pa.int64())
        seam = pa.struct([("at", numbers), ("before", numbers)])
        names = ["key", "n", "last", "tokens", "entry", "exit"]
        types = [pa.string(), pa.int32(), pa.bool_(), pa.int64(), seam, seam]
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                whole = own.encode(row["piece"], add_special_tokens=False)
                start, size = row["start"], len(row["piece"])
                settled = size if row["reaches_end"] else size - UNSETTLED
                entry = exit_ = None
                if row["n"]:
                    entry = word_starts(whole, 0, overlap, start)
                if not row["last"]:
                    exit_ = word_starts(whole, chunk, settled, start)
                rows.append((row["key"], row["n"], row["last"], len(whole), entry, exit_))
            columns = [pa.array(list(v), t) for v, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def word_starts(encoded: Encoding, low: int, high: int, shift: int) -> dict[str, list[int]]:
    """Word starts between two offsets, and how many tokens come before each."""
    found: dict[str, list[int]] = {"at": [], "before": []}
    previous = None
    for k, ((at, _), word) in enumerate(zip(encoded.offsets, encoded.word_ids)):
        if (word is None or word != previous) and low <= at < high:
            found["at"].append(at + shift)
            found["before"].append(k)
        previous = word
    return found
