"""Removal of word passages that a smaller document holds, by suffix automata.

A word goes if it is covered by a window of 13 words whose sequence also starts
in a document with a smaller id. ``repeats`` finds the places whose grams stand
in several documents; what stands around them is the reference, each different
context once, with the smallest document that has it. The reference is cut into
shards by gram, so equal windows are in one shard. Of each shard a suffix
automaton is built, whose states know the smallest document of their sequences,
and the contexts of the shard stream through it: the matching statistics give,
for every window, the smallest document that holds it.

An automaton of the whole reference would grow with the corpus and could not be
broadcast, so each shard's automaton stays in the task that gets the contexts of
that shard. A gram in very many places would fill its shard; its windows are
compared by hash, each window being a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bronzeflow.llm.common import free_name, partitions, release, scratch, whole_text
from bronzeflow.llm.repeats import (
    Windows,
    anchors,
    bodies,
    contexts_of,
    keyed,
    window_hashes,
    with_texts,
)

WINDOW, GRAM = 13, 5
CROWDED = 2000
#: Words of a shard's reference at most (a single gram may exceed it, up to ``CROWDED`` contexts).
#: An automaton has up to two states a word, of some 400 bytes; every core builds one.
SHARD = 50_000
NOBODY = int(np.iinfo(np.int64).max)


class SuffixAutomaton:
    """All sequences of words of the texts added, and the smallest owner of each.

    Texts are added one after another from the initial state (a generalised
    automaton). ``settle`` passes owners up the suffix links.
    """

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.owner = [-1], [0], [NOBODY]

    def add(self, words: Sequence[bytes], owner: int) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)
            if owner < self.owner[last]:
                self.owner[last] = owner

    def _state(self, length: int, link: int, following: dict[bytes, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.owner.append(NOBODY)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: bytes) -> int:
        """A state for the sequences of ``q`` that end p's ones, shorter than q's longest."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        state = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            exact = self.length[q] == self.length[p] + 1
            self.link[state] = q if exact else self._split(p, q, word)
        return state

    def settle(self) -> None:
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if up > 0 and self.owner[state] < self.owner[up]:
                self.owner[up] = self.owner[state]

    def window_owners(self, words: Sequence[bytes], length: int) -> list[int]:
        """Smallest owner of each window, by its first word; ``NOBODY`` if none has it."""
        found, state, matched = [], 0, 0
        for k, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            # Of longer matches only the last ``length`` words matter.
            while self.length[self.link[state]] >= length if state else False:
                state = self.link[state]
                matched = min(matched, self.length[state])
            if k >= length - 1:
                found.append(self.owner[state] if matched >= length else NOBODY)
        return found


def held_before(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    window: int = WINDOW,
    gram: int = GRAM,
    crowded: int = CROWDED,
) -> DataFrame:
    """``(key, pos, back, owner)``: windows that several documents hold.

    In the texts with hash ``key`` the window that starts ``back`` words before
    the word ``pos`` is also in document ``owner``, the smallest. A null ``back``
    stands for all windows around that place.
    """
    spark = docs.sparkSession
    spec = Windows(window, gram, words=True)
    texts = keyed(docs, text_col, F.coalesce(F.col(id_col).cast("long"), F.lit(NOBODY)))
    grams = (
        anchors(texts, spec)
        .groupBy("gram")
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.min("context") < F.max("context")).alias("mixed"),
            F.min("doc").alias("owner"),
            F.max("doc").alias("latest"),
        )
        .where("owner < latest")
        .drop("latest")
    )
    grams = scratch(grams, "automata-grams")
    release(spark)
    shared = anchors(texts, spec).join(grams, "gram")
    shared = scratch(
        shared.groupBy("gram", "key", "pos", "context", "n", "mixed", "owner").agg(
            F.count(F.lit(1)).alias("copies"), F.min("doc").alias("doc")
        ),
        "automata-places",
    )
    release(spark)
    same = shared.where("NOT mixed").select(
        "key", "pos", F.lit(None).cast("int").alias("back"), "owner"
    )
    differing = shared.where("mixed").select(
        "gram", "key", "pos", "context", "copies", "doc", (F.col("n") >= crowded).alias("crowded")
    )
    chosen = scratch(contexts_of(differing), "automata-contexts")
    placed = with_texts(texts, chosen)
    found = _by_automata(placed, spec).unionByName(_by_hash(placed, spec))
    found = scratch(found, "automata-found")
    release(spark)
    by_context = differing.select("key", "pos", "context").join(found, "context")
    return same.unionByName(by_context.select("key", "pos", "back", "owner"))


def _by_automata(placed: DataFrame, spec: Windows) -> DataFrame:
    """``(context, back, owner)`` of the windows that a document may lose."""
    reference = bodies(placed, spec).select("gram", "context", "left", "body", "doc", "count")
    dealt = reference.repartition(partitions(placed.sparkSession), "gram")
    schema = "context long, back int, owner long"
    return dealt.sortWithinPartitions("gram").mapInArrow(_streamed(spec), schema)


def _streamed(spec: Windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _shards(batches):
            automaton = SuffixAutomaton()
            split = [(context, left, body.split(b" "), *rest) for _, context, left, body, *rest in rows]
            for _, _, words, doc, _ in split:
                automaton.add(words, doc)
            automaton.settle()
            out: tuple[list[int], list[int], list[int]] = ([], [], [])
            for context, left, words, doc, count in split:
                for k, owner in enumerate(automaton.window_owners(words, spec.length)):
                    # A context of one place only loses what another document has.
                    if owner < doc or count > 1:
                        for column, value in zip(out, (context, left - k, owner)):
                            column.append(value)
            columns = [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["context", "back", "owner"])

    return run


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Whole grams, which come one after another, up to the size of a shard."""
    rows: list[tuple] = []
    words = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and words >= SHARD and row[0] != rows[-1][0]:
                yield rows
                rows, words = [], 0
            rows.append(row)
            words += row[3].count(b" ") + 1
    if rows:
        yield rows


def _by_hash(placed: DataFrame, spec: Windows) -> DataFrame:
    windows = window_hashes(placed, spec).select(
        "context", "doc", F.posexplode("windows").alias("back", "window")
    )
    windows = windows.where("window IS NOT NULL")
    # One context may stand in many documents, so even a single one has an owner to tell.
    owners = windows.groupBy("window").agg(F.min("doc").alias("owner"))
    return windows.join(owners, "window").select("context", "back", "owner")


def without_held_passages(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    kept_col: str = "kept_words",
    window: int = WINDOW,
    gram: int = GRAM,
    crowded: int = CROWDED,
) -> DataFrame:
    """``docs`` with the words that remain, joined by one space, and the runs of words
    removed as ``<kept_col>_spans``.

    * Spans are an array of ``(start, end)`` in words, null if there are none.
      Words are maximal runs without ASCII white space.
    * Null text: no words. A null id is larger than any other, and not than
      itself. Rows of equal id are one document: none is smaller than another.
    * Texts of fewer words than a window stay whole. Names that are taken get
      underscores in front. An empty table gives no rows.
    """
    kept, spans = free_name(docs, kept_col), free_name(docs, f"{kept_col}_spans")
    key, places, own = (free_name(docs, x) for x in ("text_key", "text_places", "own_id"))
    found = held_before(docs, text_col, id_col, window, gram, crowded)
    per_text = scratch(
        found.groupBy(F.col("key").alias(f"_{key}")).agg(
            F.collect_list(F.struct("pos", "back", "owner")).alias(places)
        ),
        "automata-spans",
    )
    release(docs.sparkSession)
    keyed_docs = docs.select(
        "*",
        F.xxhash64(whole_text(text_col)).alias(key),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NOBODY)).alias(own),
    )
    joined = keyed_docs.join(per_text, F.col(key) == F.col(f"_{key}"), "left").drop(key, f"_{key}")
    span = T.ArrayType(T.StructType([T.StructField(x, T.IntegerType()) for x in ("start", "end")]))
    fields = [*docs.schema.fields, T.StructField(kept, T.StringType()), T.StructField(spans, span)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            names = batch.schema.names
            bodies = batch.column(names.index(text_col)).cast(pa.binary())
            lists, ids = batch.column(names.index(places)), batch.column(names.index(own))
            texts, removed = [], []
            for body, list_, doc in zip(bodies, lists, ids.to_pylist()):
                words, runs = (body.as_py() or b"").split(), []
                if list_.is_valid:
                    runs = covered(list_.values, doc, len(words), window, gram)
                at, parts = 0, []
                for start, end in runs:
                    parts += words[at:start]
                    at = end
                texts.append(b" ".join([*parts, *words[at:]]).decode())
                removed.append([{"start": a, "end": b} for a, b in runs] or None)
            keep = [i for i, n in enumerate(names) if n not in (places, own)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(texts), pa.array(removed, kind)],
                [*[names[i] for i in keep], kept, spans],
            )

    return joined.mapInArrow(run, T.StructType(fields))


def covered(
    places: pa.StructArray, doc: int, size: int, window: int, gram: int
) -> list[tuple[int, int]]:
    """Maximal runs of words that the windows cover which a smaller document holds."""
    owner = np.asarray(places.field("owner"))
    pos = np.asarray(places.field("pos")).astype(np.int64)
    back = np.asarray(places.field("back").fill_null(-1)).astype(np.int64)
    own = owner < doc
    pos, back = pos[own], back[own]
    every = back < 0  # all windows that hold the gram at this place
    first = np.where(every, pos - (window - gram), pos - back)
    last = np.where(every, pos, pos - back)
    first, last = np.maximum(first, 0), np.minimum(last, size - window)
    fits = first <= last
    first, last = first[fits], last[fits]
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last + window, -1)
    inside = np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8)
    edges = np.diff(inside)
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
