"""Near duplicates by SimHash: a byte-position inverted index with count filtering.

Two fingerprints of 64 bits that differ in at most four of them share at least
four of their eight bytes. The index lists fingerprints by the values of three
bytes: twenty choices of three positions, such that any four shared positions
contain one of the choices. Inside a list, the lists of a fourth byte hold the
pairs whose tally of shared bytes reaches four, each choice of four in one place.
Only those are compared bit by bit, and of the links found in a list as many
leave the task as join its fingerprints, not one for every pair.

A list longer than ``CROWD`` is not compared pair by pair. Fingerprints at most
four bits apart have a number between them that is at most two bits from either,
so every member names the 2,081 numbers around it, and those that name the same
one are linked. That is exact, and grows with the members, not with their pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bronzeflow.llm.common import scratch, whole_text
from bronzeflow.llm.minhash import _renamed, components

WORDS, SEED, DISTANCE = 4, 42, 4
#: Fingerprints of a list that are compared in one task, and of a list in one sweep.
CROWD, SMALL = 1 << 15, 32
#: Bytes of a text whose shingles are hashed at once.
PIECE = 1 << 20
_BREAK = re.compile(rb"[\x20\x09-\x0D]")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    crowd: int = CROWD,
) -> DataFrame:
    """``(row, id, fingerprint, component_id)`` of each document.

    * ``row`` is a struct of the id and the columns ``carry``; ``fingerprint`` is a long that
      holds the 64 bits; ``component_id`` is the smallest id that links lead to.
    * Words are split at ASCII white space after A-Z were lower-cased. A text of
      fewer than four words is one shingle; a null, empty or blank one has the
      fingerprint zero, which links like any other.
    * A null id is nobody's smallest; a component of null ids only has a null id.
      Repeated rows stay, in one component. An empty table gives no rows.
    """
    slim = docs.select(
        F.struct(*[F.col(c) for c in dict.fromkeys([id_col, *carry])]).alias("row"),
        F.col(id_col).alias("id"),
        whole_text(text_col).cast("binary").alias("text"),
    )
    schema = T.StructType([slim.schema["row"], slim.schema["id"]]).add("fingerprint", "long")
    prints = scratch(slim.mapInArrow(_printer, schema), "simhash-prints")
    distinct = scratch(
        prints.groupBy("fingerprint").agg(F.min("id").alias("least")), "simhash-distinct"
    )
    links = scratch(_links(distinct.select("fingerprint"), crowd).distinct(), "simhash-links")
    named = distinct.withColumn("root", F.col("fingerprint"))
    named = _renamed(named, components(links))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = named.join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(of_print, "fingerprint").select("row", "id", "fingerprint", "component_id")


def fingerprint(text: bytes) -> int:
    """Each bit as more than half of the shingles' hashes have it."""
    ones, n, words = np.zeros(64, dtype=np.int64), 0, []
    for piece in _pieces(text.lower()):
        words = words[1 - WORDS :] + piece.split() if n else words + piece.split()
        if len(words) >= WORDS:
            hashes = shingle_hashes(words)
            bits = np.unpackbits(hashes.byteswap().view(np.uint8)).reshape(-1, 64)
            ones += bits.sum(axis=0, dtype=np.int64)
            n += len(hashes)
    if not n and words:
        return int(shingle_hashes(words)[0])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """Of all words together, if there are fewer than a shingle has."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: max(1, len(words) - WORDS + 1)]
    spans = zip(starts.tolist(), ends[-len(starts) :].tolist())
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype=np.uint64, count=len(starts))


def _pieces(text: bytes) -> Iterator[bytes]:
    lo = 0
    while lo < len(text):
        found = _BREAK.search(text, lo + PIECE)
        hi = found.end() if found else len(text)
        yield text[lo:hi]
        lo = hi


def _printer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t.as_py()) for t in batch.column(2)], dtype=np.uint64)
        columns = [batch.column(0), batch.column(1), pa.array(found.view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["row", "id", "fingerprint"])


def index_positions() -> dict[tuple[int, ...], list[int]]:
    """Three positions of each list, and the fourth ones that are looked up inside it.

    The positions stand in a ring of three groups. A choice is three of one group,
    or two of a group and one of the next. Any four positions contain a choice:
    either a group holds three of them, or one holds two and the next one or,
    if that is empty, the group before holds two as well.
    """
    groups = [range(0, 3), range(3, 6), range(6, 8)]
    chosen: dict[tuple[int, ...], list[int]] = {}
    for g, group in enumerate(groups):
        for three in combinations(group, 3):
            chosen[three] = []
        for two in combinations(group, 2):
            for one in groups[(g + 1) % 3]:
                chosen[tuple(sorted((*two, one)))] = []
    for four in combinations(range(8), 4):
        three = next(c for c in combinations(four, 3) if c in chosen)
        chosen[three].append(next(p for p in four if p not in three))
    return chosen


POSITIONS = index_positions()


def _links(distinct: DataFrame, crowd: int) -> DataFrame:
    """``(a, b)`` of linked fingerprints: enough of them to join every component."""
    postings = distinct.mapInArrow(_poster, "list long, fingerprint long")
    sizes = postings.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    crowded = scratch(sizes.where(F.col("n") > crowd).select("list"), "simhash-crowded")
    few = postings if crowded.isEmpty() else postings.join(crowded, "list", "left_anti")
    listed = few.repartition("list").sortWithinPartitions("list", "fingerprint")
    links = listed.mapInArrow(_lister, "a long, b long")
    if crowded.isEmpty():
        return links
    many = postings.join(crowded, "list", "left_semi").select("fingerprint").distinct()
    around = many.mapInArrow(_between, "middle long, fingerprint long")
    met = around.repartition("middle").sortWithinPartitions("middle", "fingerprint")
    return links.unionByName(met.mapInArrow(_neighbours, "a long, b long"))


def _poster(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.asarray(batch.column(0))
        values = prints.view(np.uint8).reshape(-1, 8).astype(np.int64)
        for i, (a, b, c) in enumerate(POSITIONS):
            lists = (i << 24) + (values[:, a] << 16) + (values[:, b] << 8) + values[:, c]
            yield pa.RecordBatch.from_arrays([pa.array(lists), batch.column(0)], ["list", "fingerprint"])


def _lister(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole lists at a time; rows come sorted by list."""
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def found(lists: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i, fourths in enumerate(POSITIONS.values()):
            own = slice(*np.searchsorted(lists, [i << 24, (i + 1) << 24]))
            for position in fourths:
                a, b = _compared(lists[own], prints[own], position)
                if len(a):
                    columns = [pa.array(x.view(np.int64)) for x in (a, b)]
                    yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    for batch in batches:
        lists, prints = np.asarray(batch.column(0)), np.asarray(batch.column(1)).view(np.uint64)
        if not len(lists):
            continue
        cut = int(np.searchsorted(lists, lists[-1]))
        if cut:  # the lists before the last one are complete
            parts = [*waiting, (lists[:cut], prints[:cut])]
            yield from found(*map(np.concatenate, zip(*parts)))
            waiting = []
        elif waiting and waiting[0][0][0] != lists[0]:
            yield from found(*map(np.concatenate, zip(*waiting)))
            waiting = []
        waiting.append((lists[cut:], prints[cut:]))
    if waiting:
        yield from found(*map(np.concatenate, zip(*waiting)))


def _compared(lists: np.ndarray, prints: np.ndarray, position: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the pairs that share a list and the byte at one more position."""
    key = (lists << 8) + prints.view(np.uint8).reshape(-1, 8)[:, position]
    order = np.argsort(key, kind="stable")
    key, prints = key[order], prints[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
    sizes = np.diff(np.append(starts, len(key)))
    size = np.repeat(sizes, sizes)
    small = np.flatnonzero((size > 1) & (size <= SMALL))
    left, right = [prints[:0]], [prints[:0]]
    for step in range(1, SMALL):
        i = small[small + step < len(key)]
        i = i[key[i] == key[i + step]]
        if not len(i):
            break
        near = np.bitwise_count(prints[i] ^ prints[i + step]) <= DISTANCE
        left.append(prints[i][near])
        right.append(prints[i + step][near])
    for start in np.flatnonzero(sizes > SMALL).tolist():
        a, b = _joined(prints[starts[start] : starts[start] + sizes[start]])
        left.append(a)
        right.append(b)
    return np.concatenate(left), np.concatenate(right)


def _joined(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all links among the fingerprints those that join two components of them."""
    component = np.arange(len(prints))
    pairs: list[tuple[int, int]] = []
    for i in range(len(prints) - 1):
        near = np.bitwise_count(prints[i] ^ prints[i + 1 :]) <= DISTANCE
        others = np.flatnonzero(near) + i + 1
        others = others[component[others] != component[i]]
        while len(others):
            j = int(others[0])
            pairs.append((i, j))
            component[component == component[j]] = component[i]
            others = others[component[others] != component[i]]
    at = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    return prints[at[:, 0]], prints[at[:, 1]]


def flips() -> np.ndarray:
    """The numbers of at most two bits."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    two = [a | b for a, b in combinations(one, 2)]
    return np.concatenate([[np.uint64(0)], one, np.array(two, dtype=np.uint64)]).view(np.int64)


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    masks = flips()
    for batch in batches:
        prints = np.asarray(batch.column(0))
        for lo in range(0, len(prints), 64):
            own = prints[lo : lo + 64]
            columns = [(own[:, None] ^ masks).ravel(), np.repeat(own, len(masks))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["middle", "fingerprint"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows that follow each other and have one middle."""
    last = (np.zeros(0, dtype=np.int64),) * 2
    for batch in batches:
        middle, prints = (np.concatenate([x, np.asarray(batch.column(i))]) for i, x in enumerate(last))
        same = middle[1:] == middle[:-1]
        columns = [prints[:-1][same], prints[1:][same]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b"])
        last = (middle[-1:], prints[-1:])
