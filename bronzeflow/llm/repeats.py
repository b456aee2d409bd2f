"""Where texts may repeat each other: sampled suffixes, and what they share.

Both operators on repeated windows start here. Of all suffixes of a text only
those at anchors are taken: the least of the grams of each window, by hash, so
that equal windows have their anchor at the same place. An anchor stands for the
windows that hold it; its context is all that these windows can cover. A gram
that stands in one place only belongs to windows that repeat nowhere, so such
anchors are dropped after one aggregate over hashes, before any text is moved.

Symbols are bytes or words (by hash). Places are (text, position), the text being
named by a 64-bit hash.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow.llm.common import whole_text
from bronzeflow.llm.hashing import mixed, word_hashes

#: Symbols that are worked on at once.
PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
PLACE = np.uint64((1 << 22) - 1)


@dataclass(frozen=True)
class Windows:
    """Windows of ``length`` symbols, found by grams of ``gram`` symbols."""

    length: int
    gram: int
    words: bool
    #: Drawn per run, so that no text can be written to fit the hashes.
    seed: int = field(default_factory=lambda: secrets.randbits(62))

    @property
    def before(self) -> int:
        """Symbols before an anchor that its windows can cover."""
        return self.length - self.gram

    def symbols(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of texts, one after another, and how many each text has."""
        if self.words:
            return word_hashes(texts, self.seed)
        octets = np.frombuffer(b"".join(texts), dtype=np.uint8)
        return octets.astype(np.uint64) + np.uint64(1), np.array([len(t) for t in texts], dtype=np.int64)


class Sums:
    """Hashes of stretches of a gram or more, from running sums of a polynomial.

    The terms of a polynomial over bytes can be chosen so that it vanishes modulo
    2**64. So its coefficients are not bytes but hashes of eight bytes that follow
    each other, with the seed of the run; those of words are hashed again.
    """

    def __init__(self, symbols: np.ndarray, spec: Windows) -> None:
        self.over = 1 if spec.words else min(8, spec.gram)
        n = max(0, len(symbols) - self.over + 1)
        terms = np.full(n, spec.seed, dtype=np.uint64)
        if spec.words:
            terms ^= symbols
        else:
            for k in range(self.over):
                terms ^= (symbols[k : n + k] - np.uint64(1)) << np.uint64(8 * k)
        up, self.down = powers(len(symbols) + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mixed(terms, 5) * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end - self.over + 1] - self.sums[start]) * self.down[start], 1)

    def of_each(self, size: int) -> np.ndarray:
        """Hashes of all stretches of a size, by their start."""
        first = self.sums[size - self.over + 1 :]
        n = len(first)
        return mixed((first - self.sums[:n]) * self.down[:n], 1)


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PIECE + 4096)
        _POWERS.clear()
        for b in (BASE, INVERSE):
            factors = np.full(size, b, dtype=np.uint64)
            factors[0] = 1
            _POWERS.append(np.cumprod(factors, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    if done < width:
        values = np.minimum(values[: len(values) - (width - done)], values[width - done :])
    return values


def anchors_of(
    symbols: np.ndarray, bounds: np.ndarray, spec: Windows
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, position, gram, context)`` of all anchors of texts side by side.

    ``bounds``: where each text starts, and the end of the last. The context is
    a hash of the symbols around and of how many of them stand before.
    """
    none = np.zeros(0, dtype=np.int64)
    n = len(symbols)
    if n < spec.length:
        return none, none, none, none
    sums = Sums(symbols, spec)
    gram = sums.of_each(spec.gram)
    order = (gram & ~PLACE) | np.arange(len(gram), dtype=np.uint64)
    least = least_of(order, spec.length - spec.gram + 1)
    ends = np.repeat(bounds[1:], np.diff(bounds))  # of the text of each symbol
    whole = np.arange(len(least)) + spec.length <= ends[: len(least)]
    at = (least[whole] & PLACE).astype(np.int64)
    # The least of a sliding window never goes back, so equal places are neighbours.
    at = at[np.diff(at, prepend=-1) > 0]
    text = np.searchsorted(bounds, at, side="right") - 1
    left = np.minimum(spec.before, at - bounds[text])
    right = np.minimum(spec.length, bounds[text + 1] - at)
    context = mixed(sums.of(at - left, at + right) ^ left.astype(np.uint64), 3)
    return text, at - bounds[text], gram[at].view(np.int64), context.view(np.int64)


def pieces(counts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about ``most`` symbols, one text at least."""
    ends = np.cumsum(counts)
    lo, base = 0, 0
    while lo < len(counts):
        hi = max(lo + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield lo, hi
        lo, base = hi, int(ends[hi - 1])


def anchors(texts: DataFrame, spec: Windows) -> DataFrame:
    """``(gram, key, doc, pos, context)`` of ``(key, doc, text)``.

    A text longer than a piece is cut into stretches of windows, each with what
    its contexts need on both sides; a place found twice counts once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, docs = (np.asarray(batch.column(i)) for i in (0, 1))
            bodies = batch.column(2).cast(pa.binary())
            sizes = np.asarray(pa.compute.binary_length(bodies)).astype(np.int64)
            for lo, hi in pieces(sizes, PIECE):
                rows = [bodies[i].as_py() for i in range(lo, hi)]
                symbols, counts = spec.symbols(rows)
                if len(rows) == 1 and len(symbols) > 2 * PIECE:
                    text, at, gram, context = _long_anchors(symbols, spec)
                else:
                    bounds = np.concatenate([[0], np.cumsum(counts)])
                    text, at, gram, context = anchors_of(symbols, bounds, spec)
                columns = [gram, keys[lo:hi][text], docs[lo:hi][text], at.astype(np.int32), context]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["gram", "key", "doc", "pos", "context"]
                )

    return texts.select("key", "doc", "text").mapInArrow(
        run, "gram long, key long, doc long, pos int, context long"
    )


def _long_anchors(symbols: np.ndarray, spec: Windows) -> tuple[np.ndarray, ...]:
    found: dict[int, tuple[int, int]] = {}
    for lo in range(0, max(1, len(symbols) - spec.length + 1), PIECE):
        a = max(0, lo - spec.before)
        b = min(len(symbols), lo + PIECE + 2 * spec.length)
        part = symbols[a:b]
        _, at, gram, context = anchors_of(part, np.array([0, len(part)]), spec)
        # At the cuts contexts are short; those places are whole in the next stretch.
        inside = (a == 0) | (at >= spec.before)
        inside &= (b == len(symbols)) | (at + spec.length <= len(part))
        for p, g, c in zip((at + a)[inside].tolist(), gram[inside].tolist(), context[inside].tolist()):
            found[p] = (g, c)
    order = sorted(found)
    values = np.array([found[p] for p in order], dtype=np.int64).reshape(-1, 2)
    return np.zeros(len(order), dtype=np.int64), np.array(order, dtype=np.int64), values[:, 0], values[:, 1]


def keyed(docs: DataFrame, text_col: str, doc: Column) -> DataFrame:
    """``(key, doc, text)``: the text's hash, a number for the document, the text."""
    text = whole_text(text_col)
    return docs.select(F.xxhash64(text).alias("key"), doc.alias("doc"), text.alias("text"))


def contexts_of(places: DataFrame) -> DataFrame:
    """One place of each context: ``(key, pos, context, gram, crowded, count, doc)``.

    ``places`` is ``(gram, key, pos, context, crowded, copies, doc)``. The count is
    that of all places and copies of the texts, the document the smallest; so a
    context is fetched and compared once, however many texts have it.
    """
    return places.groupBy("context").agg(
        F.min(F.struct("key", "pos", "gram", "crowded")).alias("place"),
        F.sum("copies").alias("count"),
        F.min("doc").alias("doc"),
    ).select("place.*", "context", "count", "doc")


def with_texts(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """The texts of the places, each text once with its arrays of places."""
    per_text = chosen.groupBy("key").agg(
        F.collect_list(F.struct("pos", "gram", "context", "crowded", "count", "doc")).alias("p")
    )
    # One copy of each text before anything meets by key.
    once = texts.groupBy("key").agg(F.first("text").alias("text"))
    return once.join(per_text, "key").select("text", "p")


def bodies(placed: DataFrame, spec: Windows, crowded: bool = False) -> DataFrame:
    """``(gram, context, count, doc, left, body)`` of the places that are (not) crowded.

    ``body`` holds the symbols of the context: bytes, or words joined by a space.
    """

    def cut(texts: list[bytes]) -> tuple[np.ndarray, Callable]:
        split = [t.split() for t in texts] if spec.words else texts

        def make(text: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.Array:
            ends = zip(text.tolist(), (at - left).tolist(), (at + right).tolist())
            found = [split[i][a:b] for i, a, b in ends]
            return pa.array([b" ".join(c) for c in found] if spec.words else found, pa.binary())

        return np.array([len(x) for x in split], dtype=np.int64), make

    return _around(placed, spec, crowded, "body binary", cut)


def window_hashes(placed: DataFrame, spec: Windows) -> DataFrame:
    """``(gram, context, count, doc, left, windows)`` of the crowded places.

    ``windows`` holds hashes: the k-th is that of the window that starts k symbols
    before the anchor, null if there is none.
    """

    def hashed(texts: list[bytes]) -> tuple[np.ndarray, Callable]:
        symbols, counts = spec.symbols(texts)
        sums, first = Sums(symbols, spec), np.cumsum(counts) - counts
        back = np.arange(spec.before + 1)

        def make(text: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.Array:
            there = (back <= left[:, None]) & (back >= spec.length - right[:, None])
            start = ((first[text] + at)[:, None] - back)[there]
            value = np.zeros(there.shape, dtype=np.int64)
            value[there] = sums.of(start, start + spec.length).view(np.int64)
            flat = pa.array(value.ravel(), mask=~there.ravel())
            offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * len(back))
            return pa.ListArray.from_arrays(offsets, flat)

        return counts, make

    return _around(placed, spec, True, "windows array<long>", hashed)


#: Places of a batch that is made at once.
PLACES = 1 << 14


def _around(placed: DataFrame, spec: Windows, crowded: bool, last: str, read: Callable) -> DataFrame:
    """What stands around the places of one kind.

    ``read(texts)`` gives the number of symbols of each text, and a function from
    places (text, position, symbols before and from there on) to their column.
    """
    values = ("gram", "context", "count", "doc")
    names = [*values, "left", last.split()[0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            places = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), np.asarray(pa.compute.list_value_length(lists)))
            own = np.flatnonzero(np.asarray(places.field("crowded").cast(pa.int8())) == crowded)
            row, places = row[own], places.take(pa.array(own))
            there = np.unique(row)
            texts = batch.column(0).cast(pa.binary()).take(pa.array(there))
            text = np.searchsorted(there, row)
            pos = np.asarray(places.field("pos")).astype(np.int64)
            octets = np.asarray(pa.compute.binary_length(texts)).astype(np.int64)
            for lo, hi in pieces(octets, PIECE):
                sizes, make = read([texts[i].as_py() for i in range(lo, hi)])
                begin, end = np.searchsorted(text, (lo, hi))
                for a in range(begin, end, PLACES):
                    b = min(a + PLACES, end)
                    of, at = text[a:b] - lo, pos[a:b]
                    left = np.minimum(spec.before, at)
                    right = np.minimum(spec.length, sizes[of] - at)
                    columns = [places.field(n).slice(a, b - a) for n in values]
                    columns += [pa.array(left.astype(np.int32)), make(of, at, left, right)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return placed.mapInArrow(
        run, f"gram long, context long, count long, doc long, left int, {last}"
    )
