"""Byte-level BPE, encoding by a segment tree over adjacent pair ranks, and decoding.

A word's adjacent pairs are the leaves of a minimum tree whose keys are
(rank, position): the root is the leftmost pair of lowest rank. A merge changes
three leaves, each in logarithmic time, and ends when the root is empty. Words
that are new to a task go through the trees together, those of one size class as
one array; very long words have a tree each.

Vocabulary and merges come from a ``tokenizers`` file whose path is a parameter;
byte-level BPE with the usual split pattern is supported, nothing else.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers.pre_tokenizers import ByteLevel

from bronzeflow.llm.common import free_name

#: Bytes of text worked on at once, and words remembered by a task.
PIECE = 1 << 21
REMEMBERED = 300_000
#: Symbols of a word from which it gets a tree of its own.
LONG = 1024
EMPTY = np.int64(1) << 62

OTHER, LETTER, NUMBER, SPACE, END = range(5)
#: Code "points" after the last one: the end of a text, then the special tokens.
STOP = 0x110000

class Vocabulary:
    """Symbols, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
        usual = (
            model["type"] == "BPE"
            and not any(model.get(k) for k in (*options, "byte_fallback", "ignore_merges"))
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not spec.get("normalizer")
        )
        plain = all(
            not any(t.get(k) for k in ("single_word", "lstrip", "rstrip"))
            for t in spec["added_tokens"]
        )
        if not usual or not plain:
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        to_byte = {c: b for b, c in enumerate(byte_letters())}
        ids = model["vocab"]
        self.specials = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.specials.values()]) + 1
        pieces = [b""] * size
        for token, i in ids.items():
            pieces[i] = bytes(to_byte[c] for c in token)
        for content, i in self.specials.items():
            pieces[i] = content
        self.lengths = np.array([len(x) for x in pieces], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.symbol = np.array([ids.get(c, -1) for c in byte_letters()], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([ids[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = np.append(keys[order], EMPTY), np.append(order, 0)
        self.rank_of = dict(zip(keys.tolist(), range(len(pairs))))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the pair does not merge (or has an absent symbol)."""
        keys = (left << 32) | right
        at = np.searchsorted(self.keys[:-1], keys)
        found = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[at], -1)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=1)
def letter_classes() -> np.ndarray:
    """Class of every code point as the split pattern of the library sees it.

    ``regex`` may know letters and numbers that are too new for the library; each
    candidate is shown to the library's splitter, after one of its kind.
    """
    table = np.zeros(STOP + 64, dtype=np.uint8)
    everything = "".join("\0" if 0xD800 <= i < 0xE000 else chr(i) for i in range(STOP))
    splitter = ByteLevel(add_prefix_space=False)
    for pattern, kind, peer in ((r"\p{L}", LETTER, "a"), (r"\p{N}", NUMBER, "1")):
        points = [ord(m.group()) for m in regex.finditer(pattern, everything)]
        probe = "".join(f"\n{peer}{chr(i)}" for i in points)
        begins = {at for _, (at, _) in splitter.pre_tokenize_str(probe)}
        table[[i for n, i in enumerate(points) if 3 * n + 2 not in begins]] = kind
    for m in regex.finditer(r"\s+", everything):
        table[m.start() : m.end()] = SPACE
    table[STOP:] = END
    return table


def word_starts(points: np.ndarray) -> np.ndarray:
    """Where the words of the split pattern start, in texts that each end with an END.

    The pattern: contractions (after anything but a space), else an optional
    space and a run of letters, of numbers, or of others, else white space, whose
    last character stays with what follows.
    """
    kind = letter_classes()[points]
    before = np.concatenate([[END], kind[:-1]])
    after = np.concatenate([kind[1:], [END]])
    previous = np.concatenate([[STOP], points[:-1]])
    solid = kind < SPACE
    run = kind != before
    start = np.where(solid, run & (previous != 0x20), run | (kind == END))
    start |= (kind == SPACE) & (after < SPACE)
    marks = np.flatnonzero(
        (points == 0x27) & run & (previous != 0x20) & (after == LETTER)
    )
    if marks.size:
        one, two = points[marks + 1], points[np.minimum(marks + 2, len(points) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(marks), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        ends = np.where(short, marks + 2, marks + 3)
        hit = short | long
        start[marks[hit] + 1] = False
        ends = ends[hit]
        start[ends] |= kind[ends] == LETTER
    return start


def _tree_of_one(symbols: list[int], vocab: Vocabulary) -> list[int]:
    """Ids of one long word."""
    n = len(symbols)
    size = 1 << max(n - 1, 1).bit_length()
    none = int(EMPTY)
    rank_of, merged = vocab.rank_of, vocab.merged
    tree = [none] * (2 * size)
    for i in range(n - 1):
        rank = rank_of.get((symbols[i] << 32) | symbols[i + 1])
        if rank is not None:
            tree[size + i] = rank * size + i
    for k in range(size - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])
    after, before, alive = list(range(1, n + 1)), list(range(-1, n)), [True] * n

    def put(leaf: int, key: int) -> None:
        k = size + leaf
        tree[k] = key
        while k > 1:
            k >>= 1
            least = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == least:
                break
            tree[k] = least

    def key(i: int, j: int) -> int:
        rank = rank_of.get((symbols[i] << 32) | symbols[j])
        return none if rank is None else rank * size + i

    while tree[1] != none:
        rank, i = divmod(tree[1], size)
        j = after[i]
        k, h = after[j], before[i]
        symbols[i], alive[j] = int(merged[rank]), False
        after[i], before[k] = k, i
        put(j, none)
        put(i, key(i, k) if k < n else none)
        if h >= 0:
            put(h, key(h, i))
    return [s for s, live in zip(symbols, alive) if live]


def _trees(symbols: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many words of one size class, one after another; and how many each has.

    ``symbols``: a row per word, as wide as the tree has leaves plus one, absent
    symbols being -1.
    """
    rows, width = symbols.shape
    size = width - 1
    tree = np.full((rows, 2 * size), EMPTY, dtype=np.int64)
    rank = vocab.rank(symbols[:, :-1], symbols[:, 1:])
    tree[:, size:] = np.where(rank >= 0, rank * size + np.arange(size), EMPTY)
    level = size
    while level > 1:
        level //= 2
        half = tree[:, 2 * level : 4 * level]
        tree[:, level : 2 * level] = np.minimum(half[:, ::2], half[:, 1::2])
    alive = symbols >= 0
    # Slot ``width`` stands for "none" on either side; its symbol is absent.
    padded = np.concatenate([symbols, np.full((rows, 1), -1, dtype=np.int64)], axis=1)
    after = np.broadcast_to(np.arange(1, width + 2), (rows, width + 1)).copy()
    before = np.broadcast_to(np.arange(-1, width), (rows, width + 1)).copy()
    before[:, 0] = width
    after[:, -1] = width

    def put(words: np.ndarray, leaf: np.ndarray, keys: np.ndarray) -> None:
        node = size + leaf
        tree[words, node] = keys
        while node[0] > 1:
            node = node >> 1
            tree[words, node] = np.minimum(tree[words, 2 * node], tree[words, 2 * node + 1])

    def keys(words: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        found = vocab.rank(padded[words, i], padded[words, j])
        return np.where(found >= 0, found * size + i, EMPTY)

    words = np.flatnonzero(tree[:, 1] != EMPTY)
    while words.size:
        root = tree[words, 1]
        i = root % size
        j = after[words, i]
        k, h = after[words, j], before[words, i]
        padded[words, i] = vocab.merged[root // size]
        padded[words, j] = -1
        alive[words, j] = False
        after[words, i] = k
        before[words, k] = i
        last = j < size  # the last symbol of a full row has no leaf
        put(words[last], j[last], np.full(int(last.sum()), EMPTY)) if last.any() else None
        put(words, i, keys(words, i, k))
        inner = h < width
        if inner.any():
            put(words[inner], h[inner], keys(words[inner], h[inner], i[inner]))
        words = words[tree[words, 1] != EMPTY]
    return padded[:, :width][alive], alive.sum(axis=1)


def encode_words(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one word after another; and how many each has."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    letters = vocab.symbol[np.frombuffer(b"".join(words), dtype=np.uint8)]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    found: list[np.ndarray] = []
    order: list[np.ndarray] = []
    counts = np.zeros(len(words), dtype=np.int64)
    low, size = 0, 4
    while low < LONG:
        members = np.flatnonzero((lengths > low) & (lengths <= size + 1 if size < LONG else lengths < LONG))
        low = size + 1
        for block in np.array_split(members, max(1, -(-len(members) * size // (1 << 19)))):
            if block.size:
                at = starts[block][:, None] + np.arange(size + 1)
                inside = np.arange(size + 1) < lengths[block][:, None]
                symbols = np.where(inside, letters[np.minimum(at, len(letters) - 1)], -1)
                ids, counts[block] = _trees(symbols, vocab)
                found.append(ids)
                order.append(block)
        size *= 2
    for w in np.flatnonzero(lengths >= LONG):
        ids = _tree_of_one(letters[starts[w] : starts[w] + lengths[w]].tolist(), vocab)
        counts[w] = len(ids)
        found.append(np.array(ids, dtype=np.int64))
        order.append(np.array([w]))
    if not found:
        return np.zeros(0, dtype=np.int64), counts
    by_class = np.concatenate(order)
    ids = np.concatenate(found)
    ends = np.cumsum(counts[by_class])
    begins = np.empty(len(words), dtype=np.int64)
    begins[by_class] = ends - counts[by_class]
    return ids[spread(begins, counts)], counts


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the stretches ``[start, start + length)``, one after another."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return shift + np.arange(total)


class Encoder:
    """Ids of texts; remembers the words that a task has met, within a bound."""

    def __init__(self, path: str) -> None:
        self.vocab = vocabulary(path)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, dtype=np.int64)
        self.used = 0
        self.starts = np.zeros(1 << 14, dtype=np.int64)
        self.counts = np.zeros(1 << 14, dtype=np.int64)

    def learn(self, words: list[bytes]) -> None:
        ids, counts = encode_words(words, self.vocab)
        first, n = len(self.known), len(words)
        while first + n > len(self.starts):
            self.starts, self.counts = (np.concatenate([x, x]) for x in (self.starts, self.counts))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, self.ids])
        self.ids[self.used : self.used + len(ids)] = ids
        self.counts[first : first + n] = counts
        self.starts[first : first + n] = self.used + np.cumsum(counts) - counts
        self.used += len(ids)
        self.known.update(zip(words, range(first, first + n)))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after another; and how many each has."""
        parts, owners = [], []
        for owner, text in enumerate(texts):
            for part in self._parts(text):
                parts.append(part)
                owners.append(owner)
        ids, counts = [], np.zeros(len(texts), dtype=np.int64)
        lo = 0
        while lo < len(parts):
            hi, size = lo, 0
            while hi < len(parts) and (hi == lo or size + len(parts[hi]) <= PIECE):
                size += len(parts[hi])
                hi += 1
            got, each = self._encode_parts(parts[lo:hi])
            ids.append(got)
            np.add.at(counts, owners[lo:hi], each)
            lo = hi
        return (np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64)), counts

    def _parts(self, text: bytes) -> Iterator[bytes | int]:
        """The text cut at special tokens; what is over ``PIECE`` also before a single space.

        Between a printable ASCII character and a space a word always ends.
        """
        at = 0
        while at < len(text) or not text:
            hits = [(text.find(s, at), s) for s in self.vocab.specials]
            hits = [(p, s) for p, s in hits if p >= 0]
            stop, special = min(hits) if hits else (len(text), b"")
            while stop - at > PIECE:
                cut = _CUT.search(text, at + PIECE - 1, stop)
                if not cut:
                    break
                yield text[at : cut.start() + 1]
                at = cut.start() + 1
            yield text[at:stop]
            if special:
                yield special
            at = stop + len(special)
            if not text:
                return

    def _encode_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        specials = self.vocab.specials
        plain = [b"" if p in specials else p for p in parts]
        raw = b"".join(plain)
        ends = np.cumsum([len(p) for p in plain])
        octets = np.frombuffer(raw, dtype=np.uint8)
        chars = np.concatenate([[0], np.cumsum((octets & 0xC0) != 0x80)])
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        stops = chars[ends]
        codes = np.insert(points.astype(np.int64), stops, STOP)
        starts = np.flatnonzero(word_starts(codes))
        width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000).astype(np.int64)
        width[codes >= STOP] = 0
        offsets = np.concatenate([[0], np.cumsum(width)])
        begin = offsets[starts]
        end = np.append(begin[1:], len(raw))
        is_stop = codes[starts] >= STOP
        owner = (np.cumsum(is_stop) - is_stop)[~is_stop]
        begin, end = begin[~is_stop], end[~is_stop]
        first, which = _different_words(raw, octets, begin, end)
        words = [raw[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]
        if len(self.known) > REMEMBERED:
            self.forget()
        index = list(map(self.known.get, words))
        if None in index:
            self.learn([w for w, i in zip(words, index) if i is None])
            index = list(map(self.known.get, words))
        at = np.array(index, dtype=np.int64)[which]
        sizes = self.counts[at]
        ids = self.ids[spread(self.starts[at], sizes)]
        counts = np.bincount(owner, weights=sizes, minlength=len(parts)).astype(np.int64)
        if len(raw) < sum(map(len, parts)):  # special tokens stand between the words
            edges = np.cumsum(counts)
            marks = [k for k, p in enumerate(parts) if p in specials]
            ids = np.insert(ids, edges[marks], [specials[parts[k]] for k in marks])
            counts[marks] += 1
        return ids, counts


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, for positions in a piece."""
    base = 0x9E3779B97F4A7C15
    powers = []
    for b in (base, pow(base, -1, 1 << 64)):
        factors = np.full(PIECE + 1, b, dtype=np.uint64)
        factors[0] = 1
        powers.append(np.cumprod(factors, dtype=np.uint64))
    return powers[0], powers[1]


def _word_hashes(octets: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each stretch of bytes, from running sums of a polynomial."""
    up, down = _powers()
    if len(octets) >= len(up):  # one word longer than a piece, or a few of that kind
        return np.array([hash(octets[a:b].tobytes()) for a, b in zip(begin, end)], dtype=np.int64)
    sums = np.zeros(len(octets) + 1, dtype=np.uint64)
    np.cumsum((octets.astype(np.uint64) + np.uint64(1)) * up[: len(octets)], out=sums[1:])
    h = (sums[end] - sums[begin]) * down[begin]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _different_words(
    raw: bytes, octets: np.ndarray, begin: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different word, and of each place the number of its word.

    Words are brought together by hash, so each is looked up once. Every place is
    then compared with the word that stands for it; if two words have one hash,
    the words themselves are the keys.
    """
    _, first, which = np.unique(
        _word_hashes(octets, begin, end), return_index=True, return_inverse=True
    )
    sizes, own = end - begin, first[which]
    if np.array_equal(sizes, sizes[own]) and np.array_equal(
        octets[spread(begin, sizes)], octets[spread(begin[own], sizes)]
    ):
        return first, which
    numbers: dict[bytes, int] = {}
    words = (raw[a:b] for a, b in zip(begin.tolist(), end.tolist()))
    which = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    return np.unique(which, return_index=True)[1], which


_CUT = regex.compile(rb"[!-~](?= )")


def decode_ids(
    ids: np.ndarray, counts: np.ndarray, vocab: Vocabulary
) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after another; and how many each has.

    A text whose tokens do not join to UTF-8 has the replacement character for
    what is broken.
    """
    lengths = vocab.lengths[ids]
    octets = vocab.bytes[spread(vocab.starts[ids], lengths)]
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
    sizes = np.diff(ends, prepend=0)
    try:
        octets.tobytes().decode("utf-8")
        if not ((octets[ends[(ends < len(octets)) & (sizes > 0)]] & 0xC0) == 0x80).any():
            return octets, sizes
    except UnicodeDecodeError:
        pass
    texts = [
        octets[e - n : e].tobytes().decode("utf-8", "replace").encode()
        for e, n in zip(ends.tolist(), sizes.tolist())
    ]
    joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
    return joined, np.array([len(t) for t in texts], dtype=np.int64)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker, so that tasks that follow each other share the words."""
    return Encoder(path)


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with one more column, the ids of the whole text as an array.

    * Null and empty texts give an empty array; special strings in a text are
      special tokens; nothing is added, cut or padded.
    * Other columns pass through; if one is called ``ids_col`` already, the new
      one has underscores in front. An empty table gives no rows.
    """
    return _mapped(docs, path, text_col, ids_col, None)


def round_trip(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    ids_col: str = "ids",
    decoded_col: str = "decoded",
) -> DataFrame:
    """As ``encode``, with the text that the ids decode to as a further column."""
    return _mapped(docs, path, text_col, ids_col, decoded_col)


def decode(docs: DataFrame, path: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``docs`` with one more column, the text of the ids; a null array is an empty one."""
    name = free_name(docs, decoded_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids_col))
            ids = np.asarray(lists.flatten()).astype(np.int64)
            counts = np.array([len(x) if x.is_valid else 0 for x in lists], dtype=np.int64)
            yield _with(batch, name, _strings(*decode_ids(ids, counts, vocab)))

    fields = [*docs.schema.fields, T.StructField(name, T.StringType())]
    return docs.mapInArrow(run, T.StructType(fields))


def _mapped(docs: DataFrame, path: str, text_col: str, ids_col: str, decoded_col: str | None) -> DataFrame:
    ids_name = free_name(docs, ids_col)
    fields = [*docs.schema.fields, T.StructField(ids_name, T.ArrayType(T.IntegerType()))]
    decoded_name = free_name(docs, decoded_col) if decoded_col else None
    if decoded_name:
        fields.append(T.StructField(decoded_name, T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for whole in batches:
            for batch in slices(whole, text_col):
                column = batch.column(batch.schema.get_field_index(text_col))
                texts = [x or b"" for x in column.cast(pa.binary()).to_pylist()]
                ids, counts = own.encode(texts)
                out = _with(batch, ids_name, _lists(ids, counts))
                if decoded_name:
                    out = _with(out, decoded_name, _strings(*decode_ids(ids, counts, own.vocab)))
                yield out

    return docs.mapInArrow(run, T.StructType(fields))


def slices(batch: pa.RecordBatch, text_col: str, most: int = 2 * PIECE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about so many bytes of text, one row at least."""
    column = batch.column(batch.schema.get_field_index(text_col))
    ends = np.cumsum(np.asarray(pa.compute.binary_length(column).fill_null(0)).astype(np.int64))
    lo, base = 0, 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(lo, hi - lo)
        lo, base = hi, int(ends[hi - 1])


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, name])


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))


def _strings(octets: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(octets))]
    return pa.Array.from_buffers(pa.string(), len(sizes), buffers)


def digests(mapped: DataFrame, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Number and SHA-256 digests of the ids and of the decoded text, beside ``doc_id``."""
    return mapped.select(
        "doc_id",
        F.size(ids_col).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids_col, ","), 256).alias("ids_sha256"),
        F.sha2(decoded_col, 256).alias("decoded_sha256"),
    )
