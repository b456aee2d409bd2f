"""Hashes of words and numbers, computed over whole buffers."""

from __future__ import annotations

import numpy as np

#: Bytes between words.
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Longer words are hashed one by one.
LONG_WORD = 64


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Hash of whole numbers to 64 bits."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts, one after another, and how many each text has.

    A word's length and its stretches of eight bytes are mixed in turn, all words at
    once. Nothing is remembered between calls; equal words have equal hashes.
    """
    data = b"\n".join(texts) + b"\n" + bytes(8)
    octets = np.frombuffer(data, dtype=np.uint8)[:-8]
    blank = np.concatenate([[True], BLANK[octets]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    begin, length = edges[::2], edges[1::2] - edges[::2]
    # The eight bytes from each place on, as one number.
    eight = np.ndarray(len(octets), dtype="<u8", buffer=data, strides=(1,))
    value = mixed(length.astype(np.uint64) ^ mixed(np.array([seed]), 20), 21)
    todo = np.flatnonzero(length <= LONG_WORD)
    at = 0
    while todo.size:
        left = length[todo] - at
        part = eight[begin[todo] + at]
        short = left < 8
        part[short] &= (np.uint64(1) << (np.uint64(8) * left[short].astype(np.uint64))) - np.uint64(1)
        value[todo] = mixed(value[todo] ^ part, 22)
        todo, at = todo[left > 8], at + 8
    for i in np.flatnonzero(length > LONG_WORD):
        value[i] = _long_word_hash(data[begin[i] : begin[i] + length[i]], seed)
    ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(begin, ends)
    return value, np.diff(upto, prepend=0)


def _long_word_hash(word: bytes, seed: int) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word, seed)
