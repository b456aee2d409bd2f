import random

import numpy as np

from bronzeflow.llm.hashing import LONG_WORD, word_hashes


def test_words_of_texts_have_hashes_of_their_own():
    rng = random.Random(5)
    words = [bytes(rng.choices(b"ab\xc3\x00\x1c\x85", k=rng.choice((1, 2, 7, 8, 9, 16, 63, 64, 65, 200)))) for _ in range(400)]
    texts = [b"", b" \t", b"\x0bx\x0c", b"last"]
    texts += [b"".join(rng.choice(words) + rng.choice((b" ", b"\r\n", b"\t ")) for _ in range(30)) for _ in range(40)]
    found, counts = word_hashes(texts, 9)
    split = [t.split() for t in texts]
    assert counts.tolist() == [len(w) for w in split]
    flat = [w for ws in split for w in ws]
    assert len({*flat}) == len({*found.tolist()}) == len({*zip(flat, found.tolist())})
    for text, hashes in zip(texts, np.split(found, np.cumsum(counts)[:-1])):
        assert word_hashes([text], 9)[0].tolist() == hashes.tolist()
    assert max(map(len, flat)) > LONG_WORD
    assert not set(found.tolist()) & set(word_hashes(texts, 10)[0].tolist())


def test_no_texts():
    found, counts = word_hashes([])
    assert len(found) == len(counts) == 0


def test_padding_is_no_word():
    # A word of zero bytes differs from a shorter one, and from none.
    found, _ = word_hashes([b"\x00 \x00\x00 a a\x00 a\x00\x00\x00\x00\x00\x00\x00\x00"])
    assert len(set(found.tolist())) == 5
