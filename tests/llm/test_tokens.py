import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bronzeflow.llm import bpe, tokens
from bronzeflow.llm.queries import op1_token_counts, op4_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_tokens string, ids string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(5)
    letters = list("abcdersti'' \n\t!?.,012ñé日本 \x1c\x85🎉²") + ["<|endoftext|>", "'re", "'s", "  "]
    made = ["".join(rng.choices(letters, k=rng.randint(0, 900))) for _ in range(40)]
    return [
        *made,
        None,
        "",
        "x" * 3000,
        "word " * 700,
        " " * 1500,
        "<|endoftext|>" * 60,
        made[0],
        made[0],
        "ab" * 400 + " tail of words " * 30,
    ]


@pytest.fixture(scope="module")
def rows():
    return [(i % 40, t, "clash", "clash") for i, t in enumerate(texts())]


def test_counts_of_chunked_texts(spark, library, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = tokens.count_tokens(docs, PATH, chunk=200, overlap=80)
    assert got.columns == [*docs.columns, "_n_tokens"]
    wanted = sorted((i, t or "", len(library.encode(t or "").ids)) for i, t, *_ in rows)
    assert sorted((r.doc_id, r.text or "", r._n_tokens) for r in got.collect()) == wanted


def test_round_trip(spark, library, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = bpe.round_trip(docs, PATH)
    assert got.columns == [*docs.columns, "_ids", "decoded"]
    for r in got.collect():
        ids = library.encode(r.text or "").ids
        assert r._ids == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_decode_broken_and_null_ids(spark, library):
    ids = library.encode("日本").ids
    docs = spark.createDataFrame([(1, ids[:1]), (2, None), (3, ids)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(docs, PATH).collect()}
    assert got == {1: library.decode(ids[:1]), 2: "", 3: "日本"}


def test_words_of_every_letter_kind(library):
    own = bpe.Encoder(PATH)
    made = [f"a{chr(i)}b {chr(i)}'ll {chr(i)}\n" for i in range(0x3200) if not 0xD800 <= i < 0xE000]
    ids, counts = own.encode([t.encode() for t in made])
    at = 0
    for text, n in zip(made, counts.tolist()):
        assert library.encode(text).ids == ids[at : at + n].tolist(), text
        at += n


def test_long_word_has_a_tree_of_its_own(library):
    own = bpe.Encoder(PATH)
    for text in ("ab" * 3000, "the" * 341 + "a", "q" * 1024, "q" * 1023):
        ids, _ = own.encode([text.encode()])
        assert ids.tolist() == library.encode(text).ids


def test_text_over_a_piece_is_cut_safely(library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 64)
    bpe._powers.cache_clear()
    own = bpe.Encoder(PATH)
    for text in texts():
        ids, _ = own.encode([(text or "").encode()])
        assert ids.tolist() == library.encode(text or "").ids
    bpe._powers.cache_clear()


def test_memory_of_words_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    own = bpe.Encoder(PATH)
    for text in texts():
        ids, _ = own.encode([(text or "").encode()])
        assert ids.tolist() == library.encode(text or "").ids


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("function", [tokens.count_tokens, bpe.encode])
def test_empty_table(spark, function):
    assert function(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_queries_against_the_library(spark, library):
    import hashlib

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    counted = op1_token_counts(spark, SF_DIR).collect()
    coded = {r.doc_id: r for r in op4_bpe(spark, SF_DIR).collect()}
    assert len(counted) == len(coded) == len(docs)
    for r in counted:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_bytes, r.n_tokens) == (len(docs[r.doc_id].encode()), len(ids))
        assert r.over_limit == (len(ids) > 1024)
        own = coded[r.doc_id]
        assert own.n_tokens == len(ids)
        assert own.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert own.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("length", [1024, 2048])
def test_words_of_equal_hash_are_told_apart(library, length):
    """A polynomial modulo 2**64 cannot tell this word from the one with its letters exchanged."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(length))
    other = word.translate(str.maketrans("ab", "ba"))
    raw = f"{word} {other} {word}".encode()
    begin = np.array([0, length + 1])
    octets = np.frombuffer(raw, dtype=np.uint8)
    same = bpe._word_hashes(octets, begin, begin + length)
    assert same[0] == same[1]
    own = bpe.Encoder(PATH)
    for text in (f"{word}\n{other}", f"{other}\n{word}\n{word}", f"x\n{word}\n{other}\nx"):
        ids, _ = own.encode([text.encode()])
        assert ids.tolist() == library.encode(text).ids
