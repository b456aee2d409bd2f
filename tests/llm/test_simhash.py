import random
import re

import numpy as np
import pytest
import xxhash

from bronzeflow.llm import simhash
from bronzeflow.llm.queries import op13_simhash

SF_DIR = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id that links of at most four bits lead to, all pairs compared."""
    n = len(prints)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    values = np.array([p for _, p in prints], dtype=np.uint64)
    for i in range(n):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1 :]) <= 4) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, p, least.get(find(i))) for i, (doc, p) in enumerate(prints)]


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(df, **options).collect()
    return sorted(((r.id, r.fingerprint % (1 << 64), r.component_id) for r in found), key=repr)


def test_fingerprints():
    rng = random.Random(1)
    texts = ["", " \t\n\x0b\x0c\r", "one", "One two THREE", "a b c d", "Ä ä x \U0001f600 y z", "a  b\tc\nd e a b c d e"]
    texts += [" ".join(rng.choice(["aa", "Bb", "cé"]) for _ in range(rng.randrange(60))) for _ in range(40)]
    for text in texts:
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_long_texts_go_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE", piece)
    rng = random.Random(piece)
    for _ in range(30):
        text = "".join(rng.choice(["a", "B", " ", "  ", "xyz "]) for _ in range(rng.randrange(200)))
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_any_four_positions_are_looked_up_once():
    fours = [tuple(sorted((*three, p))) for three, ps in simhash.POSITIONS.items() for p in ps]
    assert len(simhash.POSITIONS) == 20 and len(set(fours)) == len(fours) == 70


def clustered(rng, centres, members):
    """Fingerprints around centres, up to nine bits away, and some alone."""
    found = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(centres):
        centre = rng.getrandbits(64)
        volatile = rng.sample(range(64), 14)
        for _ in range(members):
            bits = rng.sample(volatile, rng.randrange(10))
            found.append(centre ^ sum(1 << b for b in bits))
    return found


@pytest.mark.parametrize("crowd", [simhash.CROWD, 5])
def test_links_against_all_pairs(spark, crowd):
    rng = random.Random(crowd)
    prints = list(dict.fromkeys(clustered(rng, 6, 150)))
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    pairs = simhash._links(df, crowd).collect()
    of = {s: n for n, s in enumerate(signed)}
    for r in pairs:
        assert (prints[of[r.a]] ^ prints[of[r.b]]).bit_count() <= 4
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in pairs:
        a, b = find(of[r.a]), find(of[r.b])
        root[max(a, b)] = min(a, b)
    wanted = [c for _, _, c in plain_components(list(enumerate(prints)))]
    assert [find(i) for i in range(len(prints))] == wanted


def test_documents_of_every_kind(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(10 + n, base.replace(f"w{n * 7} ", "Other ")) for n in range(12)]
    rows += [(3, None), (9, ""), (8, " \n"), (None, "only a null id"), (None, base), (7, "two words"), (7, "two words"), (6, "x " * 50_000)]
    wanted = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    assert run(spark, rows) == sorted(wanted, key=repr)


def test_empty_table_and_clashing_names(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "a", "b", 2)], "doc_id long, text string, row string, fingerprint int")
    row = simhash.near_duplicates(df, carry=["row", "fingerprint"]).first()
    assert (row["row"]["row"], row["row"]["fingerprint"], row.component_id) == ("b", 2, 1)


def test_query(spark):
    docs = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    wanted = {(i, f"{p:016x}", c) for i, p, c in plain_components(docs)}
    found = op13_simhash(spark, SF_DIR)
    assert found.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    assert set(map(tuple, found.collect())) == wanted
