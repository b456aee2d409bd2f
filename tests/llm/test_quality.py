import random
import re

import pytest
from pyspark.sql import functions as F

from bronzeflow.llm import quality
from bronzeflow.llm.queries import op8_quality_rules

SF_DIR = "/root/testdata/sf0.01"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    starts = {}
    for i in range(len(words) - 7):
        starts.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for s in starts.values() if len(s) > 1 for i in s for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = op8_quality_rules(spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    kept = {}
    for r in rows:
        wanted = base(docs[r.doc_id])
        assert tuple(r[c] for c in BASE) == wanted
        failed = wanted[0] < 20 or 100 * wanted[4] > 30 * wanted[0]
        assert r.base_failed == failed and not (failed and r.kept)
        kept[r.doc_id] = r.kept if not failed else None
    clean = [kept[d] for d, q in labels.items() if q == 1 and kept[d] is not None]
    junk = [kept[d] for d, q in labels.items() if q == 0 and kept[d] is not None]
    assert sum(clean) >= 0.97 * len(clean)
    assert sum(junk) <= 0.2 * len(junk)


def test_posterior_is_no_all_must_pass_filter(spark):
    """Weak rules are told from strong ones, and the labels agree more than with a veto."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    vetoed = F.expr(" OR ".join(f"({bad})" for _, bad in quality.RULES.values()))
    judged = (
        quality.judge(docs, carry=["doc_id"])
        .withColumn("mean_word", F.col("word_chars") / F.greatest("n_words", F.lit(1)))
        .where("NOT base_failed")
        .select("row.doc_id", "kept", vetoed.alias("vetoed"))
    )
    rows = judged.join(labels, "doc_id", "left").collect()
    assert any(r.kept and r.vetoed for r in rows) and any(not r.kept for r in rows)
    known = [r for r in rows if r.quality is not None]
    right = sum(r.kept == (r.quality == 1) for r in known)
    assert right > sum(r.vetoed != (r.quality == 1) for r in known)


def made_texts():
    rng = random.Random(8)
    words = ["é", "日本", "a b", "#x|", "the", "of", "DE", "<p>"]
    seps = [" ", "\n", "\t", "\x0b", "\r\n", "  "]
    texts = ["".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, 90))) for _ in range(60)]
    return texts + [None, "", " \n ", "w " * 300, "\n".join(["one line"] * 5), "a b c d e f g h " * 2]


def test_measures_of_odd_texts(spark):
    rows = [(i, t, 5) for i, t in enumerate(made_texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = quality.judge(df)
    for r in got.collect():
        assert tuple(r[c] for c in BASE) == base(r.row.text), r.row.text
    kept = quality.kept_documents(df)
    assert kept.columns == df.columns


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None)] * 3, "doc_id long, text string")
    assert [(r.base_failed, r.kept) for r in quality.judge(df).collect()] == [(True, False)] * 3
    assert quality.judge(df.limit(0)).count() == 0


def test_rules_are_learned_from_their_agreement(spark):
    """A rule that votes at random gets little weight, good ones much."""
    rng = random.Random(1)
    counts = {}
    for _ in range(4000):
        good = rng.random() < 0.8
        key = (1 if good or rng.random() < 0.1 else -1, 1 if good or rng.random() < 0.2 else -1, rng.choice([1, 0]))
        counts[key] = counts.get(key, 0) + 1
    row = [[{"votes": list(k), "n": float(n)} for k, n in counts.items()]]
    df = spark.createDataFrame([row], "patterns array<struct<votes:array<int>,n:double>>")
    fit = df.select(quality._fitted(F.col("patterns"), 3, 60).alias("f")).first()["f"]
    assert fit["prior"] == pytest.approx(0.8, abs=0.03)
    assert fit["bad"][0] == pytest.approx(0.1, abs=0.05)
    assert fit["bad"][1] == pytest.approx(0.2, abs=0.05)


def test_main_path_is_native(spark):
    plan = op8_quality_rules(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
