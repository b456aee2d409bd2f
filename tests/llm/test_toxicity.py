import zlib

import pytest
from pyspark.sql import functions as F

from bronzeflow.llm import toxicity as tox
from bronzeflow.llm.queries import op6_toxicity

SF_DIR = "/root/testdata/sf0.1"
SCHEMA = "text string, toxic int"


def test_held_out_documents(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = op6_toxicity(spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    right = {0: [], 1: []}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.held_out and r.doc_id in labels:
            right[labels[r.doc_id]].append(r.predicted == labels[r.doc_id])
    assert sum(right[0]) >= 0.99 * len(right[0])
    assert sum(right[1]) >= 0.85 * len(right[1])


def reader(**stems):
    return tox.Reader(tox.Lexicon(stems))


def test_clauses_weigh_more_than_words():
    read = reader(idio=4.0).weight
    assert read("an idiot came") == pytest.approx(4.0)
    assert read("you idiot") == pytest.approx(5.0)  # with a target
    assert read("you. an idiot") == pytest.approx(4.0)  # in another clause
    assert read("not an idiot") == pytest.approx(2.4)  # negated
    assert read("not now or then an idiot") == pytest.approx(4.0)  # out of reach
    assert read("he said: idiot") == pytest.approx(4.0)
    assert read("she wrote idiot") == pytest.approx(4.0 * 1.25 * 0.7)  # reported
    assert read("idiots, idiotic") == pytest.approx(8.0)  # two clauses
    assert read("kill the light") == 0.0
    assert read("kill you") == 0.0 and read("you kill") == 0.5  # a threat needs a target before it
    assert read("") == 0.0


def test_composition_runs_the_parts_in_turn():
    table = tox.composed(tox.negation(), tox.reported_speech(), tox.matches())
    assert table.shape == (4 * 2 * 2, tox.STOP + 1, 2)
    state, weight = table[0, tox.INSULT]
    assert (state, weight) == (0, 1.0)
    state, _ = table[0, tox.NEGATION]
    state, _ = table[int(state), tox.REPORT]
    state, _ = table[int(state), tox.TARGET]
    assert table[int(state), tox.INSULT][1] == pytest.approx(1.25 * 0.6 * 0.7)
    assert table[int(state), tox.STOP][0] == 0


def test_stems_are_learned_and_chance_is_not(spark):
    rows = [(f"w{i} x{i} grobian{i % 9}", 1) for i in range(40)] + [(f"w{i} y{i} nett", 0) for i in range(200)]
    stems = tox.learn_lexicon(spark.createDataFrame(rows, SCHEMA)).stems
    assert stems["grob"] > 3
    assert not any(s.startswith(("=w", "=nett")) for s in stems)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (2, "", "c")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], SCHEMA)
    one_kind = spark.createDataFrame([("a b c", 1), (None, 1), ("x", None), ("y", 7)], SCHEMA)
    for labelled in (none, one_kind):
        got = tox.score(docs, labelled)
        assert got.columns == [*docs.columns, "_score"]
        assert len({r["_score"] for r in got.collect()}) == 1
    assert tox.score(docs.limit(0), none).count() == 0


def test_curve_of_separate_and_of_equal_weights():
    slope, offset = tox.fit_curve([(0.0, 0, 900), (4.0, 100, 100)])
    assert slope > 0 and offset < -3 and slope * 4 + offset > 3
    slope, offset = tox.fit_curve([(0.0, 10, 100)])
    assert slope >= 0 and -3 < offset < -1.5


def test_threats_weigh_with_a_target_on_either_side(spark):
    rows = [(f"w{i} x{i} grobian{i % 9}", 1) for i in range(40)] + [(f"w{i} y{i} nett", 0) for i in range(200)]
    lexicon = tox.learn_lexicon(spark.createDataFrame(rows, SCHEMA))
    read = tox.Reader(lexicon).weight
    full = read("kill you")
    assert full > 3  # as much as an insult
    assert read("you kill") == read("I will kill you") == read("killing you") == full
    assert read("kill the light") == read("kill. you") == read("") == 0.0
    assert read("never kill you") == pytest.approx(full * 0.6)
    assert read("she wrote kill him") == pytest.approx(full * 0.7)
    assert read("never kill, kill you") == read("never kill or so, you") + full
    docs = spark.createDataFrame([("we will hurt them",), ("we will paint it",), ("",)], "text string")
    scores = {r.text: r.score for r in tox.score(docs, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert scores["we will hurt them"] > 0.5 > scores["we will paint it"] == scores[""]


def test_weight_of_threats_follows_the_labels(spark):
    harmless = [(f"they beat him {i} w{i}", 0) for i in range(100)]
    rows = harmless + [(f"w{i} grobian", 1) for i in range(40)]
    assert tox.learn_lexicon(spark.createDataFrame(rows, SCHEMA)).threat == 0.0


def test_copies_of_a_labelled_text_are_one_text(spark, monkeypatch):
    monkeypatch.setattr(tox, "TRAINING_ROWS", 60)
    insults = [(f"w{i} x{i} grobian", 1) for i in range(20)]
    clean = [(f"y{i} z{i} wetter morgen", 0) for i in range(80)]
    # By its hash this text comes first, so that its copies would fill the sample.
    names = spark.range(500).selectExpr("concat('wetter laterne', id) AS text")
    text = names.orderBy(F.xxhash64("text", F.lit(7))).first().text
    labelled = spark.createDataFrame([(text, 1)] * 400 + [(text, 0)] * 40 + insults + clean, SCHEMA)
    got = tox.drawn_texts(labelled.selectExpr("text", "CAST(toxic AS long) AS toxic")).collect()
    assert len(got) == len({r.text for r in got}) == 60
    assert [r.toxic for r in got if r.text == text] == [1]
    docs = spark.createDataFrame([(text,), ("grobian",), ("",)], "text string")
    scores = {r.text: r.score for r in tox.score(docs, labelled).collect()}
    assert scores[text] == scores[""] < scores["grobian"]


def test_scoring_reads_the_letter_runs_that_learning_reads(spark):
    read = reader(**{"=scum": 4.0, "insul": 4.0}).weight
    for text in ("###scum", "scum$$$", "a/scum", "l'insulte", "scum’s", "1scum²", "_scum_", "scum't"):
        assert read(text) == pytest.approx(4.0), text
    assert read("isn't scum") == read("isn’t scum") == pytest.approx(2.4)
    assert read("you/scum") == pytest.approx(5.0) and read("you...scum") == pytest.approx(4.0)
    assert read("scum!scum") == pytest.approx(8.0) and read("scump") == 0.0
    odd = "Ab1cdé_fgh²ijk Ⅷxyz l'été ǆabc 日本語 don't état ªbcd Straße"
    learned = spark.createDataFrame([(odd,)], "text string").select(tox.tokens_of(F.col("text"))).first()[0]
    found = [w.partition("'")[0] for w in tox.runs_of(odd)]
    assert [w for w in found if len(w) > 2] == learned


def test_factors_follow_the_labels(spark):
    rows = [(f"w{i} grobian{i % 9}", 1) for i in range(60)] + [(f"w{i} y{i} nett", 0) for i in range(400)]
    assert tox.learn_lexicon(spark.createDataFrame(rows, SCHEMA)).factors == tox.FACTORS
    # Negated insults are as harmless as any text, reported ones as bad as the insult.
    more = [(f"w{i} not grobian", int(i < 4)) for i in range(36)]
    more += [(f"w{i} she wrote grobian", 1) for i in range(60)]
    lexicon = tox.learn_lexicon(spark.createDataFrame(rows + more, SCHEMA))
    targeted, negated, reported = lexicon.factors
    assert negated < 0.3 and reported > 0.9 and targeted > 0
    read = tox.Reader(lexicon).weight
    assert read("not grobian") == pytest.approx(negated * read("grobian"))


def test_long_texts_and_large_weights(spark):
    rows = [(f"w{i} grobian", 1) for i in range(40)] + [(f"w{i} nett", 0) for i in range(200)]
    rows += [("grobian. " * 5000 + str(i), 1) for i in range(5)]
    docs = spark.createDataFrame([("grobian. " * 20000,), ("grobian",), ("",)], "text string")
    scores = {len(r.text): r.score for r in tox.score(docs, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert 1.0 >= scores[180000] >= scores[7] > 0.5 > scores[0]
