"""Toxicity by a weighted finite-state pattern grammar.

Five transducers read the words of a clause: insults, threats and targets are
told apart by a lexicon, and what negation or reported speech covers is weakened.
They are composed once into one transducer, which turns a clause into a weight;
a text scores by its matched clauses, not by isolated words.

The insults are learned: stems (beginnings of words, or whole words) that stand
in toxic texts far more often than in others, each with a weight. The other
lexicons are fixed lists; a threat counts with a target on either side of it in
its clause. What a threat weighs, and by how much targets, negation and reported
speech change a weight, is fitted to the labelled texts too. A logistic curve,
fitted to them as well, turns the weight of a text into a probability.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow.llm.common import free_name, scratch, whole_text

#: Labelled texts that the grammar and the curve are learned from at most, drawn by hash.
TRAINING_ROWS = 20_000
#: Lengths of the beginnings of words that may be stems.
STEMS = (4, 5, 6, 7)
#: Toxic texts that a stem must stand in, and how many stems of pure chance the
#: lexicon may be expected to hold, as a power of e.
LEAST_TEXTS, CHANCE = 4, -2.0
#: Weight of a threat with its target if no insult is learned, else their median is
#: taken; it counts as LEAST_TEXTS texts beside the labelled ones with such a threat.
THREAT_WEIGHT = 4.0
#: By what an insult counts after a target, negated, and reported, if no labelled text
#: tells; this counts as LEAST_TEXTS texts beside the labelled ones.
FACTORS = (1.25, 0.6, 0.7)
#: Tokens that a task remembers.
REMEMBERED = 300_000

#: Words of the other lexicons, in English, German, French, Spanish.
TARGETS = "you your yours yourself he she him her they them these those du dich dir ihr euch sie er tu toi te vous ils elles lui usted ustedes tú ti ellos ellas"
NEGATIONS = "not no never nor isn't aren't wasn't don't doesn't didn't won't wouldn't can't couldn't nicht kein keine keinen nie niemals pas jamais ni nunca jamás"
REPORTS = "said says say wrote writes claimed claims called quoted sagte sagt schrieb behauptet dit disait écrit dijo dice escribió"
THREATS = (
    "kill kills killing killed hurt hurts hurting destroy destroys destroying destroyed "
    "beat beats beating beaten burn burns burning burned shoot shoots shooting stab stabs "
    "stabbing stabbed töten töte tötet getötet umbringen umbringe umbringt umgebracht schlagen "
    "schlage schlägt geschlagen tuer tue tuez tuerai tuera frapper frappe frapperai frappera "
    "brûler brûle brûlerai brûlera matar mato mata mataré matará golpear golpeo golpea golpearé "
    "golpeará quemar quemo quema quemaré quemará"
)

#: Symbols that the lexicon writes and the others rewrite.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, STOP = range(7)
NEGATED, REPORTED, MET = 8, 16, 32
#: How far a negation reaches, in words.
REACH = 3

Rule = Callable[[int, int], tuple[int, int, float]]


class Transducer(NamedTuple):
    """``step(state, symbol) -> (state, symbol, weight)`` from state 0; ``n`` states."""

    n: int
    step: Rule


def negation() -> Transducer:
    """Marks insults and threats within reach of a negation. State: words left of it."""

    def step(state: int, symbol: int) -> tuple[int, int, float]:
        if symbol == STOP:
            return 0, symbol, 1.0
        if symbol == NEGATION:
            return REACH, OTHER, 1.0
        marked = symbol | NEGATED if state and symbol in (INSULT, THREAT) else symbol
        return max(state - 1, 0), marked, 1.0

    return Transducer(REACH + 1, step)


def reported_speech() -> Transducer:
    """Marks insults and threats after a verb of saying, up to the end of the clause."""

    def step(state: int, symbol: int) -> tuple[int, int, float]:
        if symbol == STOP:
            return 0, symbol, 1.0
        if symbol == REPORT:
            return 1, OTHER, 1.0
        hit = state and symbol & ~NEGATED in (INSULT, THREAT)
        return state, symbol | REPORTED if hit else symbol, 1.0

    return Transducer(2, step)


def open_threats() -> Transducer:
    """Marks targets that a threat of the clause stands before, with the marks of that threat.

    State: none, or one more than the marks of the threat; of several the one marked least.
    """
    marks = (0, REPORTED, NEGATED, NEGATED | REPORTED)

    def step(state: int, symbol: int) -> tuple[int, int, float]:
        if symbol == STOP:
            return 0, symbol, 1.0
        if symbol & 7 == THREAT:
            own = marks.index(symbol & (NEGATED | REPORTED)) + 1
            return min(state, own) if state else own, symbol, 1.0
        if symbol == TARGET and state:
            return state, symbol | MET | marks[state - 1], 1.0
        return state, symbol, 1.0

    return Transducer(len(marks) + 1, step)


def matches(targeted: float = 1.25, negated: float = 0.6, reported: float = 0.7) -> Transducer:
    """Weights of the insults and threats of a clause; a target makes them heavier.

    A threat counts only with a target: itself if that stands before it, else the
    target that ``open_threats`` has marked. Negated and reported ones have factors.
    """

    def step(state: int, symbol: int) -> tuple[int, int, float]:
        if symbol == STOP:
            return 0, symbol, 0.0
        kind, met = symbol & 7, bool(symbol & MET)
        factors = {INSULT: targeted if state else 1.0, THREAT: float(state), TARGET: float(met)}
        weight = factors.get(kind, 0.0)
        if symbol & NEGATED:
            weight *= negated
        if symbol & REPORTED:
            weight *= reported
        return 1 if kind == TARGET else state, symbol, weight

    return Transducer(2, step)


def composed(*parts: Transducer) -> np.ndarray:
    """Table ``[state, symbol] -> (state, weight)`` of transducers run one after another."""
    sizes = [p.n for p in parts]
    table = np.zeros((math.prod(sizes), STOP + 1, 2))
    for state in range(len(table)):
        states = np.unravel_index(state, sizes)
        for symbol in range(STOP + 1):
            following, seen, weight = [], symbol, 1.0
            for own, part in zip(states, parts):
                own, seen, factor = part.step(int(own), seen)
                following.append(own)
                weight *= factor
            table[state, symbol] = np.ravel_multi_index(following, sizes), weight
    return table


#: Weight of the squares of the curve's two numbers when it is fitted.
PENALTY = 0.1


class Lexicon(NamedTuple):
    """Weights of stems, ``=word`` being a whole word, and of threats.

    ``threat`` is the weight of one after a target, ``aimed`` that of one before a
    target; ``factors`` are what targets, negation and reported speech multiply by.
    Learning sets them; the defaults are those of a lexicon that nothing was fitted for.
    """

    stems: dict[str, float]
    threat: float = 0.5
    aimed: float = 0.0
    factors: tuple[float, float, float] = FACTORS


def tokens_of(text: Column) -> Column:
    """Lower-case runs of letters of a text, as an array."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}{3,}"), F.lit(0))


def learn_lexicon(labelled: DataFrame) -> Lexicon:
    """Stems of ``(text, toxic)`` that stand in toxic texts too often for chance.

    Texts are counted per stem, so a word that fills one text counts once. The
    log-likelihood gain over the share of toxic texts must exceed the logarithm
    of the number of stems that are looked at, by ``-CHANCE``.
    """
    totals = labelled.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = totals["t"] or 0, totals["n"] - (totals["t"] or 0)
    # A text's own set of stems: words of it that share one count once.
    per_text = labelled.select(
        "toxic",
        F.array_distinct(
            F.flatten(
                F.transform(
                    F.array_distinct(tokens_of(F.col("text"))),
                    lambda w: F.array(
                        F.concat(F.lit("="), w),
                        *[F.when(F.length(w) > n, F.substring(w, 1, n)) for n in STEMS],
                    ),
                )
            )
        ).alias("stems"),
    )
    counts = scratch(
        per_text.select("toxic", F.explode("stems").alias("stem"))
        .where("stem IS NOT NULL")
        .groupBy("stem")
        .agg(F.sum("toxic").cast("double").alias("t"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= LEAST_TEXTS),
        "toxicity-stems",
    )
    tried, share = counts.count(), toxic / max(totals["n"], 1)
    if not 0 < share < 1 or not tried:
        return Lexicon({}, THREAT_WEIGHT, THREAT_WEIGHT)
    t, c = F.col("t"), F.col("n") - F.col("t")
    gain = t * F.log(t / F.col("n") / share) + F.when(
        c > 0, c * F.log(c / F.col("n") / (1 - share))
    ).otherwise(0.0)
    odds = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    rows = (
        counts.where((t >= LEAST_TEXTS) & (t * 2 > F.col("n")))
        .select("stem", odds.alias("odds"), gain.alias("gain"))
        .where(F.col("gain") > math.log(tried) - CHANCE)
        .collect()
    )
    stems = {r["stem"]: round(r["odds"], 6) for r in rows}
    usual = float(np.median(list(stems.values()))) if stems else THREAT_WEIGHT
    threats, plain, *marked = evidence(labelled, stems)
    threat = threat_weight(*threats, toxic, clean, usual)
    factors = tuple(fitted_factor(*hit, *plain, share, f) for hit, f in zip(marked, FACTORS))
    return Lexicon(stems, threat, threat, factors)


def evidence(labelled: DataFrame, stems: dict[str, float]) -> list[tuple[int, int]]:
    """Toxic texts and all texts ``(t, n)`` of each kind, from one reading: those with a
    threat and its target; with an insult that no factor touches; and those all of whose
    insults stand after a target, are negated, or are reported."""
    without = [tuple(float(k != j) for k in range(3)) for j in range(3)]
    lexicons = [Lexicon({}, 1.0, 1.0)]
    lexicons += [Lexicon(stems, 0.0, 0.0, f) for f in ((0.0,) * 3, (1.0,) * 3, *without)]
    read = clause_readings(labelled, lexicons, "text", "w")
    insulting = F.col("w")[2] > 0
    kinds = [F.col("w")[0] > 0, F.col("w")[1] > 0]
    kinds += [insulting & (F.col("w")[3 + j] == 0) for j in range(3)]
    sums = [F.sum(F.when(k, x)) for k in kinds for x in (F.col("toxic"), F.lit(1))]
    found = [x or 0 for x in read.agg(*[x.alias(f"x{i}") for i, x in enumerate(sums)]).first()]
    return list(zip(found[::2], found[1::2]))


def threat_weight(t: int, n: int, toxic: int, clean: int, usual: float) -> float:
    """Log-odds of ``n`` texts with a threat, ``t`` toxic, drawn towards ``usual``; never negative."""
    odds = math.log((t + 0.5) / (toxic + 1)) - math.log((n - t + 0.5) / (clean + 1))
    return round(max((usual * LEAST_TEXTS + odds * n) / (LEAST_TEXTS + n), 0.0), 6)


def fitted_factor(t: int, n: int, plain_t: int, plain_n: int, share: float, usual: float) -> float:
    """Log-odds of texts whose insults are all marked, over those of plain insults.

    The part of the former that is toxic has a prior that stands for LEAST_TEXTS
    texts and whose log-odds are ``usual`` times the latter. Never negative.
    """
    logit = lambda p: math.log(p / (1 - p))
    plain = logit((plain_t + 0.5) / (plain_n + 1)) - logit(share)
    if plain <= 0 or not n:
        return usual
    prior = 1 / (1 + math.exp(-(usual * plain + logit(share))))
    odds = logit((t + LEAST_TEXTS * prior) / (n + LEAST_TEXTS)) - logit(share)
    return round(max(odds / plain, 0.0), 6)


class Reader:
    """Symbols and weights of tokens, remembered within a bound."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.stems = lexicon.stems
        kinds = ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (THREATS, THREAT))
        self.fixed = {w: kind for words, kind in kinds for w in words.split()}
        self.own = {THREAT: lexicon.threat, TARGET: lexicon.aimed}
        table = composed(negation(), reported_speech(), open_threats(), matches(*lexicon.factors))
        self.steps = [[(int(state), weight) for state, weight in row] for row in table.tolist()]
        self.known: dict[str, tuple[int, float]] = {}

    def token(self, word: str) -> tuple[int, float]:
        """Symbol and weight of a run of letters, or of a character that ends a clause."""
        if word in CLAUSE_ENDS:
            return STOP, 0.0
        word = word.replace("’", "'")
        kind = self.fixed.get(word, OTHER)
        word = word.partition("'")[0]
        keys = ["=" + word, *[word[:n] for n in STEMS if len(word) > n]]
        weight = max((self.stems.get(k, 0.0) for k in keys), default=0.0)
        if weight > 0 and kind in (OTHER, THREAT):
            return INSULT, weight
        return kind, self.own.get(kind, 0.0)

    def weight(self, text: str) -> float:
        """Sum of the weights of the matched clauses, a clause counting by its heaviest match."""
        return self.weight_of(runs_of(text))

    def weight_of(self, words: list[str]) -> float:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, token = self.known, self.token
        read = {w: known.get(w) or known.setdefault(w, token(w)) for w in set(words)}
        if not any(s in (INSULT, THREAT) for s, _ in read.values()):
            return 0.0
        total, state, best = 0.0, 0, 0.0
        for word in words:
            symbol, own = read[word]
            state, factor = self.steps[state][symbol]
            if symbol == STOP:
                total, best = total + best, 0.0
            elif own * factor > best:
                best = own * factor
        return total + best


CLAUSE_ENDS = ".,;:!?"
#: Runs of letters, as learning sees them but of any length; a negation's "'t" belongs to
#: its word, and characters that end a clause stand for themselves.
RUNS = re.compile(rf"[^\W\d_]+(?:['’]t\b)?|[{CLAUSE_ENDS}]")


def runs_of(text: str) -> list[str]:
    """Lower-case runs of letters of a text, and the characters that end its clauses."""
    words = RUNS.findall(text.lower())
    if text.isascii():
        return words
    # Numbers that are no digits are word characters to a pattern, but no letters.
    odd = {w for w in set(words) if not w.isalpha() and w[0] not in CLAUSE_ENDS}
    if odd:
        apart = {w: "".join(c if c.isalpha() or c in "'’" else " " for c in w).split() for w in odd}
        words = [x for w in words for x in apart.get(w, (w,))]
    return words


def clause_weights(docs: DataFrame, lexicon: Lexicon, text_col: str, name: str) -> DataFrame:
    """``docs`` with the weight of the matched clauses of the whole text."""

    @F.pandas_udf("double")
    def read(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(lexicon)
        for part in texts:
            yield pd.Series([reader.weight(t) for t in part], dtype="float64")

    return docs.withColumn(name, read(whole_text(text_col)))


def clause_readings(
    docs: DataFrame, lexicons: list[Lexicon], text_col: str, name: str
) -> DataFrame:
    """``docs`` with an array of the weights that each of the lexicons gives the whole text."""

    @F.pandas_udf("array<double>")
    def read(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        readers = [Reader(x) for x in lexicons]
        for part in texts:
            runs = map(runs_of, part)
            yield pd.Series([[r.weight_of(words) for r in readers] for words in runs], dtype=object)

    return docs.withColumn(name, read(whole_text(text_col)))


def fit_curve(counts: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset of the logistic curve over ``(weight, toxic, rows)``.

    Newton's method with a small penalty on the slope, so that labels which the
    weights separate have a finite one; the slope is never negative.
    """
    if not counts:
        return 1.0, -2.0
    x, t, n = (np.array(c, dtype=float) for c in zip(*counts))

    def loss(a: float, b: float) -> float:
        z = a * x + b
        return float((n * np.logaddexp(0, z) - t * z).sum() + PENALTY * (a * a + b * b) / 2)

    a, b = 0.0, math.log((t.sum() + 1) / (n.sum() - t.sum() + 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-(a * x + b)))
        gap, spread = n * p - t, n * p * (1 - p)
        slope = np.array([(gap * x).sum() + PENALTY * a, gap.sum() + PENALTY * b])
        cross = (spread * x).sum()
        bend = np.array([[(spread * x * x).sum(), cross], [cross, spread.sum()]])
        step = np.linalg.solve(bend + PENALTY * np.eye(2), slope)
        size = 1.0
        while size > 1e-6 and loss(a - size * step[0], b - size * step[1]) > loss(a, b):
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
        if size * np.abs(step).max() < 1e-9:
            break
    return round(max(a, 0.0), 9), round(b, 9)


def drawn_texts(labelled: DataFrame) -> DataFrame:
    """``(text, toxic)`` of the ``TRAINING_ROWS`` different texts with the lowest hashes."""
    draw = F.xxhash64("text", F.lit(7))
    share = min(1.0, 2 * TRAINING_ROWS / max(labelled.count(), 1))
    while True:
        # Most of what a large table has is passed over before anything is ordered.
        low = labelled.where(draw <= F.lit(min(int((2 * share - 1) * 2.0**63), (1 << 63) - 1)))
        # Hashes alone are ordered, so that the texts stay spread over the tasks.
        lowest = low.select(draw.alias("draw")).distinct().orderBy("draw").limit(TRAINING_ROWS)
        found = lowest.agg(F.count(F.lit(1)).alias("n"), F.max("draw").alias("last")).first()
        if share == 1.0 or found["n"] >= TRAINING_ROWS:
            break
        # Rows are more than texts: the share of the hashes was too small.
        share = min(1.0, max(2.0, 2 * TRAINING_ROWS / max(found["n"], 1)) * share)
    texts = low.where(draw <= F.lit(found["last"])).groupBy("text")
    toxic = (F.sum("toxic") * 2 >= F.count(F.lit(1))).cast("long").alias("toxic")
    return scratch(texts.agg(toxic), "toxicity-training")


def score(
    docs: DataFrame, labelled: DataFrame, text_col: str = "text", score_col: str = "score"
) -> DataFrame:
    """``docs`` with one more column, the probability that a text is toxic.

    ``labelled`` is ``(text, toxic)``; at most ``TRAINING_ROWS`` different texts of
    it are used, drawn by a hash of the text.

    * Copies of a labelled text are one text, toxic if at least half of them are.
    * Null and empty texts match nothing and have the score of such texts. Only
      the text enters a score.
    * Labels that are null, or neither 0 nor 1, are left out. Without any, or
      with one kind only, there is nothing to learn: no stems, and the curve of
      the share alone.
    * Repeated rows score alike; other columns pass through; if one is called
      ``score_col``, the new one has underscores in front. An empty table gives
      no rows.
    """
    name, weight = free_name(docs, score_col), free_name(docs, "clause_weight")
    labelled = labelled.where("toxic IN (0, 1)").select(
        whole_text("text").alias("text"), F.col("toxic").cast("long").alias("toxic")
    )
    training = drawn_texts(labelled)
    lexicon = learn_lexicon(training)
    weighed = clause_weights(training, lexicon, "text", "weight")
    # Weights by halves, and no more of them than drawn texts, come to the driver.
    halves = (F.ceil(F.col("weight") * 2) / 2).alias("weight")
    counts = weighed.groupBy(halves).agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    slope, offset = fit_curve([tuple(r) for r in counts.orderBy("weight").collect()])
    odds = F.col(weight) * slope + offset
    scored = clause_weights(docs, lexicon, text_col, weight)
    return scored.withColumn(name, 1 / (1 + F.exp(-odds))).drop(weight)
