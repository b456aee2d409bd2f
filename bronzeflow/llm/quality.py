"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) on a document. How far each
can be trusted is not given but estimated: expectation-maximisation over the
counts of the vote patterns, of which there are at most 3 to the number of
rules, whatever the number of documents. A document is kept if its posterior
probability of being good is at least one half.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow.llm.common import SPACE, scratch, whole_text, words_of

WINDOW = 8
LEAST_WORDS = 20
SYMBOLS = "#*$%&|<>"

#: (good if, bad if) over the measures; neither: the rule abstains. Only shapes
#: of text are judged, so that the rules hold for any language.
RULES: dict[str, tuple[str, str]] = {
    "word_length": ("mean_word BETWEEN 3 AND 11", "mean_word < 2 OR mean_word > 16"),
    "symbols": ("n_symbols <= 0.02 * n_words", "n_symbols > 0.1 * n_words"),
    "lines": ("n_dup_lines <= 0.1 * n_lines", "n_dup_lines > 0.3 * n_lines"),
    "repeats": ("n_repeat_words <= 0.1 * n_words", "n_repeat_words > 0.3 * n_words"),
    "letters": ("n_letters >= 0.85 * word_chars", "n_letters < 0.65 * word_chars"),
    "capitals": ("n_capitals <= 0.2 * n_letters", "n_capitals > 0.4 * n_letters"),
    "shouting": ("n_shouts <= 0.05 * n_words", "n_shouts > 0.2 * n_words"),
    "variety": ("n_distinct >= 0.4 * least(n_words, 200)", "n_distinct < 0.2 * least(n_words, 200)"),
}


#: Before any votes are seen: of a rule's votes on good texts, so many are bad ones.
#: The belief weighs as much as all texts together, at every size of the corpus.
FALSE_ALARM = 0.005
#: Posterior at which a document is kept.
KEEP = 0.5


def measures(
    docs: DataFrame, text_col: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """``(row, n_words, ...)``: the columns ``carry`` as a struct, and the measures.

    Repeated windows of eight words are found per text by a hash of 64 bits;
    every step is linear in the text but for sorting the windows of the texts
    that do repeat one.
    """
    kept = F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)]).alias("row")
    df = docs.select(kept, whole_text(text_col).alias("t"))
    df = df.select("*", words_of(F.col("t")).alias("words"))
    df = df.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("w1"))
    df = df.select("*", _paired("w1", 1).alias("w2"))
    df = df.select("*", _paired("w2", 2).alias("w4"))
    whole = F.slice(_paired("w4", 4), 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0)))
    df = df.select("t", "row", "words", whole.alias("windows"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    df = df.select("*", lines.alias("lines"))
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    df = df.select("*", F.when(twice, F.sort_array(placed)).alias("placed"))
    found = F.sort_array(F.transform(F.filter("placed", _has_twin), lambda x: x["i"]))
    df = df.select("*", found.alias("found"))
    covers = F.transform(
        "found",
        lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("found", i + 1) - p, F.lit(WINDOW))),
    )
    counts = {
        "n_words": F.size("words"),
        "n_distinct": F.size(F.array_distinct("words")),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": _length_without(f"[^{SYMBOLS}]+"),
        "n_letters": _length_without(r"[^\p{L}]+"),
        "n_capitals": _length_without(r"[^\p{Lu}]+"),
        "n_shouts": _length_without("[^!?]+"),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.coalesce(F.aggregate(covers, F.lit(0), lambda a, x: a + x), F.lit(0)),
    }
    return df.select("row", *[c.cast("long").alias(k) for k, c in counts.items()])


def _paired(runs: str, by: int) -> Column:
    """Hash of each run of words with the run ``by`` words on: runs twice as long."""
    later = F.slice(runs, by + 1, F.size(runs))
    return F.zip_with(runs, later, lambda a, b: F.xxhash64(a, b))


def _has_twin(x: Column, i: Column) -> Column:
    """Of windows in hash order: a neighbour is equal."""
    before = (i > 0) & (F.get("placed", F.greatest(i - 1, F.lit(0)))["h"] == x["h"])
    return before | F.coalesce(F.get("placed", i + 1)["h"] == x["h"], F.lit(False))


def _length_without(pattern: str) -> Column:
    return F.length(F.regexp_replace("t", pattern, ""))


def judge(
    docs: DataFrame,
    text_col: str = "text",
    carry: Sequence[str] | None = None,
    rules: Mapping[str, tuple[str, str]] = RULES,
    rounds: int = 40,
) -> DataFrame:
    """``(row, measures..., base_failed, quality, kept)``, one row per input row.

    * ``base_failed``: under 20 words, or over 30 % of them in repeated windows.
      Such a document is not kept, whatever the votes.
    * Null text: no words, so it fails. Nulls elsewhere, extra columns and
      repeated rows pass through in ``row``.
    * An empty table gives no rows.
    """
    measured = measures(docs, text_col, carry).withColumn(
        "mean_word", F.col("word_chars") / F.greatest("n_words", F.lit(1))
    )
    ballots = [
        F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0) for good, bad in rules.values()
    ]
    failed = F.expr(f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 30 * n_words")
    voted = scratch(
        measured.select("*", failed.alias("base_failed"), F.array(*ballots).alias("votes")),
        "quality-votes",
    )
    # Rejected texts would only teach the rules what the fixed checks know.
    patterns = voted.where("NOT base_failed").groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    # At most 3 to the number of rules patterns, so they fit one row.
    fit = patterns.agg(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n"))))
    fit = fit.toDF("patterns").select(_fitted(F.col("patterns"), len(rules), rounds).alias("fit"))
    found = scratch(fit, "quality-fit").first()["fit"]
    model = F.struct(
        F.lit(found["prior"]).alias("prior"),
        *[F.array(*map(F.lit, found[k])).alias(k) for k in ("good", "bad")],
    )
    return voted.withColumn("quality", _posterior(F.col("votes"), model)).select(
        *[c for c in voted.columns if c != "votes"],
        "quality",
        (~F.col("base_failed") & (F.col("quality") >= KEEP)).alias("kept"),
    )


def kept_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that are kept, with their own columns."""
    return judge(docs, text_col).where("kept").select("row.*")


def _posterior(ballot: Column, model: Column) -> Column:
    """P(good | votes), votes being independent given the truth."""

    def heard(odds: Column, vote: Column, j: Column) -> Column:
        good, bad = F.get(model["good"], j), F.get(model["bad"], j)
        return odds * F.when(vote == 1, good / bad).when(vote == -1, (1 - good) / (1 - bad)).otherwise(1.0)

    placed = F.transform(ballot, lambda v, j: F.struct(v.alias("v"), j.alias("j")))
    odds = F.aggregate(
        placed, model["prior"] / (1 - model["prior"]), lambda odds, x: heard(odds, x["v"], x["j"])
    )
    return odds / (odds + 1)


def _fitted(patterns: Column, n_rules: int, rounds: int) -> Column:
    """Prior, and of each rule how often it votes good on good and on bad texts.

    The whole of expectation-maximisation, as one fold over the row that holds
    the pattern counts. Two Beta priors enter: on bad texts, one vote each way; on
    good ones, two more than there are texts, ``FALSE_ALARM`` of them bad, since
    rules are written to be rarely wrong against a text. A rule whose bad votes meet
    no other rule's is found to be weak and rejects nothing alone. Sums run over
    sorted patterns, so reruns agree to the last digit.
    """
    rules = F.sequence(F.lit(0), F.lit(n_rules - 1))
    start = F.struct(
        F.lit(0.9).alias("prior"),
        F.array_repeat(F.lit(1 - FALSE_ALARM), n_rules).alias("good"),
        F.array_repeat(F.lit(0.5), n_rules).alias("bad"),
    )

    def total(xs: Column, of: Callable[[Column], Column]) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda a, x: a + of(x))

    def rate(seen: Column, j: Column, side: str, prior: tuple[Column, Column]) -> Column:
        up = total(seen, lambda x: F.when(F.get(x["votes"], j) == 1, x[side]).otherwise(0.0))
        cast = total(seen, lambda x: F.when(F.get(x["votes"], j) != 0, x[side]).otherwise(0.0))
        return (up + prior[0]) / (cast + prior[0] + prior[1])

    def improved(seen: Column) -> Column:
        good = total(seen, lambda x: x["good"])
        texts = good + total(seen, lambda x: x["bad"])
        trusted = ((texts + 2) * (1 - FALSE_ALARM), (texts + 2) * FALSE_ALARM)
        even = (F.lit(1.0), F.lit(1.0))
        return F.struct(
            ((good + 1) / (texts + 2)).alias("prior"),
            F.transform(rules, lambda j: rate(seen, j, "good", trusted)).alias("good"),
            F.transform(rules, lambda j: rate(seen, j, "bad", even)).alias("bad"),
        )

    def step(model: Column, _: Column) -> Column:
        def weighed(x: Column) -> Column:
            p = _posterior(x["votes"], model)
            return F.struct(x["votes"].alias("votes"), (p * x["n"]).alias("good"), p.alias("p"), x["n"].alias("n"))

        seen = F.transform(
            F.transform(F.sort_array(patterns), weighed),
            lambda x: F.struct(x["votes"].alias("votes"), x["good"], (x["n"] - x["good"]).alias("bad")),
        )
        # One element, so that the weights are worked out once a round.
        return F.get(F.transform(F.array(seen), improved), F.lit(0))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)
