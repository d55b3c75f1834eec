"""Quality rules as weak supervision: rules vote or abstain, EM estimates how far to trust them.

Words are maximal runs of characters other than space and ``\\x09-\\x0D``.  Every rule
looks at counts of the whole text (all whole numbers, see ``counts``) and votes good
(1), bad (-1) or abstains (0).  The model has a latent good/bad state per document and
two accuracies per rule, given the state and a vote: how often it says good of a good
document, and bad of a bad one.  Expectation-maximisation runs over the histogram of
vote patterns -- at most 3 to the number of rules rows, whatever the corpus -- and
counts every document that passes the base test.  Accuracies stay within ``ACCURACY``
(a rule is assumed better than chance, and never sure) and the share of good documents
within ``PRIOR``, so that the two states cannot swap and a rule that never fires
cannot decide alone.  A document stays when its posterior probability of
being good is at least one half, instead of having to pass every rule.

Everything is DataFrame functions.  The counts are made within a row (no words are
shuffled): repeated 3-word windows are found by sorting 64-bit window hashes of the
text, so the work is n log n in its length.

Null and empty texts have no words and fail the base test, as does any text of fewer than
``MIN_WORDS`` words or with more than half of its words in repeated windows.  A very long text
is one row's arrays.  Rows are judged one by one: repeated rows, ties and null ids need no
rule, and equal texts get equal verdicts.  Without a document that passes the base test every
estimate is its smoothed prior.  An empty table gives an empty result.  Only doc_id and text
are read; ``filter_quality`` keeps all other columns, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.session_tables import packed, unpacked, written

MIN_WORDS = 50
SYMBOLS = "[#*$%&|<>]"
_WORD_GAP = r"[\x20\x09-\x0D]+"
_INK = r"[^\x20\x09-\x0D]"

ITERATIONS = 20
ACCURACY = (0.6, 0.99)
PRIOR = (0.05, 0.95)
START_ACCURACY, START_PRIOR = 0.8, 0.8

#: name: (votes good when, votes bad when) -- SQL over the counts, whole numbers only.
RULES: dict[str, tuple[str, str]] = {
    "symbol_free": ("n_symbols = 0", "20 * n_symbols > word_chars"),
    "symbols_per_word": ("100 * n_symbols <= n_words", "5 * n_symbols > n_words"),
    "word_length": ("2 * word_chars >= 9 * n_words AND 2 * word_chars <= 11 * n_words",
                    "word_chars < 3 * n_words OR word_chars > 7 * n_words"),
    "repeated_windows": ("n_repeat_words = 0", "10 * n_repeat_words > 3 * n_words"),
    "repeated_lines": ("n_lines >= 3 AND n_dup_lines = 0", "n_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines"),
    "capitals": ("20 * n_capitals <= word_chars", "5 * n_capitals > word_chars"),
    "vocabulary": ("2 * n_distinct >= n_words", "10 * n_distinct < 3 * n_words AND n_words < 1000"),
    "sentences": ("20 * n_ends >= n_words AND 5 * n_ends <= n_words", "60 * n_ends < n_words OR 2 * n_ends > n_words"),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_distinct", "n_ends"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more, each word once."""
    def covered(starts: Column) -> Column:
        begin = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(starts, begin, lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])

    def twins(s: Column) -> Column:
        near = lambda k: F.coalesce(F.get(s, k)["h"], F.lit(None))
        found = F.transform(s, lambda x, k: F.when(near(k - 1).eqNullSafe(x["h"]) | near(k + 1).eqNullSafe(x["h"]), x["i"]))
        return F.sort_array(F.array_compact(found))

    def count(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            _let(_let(placed, twins), covered))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                          lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(windows, count))


def counts(text: Column) -> Column:
    """The struct of ``COUNTS`` of a text, all long."""
    t = F.coalesce(text, F.lit(""))
    long = lambda c, name: c.cast("bigint").alias(name)
    of_words = _let(F.array_remove(F.split(t, _WORD_GAP), ""), lambda w: F.struct(
        long(F.size(w), "n_words"), long(F.length(F.array_join(w, "")), "word_chars"),
        long(_repeat_words(w), "n_repeat_words"), long(F.size(F.array_distinct(w)), "n_distinct")))
    of_lines = _let(F.filter(F.split(t, "\n"), lambda s: s.rlike(_INK)), lambda s: F.struct(
        long(F.size(s), "n_lines"), long(F.size(s) - F.size(F.array_distinct(s)), "n_dup_lines")))
    return F.struct(of_words.alias("w"), of_lines.alias("l"), long(F.regexp_count(t, F.lit(SYMBOLS)), "n_symbols"),
                    long(F.regexp_count(t, F.lit("[A-Z]")), "n_capitals"), long(F.regexp_count(t, F.lit("[.!?]")), "n_ends"))


_PLACE = {"n_words": "w", "word_chars": "w", "n_repeat_words": "w", "n_distinct": "w", "n_lines": "l", "n_dup_lines": "l"}
BASE_FAILED = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words"


def _once(value: Column) -> Column:
    """``value`` as a generated column: neither projections nor filters repeat its expression."""
    return F.explode(F.array(value)).alias("counts")


def _counted(rows: DataFrame) -> DataFrame:
    """``rows`` with its struct ``counts`` laid out beside the other columns."""
    flat = [F.col(f"counts.{_PLACE[c]}.{c}" if c in _PLACE else f"counts.{c}").alias(c) for c in COUNTS]
    return rows.select(*[c for c in rows.columns if c != "counts"], *flat).withColumn("base_failed", F.expr(BASE_FAILED))


def vote(rule: tuple[str, str]) -> Column:
    good, bad = rule
    return F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0).cast("tinyint")


@dataclass(frozen=True)
class Trust:
    """What EM found: the share of good documents and, per rule, the accuracy on good and on bad ones."""
    prior: float
    good: tuple[float, ...]
    bad: tuple[float, ...]

    def log_odds(self, votes: list[Column]) -> Column:
        out = F.lit(math.log(self.prior / (1 - self.prior)))
        for v, g, b in zip(votes, self.good, self.bad):
            out = out + F.when(v == 1, math.log(g / (1 - b))).when(v == -1, math.log((1 - g) / b)).otherwise(0.0)
        return out


def _within(x: Column, bounds: tuple[float, float]) -> Column:
    return F.least(F.lit(bounds[1]), F.greatest(F.lit(bounds[0]), x))


def _log_odds(state: Column, votes: Column, k: int) -> Column:
    def add(total: Column, i: Column) -> Column:
        good, bad, v = F.get(state["good"], i), F.get(state["bad"], i), F.get(votes, i)
        return total + F.when(v == 1, F.log(good / (1 - bad))).when(v == -1, F.log((1 - good) / bad)).otherwise(0.0)
    return F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), F.log(state["prior"] / (1 - state["prior"])), add)


def estimate(patterns: DataFrame, votes: list[str], iterations: int = ITERATIONS) -> Trust:
    """EM over (votes..., n) rows, one row per vote pattern.

    There are at most 3 ** rules of them, so they are one array, in order (the sums are
    repeatable); all rounds are one expression over it."""
    k = len(votes)

    def total(weighted: Column, share: Callable[[Column], Column]) -> Column:
        return F.aggregate(weighted, F.lit(0.0), lambda a, w: a + share(w))

    def round_of(state: Column, patterns: Column) -> Column:
        weighed = F.transform(patterns, lambda p: F.struct(
            p["votes"].alias("votes"), p["n"].alias("n"),
            (p["n"] / (F.lit(1.0) + F.exp(-_log_odds(state, p["votes"], k)))).alias("good")))

        def rate(w: Column, i: Column, sign: int) -> Column:
            share = (lambda x: x["good"]) if sign == 1 else (lambda x: x["n"] - x["good"])
            right = total(w, lambda x: F.when(F.get(x["votes"], i) == sign, share(x)).otherwise(0.0))
            spoke = total(w, lambda x: F.when(F.get(x["votes"], i) != 0, share(x)).otherwise(0.0))
            return _within((right + 1) / (spoke + 2), ACCURACY)

        rules = F.sequence(F.lit(0), F.lit(k - 1))
        return _let(weighed, lambda w: F.struct(
            _within((total(w, lambda x: x["good"]) + 1) / (total(w, lambda x: x["n"]) + 2), PRIOR).alias("prior"),
            F.transform(rules, lambda i: rate(w, i, 1)).alias("good"),
            F.transform(rules, lambda i: rate(w, i, -1)).alias("bad")))

    start = F.struct(F.lit(START_PRIOR).alias("prior"), F.array_repeat(F.lit(START_ACCURACY), k).alias("good"),
                     F.array_repeat(F.lit(START_ACCURACY), k).alias("bad"))
    packed_votes = F.struct(F.array(*votes).alias("votes"), F.col("n").cast("double").alias("n"))
    all_patterns = patterns.agg(F.sort_array(F.collect_list(packed_votes)).alias("patterns"))
    found = all_patterns.select(F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start,
                                            lambda s, _: round_of(s, F.col("patterns"))).alias("t")).first().t
    return Trust(found.prior, tuple(found.good), tuple(found.bad))


def _votes(rows: DataFrame, rules: dict[str, tuple[str, str]]) -> tuple[DataFrame, list[str]]:
    names = [f"vote_{i}" for i in range(len(rules))]
    return rows.withColumns({n: vote(r) for n, r in zip(names, rules.values())}), names


def learn(counted: DataFrame, rules: dict[str, tuple[str, str]] = RULES) -> Trust:
    """Fits the model to the vote patterns of all rows that pass the base test."""
    voted, names = _votes(counted.filter("NOT base_failed"), rules)
    return estimate(written(voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "quality-patterns"), names)


def quality(docs: DataFrame, rules: dict[str, tuple[str, str]] = RULES) -> DataFrame:
    """doc_id, the counts, base_failed, posterior (of being good) and kept: one row per row of ``docs``."""
    rows = written(_counted(docs.select("doc_id", _once(counts(F.col("text"))))), "quality-counts")
    trust = learn(rows, rules)
    voted, names = _votes(rows, rules)
    odds = trust.log_odds([F.col(n) for n in names])
    return voted.withColumn("posterior", F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))).withColumn(
        "kept", ~F.col("base_failed") & (odds >= 0)).drop(*names)


def filter_quality(docs: DataFrame, rules: dict[str, tuple[str, str]] = RULES) -> DataFrame:
    """The rows that stay, with all their columns; texts are read again instead of being shuffled."""
    trust = learn(written(_counted(docs.select(_once(counts(F.col("text"))))), "quality-counts"), rules)
    voted, names = _votes(_counted(packed(docs, text=F.col("text")).select("_row", _once(counts(F.col("text"))))), rules)
    return unpacked(voted.filter(~F.col("base_failed") & (trust.log_odds([F.col(n) for n in names]) >= 0)))
