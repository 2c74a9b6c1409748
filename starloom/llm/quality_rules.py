"""Weak supervision over quality rules: rules vote or abstain, and expectation-maximisation weighs them.

Each rule looks at one statistic of a text and praises, blames, blames clearly, or says nothing. What a vote is worth is not
known; it is estimated from how the rules agree over the whole table. Texts are good or of one of several kinds of bad, and
each class has its own shares of votes for every rule. The classes are what makes rules depend on each other: rules on the same
trouble agree on texts of its class, so that two of them count for more than one, and rules on other troubles are a
little worse there than on good texts. A text is kept if the posterior probability of the good class is at least one half: a
single weak blame is outvoted by praise, a clear one or two together are not, as far as the table bears that out. A
trouble that the table hardly shows keeps what its rules begin with, whose weight grows with the table.

Spark counts the patterns of votes, which are bounded by the number of rules; the estimate works on these counts alone.

Null and empty texts have no words: all rules abstain, and the base rejects them. Null ids, repeated
rows and further columns pass through unchanged. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.native import covered, gram_hashes, let, words_of
from starloom.llm.tables import materialise, temporary

WINDOW = 5


def repeated_words(words: Column, k: int = WINDOW) -> Column:
    """Words in windows of ``k`` words that occur twice or more in the text.

    Most texts repeat no window, which a distinct count tells. For the others the windows are sorted by hash
    with their place, so that equal ones become neighbours: no step grows with the square of the text.
    """

    def places(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("p"))))
        twice = let(
            ordered,
            lambda s: F.filter(
                s,
                lambda x, i: x["g"].eqNullSafe(F.get(s, i - 1)["g"]) | x["g"].eqNullSafe(F.get(s, i + 1)["g"]),
            ),
        )
        return F.sort_array(F.transform(twice, lambda x: x["p"]))

    def count(grams: Column) -> Column:
        repeats = F.size(F.array_distinct(grams)) < F.size(grams)
        return F.when(repeats, covered(places(grams), k)).otherwise(F.lit(0).cast("long"))

    return let(gram_hashes(F.transform(words, lambda w: F.xxhash64(w)), k), count)


def statistics(text: Column) -> Column:
    """A struct of what the rules look at. Everything is counted over the whole text."""
    held = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(held, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(held, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.regexp_count(held, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
            F.regexp_count(held, F.lit("!")).cast("long").alias("n_exclamations"),
            F.regexp_count(held, F.lit(r"[\p{L}\p{M}]")).cast("long").alias("n_letters"),
            F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))).cast("long").alias("n_doubled_words"),
        )

    return let(words_of(held), of_words)


PRAISE, BLAME, CLEAR = 1, 0, -1  # votes; null abstains


@dataclass(frozen=True)
class Rule:
    """Blames clearly if ``clear`` holds, else blames if ``bad`` holds, else praises if ``good`` holds, else abstains; a
    condition on something null does not hold."""

    name: str
    clear: Column
    bad: Column
    good: Column

    def vote(self) -> Column:
        return F.when(self.clear, F.lit(CLEAR)).when(self.bad, F.lit(BLAME)).when(self.good, F.lit(PRAISE))


def default_rules(stats: str = "stats") -> list[Rule]:
    """Rules on the statistics in the struct column ``stats``; each can blame texts that pass the base."""
    s = lambda name: F.col(f"{stats}.{name}")
    per_word = lambda name: s(name) / F.nullif(s("n_words"), F.lit(0))
    per_line = lambda name: s(name) / F.nullif(s("n_lines"), F.lit(0))
    per_char = lambda c: c / F.nullif(s("word_chars"), F.lit(0))
    some, many = s("n_words") >= 10, s("n_words") >= 50
    high = lambda name, c, clear, bad, good, where=some: Rule(name, where & (c >= clear), where & (c >= bad), where & (c <= good))
    low = lambda name, c, clear, bad, good, where=some: high(name, -c, -clear, -bad, -good, where)
    letters, length = per_char(s("n_letters")), per_word("word_chars")
    return [
        high("symbols", per_word("n_symbols"), 0.3, 0.05, 0.0),
        low("letters", letters, 0.7, 0.9, 0.94),
        high("duplicate_lines", per_line("n_dup_lines"), 0.4, 0.2, 0.05, s("n_lines") >= 2),
        high("repeats", per_word("n_repeat_words"), 0.17, 0.12, 0.05),
        low("variety", per_word("n_distinct_words"), 0.25, 0.5, 0.6, many),
        high("doubled_words", per_word("n_doubled_words"), 0.15, 0.04, 0.02),
        high("capitals", per_char(s("n_capitals")), 0.25, 0.05, 0.03),
        high("exclamations", per_word("n_exclamations"), 0.3, 0.05, 0.0),
        Rule("word_length", some & ~length.between(2.5, 10), some & ~length.between(3.8, 7.2), length.between(4.2, 6.5)),
    ]


# Which rules look for the same trouble, each on another statistic.
KINDS = {
    "symbols": ("symbols", "letters"),
    "repetition": ("duplicate_lines", "repeats"),
    "variety": ("variety", "doubled_words"),
    "shouting": ("capitals", "exclamations"),
    "words": ("word_length", "letters"),
}
GOOD = "good"

# Where the estimates begin: the share of good texts, and how often a vote is praise, blame or clear blame on a good text, on one
# in whose kind of trouble the rule is, and on one in other trouble, which tends to be less neat than a good one.
START_GOOD = 0.7
START = {"good": (0.965, 0.034, 0.001), "own": (0.3, 0.35, 0.35), "other": (0.95, 0.042, 0.008)}
# What these beginnings are worth, as shares of the rows: how often good texts are blamed, and the classes' sizes, are hard to tell
# from blame that nothing corroborates; what the rules do in a class of bad texts is not.
SIZES_WORTH, GOOD_WORTH, BAD_WORTH, PSEUDO = 1.0, 0.3, 0.02, 10.0


@dataclass(frozen=True)
class VoteModel:
    """The share of each class of texts, and for each class and rule how often a vote is praise, blame or clear blame."""

    shares: dict[str, float]
    votes: dict[str, dict[str, tuple[float, float, float]]]

    def posterior(self) -> Column:
        """Probability that a row with vote columns of these names is good. Abstaining says nothing."""
        logs = []
        for name, share in self.shares.items():
            log = F.lit(math.log(share))
            for rule, odds in self.votes[name].items():
                vote = F.col(rule)
                told = F.when(vote == PRAISE, math.log(odds[0])).when(vote == BLAME, math.log(odds[1])).when(vote == CLEAR, math.log(odds[2]))
                log = log + F.coalesce(told, F.lit(0.0))
            logs.append(log)
        good = list(self.shares).index(GOOD)
        total = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.exp(F.least(x - a[good], F.lit(700.0))))
        return let(F.array(*logs), lambda a: 1 / total(a))


def begin(names: list[str], kinds: dict[str, tuple[str, ...]]) -> VoteModel:
    """The model before any row is seen."""
    shares = {GOOD: START_GOOD} | dict.fromkeys(kinds, (1 - START_GOOD) / max(len(kinds), 1))
    votes = {GOOD: dict.fromkeys(names, START["good"])}
    votes |= {kind: {n: START["own" if n in members else "other"] for n in names} for kind, members in kinds.items()}
    return VoteModel(shares, votes)


def estimate(patterns: np.ndarray, counts: np.ndarray, names: list[str], kinds: dict[str, tuple[str, ...]], rounds: int = 200) -> VoteModel:
    """Expectation-maximisation from rows of votes (one column per name, 2 for abstaining) and how often each occurs."""
    first = begin(names, kinds)
    classes = list(first.shares)
    share = share0 = np.array([first.shares[c] for c in classes])
    table = table0 = np.array([[first.votes[c][n] for n in names] for c in classes])  # class, rule, vote
    cast = np.stack([patterns == v for v in (PRAISE, BLAME, CLEAR)], 2).astype(float)  # pattern, rule, vote
    total = counts.sum()
    if not total:
        return first
    worth = np.array([max(PSEUDO, (GOOD_WORTH if c == GOOD else BAD_WORTH) * total) for c in classes])[:, None, None]
    for _ in range(rounds):
        log = np.log(share) + np.einsum("prv,crv->pc", cast, np.log(table))
        belongs = np.exp(log - log.max(1, keepdims=True))
        belongs *= (counts / belongs.sum(1))[:, None]
        new_share = (belongs.sum(0) + SIZES_WORTH * total * share0) / (total * (1 + SIZES_WORTH))
        seen = np.einsum("pc,prv->crv", belongs, cast)
        new_table = (seen + worth * table0) / (seen.sum(2, keepdims=True) + worth)
        moved = max(np.abs(new_share - share).max(), np.abs(new_table - table).max())
        share, table = new_share, new_table
        if moved < 1e-7:
            break
    votes = {c: {n: tuple(map(float, table[i, j])) for j, n in enumerate(names)} for i, c in enumerate(classes)}
    return VoteModel(dict(zip(classes, map(float, share), strict=True)), votes)


def fit(votes: DataFrame, names: list[str], kinds: dict[str, tuple[str, ...]] | None = None) -> VoteModel:
    """Estimates from the vote columns ``names``; ``kinds`` names the classes of bad texts, one if not given.

    Spark counts the patterns of votes, in one aggregate. They are at most 4 to the power of the number of rules, whatever the
    size of the table, and only they come to the driver, where the rounds are small matrix products.
    """
    found = votes.groupBy(*names).agg(F.count(F.lit(1)).alias("rows")).collect()
    found.sort(key=lambda r: [(x is None, x) for x in r])  # sums do not depend on the order of tasks
    patterns = np.array([[2 if r[n] is None else r[n] for n in names] for r in found], int).reshape(len(found), len(names))
    return estimate(patterns, np.array([r["rows"] for r in found], float), names, kinds or {"bad": tuple(names)})


def _voted(counted: DataFrame) -> DataFrame:
    return counted.select("row", "stats", *[r.vote().alias(r.name) for r in default_rules()])


def _judged(voted: DataFrame, model: VoteModel, threshold: float) -> DataFrame:
    quality = model.posterior()
    votes = F.struct(*model.votes[GOOD]).alias("votes")
    return voted.select("row", "stats", votes, quality.alias("quality")).withColumn("good", F.col("quality") >= threshold)


def _counted(docs: DataFrame, text: str, columns: list[str]) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    # Exploded, so that Spark counts once and does not put the counting in place of every use of a statistic.
    return docs.select(row, F.explode(F.array(statistics(F.col(f"`{text}`")))).alias("stats"))


def judge(docs: DataFrame, text: str = "text", keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """``docs`` as a struct ``row`` (of the columns ``keep``, default all), with ``stats``, ``votes``,
    ``quality`` (the posterior) and ``good`` (whether that reaches ``threshold``).

    Texts are counted once; what follows reads the written counts. The votes' worth is estimated on the texts that pass the
    base, as the others are out in any case and would stand for all that is bad.
    """
    counted = _counted(docs, text, docs.columns if keep is None else keep)
    voted = _voted(materialise(counted, "rules"))
    return _judged(voted, fit(voted.filter(~base_failed()), [r.name for r in default_rules()], KINDS), threshold)


def base_failed(stats: str = "stats") -> Column:
    """Too short, or more than a fifth of the words in repeated windows."""
    n, repeats = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < 10) | (100 * repeats > 20 * n)


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that pass the base and the vote, with their columns.

    Nothing is written out to fit the model; counting the texts again costs less than writing them.
    """
    rules = default_rules()
    counted = _counted(docs, text, docs.columns)
    with temporary(docs.sparkSession):
        votes = counted.filter(~base_failed()).select(*[r.vote().alias(r.name) for r in rules])
        model = fit(votes, [r.name for r in rules], KINDS)
    judged = _judged(_voted(counted), model, threshold)
    return judged.filter(~base_failed() & F.col("good")).select("row.*")
