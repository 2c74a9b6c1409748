"""URL rules found by their rarest literal token.

A rule is a regular expression with the literal tokens that every matching URL has to contain. Each rule is filed
under the one of its tokens that the fewest URLs carry; the tokens of a URL fetch the rules filed there, and
only those run their expression. A rule without a token is filed under the empty token, which every URL carries.

Verdicts depend on the URL alone, so distinct URLs are judged and the verdict is joined back: copies of a URL cost
nothing, and the join can split a URL that fills a third of the table. A URL without ``://``, and null, has an empty
host and path; such rows fit no host rule. Ids may be null or repeated.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.native import ascii_lower
from starloom.llm.tables import materialise, temporary


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A to Z in lower case, and path of a URL; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    no_tail = F.regexp_extract(rest, r"(?s)^[^?#]*", 0)
    host = F.regexp_extract(no_tail, r"(?s)^[^/]*", 0)
    path = F.substring(no_tail, F.length(host) + 1, F.length(no_tail))
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def tokens_of(target: Column) -> Column:
    """The distinct runs of letters and digits, and the empty token."""
    return F.array_distinct(F.split(target, "[^A-Za-z0-9]+"))


def host_rule(verdict: str, host: str, path: str) -> tuple[str, str, str, list[str], int]:
    """A rule for a host and its subdomains, for paths that start with ``path``.

    The last token of the path may go on in the URL, so it is no literal token unless a separator ends it.
    """
    whole = re.findall(r"[A-Za-z0-9]+(?![A-Za-z0-9]|$)", host + path)
    pattern = f"^(?:[^/]*\\.)?{re.escape(host + path)}"
    return host + path, verdict, pattern, whole, len(host + path)


def word_rule(verdict: str, word: str) -> tuple[str, str, str, list[str], int]:
    """A rule for URLs with this word, between any separators, in host or path."""
    return word, verdict, f"(?:^|[^A-Za-z0-9]){re.escape(word)}(?:[^A-Za-z0-9]|$)", re.findall("[A-Za-z0-9]+", word), 0


def rule_table(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    """The rules as a relation that Spark knows to be small."""
    kinds = ("string", "string", "string", "array<string>", "int")
    names = ("rule", "verdict", "pattern", "tokens", "rank")
    value = lambda x: F.array(*[F.lit(y) for y in x]) if isinstance(x, list) else F.lit(x)
    rows = [F.struct(*[value(x).cast(k).alias(n) for x, k, n in zip(r, kinds, names, strict=True)]) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def index_rules(rules: DataFrame, targets: DataFrame) -> DataFrame:
    """``rules`` with the token each is filed under: the rarest in ``targets`` (a column ``target``, distinct)."""
    listed = rules.withColumn("token", F.explode(F.array_union("tokens", F.array(F.lit("")))))
    wanted = listed.select("token").distinct()
    carried = targets.select(F.explode(tokens_of(F.col("target"))).alias("token"))
    counts = carried.join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    # The empty token only where there is no other.
    rarity = F.struct(F.col("token") == "", F.coalesce(F.col("n"), F.lit(0)), F.col("token"))
    return (
        listed.join(counts, "token", "left")
        .groupBy("rule", "verdict", "pattern", "rank")
        .agg(F.min_by("token", rarity).alias("token"))
    )


def first_rules(targets: DataFrame, rules: DataFrame) -> DataFrame:
    """For each distinct ``target`` that a rule fits: rule and verdict of the highest rank, the smaller name in a tie."""
    index = materialise(index_rules(rules, targets), "rules")
    asked = targets.select("target", F.explode(tokens_of(F.col("target"))).alias("token"))
    fits = asked.join(index, "token").filter(F.expr("target rlike pattern"))
    best = F.struct(-F.col("rank"), F.col("rule"), F.col("verdict"))
    return fits.groupBy("target").agg(F.min(best).alias("best")).select("target", "best.rule", "best.verdict")


# The method's own rules for URLs that no host rule fits: words of sites that hold no text worth keeping.
JUNK_WORDS = ["spam", "spam-farm", "casino", "porn", "xxx", "viagra", "lottery", "phishing", "malware", "warez"]


def judge_urls(pages: DataFrame, rules: list[tuple], url: str = "url", words: list[str] | None = None) -> DataFrame:
    """``pages`` as a struct ``row``, with ``host``, ``path``, the fitting ``rule`` or null, and the ``verdict``.

    Host rules come first, the longest wins; without one, the words decide: block if one occurs, else allow.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(f"`{url}`"))
    split = pages.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))
    split = split.withColumn("target", F.concat("host", "path"))
    junk = [word_rule("block", w) for w in (JUNK_WORDS if words is None else words)]
    with temporary(spark):
        targets = materialise(split.select("target").distinct(), "targets")
        ruled = first_rules(targets, rule_table(spark, rules))
        by_word = first_rules(targets, rule_table(spark, junk)).select("target", F.col("verdict").alias("by_word"))
        verdicts = materialise(ruled.join(by_word, "target", "full"), "verdicts", lasting=True)
    verdict = F.coalesce("verdict", "by_word", F.lit("allow"))
    return split.join(verdicts, "target", "left").select("row", "host", "path", "rule", verdict.alias("verdict"))
