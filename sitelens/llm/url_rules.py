"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` together with literal
tokens (runs of ``a-z0-9``) that every match must contain as whole tokens.
Each rule is filed under the one of its tokens that is rarest in the URLs at
hand; a URL's tokens fetch the rules filed under them, and only those run
their regular expression. All of it is DataFrame functions. Rules come as
``Rule`` objects or as a table of any size (columns of ``RULE_COLUMNS``, say
from ``site_rules`` over a table of host/path texts). Rules without a token meet
every URL; they are copied to ``SALTS`` keys, one of which each URL has.

Only A-Z are lower-cased, in tokens as in hosts, and only a-z and 0-9 make
tokens and words of hosts; any other character ends them.

Defined cases: a null URL or one without ``://`` has an empty host and path
and gets the default verdict; of several fitting host/path rules the longest
wins, of equally long ones the greatest by code point; a host/path rule goes
before a pattern rule, of several fitting pattern rules the one with the
smallest name counts. An empty table gives an empty result. Other columns
stay out; rows are repeated as they come.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed values: (host and path, verdict) of the host/path rules, and words of
# hosts that the pattern rules block when no host/path rule fits.
SITE_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
BLOCKED_HOST_WORDS = ["ads", "casino", "lottery", "pills", "porn", "spam", "viagra", "warez", "xxx"]


RULE_COLUMNS = ("rule_name", "regex", "rule_verdict", "weight", "tokens")
SALTS = 64


@dataclass(frozen=True)
class Rule:
    """``tokens`` may be empty: such a rule is tried on every URL."""

    name: str
    regex: str
    verdict: str
    tokens: tuple[str, ...]
    weight: int  # length of a host/path rule; 0 for a pattern rule


def site_rule(text: str, verdict: str) -> Rule:
    """Fits the host and all its subdomains if the path starts with the rule's."""
    host, slash, rest = text.partition("/")
    host = host.translate(str.maketrans(UPPER, LOWER))
    whole = host + slash + rest
    # The last run of letters and digits may go on in the URL; others are whole tokens.
    tokens = re.findall(r"[a-z0-9]+(?=[^a-z0-9])" if slash else r"[a-z0-9]+", whole.translate(str.maketrans(UPPER, LOWER)))
    quoted = r"\Q" + whole.replace(r"\E", r"\E\\E\Q") + r"\E"  # a quote that the text itself ends goes on after it
    return Rule(text, r"^(?:[^/]*\.)?" + quoted + ("" if slash else "(?:/|$)"), verdict, tuple(tokens), len(text))


def host_word_rule(word: str) -> Rule:
    return Rule(f"host-word:{word}", rf"^(?:[^/]*[^/a-z0-9])?{word}(?:[^a-z0-9/][^/]*)?(?:/|$)", "block", (word,), 0)


def default_rules() -> list[Rule]:
    return [site_rule(t, v) for t, v in SITE_RULES] + [host_word_rule(w) for w in BLOCKED_HOST_WORDS]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column."""
    found = F.coalesce(F.instr(url, "://"), F.lit(0)) > 0
    rest = F.when(found, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules as rows, made of literals (no Python worker)."""
    rows = [F.struct(F.lit(r.name).alias("rule_name"), F.lit(r.regex).alias("regex"), F.lit(r.verdict).alias("rule_verdict"),
                     F.lit(r.weight).alias("weight"), F.array(*[F.lit(t) for t in r.tokens]).cast("array<string>").alias("tokens"))
            for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def site_rules(table: DataFrame, text_col: str = "rule", verdict_col: str = "verdict") -> DataFrame:
    """The rules of a table of host/path texts and verdicts, as ``site_rule`` makes them; null and empty texts are no
    rules, a repeated text counts once, with its greatest verdict."""
    table = table.filter(F.col(text_col) != "").groupBy(F.col(text_col).alias("rule_name")).agg(F.max(verdict_col).alias("rule_verdict"))
    host = F.substring_index("rule_name", "/", 1)
    slash = F.instr("rule_name", "/") > 0
    whole = F.concat(F.translate(host, UPPER, LOWER), F.substr("rule_name", F.length(host) + 1))
    lower = F.translate(whole, UPPER, LOWER)
    quoted = F.concat(F.lit("\\Q"), F.replace(whole, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    return table.select(
        "rule_name", F.concat(F.lit(r"^(?:[^/]*\.)?"), quoted, F.when(slash, "").otherwise("(?:/|$)")).alias("regex"), "rule_verdict",
        F.length("rule_name").alias("weight"),
        F.when(slash, F.regexp_extract_all(lower, F.lit("([a-z0-9]+)(?=[^a-z0-9])"))).otherwise(
            F.regexp_extract_all(lower, F.lit("([a-z0-9]+)"))).alias("tokens"))


def rule_index(rules: DataFrame, token_counts: DataFrame) -> DataFrame:
    """Each rule once, with the rarest of its tokens as ``token`` (ties: the
    smallest; no token: the empty one)."""
    tokens = rules.select("rule_name", F.explode("tokens").alias("token")).distinct()
    ranked = (tokens.join(token_counts, "token", "left")
              .groupBy("rule_name").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rarest")))
    return (rules.join(ranked, "rule_name", "left")
            .select("rule_name", "regex", "rule_verdict", "weight", F.coalesce("rarest.token", F.lit("")).alias("token")))


def judge_urls(pages: DataFrame, rules: Sequence[Rule] | DataFrame | None = None, default: str = "allow",
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, pattern.

    Verdicts are found for distinct (host, path) pairs, so a page that is
    linked a million times is judged once; the answer is joined back.
    """
    rules = default_rules() if rules is None else rules
    host, path = url_parts(F.col(url_col))
    judged = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    if not isinstance(rules, DataFrame) and not rules:
        return judged.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"),
                             F.lit(None).cast("string").alias("pattern"))
    places = judged.select("host", "path").distinct()
    token = F.explode(F.array_distinct(F.split(F.translate(F.concat("host", "path"), UPPER, LOWER), "[^a-z0-9]+")))
    tokens = places.select("host", "path", token.alias("token"))
    book = rules.select(*RULE_COLUMNS) if isinstance(rules, DataFrame) else rule_table(pages.sparkSession, rules)
    wanted = book.select(F.explode("tokens").alias("token")).distinct()
    counts = tokens.join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    index = rule_index(book, counts)
    # The key of rules without a token is "/" and a number, which no token is.
    salts = F.when(F.col("token") != "", F.array("token")).otherwise(F.array(*[F.lit(f"/{i}") for i in range(SALTS)]))
    index = index.withColumn("token", F.explode(salts))
    salted = places.withColumn("token", F.concat(F.lit("/"), F.pmod(F.xxhash64("host", "path"), F.lit(SALTS))))
    fetched = (tokens.filter("token != ''").unionByName(salted)
               .join(index, "token").filter(F.expr("rlike(concat(host, path), regex)")))
    best = fetched.groupBy("host", "path").agg(
        F.max(F.when(F.col("weight") > 0, F.struct("weight", "rule_name", "rule_verdict"))).alias("site"),
        F.min(F.when(F.col("weight") == 0, F.struct("rule_name", "rule_verdict"))).alias("general"))
    return (judged.join(best, ["host", "path"], "left")
            .select(F.col(id_col), "host", "path", F.col("site.rule_name").alias("rule"),
                    F.coalesce("site.rule_verdict", "general.rule_verdict", F.lit(default)).alias("verdict"),
                    F.col("general.rule_name").alias("pattern")))
