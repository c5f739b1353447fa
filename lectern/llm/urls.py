"""URL filter rules, found through their rarest literal token.

A rule is a regular expression over ``host + path`` with the literal tokens that any URL it matches must hold. It is filed under
that of its tokens which the fewest URLs hold. The tokens of a URL fetch the rules filed under them, and only these are
run. Everything is DataFrame operations; a URL is judged once however many pages share it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.llm.common import prepare

TOKEN = r"[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """rank: of the rules that match, the highest wins; ties go to the greater name."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int = 0


def host_rule(name: str, verdict: str) -> Rule:
    """A rule like ``example.net/en/``: the host and all its subdomains, for paths that start with the rest."""
    host, slash, path = name.partition("/")
    pattern = r"^(?:[^/]*\.)?" + re.escape(host.lower()) + re.escape(slash + path)
    tokens = tuple(dict.fromkeys(re.findall(TOKEN, host.lower())))  # the path's last token may go on in a URL
    return Rule(name, verdict, pattern, tokens, 1_000_000 + len(name))


def word_rule(word: str, verdict: str = "block") -> Rule:
    """A rule for hosts that have a word as one of their tokens."""
    return Rule(f"word:{word}", verdict, rf"^(?:[^/]*[^a-z0-9/])?{re.escape(word)}(?:[^a-z0-9]|$)", (word,), len(word))


def pattern_rule(name: str, verdict: str, pattern: str, tokens: Iterable[str], rank: int = 0) -> Rule:
    tokens = tuple(t.lower() for t in tokens)
    if not tokens or any(not re.fullmatch(TOKEN, t) for t in tokens):
        raise ValueError(f"rule {name}: give the literal tokens ({TOKEN}) that every match holds")
    return Rule(name, verdict, pattern, tokens, rank)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _tokens(host: Column, path: Column) -> Column:
    text = F.translate(F.concat(host, path), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({TOKEN})"), F.lit(1)))


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame(
        [(r.name, r.verdict, r.pattern, list(r.tokens), r.rank) for r in rules],
        "rule string, verdict string, pattern string, tokens array<string>, rank int")


def index_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(token, rule, verdict, pattern, rank): each rule under the token that the fewest addresses (token lists) hold."""
    spread = rules.select("rule", "verdict", "pattern", "rank", F.explode("tokens").alias("token"))
    held = addresses.select(F.explode("tokens").alias("token")).join(spread.select("token").distinct(), "token", "left_semi")
    counts = held.groupBy("token").agg(F.count("*").alias("urls"))
    filed = spread.join(counts, "token", "left").groupBy("rule", "verdict", "pattern", "rank").agg(
        F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("rarest"))
    return filed.select(F.col("rarest.token").alias("token"), "rule", "verdict", "pattern", "rank")


def judge(pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """The rows with host, path, rule and verdict in a struct column ``__judged``.

    A URL that no rule matches has a null rule and the default verdict, null URLs too. Repeated rows stay. The rules join by
    the planner's own size check; a hot token or URL is on the side that the adaptive planner splits.
    """
    spark = prepare(pages.sparkSession)
    url = F.col(url_col)
    addresses = pages.select(url.alias("__url")).where("__url is not null").distinct()
    addresses = addresses.select("__url", host_of(F.col("__url")).alias("host"), path_of(F.col("__url")).alias("path"))
    addresses = addresses.withColumn("tokens", _tokens(F.col("host"), F.col("path")))
    index = index_rules(addresses, rule_table(spark, rules))
    candidates = addresses.select("__url", "host", "path", F.explode("tokens").alias("token")).join(index, "token")
    matched = candidates.where(F.regexp_like(F.concat("host", "path"), F.col("pattern")))
    best = matched.groupBy("__url").agg(F.max(F.struct("rank", "rule", "verdict")).alias("__best"))
    joined = pages.join(best, url == F.col("__url"), "left")
    judged = F.struct(
        host_of(url).alias("host"), path_of(url).alias("path"), F.col("__best.rule").alias("rule"),
        F.coalesce(F.col("__best.verdict"), F.lit(default)).alias("verdict"))
    return joined.withColumn("__judged", judged).select(*pages.columns, "__judged")


#: The rules of the registered query: hosts first, then words of unwanted hosts.
HOST_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
WORDS = ("casino", "bets", "spam", "adult", "porn", "viagra", "poker", "warez")


def default_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + [word_rule(w) for w in WORDS]


def check_sql() -> str:
    """The same verdicts in SQL, by trying every rule on every URL."""
    hosts = ", ".join(f"('{n}', '{v}')" for n, v in HOST_RULES)
    words = "|".join(WORDS)
    return f"""
    WITH parts AS (
        SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
        FROM pages),
    rules AS (SELECT n AS rule, v AS verdict, split_part(n, '/', 1) AS h, substr(n, strpos(n, '/')) AS p FROM (VALUES {hosts}) r(n, v)),
    hits AS (
        SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
        FROM parts JOIN rules ON (host = h OR suffix(host, '.' || h)) AND prefix(path, p) GROUP BY page_id)
    SELECT parts.page_id, host, path, hits.rule,
           coalesce(hits.verdict, CASE WHEN regexp_matches(host, '(^|[^a-z0-9])({words})([^a-z0-9]|$)') THEN 'block' ELSE 'allow' END) AS verdict
    FROM parts LEFT JOIN hits USING (page_id)"""


def verdicts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of every row by the default rules; rule only where a host rule fits."""
    judged = judge(pages.select(F.col(id_col), F.col(url_col)), default_rules(), url_col)
    rule = F.col("__judged.rule")
    return judged.select(id_col, "__judged.host", "__judged.path", F.when(~rule.startswith("word:"), rule).alias("rule"), "__judged.verdict")
