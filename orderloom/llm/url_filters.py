"""URL filters: pattern rules indexed by their rarest literal token.

A rule is (rule, pattern, action, priority, literals): a regular expression over the normalised
URL `host + path`, and the lower-case tokens that every URL it matches must hold. Each rule is
indexed under the one of its literals that the URLs hold least often. The tokens of a URL fetch
candidate rules by an equi-join, and only those candidates run their regular expression. The
highest priority wins, ties go to the smaller rule text.

Defined results: a null URL, or one without "://", has an empty host and path, and no rule but
a pattern that needs no literal could fit it; a rule without literals is refused (ValueError
where it is built). Repeated rows each get the verdict. Extra columns are kept; an empty table
gives an empty one. A URL of any length is tokenised whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import small, table

RULES = "rule string, pattern string, action string, priority int, literals array<string>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the contract (action, host and path).
HOST_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]
# Host words of link farms, each a rule of the method itself.
SPAM_WORDS = ["casino", "bets", "pills", "viagra", "poker", "jackpot", "lottery"]


def url_host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(text: Column) -> Column:
    return F.array_distinct(
        F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit("([a-z0-9]+)"))
    )


def host_rule(action: str, rule: str) -> tuple:
    """A host with all its subdomains and a path prefix; the longest such rule wins."""
    host, slash, path = rule.partition("/")
    literals = re.findall("[a-z0-9]+", host)
    if not literals:
        raise ValueError(f"rule without a literal token: {rule!r}")
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}"
    return rule, pattern, action, len(rule), literals


def word_rule(word: str) -> tuple:
    """Blocks hosts that hold the word as a token of its own."""
    return f"~{word}", rf"^(?:[^/]*[^a-z0-9/])?{word}(?:[^a-z0-9]|$)", "block", 0, [word]


def rule_index(rules: DataFrame, url_tokens: DataFrame) -> DataFrame:
    """Each rule under its rarest literal. `url_tokens`: one token a row."""
    literals = rules.select("rule", F.explode("literals").alias("token"))
    seen = (
        url_tokens.join(literals.select("token").distinct(), "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("seen"))
    )
    rarest = (
        literals.join(seen, "token", "left")
        .groupBy("rule")
        .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "token")).alias("best"))
    )
    return rules.join(rarest, "rule").select(
        F.col("best.token").alias("token"), "rule", "pattern", "action", "priority"
    )


def judge(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """`pages` with host, path, rule (null if none fits) and action (null if none fits)."""
    parts = {"host": url_host(F.col(url)), "path": url_path(F.col(url))}
    seen = pages.select(F.col(url).alias("_url")).where("_url IS NOT NULL").distinct()
    held = seen.select(
        "_url",
        F.concat(url_host(F.col("_url")), url_path(F.col("_url"))).alias("_target"),
    )
    words = held.select("_url", "_target", F.explode(tokens(F.col("_target"))).alias("token"))
    index = rule_index(small(rules), words.select("token"))
    fits = words.join(index, "token").where(F.expr("rlike(_target, pattern)"))
    best = fits.groupBy("_url").agg(
        F.min(F.struct((-F.col("priority")).alias("p"), "rule", "action")).alias("_best")
    )
    return (
        pages.drop("host", "path", "rule", "action")
        .withColumns(parts)
        .join(best, F.col(url) == F.col("_url"), "left")
        .withColumns({"rule": F.col("_best.rule"), "action": F.col("_best.action")})
        .drop("_url", "_best")
    )


def default_rules(spark: SparkSession) -> DataFrame:
    rows = [host_rule(a, r) for a, r in HOST_RULES] + [word_rule(w) for w in SPAM_WORDS]
    return spark.createDataFrame(rows, RULES)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge(pages, default_rules(spark))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.when(~F.col("rule").startswith("~"), F.col("rule")).alias("rule"),
        F.coalesce("action", F.lit("allow")).alias("verdict"),
    )


OP5_SQL = r"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
named AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%'
      THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%'
      THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host,
      '(^|[^a-z0-9])(casino|bets|pills|viagra|poker|jackpot|lottery)([^a-z0-9]|$)') THEN 'block'
    ELSE 'allow' END AS verdict
FROM named
"""
