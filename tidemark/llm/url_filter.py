"""URL rules, found through the rarest word that a matching URL must hold.

Every rule names its literal tokens: runs of letters and digits that stand as
whole tokens in each URL it matches. How often these occur is counted over all
URLs, and a rule is indexed by its rarest one. A URL fetches the rules of its
tokens, and only those run their regular expression. DataFrame functions only.
"""

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALLOW = "allow"
BLOCK = "block"
TOKEN = "[A-Za-z0-9]+"
LISTED = 1
PATTERN = 0


@dataclass(frozen=True)
class UrlRule:
    """A regular expression over host and path, with the tokens it needs.

    ``tier`` ranks listed rules over patterns; within a tier the longest name wins.
    """

    name: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    tier: int = PATTERN


def listed(host: str, path: str, verdict: str) -> UrlRule:
    """A rule for a host with its subdomains and for paths that start with ``path``.

    The last token of a path that does not end in a separator may go on in the URL,
    so it is no literal.
    """
    tokens = re.findall(TOKEN, host) + re.findall(f"{TOKEN}(?![A-Za-z0-9])(?!$)", path)
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    return UrlRule(host + path, verdict, pattern, tuple(tokens), LISTED)


def in_host(word: str) -> UrlRule:
    """Block hosts that hold a word between separators."""
    return UrlRule(f"*{word}*", BLOCK, rf"^(?:[^/]*[.-])?{word}(?:[.-][^/]*)?(?:/|$)", (word,))


def host_of(url: Column) -> Column:
    """What follows the first ``://``, A-Z lower-cased; empty without one."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(
        F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")
    )


def path_of(url: Column) -> Column:
    """What follows the host up to a query or fragment."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(address: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(address), F.lit(f"({TOKEN})")))


def index_rules(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Each rule with its rarest literal as ``token``; ties go to the first by name."""
    literals = rules.select("*", F.explode("literals").alias("token"))
    counts = (
        tokens.join(literals.select("token").distinct(), "token", "left_semi")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("seen"))
    )
    rarest = Window.partitionBy("tier", "name", "pattern").orderBy("seen", "token")
    return (
        literals.join(counts, "token", "left")
        .withColumn("seen", F.coalesce("seen", F.lit(0)))
        .withColumn("_rank", F.row_number().over(rarest))
        .filter("_rank = 1")
        .select("name", "verdict", "pattern", "tier", "token")
    )


def filter_urls(
    pages: DataFrame, rules: Sequence[UrlRule], keep: Sequence[str] = ("page_id",)
) -> DataFrame:
    """The columns ``keep`` with host, path, the listed rule that fits, and a verdict.

    A listed rule decides before any pattern; a URL that nothing fits is allowed.
    ``matched`` names the rule that decided, listed or not. A null URL, or one
    without ``://``, has empty host and path and is allowed. Repeated rows come out
    as often as they go in. Each distinct URL is judged once, so a URL that a third
    of all rows share costs one judgement; joining it back is a plain equality join,
    whose skewed partitions Spark splits.
    """
    for rule in rules:
        if not rule.literals:
            raise ValueError(f"rule {rule.name} has no literal token to index it by")
    spark = pages.sparkSession
    table = spark.createDataFrame(
        [(r.name, r.verdict, r.pattern, r.tier, [x.lower() for x in r.literals]) for r in rules],
        "name string, verdict string, pattern string, tier int, literals array<string>",
    )
    address = F.concat(host_of(F.col("url")), path_of(F.col("url")))
    urls = pages.select("url").filter("url IS NOT NULL").distinct()
    tokens = urls.select("url", address.alias("address")).select(
        "url", "address", F.explode(tokens_of(F.col("address"))).alias("token")
    )
    candidates = tokens.join(index_rules(table, tokens), "token")
    judged = (
        candidates.filter("address RLIKE pattern")
        .groupBy("url")
        .agg(
            F.max(
                F.struct("tier", F.length("name").alias("length"), "name", "verdict")
            ).alias("_best")
        )
        .withColumnRenamed("url", "_url")
    )
    # "_0" and so on: kept columns may have any name, so results take theirs last.
    kept = [F.col(c).alias(f"_{i}") for i, c in enumerate(keep)]
    found = pages.select(*kept, F.col("url").alias("_page_url")).join(
        judged, F.col("_page_url") == F.col("_url"), "left"
    )
    best = F.col("_best")
    return found.select(
        *(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)),
        host_of(F.col("_page_url")).alias("host"),
        path_of(F.col("_page_url")).alias("path"),
        F.when(best["tier"] == LISTED, best["name"]).alias("rule"),
        F.coalesce(best["verdict"], F.lit(ALLOW)).alias("verdict"),
        best["name"].alias("matched"),
    )
