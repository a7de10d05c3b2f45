"""URL filter: pattern rules found through their rarest literal token.

A rule is ``host/path``: it fits the host and all subdomains, and every path that starts with the rule's path; ``*`` stands
for any characters (in the host part, for any but ``/``). Every rule is a regular expression, which only runs on URLs that
hold the rule's rarest literal token: the tokens of the distinct URLs are joined with the rules' index, and the expression
decides for the pairs this yields. How rare a token is, is counted over all distinct URLs. A rule without a literal token
is tried on every URL.

Rules come in tiers; within the highest tier that fits, the longest rule wins (ties: block before allow, then by text).

Defined cases: a null URL, or one without ``://``, has an empty host and path, which only a rule without tokens can fit;
repeated URLs are judged once and alike; an empty table, or no rules, is fine; without a fitting rule the default holds.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.llm.frames import free_name
from sluice.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # what separates tokens


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    text: str  # host/path
    tier: int = 1

    def pattern(self) -> str:
        host, _, path = self.text.partition("/")
        host = re.escape(host.translate(str.maketrans(UPPER, LOWER))).replace(r"\*", "[^/]*")
        return rf"^([^/]*\.)?{host}/{re.escape(path).replace(r'\*', '(.|\n)*')}"

    def tokens(self) -> list[str]:
        """Literal tokens that every fitting URL holds whole: no wildcard beside them, and not at the open end of the path."""
        host, _, path = self.text.partition("/")
        found = []
        for zone, part in (("h", f".{host.translate(str.maketrans(UPPER, LOWER))}/"), ("p", f"/{path}")):
            closed = re.finditer(r"(?<=[^*0-9A-Za-z\x80-\U0010ffff])[0-9A-Za-z\x80-\U0010ffff]+(?=[^*0-9A-Za-z\x80-\U0010ffff])", part)
            found += [f"{zone}:{m[0]}" for m in closed]
        return sorted(set(found))


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.when(F.coalesce(F.contains(url, F.lit("://")), F.lit(False)), F.translate(host, UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return F.when(F.coalesce(F.contains(url, F.lit("://")), F.lit(False)), path).otherwise("")


def _tokens(zone: str, text: Column) -> Column:
    parts = F.filter(F.split(text, _BETWEEN), lambda t: t != "")
    return F.transform(parts, lambda t: F.concat(F.lit(f"{zone}:"), t))


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """(rule, action, tier, pattern, tokens) of a list of rules."""
    rows = [(r.text, r.action, r.tier, r.pattern(), r.tokens()) for r in rules]
    return spark.createDataFrame(rows, "rule string, action string, tier int, pattern string, tokens array<string>")


def rarest_token_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """``rules`` with ``token``, the one that the fewest of ``urls`` (url, token) hold; empty for a rule without tokens."""
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    counts = urls.join(wanted, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = rules.select("*", F.explode_outer("tokens").alias("token")).join(counts, "token", "left")
    rarest = F.min_by(F.coalesce("token", F.lit("")), F.struct(F.coalesce("n", F.lit(0)), "token"))
    return stage(ranked.groupBy("rule", "action", "tier", "pattern").agg(rarest.alias("token")), "rule-index")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", name: str = "judged") -> DataFrame:
    """``pages`` with a struct column: ``host``, ``path``, the deciding ``rule`` with its ``tier`` (or null) and the ``verdict``."""
    distinct = pages.select(F.coalesce(url, F.lit("")).alias("url")).distinct()
    distinct = stage(distinct.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), "urls")
    tokens = F.array_distinct(F.concat(_tokens("h", F.col("host")), _tokens("p", F.col("path")), F.array(F.lit(""))))
    tokens = distinct.select("url", F.concat("host", "path").alias("subject"), F.explode(tokens).alias("token"))
    index = rarest_token_index(rules, tokens)
    fitting = tokens.join(index, "token").filter(F.expr("subject rlike pattern"))
    order = F.struct("tier", F.length("rule").alias("length"), (F.col("action") == "block").alias("blocks"), "rule")
    best = fitting.groupBy("url").agg(F.max_by(F.struct("rule", "tier", "action"), order).alias("best"))
    key, best_of = free_name(pages, "_url"), free_name(pages, "_best")
    joined = pages.join(
        best.withColumnsRenamed({"url": key, "best": best_of}), F.coalesce(pages[url], F.lit("")) == F.col(key), "left"
    )
    judged = F.struct(
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        F.col(best_of)["rule"].alias("rule"),
        F.col(best_of)["tier"].alias("tier"),
        F.coalesce(F.col(best_of)["action"], F.lit(default)).alias("verdict"),
    )
    return joined.select(*[pages[c] for c in pages.columns], judged.alias(name))
