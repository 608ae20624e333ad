"""URL rules found through their rarest literal token.

A rule is a host and a path prefix, ``example.com/en/``; it fits its host, all subdomains, and
paths that start with its path. As a pattern it is a regular expression. Every rule is
indexed under one literal token that any URL it fits must contain as a whole token: the one
in the fewest URLs. The tokens of a URL fetch candidate rules; only candidates run their
regular expression, and the longest fitting rule decides.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomvec.operators.joins import join_on
from loomvec.session import materialise

ALLOW, BLOCK = "allow", "block"
# A rule none of whose tokens must be whole is looked up under the token every URL has.
EVERY_URL = ""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def host_pattern(self) -> str:
        return rf"(?s)^(?:.*\.)?{_quoted(self.host)}\z"

    @property
    def path_pattern(self) -> str:
        return f"^{_quoted(self.path)}"

    def tokens(self) -> list[str]:
        """Tokens every fitting URL has in whole; the last one of a path may be only begun."""
        path = re.findall(r"[a-z0-9]+", self.path)
        if re.search(r"[a-z0-9]$", self.path):
            path = path[:-1]
        return [f"h:{t}" for t in re.findall(r"[a-z0-9]+", self.host)] + [f"p:{t}" for t in path]


def _quoted(literal: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_-])", r"\\\1", literal)


# The rules in force: host, path, verdict.
RULES = (
    Rule("com", "/", ALLOW),
    Rule("example.com", "/en/", BLOCK),
    Rule("www.example.com", "/en/", ALLOW),
    Rule("net", "/es/", BLOCK),
    Rule("net", "/fr/", BLOCK),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` with A-Z lower-cased, and path up to ``?`` or ``#``; empty without a ``://``."""
    host = F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _tokens(host: Column, path: Column) -> Column:
    def part(text: Column, mark: str) -> Column:
        found = F.filter(F.split(text, "[^a-z0-9]+"), lambda t: t != "")
        return F.transform(found, lambda t: F.concat(F.lit(mark), t))

    return F.array_distinct(F.concat(F.array(F.lit(EVERY_URL)), part(host, "h:"), part(path, "p:")))


def _row(rule: Rule) -> Column:
    fields = {"rule": rule.text, "length": len(rule.text), "verdict": rule.verdict, "host_pattern": rule.host_pattern, "path_pattern": rule.path_pattern}
    tokens = F.array(*[F.lit(t) for t in [EVERY_URL, *rule.tokens()]])
    return F.struct(*[F.lit(v).alias(k) for k, v in fields.items()], tokens.alias("tokens"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, otherwise: str = ALLOW) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per row of ``pages (page_id, url, ...)``.

    ``rule`` is the longest fitting rule's text (ties: block before allow), else null; a URL no rule fits
    gets the verdict ``otherwise``. A null URL or one without ``://`` has empty host and path, which no
    rule fits. Null and repeated page_ids pass through; other columns of any name are ignored;
    without rules every URL gets ``otherwise``.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    if not rules:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict"))
    urls = materialise(rows.select("host", "path").distinct(), "urls")
    tokens = urls.select("host", "path", F.explode(_tokens(F.col("host"), F.col("path"))).alias("token"))
    given = spark.range(1).select(F.inline(F.array(*[_row(r) for r in rules])))
    wanted = given.select("rule", "length", "verdict", "host_pattern", "path_pattern", F.explode("tokens").alias("token"))
    # URLs per token of a rule; partial counts leave at most one row per token and task.
    counts = tokens.join(given.select(F.explode("tokens").alias("token")).distinct(), "token", "left_semi")
    counts = counts.groupBy("token").agg(F.count("*").alias("urls"))
    ranked = wanted.join(counts, "token", "left").groupBy("rule", "length", "verdict", "host_pattern", "path_pattern").agg(
        F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), (F.col("token") == EVERY_URL).alias("last"), "token")).alias("rarest")
    )
    index = materialise(ranked.select("rule", "length", "verdict", "host_pattern", "path_pattern", F.col("rarest.token").alias("token")), "rules")
    fits = tokens.join(index, "token").where(F.rlike("host", F.col("host_pattern")) & F.rlike("path", F.col("path_pattern")))
    best = fits.groupBy("host", "path").agg(F.max(F.struct("length", "verdict", "rule")).alias("best"))
    found = join_on(rows, best, ["host", "path"], "left")
    return found.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict")
    )
