"""URL filters: rules indexed by their rarest literal token, run only on URLs that hold it."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: host, path, verdict; a rule holds for its host and all subdomains
HOST_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: patterns that block: ``||`` starts at a host label, ``^`` is a separator or the end, ``*`` anything
PATTERNS = (
    "||ads-track.*^",
    "||adserver.*^",
    "||doubleclick.net^",
    "/login^",
    "/signup^",
    "/logout^",
    "/cart^",
    "/checkout^",
    "/wp-admin/",
    "/cgi-bin/",
    "?replytocom=",
    "&sessionid=",
    "?sessionid=",
    "/tag/*/page/",
)

DEFAULT = "allow"
SMALL_INDEX = 10_000
TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """A regular expression, the literal tokens every match holds, and what it decides."""

    regex: str
    tokens: tuple[str, ...]
    on_place: bool  # matched on host and path; else on the whole URL in lower case
    rank: int
    name: str | None
    verdict: str


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Host and path rule. Only tokens that end inside the rule are sure to be tokens of the URL."""
    sure = re.findall(f"{TOKEN}(?=[^a-z0-9])", f"{host}{path}".lower())
    regex = f"^([^/]*\\.)?{re.escape(host)}{re.escape(path)}"
    return Rule(regex, tuple(dict.fromkeys(sure)), True, len(host) + len(path), host + path, verdict)


def pattern_rule(pattern: str, verdict: str = "block") -> Rule:
    """Pattern rule; a literal token is one with separators of the pattern on both sides."""
    body = pattern.lower()
    anchored = body.startswith("||")
    sure = re.findall(rf"(?<=[^a-z0-9*])({TOKEN})(?=[^a-z0-9*])", body)
    parts = [
        {"^": "([^a-z0-9_.%-]|$)", "*": ".*"}.get(c) or re.escape(c) for c in (body[2:] if anchored else body)
    ]
    start = "^[^:/?#]*://([^/?#]*\\.)?" if anchored else ""
    return Rule(start + "".join(parts), tuple(dict.fromkeys(sure)), False, 0, None, verdict)


def default_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + [pattern_rule(p) for p in PATTERNS]


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    rest = F.substring_index(_after_scheme(url), "/", 1)
    return F.translate(_before(rest, "?", "#"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What stands between the host and ``?``, ``#`` or the end; else empty."""
    rest = _before(_after_scheme(url), "?", "#")
    return F.when(F.instr(rest, "/") > 0, rest.substr(F.instr(rest, "/"), F.length(rest))).otherwise("")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def _before(text: Column, *marks: str) -> Column:
    for mark in marks:
        text = F.substring_index(text, mark, 1)
    return text


def _tokens(url: Column) -> Column:
    """The distinct literal tokens of a URL, and the empty token that all URLs have."""
    return F.array_distinct(F.concat(F.split(F.lower(url), "[^a-z0-9]+"), F.array(F.lit(""))))


def _index(urls: DataFrame, rules: Sequence[Rule]) -> list[tuple]:
    """Each rule under the token of its own that the fewest URLs hold; without one, under the empty token."""
    spark = urls.sparkSession
    wanted = spark.createDataFrame([(t,) for t in sorted({t for r in rules for t in r.tokens})], "token string")
    held = urls.select(F.explode(_tokens(F.col("url"))).alias("token"))
    wanted = F.broadcast(wanted) if len(rules) <= SMALL_INDEX else wanted
    counts = {r["token"]: r["n"] for r in held.join(wanted, "token").groupBy("token").agg(F.count("*").alias("n")).collect()}
    rarest = [min(r.tokens, key=lambda t: (counts.get(t, 0), t), default="") for r in rules]
    return [(t, r.regex, r.on_place, r.rank, r.name, r.verdict) for t, r in zip(rarest, rules)]


def judge_urls(pages: DataFrame, rules: Sequence[Rule] | None = None, url_col: str = "url", keep: Sequence[str] = ()) -> DataFrame:
    """``host``, ``path``, ``rule`` and ``verdict`` for every row of ``pages``, with the columns ``keep``.

    Of the host rules that fit the longest decides (ties by name); where none fits, a
    page is blocked if a pattern matches, else allowed. Each distinct URL is judged
    once: its tokens fetch the rules indexed under them, and only those run their
    regular expression. The rules are the caller's list; up to ``SMALL_INDEX`` they are
    broadcast, beyond that joined like any table. Null URLs and such without ``://``
    have an empty host and path and no host rule. Repeated rows get the same
    answer; an empty table gives an empty table.
    """
    rules = default_rules() if rules is None else list(rules)
    spark = pages.sparkSession
    given = pages.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{url_col}`").alias("_url"))
    urls = given.select(F.col("_url").alias("url")).where("url is not null").distinct()
    index = spark.createDataFrame(
        _index(urls, rules), "token string, regex string, on_place boolean, rank int, rule string, verdict string"
    )
    index = F.broadcast(index) if len(rules) <= SMALL_INDEX else index
    place = F.concat(host_of(F.col("url")), path_of(F.col("url")))
    fetched = urls.select("url", F.explode(_tokens(F.col("url"))).alias("token")).join(index, "token")
    subject = F.when(F.col("on_place"), place).otherwise(F.lower("url"))
    best = (
        fetched.where(F.rlike(subject, F.col("regex")))
        .groupBy("url")
        .agg(F.max(F.struct("rank", "rule", "verdict")).alias("best"))
    )
    url = F.coalesce("_url", F.lit(""))
    best = best.withColumnRenamed("url", "_judged").withColumnRenamed("best", "_best")
    return given.join(best, F.col("_url") == F.col("_judged"), "left").select(
        *(F.col(f"`{c}`") for c in keep),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(DEFAULT)).alias("verdict"),
    )


def judge_sql(table: str = "pages", rules: Sequence[Rule] | None = None) -> str:
    """The same judgement in SQL."""
    rules = default_rules() if rules is None else rules
    q = lambda s: "NULL" if s is None else "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({q(r.regex)}, {r.on_place}, {r.rank}, {q(r.name)}, {q(r.verdict)})" for r in rules)
    return f"""WITH rules(regex, on_place, rank, rule, verdict) AS (VALUES {values}),
cut AS (SELECT page_id, lower(coalesce(url, '')) AS low,
  CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM {table}),
place AS (SELECT page_id, low,
  translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (SELECT page_id, host, path, r.rule, r.verdict,
  row_number() OVER (PARTITION BY page_id ORDER BY r.rank DESC NULLS LAST, r.rule DESC NULLS LAST) AS nth
  FROM place LEFT JOIN rules r ON regexp_matches(CASE WHEN on_place THEN host || path ELSE low END, regex))
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict FROM fits WHERE nth = 1"""
