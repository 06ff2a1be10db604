"""URL filters: rules found by their rarest literal token.

A rule is a regular expression over the normalised address (host in lower case,
then the path), an action and literal tokens that every matching address holds as
whole tokens. Rules are indexed by the one of their tokens that fewest of the given
addresses have. An address looks its own tokens up; only the rules found run their
expressions. Rules without a literal token run on every address.

Rules are a list written by a person or a configuration; the index is part of the plan
and ``MAX_RULES`` bounds it. There is no shuffle but the one that counts the
rules' own tokens, so a host with a third of all pages is no burden. For more rules there is
``judged_by_table``: rules as a table, joined with the tokens of the distinct addresses; its results are the same.

Defined results: null urls and urls without ``://`` have empty host and path and
match no rule, so they get the default verdict. Ties between rules go to the longer
name, then to the smaller name. Repeated rows are judged alike. The given columns, whatever
their names, come back in the struct ``page``. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.shared import table

MAX_RULES = 20_000
_SPLIT = "[^a-z0-9]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str  # over host + path
    verdict: str  # "allow" or "block"
    tokens: tuple[str, ...]  # each is in every match as a whole token, in lower case
    rank: int  # the highest wins; equal ranks go to the longer name


def host_rule(verdict: str, host: str, path: str = "/") -> Rule:
    """A rule for a host, its subdomains, and the paths that begin with ``path``."""
    tokens = [t for t in re.split(_SPLIT, host.lower()) if t]
    # The last piece of the path may go on in the address, unless a separator ends it.
    inside = re.split(_SPLIT, path.lower())[:-1]
    escaped = "".join("\\" + c if c in r"\.[]{}()*+?^$|-/" else c for c in host.lower() + path)
    return Rule(host.lower() + path, rf"^(?:[^/]*\.)?{escaped}", verdict, (*tokens, *(t for t in inside if t)), 1)


def token_rule(verdict: str, token: str) -> Rule:
    """A rule for addresses that hold a token anywhere in host or path."""
    return Rule(f"*{token}*", rf"(?i)(?<![a-z0-9]){token}(?![a-z0-9])", verdict, (token,), 0)


# The rules that the query is asked to apply.
HOST_RULES = (
    host_rule("block", "net", "/"),
    host_rule("allow", "example.net", "/en/"),
    host_rule("block", "example.com", "/de/"),
    host_rule("allow", "org", "/fr/"),
)
# Words that mark a page as unwanted where no host rule applies.
TOKEN_RULES = tuple(token_rule("block", t) for t in (
    "adult", "bet", "casino", "gambling", "lottery", "malware", "nude", "phishing", "poker", "porn", "sex", "spam", "viagra",
    "warez", "xxx",
))


def with_address(pages: DataFrame, url: str = "url") -> DataFrame:
    """The given columns as ``page``, host and path."""
    packed = pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("page"))
    address = F.col("page")[url]
    cut = F.instr(address, "://")
    rest = F.coalesce(F.when(cut > 0, F.substr(address, cut + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    return packed.withColumns({"host": host, "path": F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)})


def _tokens():
    lowered = F.translate(F.concat("host", "path"), _UPPER, _LOWER)
    return F.array_distinct(F.split(lowered, _SPLIT))


def token_counts(addresses: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """In how many addresses each of the rules' tokens is: one row per token reaches the driver."""
    held = F.array_intersect(_tokens(), F.array(*(F.lit(t) for t in sorted(tokens))))
    rows = addresses.select(F.explode(held).alias("token")).groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in rows}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def judged(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """``page`` (the given columns), host, path, ``matched`` (name of the winning rule or null) and verdict."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the index holds {MAX_RULES}, judged_by_table any number")
    addresses = with_address(pages, url)
    if not rules:
        return addresses.withColumns({"matched": F.lit(None).cast("string"), "verdict": F.lit(default)})
    literal = {t for r in rules for t in r.tokens}
    often = token_counts(addresses.select("host", "path"), literal) if literal else {}
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        key = min(rule.tokens, key=lambda t: (often.get(t, 0), t)) if rule.tokens else ""
        index.setdefault(key, []).append(rule)

    def entry(rule: Rule) -> str:
        return (f"named_struct('rank', {rule.rank}, 'length', {len(rule.name)}, 'name', {_quoted(rule.name)}, "
                f"'verdict', {_quoted(rule.verdict)}, 'pattern', {_quoted(rule.pattern)})")

    # A table of about two slots per rule, in which a token finds its rules at once.
    n_slots = 2 * len(index) + 1
    slots: list[list[str]] = [[] for _ in range(n_slots)]
    rest = ", ".join(entry(r) for r in index.pop("", []))
    keys = sorted(index)
    spark = pages.sparkSession
    if keys:
        at = spark.sql("SELECT " + ", ".join(f"CAST(pmod(xxhash64({_quoted(k)}), {n_slots}) AS INT)" for k in keys)).first()
        for k, slot in zip(keys, at):
            slots[slot] += [f"named_struct('token', {_quoted(k)}, 'rule', {entry(r)})" for r in index[k]]
    kind = "struct<rank:int,length:int,name:string,verdict:string,pattern:string>"
    held = "array(" + ", ".join(
        f"CAST(array({', '.join(s)}) AS array<struct<token:string,rule:{kind}>>)" for s in slots) + ")"
    found = F.expr(
        f"transform(flatten(transform(_tokens, t -> filter(element_at({held}, CAST(pmod(xxhash64(t), {n_slots}) AS INT) + 1),"
        f" e -> e.token = t))), e -> e.rule)")
    always = F.expr(f"CAST(array({rest}) AS array<{kind}>)")
    address = F.concat("host", "path")
    fits = F.filter(
        F.concat(F.col("_found"), always), lambda r: (address != "") & F.call_function("regexp_like", address, r["pattern"])
    )
    order = F.transform(fits, lambda r: F.struct(-r["rank"], -r["length"], r["name"], r["verdict"]))
    best = F.array_min(order)
    out = addresses.withColumn("_tokens", _tokens()).withColumn("_found", found).withColumn("_best", best)
    return out.withColumns({
        "matched": F.col("_best")["name"], "verdict": F.coalesce(F.col("_best")["verdict"], F.lit(default)),
    }).drop("_tokens", "_found", "_best")


RULES = "name string, pattern string, verdict string, tokens array<string>, rank int"


def judged_by_table(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """As ``judged``, for any number of rules in a table of the columns ``RULES``.

    Rules without tokens still go into the plan, so ``MAX_RULES`` bounds those. Equal addresses are
    judged once; a token that very many of them have is a skewed join, which Spark splits.
    """
    addresses = with_address(pages, url)
    distinct = addresses.select("host", "path").distinct()
    tokens = distinct.withColumn("token", F.explode(_tokens())).where("token <> ''")
    owned = rules.where("SIZE(tokens) > 0").select("*", F.explode("tokens").alias("token"))
    often = tokens.join(owned.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("n"))
    keyed = owned.join(often, "token", "left").groupBy("name", "pattern", "verdict", "rank").agg(
        F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    # regexp_like with a pattern per row; an address is fetched by the one token of a rule, so once per rule.
    fits = tokens.join(keyed, "token").where(F.call_function("regexp_like", F.concat("host", "path"), F.col("pattern")))
    order = F.struct((-F.col("rank")).alias("r"), (-F.length("name")).alias("l"), F.col("name").alias("matched"), F.col("verdict"))
    best = fits.groupBy("host", "path").agg(F.min(order).alias("by_token"))
    always = [Rule(r["name"], r["pattern"], r["verdict"], (), r["rank"])
              for r in rules.where("SIZE(tokens) <= 0 OR tokens IS NULL").limit(MAX_RULES + 1).collect()]
    other = judged(distinct.select(F.concat(F.lit("x://"), "host", "path").alias("url")), always, "")
    ranks = {r.name: r.rank for r in always}
    rank = F.coalesce(*(F.when(F.col("matched") == n, F.lit(k)) for n, k in ranks.items()), F.lit(0)) if ranks else F.lit(0)
    other = other.where("matched IS NOT NULL").select("host", "path", F.struct(
        (-rank).alias("r"), (-F.length("matched")).alias("l"), F.col("matched"), F.col("verdict")).alias("by_none"))
    winners = best.join(other, ["host", "path"], "full").select("host", "path", F.least("by_token", "by_none").alias("best"))
    return addresses.join(winners, ["host", "path"], "left").select(
        "page", "host", "path", F.col("best.matched").alias("matched"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op2_url_filter(spark, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    found = judged(pages, HOST_RULES + TOKEN_RULES)
    names = [r.name for r in HOST_RULES]
    return found.select(
        "page.page_id", "host", "path", F.when(F.col("matched").isin(names), F.col("matched")).alias("rule"), "verdict"
    )


OP2_SQL = r"""
WITH u AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), a AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1, 's') AS path
    FROM u
), r AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM a
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host || path, '(?i)(^|[^a-z0-9])(adult|bet|casino|gambling|lottery|malware|nude|phishing|poker|porn|sex|spam|viagra|warez|xxx)($|[^a-z0-9])') THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""
