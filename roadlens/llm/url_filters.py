"""URL filters: regular-expression rules indexed by their rarest literal token.

Every rule has a pattern over ``host + path`` and the literal tokens that a
URL must hold, whole, for the pattern to match.  The rule is indexed under the
token that is rarest among the URLs at hand.  A URL's tokens fetch candidate
rules from that index, and only those patterns run on it.

There are two kinds of rules.  Scope rules (a host and a path prefix, allow or
block) decide first; the longest one that fits wins.  Otherwise a matching
pattern rule blocks, and a URL that nothing matches is allowed.

The index has one row per rule, so the rule list bounds it (checked), and it
is broadcast: URLs look it up where they are.  A token that most URLs have is
one key of the index like any other; a rule is under it only if all its tokens
are as common.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
matches nothing and is allowed; an empty table gives an empty result; repeated
rows stay and are judged alike; columns not asked for are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The index is broadcast; a longer list is refused rather than sent to every executor.
MAX_RULES = 100_000

SEPARATORS = "[^a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str             # over host + path
    tokens: tuple[str, ...]  # in lower case, whole in every URL that matches
    action: str              # allow or block
    scope: bool = False      # a host and a path prefix


def scope_rule(action: str, name: str) -> Rule:
    """``example.com/en/``: this host and its subdomains, paths that start so."""
    host, slash, rest = name.partition("/")
    # What follows the last separator of the prefix may go on in the URL, so it is no whole token.
    tokens = re.split(SEPARATORS, host.lower()) + re.split(SEPARATORS, rest.lower())[:-1]
    return Rule(name, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + rest)}",
                tuple(t for t in tokens if t), action, True)


# The scope rules.
SCOPE_RULES = tuple(scope_rule(*r.split(" ")) for r in (
    "allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/"))

# The pattern rules and the tokens that they need.
PATTERN_RULES = (
    Rule("adult host", r"^(?:[^/]*\.)?adult(?:-[a-z0-9]+)*\.", ("adult",), "block"),
    Rule("pills host", r"^(?:[^/]*\.)?(?:[a-z0-9]+-)*pills(?:-[a-z0-9]+)*\.", ("pills",), "block"),
    Rule("casino", r"\bcasino\b", ("casino",), "block"),
    Rule("free download", r"\bfree-download\b", ("free", "download"), "block"),
    Rule("spam folder", r"/spam/", ("spam",), "block"),
    Rule("login page", r"/login/?$", ("login",), "block"),
)
RULES = SCOPE_RULES + PATTERN_RULES


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A to Z in lower case, and the path of a URL; both empty without ``://``."""
    after = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), "(?s)://(.*)$", 1)
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    return (F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
            F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1))


def rarest_tokens(urls: DataFrame, rules: tuple[Rule, ...]) -> list[str]:
    """For each rule, the one of its tokens that the fewest URLs have (the first in the alphabet of equals)."""
    wanted = sorted({t for r in rules for t in r.tokens})
    seen = (urls.select(F.explode("_tokens").alias("token")).where(F.col("token").isin(wanted))
            .groupBy("token").count().collect())            # a row per token of the rules
    count = {r["token"]: r["count"] for r in seen}
    return [min(r.tokens, key=lambda t: (count.get(t, 0), t)) for r in rules]


def url_filters(pages: DataFrame, keep: tuple[str, ...] = ("page_id",), url_col: str = "url",
                rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``pages``: the ``keep`` columns, host, path, rule (the scope rule that decided, or null),
    pattern_rules (names of the pattern rules that match) and verdict."""
    if not 0 < len(rules) <= MAX_RULES:
        raise ValueError(f"{len(rules)} rules; between 1 and {MAX_RULES} can be indexed")
    if any(not r.tokens for r in rules):
        raise ValueError("every rule needs a literal token")
    host, path = host_and_path(F.col(url_col))
    urls = (pages.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keep)], host.alias("_host"), path.alias("_path"))
            .withColumn("_hp", F.concat("_host", "_path"))
            .withColumn("_tokens", F.array_distinct(F.filter(F.split(F.lower("_hp"), SEPARATORS), lambda t: t != ""))))
    index = pages.sparkSession.createDataFrame(
        [(token, r.name, r.pattern, list(r.tokens), r.action, r.scope)
         for token, r in zip(rarest_tokens(urls, rules), rules, strict=True)],
        "_token string, name string, pattern string, needs array<string>, action string, scope boolean")

    rows = urls.withColumn("_row", F.monotonically_increasing_id())
    fetched = rows.withColumn("_token", F.explode_outer("_tokens")).join(F.broadcast(index), "_token", "left")
    fits = F.when(F.col("pattern").isNotNull(),
                  (F.size(F.array_except("needs", "_tokens")) == 0) & F.expr("regexp_like(_hp, pattern)"))
    by_scope = F.max(F.when(fits & F.col("scope"), F.struct(
        F.length("name").alias("n"), "action", "name"))).alias("_best")
    by_pattern = F.collect_set(F.when(fits & ~F.col("scope"), F.col("name"))).alias("_patterns")
    carried = [f"_k{i}" for i in range(len(keep))] + ["_host", "_path"]
    judged = fetched.groupBy("_row").agg(*[F.first(c).alias(c) for c in carried], by_scope, by_pattern)
    return judged.select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keep)],
        F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_best.name").alias("rule"),
        F.sort_array("_patterns").alias("pattern_rules"),
        F.coalesce(F.col("_best.action"), F.when(F.size("_patterns") > 0, "block").otherwise("allow")).alias("verdict"))


def op8_query(pages: DataFrame) -> DataFrame:
    return url_filters(pages).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    """The same in DuckDB's SQL: every rule tried on every URL."""
    scope = " union all ".join(f"select '{r.name}' as name, '{r.action}' as action, '{r.pattern}' as p" for r in SCOPE_RULES)
    pattern = " or ".join(f"regexp_matches(host || path, '{r.pattern}')" for r in PATTERN_RULES)
    return f"""
with u as (select row_number() over () as r, page_id, regexp_extract(coalesce(url, ''), '://(.*)$', 1, 's') as a from pages),
h as (select r, page_id, translate(regexp_extract(a, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(a, '^[^/?#]*([^?#]*)', 1) as path from u),
s as ({scope}),
best as (select r, max({{'n': length(name), 'action': action, 'name': name}}) as b from h, s
         where regexp_matches(host || path, p) group by r)
select page_id, host, path, b.name as rule,
  coalesce(b.action, case when {pattern} then 'block' else 'allow' end) as verdict
from h left join best using (r)"""


ORACLE = _oracle()
