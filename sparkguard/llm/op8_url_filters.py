"""URL filters: pattern rules indexed by their rarest literal token, in DataFrame functions only.

Every rule is a regular expression with literal tokens (runs of a-z0-9) that each URL it fits must hold.  One pass
counts how many URLs hold each of these tokens; a rule is filed under its rarest one.  A URL's tokens fetch their
rules from the index, and only those run their regular expression.  The index is a literal array of hash
buckets, so a look-up takes one step per token, nothing is joined and no row is shuffled.  Rules are a list in the
driver; the index is built of pieces of ``PIECE`` rules, each a literal of bounded size, and the best fit over all
pieces wins.  Rules without tokens run on every URL.

Of the rules that fit, host rules win over pattern rules, then the longest, then block over allow, then the name.
No fit: allow.  Null or malformed URLs have an empty host and path and fit nothing.  Pages with equal URLs get equal
verdicts; columns other than page_id and url are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE = 512


@dataclass(frozen=True)
class Rule:
    """``regex`` runs on host + path for host rules, else on the lower-cased URL after ``://``."""

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...] = ()
    host_rule: bool = False


def host_rule(verdict: str, name: str) -> Rule:
    """``example.net/en/``: the host and its subdomains, if the path starts with the rule's."""
    host, slash, path = name.partition("/")
    whole = re.sub(r"[A-Za-z0-9]+$", "", slash + path)       # the last path token may go on in a URL
    tokens = re.findall(r"[a-z0-9]+", (host + whole).lower())
    return Rule(name, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}", tuple(tokens), True)


#: The host rules of the contract (fixed values).
HOST_RULES = [host_rule("block", "net/"), host_rule("allow", "example.net/en/"),
              host_rule("block", "example.com/de/"), host_rule("allow", "org/fr/")]
PATTERN_RULES = [
    Rule("spam-pills", "block", r"(?:^|[.-])cheap-pills(?:[.\-/?#:]|$)", ("cheap", "pills")),
    Rule("spam-casino", "block", r"(?:^|[.-])casino(?:[.\-/?#:]|$)", ("casino",)),
    Rule("spam-replica", "block", r"(?:^|[.-])replica-watches(?:[.\-/?#:]|$)", ("replica", "watches")),
    Rule("adult-host", "block", r"(?:^|[.-])xxx(?:[.\-/?#:]|$)", ("xxx",)),
    Rule("login-page", "block", r"/login(?:\.[a-z]+)?(?:[/?#]|$)", ("login",)),
    Rule("checkout", "block", r"/cart/checkout(?:[/?#]|$)", ("cart", "checkout")),
    Rule("session-id", "block", r"[?&;]phpsessid=[0-9a-f]{16,}", ("phpsessid",)),
    Rule("binary-file", "block", r"\.(?:exe|iso|zip)(?:[?#]|$)", ()),
]
RULES = HOST_RULES + PATTERN_RULES


def url_parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path, ``rest`` (the URL after ``://``, A-Z lower-cased) and its distinct ``tokens``."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    p = pages.select("page_id", rest.alias("r"))
    return p.select("page_id", F.translate(F.regexp_extract("r", r"^[^/?#]*", 0), UPPER, LOWER).alias("host"),
                    F.regexp_extract("r", r"^[^/?#]*([^?#]*)", 1).alias("path"),
                    F.translate("r", UPPER, LOWER).alias("rest")) \
        .withColumn("tokens", F.array_distinct(F.regexp_extract_all("rest", F.lit("[a-z0-9]+"), 0)))


def token_counts(parts: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """URLs that hold each literal token of the rules: one row per rule token at most reaches the driver."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    held = parts.select(F.explode(F.array_intersect("tokens", F.lit(wanted).cast("array<string>"))).alias("token"))
    return {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}


def _rule(r: Rule, k: int, token: str) -> Column:
    return F.struct(F.lit(r.host_rule).alias("host_rule"), F.lit(len(r.name)).alias("size"),
                    F.lit(r.verdict == "block").alias("block"), F.lit(k).alias("k"), F.lit(token).alias("token"),
                    F.lit(r.regex).alias("regex"))


def _best(rules: list[tuple[Rule, int, str]]) -> Column:
    """The best fitting rule of one piece as struct (host_rule, size, block, -k), or null."""
    kind = "array<struct<host_rule: boolean, size: int, block: boolean, k: int, token: string, regex: string>>"
    n = 1 << max(1, len(rules) - 1).bit_length()
    buckets: list[list[Column]] = [[] for _ in range(n)]
    for r, k, token in rules:
        if token:
            buckets[zlib.crc32(token.encode()) % n].append(_rule(r, k, token))
    index = F.array(*[F.array(*b).cast(kind) for b in buckets])
    always = F.array(*[_rule(r, k, "") for r, k, token in rules if not token]).cast(kind)
    fetched = F.flatten(F.transform("tokens", lambda t: F.filter(
        F.get(index, (F.crc32(t.cast("binary")) % n).cast("int")), lambda r: r["token"] == t)))
    fits = F.filter(F.concat(fetched, always), lambda r: F.regexp_like(
        F.when(r["host_rule"], F.concat("host", "path")).otherwise(F.col("rest")), r["regex"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(
        r["host_rule"].alias("host_rule"), r["size"].alias("size"), r["block"].alias("block"), (-r["k"]).alias("k"))))


def judge(pages: DataFrame, rules: list[Rule] | None = None, default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict, pattern)``: ``rule`` names the host rule that decides, ``pattern`` the pattern
    rule (each null if none)."""
    rules = sorted(RULES if rules is None else rules, key=lambda r: r.name)
    parts = url_parts(pages)
    seen = token_counts(parts, rules)
    filed = [(r, k, min(r.tokens, key=lambda t: (seen.get(t, 0), t)) if r.tokens else "") for k, r in enumerate(rules)]
    pieces = [_best(filed[i:i + PIECE]) for i in range(0, len(filed), PIECE)]
    best = F.array_max(F.array(*pieces)) if pieces else F.lit(None).cast(
        "struct<host_rule: boolean, size: int, block: boolean, k: int>")
    names = F.array(*[F.lit(r.name) for r in rules]).cast("array<string>")
    out = parts.select("page_id", "host", "path", best.alias("best"))
    name = F.when(F.col("best").isNotNull(), F.get(names, -F.col("best.k")))
    return out.select("page_id", "host", "path", F.when(F.col("best.host_rule"), name).alias("rule"),
                      F.when(F.col("best.block"), "block").when(~F.col("best.block"), "allow").otherwise(default)
                      .alias("verdict"), F.when(~F.col("best.host_rule"), name).alias("pattern"))


def keep_allowed(pages: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """page_ids of the pages that may stay."""
    return judge(pages, rules).filter(F.col("verdict") == "allow").select("page_id")
