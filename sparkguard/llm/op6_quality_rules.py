"""Quality rules as a bitmask ledger, in DataFrame and SQL functions only.

Each text is measured once, each rule is evaluated once, and a ledger row keeps the measurements and the failed rules
as bits of one long.  Policies are versioned sets of rules; a verdict, and what each rule adds to a policy (its
ablation), come from the bits alone and never read a text again.

A null text counts as empty, so it has no words and fails ``few_words``.  Equal rows get equal results, an empty
table gives an empty ledger, columns other than doc_id and text are ignored (``apply_rules`` carries them).
Windows are compared by 64-bit hashes inside one text.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_row

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 5

#: Rule -> SQL condition under which it fails, over the measurements; the bit is the place in this table.
RULES = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
    "shouting": "2 * n_upper > word_chars",
    "few_distinct_words": "n_words >= 50 and 20 * n_distinct_words < n_words",
}


@dataclass(frozen=True)
class Policy:
    """A document is kept if it fails none of ``hard`` and at most ``allowed`` of ``soft``."""

    name: str
    version: int
    hard: tuple[str, ...]
    soft: tuple[str, ...] = ()
    allowed: int = 0


POLICIES = {
    ("base", 1): Policy("base", 1, ("few_words", "repeated_windows")),
    ("web", 1): Policy("web", 1, ("few_words", "repeated_windows", "symbols", "shouting")),
    ("web", 2): Policy("web", 2, ("few_words", "repeated_windows", "symbols", "shouting", "word_length"),
                       ("duplicate_lines", "few_distinct_words"), 1),
}
CURRENT = POLICIES["web", 2]


def _let(value: str, var: str, body: str) -> str:
    """SQL: ``body`` with ``value`` computed once and bound to ``var``."""
    return f"transform(array({value}), {var} -> {body})[0]"


def repeated_words_sql(words: str, n: int = WINDOW) -> str:
    """SQL for the number of words inside n-word windows that occur at least twice in the array ``words``."""
    window = ", ".join(f"h[i + {k}]" if k else "h[i]" for k in range(n))
    hashed = _let(f"transform({words}, w -> xxhash64(w))", "h",
                  f"transform(sequence(0, size(h) - {n}), i -> xxhash64({window}))")
    twice = ("transform(filter(transform(s, (x, i) -> struct(x.p as p, x.h <=> get(s, i - 1).h or x.h <=> get(s, i + 1).h"
             " as twice)), y -> y.twice), y -> y.p)")
    covered = _let(f"sort_array({twice})", "p", "aggregate(zip_with(p, slice(p, 2, size(p)), (a, b) -> "
                   f"least({n}, coalesce(b - a, {n}))), 0L, (c, x) -> c + x)")
    ordered = _let("sort_array(transform(g, (x, i) -> struct(x as h, i as p)))", "s", covered)
    return (f"case when size({words}) <= {n} then 0L else "
            + _let(hashed, "g", f"case when size(array_distinct(g)) = size(g) then 0L else {ordered} end") + " end")


def measure(docs: DataFrame, carry: Column | None = None) -> DataFrame:
    """``row`` (all columns, or ``carry``) and the measurements of its text."""
    row = carry.alias("row") if carry is not None else whole_row(docs)
    t = docs.select(row, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    t = t.select("row", "t", F.filter(F.split("t", SPACES), lambda w: w != "").alias("words"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    long = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.expr(repeated_words_sql("words")),
        "n_lines": F.size("lines"),
        "n_upper": F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")),
        "n_distinct_words": F.size(F.array_distinct("words")),
    }
    return t.select("row", *[c.cast("long").alias(k) for k, c in long.items()])


def bit_mask(rules: tuple[str, ...]) -> int:
    return sum(1 << list(RULES).index(r) for r in rules)


def ledger(docs: DataFrame, carry: Column | None = None) -> DataFrame:
    """The measurements with ``fails``: bit k is set if rule k of ``RULES`` fails."""
    m = measure(docs, carry)
    bits = [F.when(F.expr(cond), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
            for k, cond in enumerate(RULES.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return m.withColumn("fails", total)


def verdict(policy: Policy = CURRENT, fails: str | Column = "fails") -> Column:
    """Whether a ledger row is kept under ``policy``."""
    f = F.col(fails) if isinstance(fails, str) else fails
    hard, soft = F.lit(bit_mask(policy.hard)).cast("long"), F.lit(bit_mask(policy.soft)).cast("long")
    return (f.bitwiseAND(hard) == 0) & (F.bit_count(f.bitwiseAND(soft)) <= policy.allowed)


def ablation(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """``(policy, version, rule, n_failed, n_kept, n_kept_without, n_added)`` for each rule of the policy.

    The ledger is first counted by its bits (at most 2^rules rows, map-side combined); what a policy without a rule
    would keep is a masked sum over these counts.
    """
    patterns = rows.groupBy("fails").agg(F.count(F.lit(1)).alias("n"))
    zero, n = F.lit(0).cast("long"), F.col("n")
    aggs = [F.coalesce(F.sum(F.when(verdict(policy), n)), zero).alias("kept")]
    names = policy.hard + policy.soft
    for k, rule in enumerate(names):
        bit = F.lit(bit_mask((rule,))).cast("long")
        without = F.col("fails").bitwiseAND(F.lit(~bit_mask((rule,))).cast("long"))
        aggs += [F.coalesce(F.sum(F.when(F.col("fails").bitwiseAND(bit) != 0, n)), zero).alias(f"f{k}"),
                 F.coalesce(F.sum(F.when(verdict(policy, without), n)), zero).alias(f"w{k}")]
    one = patterns.agg(*aggs)
    rows_ = F.array(*[F.struct(F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"),
                               F.lit(r).alias("rule"), F.col(f"f{k}").alias("n_failed"), F.col("kept").alias("n_kept"),
                               F.col(f"w{k}").alias("n_kept_without"), (F.col(f"w{k}") - F.col("kept")).alias("n_added"))
                      for k, r in enumerate(names)])
    return one.select(F.inline(rows_))


def quality_ledger(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """doc_id, the measurements, ``fails``, ``base_failed`` and ``kept``."""
    rows = ledger(docs, F.struct(F.col("doc_id")))
    base = ~verdict(POLICIES["base", 1])
    return rows.select("row.doc_id", *[c for c in rows.columns if c != "row"], base.alias("base_failed"),
                       (~base & verdict(policy)).alias("kept"))


def apply_rules(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The documents that the base rules and ``policy`` keep, all columns unchanged."""
    return ledger(docs).filter(verdict(POLICIES["base", 1]) & verdict(policy)).select("row.*")
