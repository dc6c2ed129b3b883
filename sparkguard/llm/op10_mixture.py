"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions only.

The tree's levels are column expressions (domain, language, source).  A node's weight is its share among its siblings
(1 unless given); its capacity is its subtree's tokens times ``max_epochs``.  The budget flows from the root down:
at each node it is filled into the children in proportion to their weights, a child gets its capacity at most, and what it
can't take goes to its siblings.  A subtree's shortage therefore reaches its ancestors' siblings only when nothing
below can take it.  All sums are exact integers, and siblings' shares add up to their parent's.

A leaf's budget is ``budget div tokens`` whole epochs and the longest prefix, of at most the remaining tokens, of the
next epoch.  Each epoch has its own seeded order: md5 of seed, epoch and doc_id, ties by doc_id and text hash.  The prefix
is cut without sorting a leaf: 4 096 order buckets per leaf are summed, and only the bucket that the cut falls in is
ranked.  So a leaf with a third of all rows is spread over its buckets.

Null levels are a value of their own; null texts have no tokens.  Rows equal in doc_id and text stand or fall together.
Empty tables give empty results.  Other columns are ignored (``mix`` carries them).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import whole_row, written

#: Source -> domain of the default tree (fixed values); any other source is of domain `other`.
DOMAINS = {
    "crawl": ("src0", "src1", "src2", "src3"),
    "forum": ("src4", "src5", "src6", "src7"),
    "books": ("src8", "src9", "src10", "src11"),
    "news": ("src12", "src13", "src14", "src15"),
    "code": ("src16", "src17", "src18", "src19"),
}
#: Node path -> weight among its siblings (fixed values); 1 if not named.
WEIGHTS = {("crawl",): 6, ("forum",): 2, ("books",): 5, ("news",): 3, ("code",): 3, ("crawl", "en"): 3, ("crawl", "de"): 2,
           ("crawl", "en", "src0"): 4}
LEVELS = ("domain", "lang", "source")
SEED, MAX_EPOCHS = 17, 2
#: Share of all tokens that the budget asks for.
SHARE = 0.8
BUCKETS = 4096


def domain_of(source: Column) -> Column:
    out = F.lit("other")
    for name, sources in DOMAINS.items():
        out = F.when(source.isin(*sources), name).otherwise(out)
    return out


def level_cols() -> dict[str, Column]:
    source = F.col("source").cast("string")
    return {"domain": domain_of(source), "lang": F.col("lang").cast("string"), "source": source}


def token_count(text: Column) -> Column:
    """Words of the text, as a language-neutral stand-in for tokens."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def _weight(path: list[str], weights: dict) -> Column:
    out = F.lit(1)
    for names, w in weights.items():
        if len(names) == len(path):
            hit = F.lit(True)
            for c, n in zip(path, names):
                hit = hit & F.col(c).eqNullSafe(F.lit(n))
            out = F.when(hit, w).otherwise(out)
    return out.cast("long")


def _div(a: Column, b: Column) -> Column:
    """Floor of a * 1 / b for decimals of 38 digits."""
    return F.floor(a / b).cast("decimal(38,0)")


def budgets(leaves: DataFrame, budget: Column, weights: dict, max_epochs: int, levels=LEVELS) -> DataFrame:
    """``levels + (tokens, budget)`` for leaves ``levels + (tokens)``; ``budget`` is an expression over one row's column
    ``all_tokens``."""
    big = "decimal(38,0)"
    total = Window.partitionBy(F.lit(1))
    t = leaves.withColumn("all_tokens", F.sum("tokens").over(total)).withColumn("cap", (F.col("tokens") * max_epochs).cast(big))
    t = t.withColumn("b", F.least(budget.cast(big), F.sum("cap").over(total).cast(big)))
    for k in range(len(levels)):
        node, parent = list(levels[:k + 1]), list(levels[:k])
        # all leaves of a node hold its values; one of them (`one`) stands for it in the sums over siblings
        t = t.withColumn("w", _weight(node, weights))
        t = t.withColumn("c", F.when(F.col("w") > 0, F.sum("cap").over(Window.partitionBy(*node))).otherwise(0).cast(big))
        t = t.withColumn("one", F.row_number().over(Window.partitionBy(*node).orderBy(*levels)) == 1)
        nodes = t.filter("one").select(*node, "w", "c", "b")
        up = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(1))
        order = up.orderBy(F.when(F.col("w") > 0, F.col("c").cast("double") / F.col("w")).otherwise(0.0), F.col(node[-1]))
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        upto = order.rowsBetween(Window.unboundedPreceding, 0)
        zero = F.lit(0).cast(big)
        nodes = nodes.withColumn("w_left", (F.sum("w").over(up) - F.coalesce(F.sum("w").over(before), F.lit(0))).cast("decimal(18,0)"))
        nodes = nodes.withColumn("b_left", F.col("b") - F.coalesce(F.sum("c").over(before), zero).cast(big))
        nodes = nodes.withColumn("full", F.col("c") * F.col("w_left") <= F.col("w").cast("decimal(18,0)") * F.col("b_left"))
        nodes = nodes.withColumn("rest", (F.col("b") - F.coalesce(F.sum(F.when(F.col("full"), F.col("c"))).over(up), zero)).cast(big))
        open_w = F.when(~F.col("full"), F.col("w")).otherwise(0)
        nodes = nodes.withColumn("ow", F.sum(open_w).over(up)).withColumn("cw", F.sum(open_w).over(upto)) \
            .withColumn("pw", F.col("cw") - open_w)
        share = lambda c: F.expr(f"cast(rest as decimal(20,0)) * cast({c} as decimal(18,0)) div cast(ow as decimal(18,0))")
        nodes = nodes.withColumn("nb", F.when(F.col("full"), F.col("c")).otherwise((share("cw") - share("pw")).cast(big)))
        small = nodes.select(*[F.col(c).alias(f"_{c}") for c in node], "nb")
        same = F.lit(True)
        for c in node:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        t = t.drop("w", "c", "one", "b").join(small, same).drop(*[f"_{c}" for c in node]).withColumnRenamed("nb", "b")
    return t.select(*levels, "tokens", F.col("b").cast("long").alias("budget"))


def _order_key(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))


def _join_levels(a: DataFrame, b: DataFrame, levels=LEVELS) -> DataFrame:
    same = F.lit(True)
    for c in levels:
        same = same & a[c].eqNullSafe(b[c])
    out = a.join(b, same)
    for c in levels:
        out = out.drop(b[c])
    return out


def cuts(docs: DataFrame, share: float = SHARE, weights: dict | None = None, max_epochs: int = MAX_EPOCHS,
         seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents ``levels + (doc_id, x, tokens)``, leaves ``levels + (tokens, budget, epochs, rest, bucket, last)``).

    ``epochs`` is the number of whole epochs; of the next one, if ``rest`` tokens are left, a leaf's documents before ``bucket`` are taken, and those
    in it up to ``last``."""
    rows = docs.select(*[c.alias(n) for n, c in level_cols().items()], F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("x"), token_count(F.col("text")).alias("tokens"))
    rows = written(rows, "mix-docs")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    asked = F.floor(F.col("all_tokens") * F.lit(share))
    plan = budgets(leaves, asked, WEIGHTS if weights is None else weights, max_epochs)
    has = F.col("tokens") > 0
    plan = plan.withColumn("epochs", F.when(has, F.expr("budget div tokens")).otherwise(0)) \
        .withColumn("rest", F.when(has, F.expr("budget % tokens")).otherwise(0))
    plan = written(plan, "mix-plan")

    slim = plan.select(*LEVELS, "epochs", "rest")
    keyed = _join_levels(rows, slim).withColumn("key", _order_key(seed, F.col("epochs") + 1)) \
        .withColumn("bucket", _bucket(F.col("key")))
    sums = keyed.groupBy(*LEVELS, "rest", "bucket").agg(F.sum("tokens").alias("t"))
    so_far = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    at = sums.withColumn("upto", F.sum("t").over(so_far)).filter(F.col("upto") > F.col("rest")) \
        .groupBy(*LEVELS).agg(F.min(F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("t")).alias("left"))).alias("s"))
    at = written(at.select(*LEVELS, "s.bucket", "s.left"), "mix-buckets")
    edge = _join_levels(keyed.withColumnRenamed("bucket", "b"), at).filter("b = bucket")
    inside = Window.partitionBy(*LEVELS).orderBy("name").rangeBetween(Window.unboundedPreceding, 0)
    last = edge.withColumn("name", F.struct("key", "doc_id", "x")).withColumn("upto", F.sum("tokens").over(inside)) \
        .filter(F.col("upto") <= F.col("left")).groupBy(*LEVELS).agg(F.max("name").alias("last"))
    # a leaf without a cut bucket has its whole next epoch inside the rest (only if it has no tokens)
    done = _left_levels(_left_levels(plan, at.select(*LEVELS, "bucket")), last)
    return rows, written(done, "mix-cuts")


def _left_levels(a: DataFrame, b: DataFrame) -> DataFrame:
    r = b.select(*[F.col(c).alias(f"_{c}") for c in LEVELS], *[c for c in b.columns if c not in LEVELS])
    same = F.lit(True)
    for c in LEVELS:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return a.join(r, same, "left").drop(*[f"_{c}" for c in LEVELS])


def _bucket(key: Column) -> Column:
    return F.conv(F.substring(key, 1, 3), 16, 10).cast("int")


def _copies(seed: int) -> Column:
    """Times that a document (with its leaf's cut) is taken."""
    key = _order_key(seed, F.col("epochs") + 1)
    inside = F.struct(key.alias("key"), "doc_id", "x") <= F.col("last")
    part = (F.col("rest") > 0) & ((_bucket(key) < F.col("bucket")) | ((_bucket(key) == F.col("bucket")) & inside))
    # leaves without tokens are taken once
    return F.when(F.col("bucket").isNull(), 1).otherwise(F.col("epochs") + F.when(F.coalesce(part, F.lit(False)), 1).otherwise(0)).cast("int")


def mixture(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """``(doc_id, domain, lang, source, n_tokens, epoch)``: one row per taken document and epoch (1, 2, ...)."""
    rows, leaves = cuts(docs, seed=seed, **options)
    taken = _join_levels(rows.withColumnRenamed("tokens", "n_tokens"), leaves.drop("tokens", "budget"))
    return taken.withColumn("n", _copies(seed)).filter("n > 0").select(
        "doc_id", *LEVELS, "n_tokens", F.explode(F.sequence(F.lit(1), "n")).alias("epoch"))


def mix(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The mixture as rows of ``docs`` with all columns, a document as many times as it is taken."""
    _, leaves = cuts(docs, seed=seed, **options)
    rows = docs.select(whole_row(docs), *[c.alias(n) for n, c in level_cols().items()],
                       F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("x"))
    taken = _join_levels(rows, leaves.drop("tokens", "budget")).withColumn("n", _copies(seed)).filter("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "n")).alias("epoch")).select("row.*")
