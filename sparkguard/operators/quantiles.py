"""Per-column quantiles (linear interpolation, as pandas / Spark ``percentile``).

Values are unpivoted to long form ``(column, x)`` so each column reduces in
its own task and code stays small.  ``method``:

* ``'exact'`` (default) -- distributed selection by rank brackets.  Targets
  are the order statistics floor/ceil((n-1)p).  One scan counts the rows of
  every column and takes a grid of quantiles from mergeable KLL sketches; each
  target rank falls between two grid values a few grid steps apart.  A second
  scan counts the rows below that bracket and, inside it, the rows of each
  distinct value (map-side combined), whose running sums name the target.
  Neither scan unpivots the rows; ``grouped_quantiles`` and brackets that are
  cut again do.  A bracket expected
  to hold more than ``FINISH_ROWS`` values is sketched and cut again.  The
  sketch only proposes brackets: a rank that isn't inside one (the counts
  tell) gets a new bracket on its side, so results are exact.  Brackets follow
  ranks, not distances, so infinities and heavy tails are ordinary values and
  a value repeated on a third of the rows is one count.
* ``'percentile'`` -- Spark's exact ``percentile`` per column (its buffer is a
  value -> count map, so memory grows with the distinct values).
* ``'approx'`` -- ``percentile_approx`` (bounded sketch, rank error 1/accuracy).
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

KLL_K = 4096             # rank error of a column's sketch about 0.07 %, a third of what a bracket allows
MERGE_TASKS = 512        # tasks whose sketches are merged at a time
GRID = 1024              # sketch quantiles per interval
SKETCH_ACCURACY = 10_000
FINISH_ROWS = 1_000_000  # a bracket of about this many distinct values at most is ranked in one window group
INF = float("inf")


def quantile_expr(col: str, probs: list[float], method: str = "percentile",
                  accuracy: int = 100_000) -> Column:
    """Grouped-aggregate form (Spark built-ins), for per-group quantiles."""
    p = F.array(*[F.lit(float(x)) for x in probs])
    c = F.col(col).cast("double")
    if method in ("exact", "percentile"):
        return F.percentile(c, p)
    if method == "approx":
        return F.percentile_approx(c, p, accuracy).cast("array<double>")
    raise ValueError(f"unknown quantile method {method!r}")


def long_values(df: DataFrame, cols: list[str], keep: list[str] = ()) -> DataFrame:
    """``(keep..., _c, _x)``: column index and non-missing value (NaN counts as missing)."""
    return df.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(i).alias("_c"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("_x"))
        for i, c in enumerate(cols)]))).where(F.col("_x").isNotNull())


def _sketch(rows: DataFrame, keys: list[str], grid: int, lo: Column, hi: Column) -> DataFrame:
    """Per key: rows below ``lo``, at ``lo``, strictly inside and at ``hi``; least, greatest and grid values inside."""
    x = F.when((F.col("_x") > lo) & (F.col("_x") < hi), F.col("_x"))
    probs = F.array(*[F.lit(i / grid) for i in range(1, grid)])
    return rows.groupBy(*keys).agg(
        F.count_if(F.col("_x") < lo).alias("lt"), F.count_if(F.col("_x") == lo).alias("at_lo"), F.count(x).alias("n"),
        F.count_if(F.col("_x") == hi).alias("at_hi"), F.min(x).alias("mn"), F.max(x).alias("mx"),
        F.percentile_approx(x, probs, SKETCH_ACCURACY).alias("g"))


def _whole(rows: DataFrame, keys: list[str], grid: int) -> list:
    """Sketch rows of whole columns, the infinities as the two ends."""
    return _sketch(rows, keys, grid, F.lit(-INF), F.lit(INF)).collect()  # one row per key


def _present(c: str) -> Column:
    return F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))


def _whole_wide(df: DataFrame, cols: list[str], grid: int) -> tuple[int, dict]:
    """Row count, and ``_whole`` by column index, from one scan of the rows as they are.

    Every task keeps a KLL sketch per column; they are merged in groups of ``MERGE_TASKS`` tasks and then per column.
    Columns without values have no entry."""
    x = df.select(F.expr(f"spark_partition_id() div {MERGE_TASKS}").alias("_t"),
                  *[_present(c).alias(f"x{i}") for i, c in enumerate(cols)])
    agg = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(cols)):
        v = F.col(f"x{i}")
        inside = F.when(F.abs(v) < INF, v)
        agg += [F.count_if(v == -INF).alias(f"a{i}"), F.count_if(v == INF).alias(f"b{i}"), F.count(inside).alias(f"n{i}"),
                F.min(inside).alias(f"l{i}"), F.max(inside).alias(f"h{i}"),
                F.kll_sketch_agg_double(inside, F.lit(KLL_K)).alias(f"s{i}")]
    part = x.groupBy("_t").agg(*agg).select(F.col("rows"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("_c"), *[F.col(f"{f}{i}").alias(f) for f in "abnlhs"]) for i in range(len(cols))])))
    ranks = F.array(*[F.lit(i / grid) for i in range(1, grid)])
    got = part.groupBy("_c").agg(
        F.sum("rows").alias("rows"), F.sum("a").alias("at_lo"), F.sum("b").alias("at_hi"), F.sum("n").alias("n"),
        F.min("l").alias("mn"), F.max("h").alias("mx"),
        F.kll_merge_agg_double(F.expr("if(n > 0, s, null)"), F.lit(KLL_K)).alias("s"))
    got = got.select("*", F.lit(0).cast("long").alias("lt"),
                     F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", ranks)).alias("g")).drop("s")
    rows = {r["_c"]: r for r in got.collect()}                           # one row per column
    return max((r["rows"] for r in rows.values()), default=0), \
        {c: r for c, r in rows.items() if r["n"] + r["at_lo"] + r["at_hi"] > 0}


def _counts_wide(df: DataFrame, cols: list[str], spans: list[tuple[int, float, float]]) -> DataFrame:
    """``(_c, lo, hi, v, m)`` for spans ``(column index, lo, hi)``: how many rows lie below ``lo`` (``v`` NULL) and how many
    hold each value of ``[lo, hi]``.  One scan of the needed columns; numpy picks the few cells inside a span."""
    used = sorted({c for c, _, _ in spans})
    at = {c: j for j, c in enumerate(used)}

    def pick(batches):
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64", na_value=np.nan)
            out = []
            for c, lo, hi in spans:
                v = x[:, at[c]]
                vals, m = np.unique(v[(v >= lo) & (v <= hi)], return_counts=True)
                out.append((c, lo, hi, np.append(vals, np.nan), np.append(m, np.count_nonzero(v < lo))))
            yield pd.DataFrame({
                "_c": np.concatenate([np.full(len(o[4]), o[0], "int32") for o in out]),
                "lo": np.concatenate([np.full(len(o[4]), o[1]) for o in out]),
                "hi": np.concatenate([np.full(len(o[4]), o[2]) for o in out]),
                "v": np.concatenate([o[3] for o in out]), "m": np.concatenate([o[4] for o in out]).astype("int64")})
    cells = df.select(*[_present(cols[c]).alias(f"x{c}") for c in used]).mapInPandas(
        pick, "_c int, lo double, hi double, v double, m long")
    v = F.nanvl("v", F.lit(None).cast("double")).alias("v")
    return cells.groupBy("_c", "lo", "hi", v).agg(F.sum("m").alias("m"))


def _bracket(r, k: int, grid: int) -> tuple[float, float, int]:
    """(lo, hi, most values strictly between) around rank ``k``, which lies inside the sketched interval ``r``."""
    if r["n"] <= min(FINISH_ROWS, 2 * SKETCH_ACCURACY):
        return r["mn"], r["mx"], r["n"]
    i = (k - r["lt"] - r["at_lo"]) * grid // r["n"]
    g = [r["mn"], *r["g"], r["mx"]]
    return g[max(0, i - 2)], g[min(grid, i + 3)], 5 * r["n"] // grid


def _order_stats(lv: DataFrame, first: dict, targets: dict, key_type: str, grid: int, finisher=None) -> dict:
    """Exact order statistics ``(key, rank) -> value`` (ranks 0-based) of ``lv(_c, _x)``.

    ``first`` holds the sketch row of each key.  The per-target state (a few
    numbers) travels through the driver between scans, like a model fit; rows
    never do.  Intervals exclude their ends, whose rows are counted apart, so
    each cut leaves about 5 / ``grid`` of the values however often one repeats.
    ``finisher(spans)`` gives the table that ranks values inside brackets; by default it is counted from ``lv``."""
    spark = lv.sparkSession
    schema = f"_c {key_type}, k long, lo double, hi double"
    out: dict[tuple, float] = {}
    sketched = [(c, k, -INF, INF, first[c]) for c, ks in targets.items() for k in ks]
    while sketched:
        finish, again = [], []
        for c, k, lo, hi, r in sketched:
            upto_lo, upto_in = r["lt"] + r["at_lo"], r["lt"] + r["at_lo"] + r["n"]
            if k < r["lt"]:
                again.append((c, k, -INF, lo))
            elif k < upto_lo:
                out[(c, k)] = lo
            elif k >= upto_in + r["at_hi"]:
                again.append((c, k, hi, INF))
            elif k >= upto_in:
                out[(c, k)] = hi
            elif r["mn"] == r["mx"]:
                out[(c, k)] = r["mn"]
            else:
                b_lo, b_hi, values = _bracket(r, k, grid)
                (finish if values <= FINISH_ROWS or b_lo == b_hi else again).append((c, k, b_lo, b_hi))
        if finish:
            spans = sorted({(c, lo, hi) for c, _, lo, hi in finish})
            tg = spark.createDataFrame(finish, schema)
            found = _rank_inside(finisher(spans) if finisher else _counts_long(lv, tg), tg)
            for c, k, lo, hi in finish:
                below, v = found[(c, k)]
                if v is not None:
                    out[(c, k)] = v
                else:   # outside its bracket: look on that side
                    again.append((c, k, -INF, lo) if k < below else (c, k, hi, INF))
        sketched = []
        if again:
            iv = spark.createDataFrame(again, schema).select("_c", "lo", "hi").distinct()
            rows = lv.join(F.broadcast(iv), ["_c"]).where(F.col("_x") <= F.col("hi"))
            got = {(r["_c"], r["lo"], r["hi"]): r
                   for r in _sketch(rows, ["_c", "lo", "hi"], grid, F.col("lo"), F.col("hi")).collect()}
            sketched = [(c, k, lo, hi, got[(c, lo, hi)]) for c, k, lo, hi in again]
    return out


def _counts_long(lv: DataFrame, tg: DataFrame) -> DataFrame:
    """``_counts_wide`` of long values, for the brackets of ``tg``."""
    iv = tg.select("_c", "lo", "hi").distinct()
    v = F.when(F.col("_x") >= F.col("lo"), F.col("_x"))
    return (lv.join(F.broadcast(iv), ["_c"]).where(F.col("_x") <= F.col("hi"))
            .groupBy("_c", "lo", "hi", v.alias("v")).agg(F.count(F.lit(1)).alias("m")))


def _rank_inside(cnt: DataFrame, tg: DataFrame) -> dict:
    """``(key, rank) -> (rows below the bracket, value or None if the rank is outside it)`` from bracket counts."""
    w = Window.partitionBy("_c", "lo", "hi").orderBy(F.asc_nulls_first("v"))
    cum = cnt.withColumn("upto", F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    hit = F.col("v").isNotNull() & (F.col("k") >= F.col("upto") - F.col("m")) & (F.col("k") < F.col("upto"))
    rows = (cum.join(F.broadcast(tg), ["_c", "lo", "hi"]).groupBy("_c", "k")
            .agg(F.coalesce(F.max(F.when(F.col("v").isNull(), F.col("m"))), F.lit(0)).alias("below"),
                 F.max(F.when(hit, F.col("v"))).alias("v")))
    return {(r["_c"], r["k"]): (r["below"], r["v"]) for r in rows.collect()}  # one row per target


def _interp(x: float, lo_k: int, hi_k: int, v_lo: float, v_hi: float) -> float:
    return float(v_lo if (hi_k == lo_k or v_hi == v_lo) else (hi_k - x) * v_lo + (x - lo_k) * v_hi)


def _selected(lv: DataFrame, first: dict, probs: list[float], key_type: str, grid: int, finisher=None) -> dict:
    """``(key, prob index) -> quantile`` for the keys of ``first`` (their sketch rows)."""
    targets, pos = {}, {}
    for c, r in first.items():
        for pi, p in enumerate(probs):
            x = float(r["lt"] + r["at_lo"] + r["n"] + r["at_hi"] - 1) * float(p)
            pos[(c, pi)] = (x, int(math.floor(x)), int(math.ceil(x)))
            targets.setdefault(c, set()).update(pos[(c, pi)][1:])
    vals = _order_stats(lv, first, targets, key_type, grid, finisher)
    return {(c, pi): _interp(x, a, b, vals[(c, a)], vals[(c, b)]) for (c, pi), (x, a, b) in pos.items()}


def exact_quantile_values(df: DataFrame, cols: list[str], probs: list[float],
                          grid: int = GRID) -> dict[tuple[int, int], float]:
    """``(column index, prob index) -> quantile`` by distributed selection."""
    _, first = _whole_wide(df, cols, grid)
    return _selected(long_values(df, cols), first, probs, "int", grid, lambda spans: _counts_wide(df, cols, spans))


def iqr_outliers(df: DataFrame, cols: list[str], factor: float, grid: int = GRID) -> tuple[int, dict]:
    """Row count and, by column index, ``(q1, q3, lower, upper, strict outliers)``; columns without values are left out.

    Two scans: the sketches bound the quartiles, these bound where the outlier limits can lie, and the scan that
    finishes the quartiles also counts the rows below and the values inside those ranges.  A limit that turns out
    elsewhere (the sketch missed, or a bracket had to be cut again) is counted by a scan of its own."""
    n_rows, first = _whole_wide(df, cols, grid)
    ranges: dict[tuple[int, int], tuple[float, float]] = {}
    for c, r in first.items():
        ends = []
        for p in (0.25, 0.75):
            x = float(r["at_lo"] + r["n"] + r["at_hi"] - 1) * p
            inside = r["n"] > 0 and r["at_lo"] <= math.floor(x) and math.ceil(x) < r["at_lo"] + r["n"]
            ends.append([_bracket(r, k, grid) for k in (math.floor(x), math.ceil(x))] if inside else None)
        if None in ends or any(b[2] > FINISH_ROWS for e in ends for b in e):
            continue
        (a1, b1), (a3, b3) = [(min(b[0] for b in e), max(b[1] for b in e)) for e in ends]
        for side, ab in enumerate(((a1 - factor * (b3 - a1), b1 - factor * (a3 - b1)),
                                   (a3 + factor * (a3 - b1), b3 + factor * (b3 - a1)))):
            slack = 1e-9 * max(abs(v) for v in (a1, b1, a3, b3))    # interpolation rounds
            ranges[(c, side)] = (ab[0] - slack, ab[1] + slack)
    kept = []

    def finisher(spans):
        extra = [] if kept else sorted({(c, lo, hi) for (c, _), (lo, hi) in ranges.items()})
        table = cut_lineage(_counts_wide(df, cols, sorted({*spans, *extra})), "brackets")
        kept.append(table)
        return table
    qv = _selected(long_values(df, cols), first, [0.25, 0.75], "int", grid, finisher)
    limits = {}
    for c in first:
        q1, q3 = qv[(c, 0)], qv[(c, 1)]
        limits[c] = (q1, q3, q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    ask, again = [], []
    for c, (_, _, lower, upper) in limits.items():
        for side, at in ((0, lower), (1, upper)):
            lo, hi = ranges.get((c, side), (INF, -INF))
            if kept and lo <= at <= hi:
                ask.append((c, side, at, lo, hi))
            elif not math.isnan(at):
                again.append((c, side, at, at, at))
    got: dict[tuple[int, int], int] = {}
    tables = ([(kept[0], ask)] if ask else []) + \
        ([(_counts_wide(df, cols, sorted({(c, lo, hi) for c, _, _, lo, hi in again})), again)] if again else [])
    for table, rows in tables:
        lim = df.sparkSession.createDataFrame(rows, "_c int, side int, at double, lo double, hi double")
        under = F.when(F.col("v").isNull() | (F.col("v") < F.col("at")), F.col("m")).otherwise(0)
        upto = F.when(F.col("v").isNull() | (F.col("v") <= F.col("at")), F.col("m")).otherwise(0)
        for r in table.join(F.broadcast(lim), ["_c", "lo", "hi"]).groupBy("_c", "side").agg(
                F.sum(F.when(F.col("side") == 0, under).otherwise(upto)).alias("m")).collect():   # two rows per column
            got[(r["_c"], r["side"])] = r["m"]
    out = {}
    for c, four in limits.items():
        total = first[c]["at_lo"] + first[c]["n"] + first[c]["at_hi"]
        above = total - got[(c, 1)] if (c, 1) in got else 0
        out[c] = (*four, got.get((c, 0), 0) + above)
    return n_rows, out


def quantiles(df: DataFrame, cols: list[str], probs: list[float], method: str = "exact",
              accuracy: int = 100_000) -> DataFrame:
    """One row; column ``c`` holds the quantiles of ``c`` at ``probs``
    (NULL when the column has no values)."""
    if not cols:
        raise ValueError("quantiles: no columns")
    if method == "exact":
        vals = exact_quantile_values(df, cols, probs)
        row = tuple(None if (i, 0) not in vals else [vals[(i, j)] for j in range(len(probs))]
                    for i in range(len(cols)))
        schema = ", ".join(f"`{c}` array<double>" for c in cols)
        return df.sparkSession.createDataFrame([row], schema)
    q = long_values(df, cols).groupBy("_c").agg(quantile_expr("_x", probs, method, accuracy).alias("_q"))
    return q.agg(*[F.first(F.when(F.col("_c") == i, F.col("_q")), ignorenulls=True).alias(c)
                   for i, c in enumerate(cols)])


def grouped_quantiles(df: DataFrame, by: list[str], cols: list[str], probs: list[float],
                      method: str = "exact") -> DataFrame:
    """``(by..., column, _q)`` with ``_q`` the quantiles of ``column`` inside
    each group.  Exact mode runs the same bounded selection on (group, column)
    keys; it is meant for low-cardinality groups (e.g. the class label), whose
    keys travel through the driver as fit state."""
    lv = long_values(df, cols, by)
    if method != "exact":
        q = lv.groupBy(*by, "_c").agg(quantile_expr("_x", probs, method).alias("_q"))
        names = F.array(*[F.lit(c) for c in cols])
        return q.select(*by, F.element_at(names, F.col("_c") + 1).alias("column"), "_q")
    keyed = lv.select(*by, F.col("_c").alias("_ci"), F.to_json(F.struct(*by, "_c")).alias("_c"), "_x")
    first = {r["_c"]: r for r in _whole(keyed, ["_c", *by, "_ci"], GRID)}
    qv = _selected(keyed.select("_c", "_x"), first, probs, "string", GRID)
    rows = [tuple(r[b] for b in by) + (cols[r["_ci"]], [qv[(key, j)] for j in range(len(probs))])
            for key, r in first.items()]
    fields = ", ".join(f"`{b}` {df.schema[b].dataType.simpleString()}" for b in by)
    schema = (fields + ", " if fields else "") + "column string, _q array<double>"
    return df.sparkSession.createDataFrame(rows, schema)
