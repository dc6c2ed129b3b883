"""Cleaning: imputation, infinity repair, de-duplication, outlier capping.

Fits are single aggregates producing one-row parameter frames, applied by a
broadcast cross join with that one row (bounded size) and one projection.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ID, INF, LABEL, is_numeric_type, nan_to_null, safe_div
from .fingerprints import SUSPECT, suspects
from .profile import OUTLIER_FACTOR, _bounds_and_counts
from .quantiles import quantiles

# Fixed value: columns whose outlier share (percent) reaches this are left as they are.
CAP_MAX_PCT = 5.0


def _numeric(df: DataFrame, exclude=(ID,)) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType) and f.name not in exclude]


def _apply_fill(df: DataFrame, params: DataFrame, cols: list[str], fill: dict[str, Column]) -> DataFrame:
    joined = df.crossJoin(F.broadcast(params))
    return joined.select(*[fill[c].alias(c) if c in fill else F.col(c) for c in df.columns])


def fit_medians(df: DataFrame, cols: list[str], method: str = "exact") -> DataFrame:
    """One row, ``{c}__med`` = median of the non-missing values of ``c``."""
    q = quantiles(df, cols, [0.5], method=method)
    return q.select(*[F.col(c)[0].alias(f"{c}__med") for c in cols])


def impute_median(df: DataFrame, cols: list[str] | None = None, method: str = "exact") -> DataFrame:
    """Numeric missing (NULL/NaN) <- column median."""
    df = nan_to_null(df)
    cols = cols or _numeric(df, exclude=(ID, LABEL))
    med = fit_medians(df, cols, method)
    return _apply_fill(df, med, cols, {c: F.coalesce(F.col(c), F.col(f"{c}__med").cast(df.schema[c].dataType))
                                        for c in cols})


def fit_modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row, ``{c}__mode`` = most frequent non-null value (smallest on ties).

    Per column: a distributed ``groupBy(value).count()`` (map-side combined,
    so a hot value costs one row per partition), then ``min_by`` over
    ``(-count, value)``, itself a partial aggregate with a one-row buffer."""
    out = None
    for c in cols:
        g = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        one = g.agg(F.min_by(F.col(c), F.struct(-F.col("_n"), F.col(c))).alias(f"{c}__mode"))
        out = one if out is None else out.crossJoin(one)
    return out


def impute_mode(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Non-numeric NULL <- column mode."""
    cols = cols or [f.name for f in df.schema.fields if not is_numeric_type(f.dataType)
                    and f.dataType.simpleString() != "boolean"]
    if not cols:
        return df
    modes = fit_modes(df, cols)
    return _apply_fill(df, modes, cols, {c: F.coalesce(F.col(c), F.col(f"{c}__mode")) for c in cols})


def replace_infinite(df: DataFrame, cols: list[str] | None = None, method: str = "exact") -> DataFrame:
    """+/-inf -> median of the finite values (always repaired, see README)."""
    cols = cols or [f.name for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")]
    nulled = df.withColumns({c: F.when(F.abs(F.col(c)) == F.lit(INF), F.lit(None).cast(df.schema[c].dataType))
                             .otherwise(F.col(c)) for c in cols})
    med = fit_medians(nulled, cols, method)
    fill = {c: F.when(F.abs(F.col(c)) == F.lit(INF), F.col(f"{c}__med")).otherwise(F.col(c)) for c in cols}
    return _apply_fill(df, med, cols, fill)


def handle_missing(df: DataFrame, method: str = "exact") -> DataFrame:
    """Median for numeric missing, mode for the rest, then infinity repair --
    only on the columns that have missing values / infinities.  A one-row
    probe (one aggregate, bounded by the column count) picks them."""
    df = nan_to_null(df)
    num = _numeric(df, exclude=(ID,))
    other = [f.name for f in df.schema.fields
             if not is_numeric_type(f.dataType) and f.dataType.simpleString() != "boolean"]
    dbl = [c for c in num if df.schema[c].dataType.simpleString() in ("double", "float")]
    probe = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(num + other)],
                   *[F.count_if(F.abs(F.col(c)) == F.lit(INF)).alias(f"i{i}") for i, c in enumerate(dbl)]).first()
    cols = num + other
    num_null = [c for i, c in enumerate(cols) if c in num and probe[f"n{i}"] > 0]
    oth_null = [c for i, c in enumerate(cols) if c in other and probe[f"n{i}"] > 0]
    inf_cols = [c for i, c in enumerate(dbl) if probe[f"i{i}"] > 0]
    out = df
    if num_null:
        out = impute_median(out, num_null, method)
    if oth_null:
        out = impute_mode(out, oth_null)
    if inf_cols:
        out = replace_infinite(out, inf_cols, method)
    return out


def drop_duplicates(df: DataFrame, cols: list[str] | None = None, key: str = ID) -> DataFrame:
    """De-duplication on ``cols`` (default all but ``key``), keeping the
    smallest ``key`` of each group (deterministic ``keep='first'``).

    Rows whose fingerprint can't repeat stay where they are; only the others are shuffled and compared on all of ``cols``."""
    cols = cols or [c for c in df.columns if c != key]
    if key not in df.columns:
        return df.dropDuplicates(cols)
    marked = suspects(df, cols)
    rest = [c for c in df.columns if c not in cols and c != key]
    kept = marked.where(SUSPECT).groupBy(*cols).agg(F.min(F.struct(key, *rest)).alias("_row")).select(*cols, "_row.*")
    return marked.where(~F.col(SUSPECT)).select(*df.columns).unionByName(kept.select(*df.columns))


def fit_caps(df: DataFrame, cols: list[str] | None = None, factor: float = OUTLIER_FACTOR,
             max_pct: float = CAP_MAX_PCT, method: str = "exact") -> DataFrame:
    """One row: bounds, outlier count and share, and whether to cap, per column."""
    cols = cols or _numeric(df, exclude=(ID, LABEL))
    one = _bounds_and_counts(df, cols, factor, method)
    extra = {}
    for c in cols:
        pct = safe_div(F.col(f"{c}__n"), F.col("_n")) * 100
        extra[f"{c}__pct"] = pct
        extra[f"{c}__cap"] = (F.col(f"{c}__n") > 0) & (pct < F.lit(max_pct))
    return one.withColumns(extra)


def cap_outliers(df: DataFrame, cols: list[str] | None = None, factor: float = OUTLIER_FACTOR,
                 max_pct: float = CAP_MAX_PCT, method: str = "exact", params: DataFrame | None = None
                 ) -> DataFrame:
    """Clamp columns whose outlier share is in (0, max_pct) to their IQR
    bounds; others stay as they are.  Booleans are not numeric: untouched."""
    cols = cols or _numeric(df, exclude=(ID, LABEL))
    p = params if params is not None else fit_caps(df, cols, factor, max_pct, method)
    joined = df.crossJoin(F.broadcast(p.select(*[x for c in cols for x in
                                                 (f"{c}__lo", f"{c}__hi", f"{c}__cap")])))

    def capped(c):
        lo, hi = F.col(f"{c}__lo"), F.col(f"{c}__hi")
        clamp = F.when(F.col(c) < lo, lo).when(F.col(c) > hi, hi).otherwise(F.col(c))
        return F.when(F.col(f"{c}__cap"), clamp.cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)

    return joined.select(*[capped(c) if c in cols else F.col(c) for c in df.columns])


def cap_report(df: DataFrame, cols: list[str] | None = None, factor: float = OUTLIER_FACTOR,
               max_pct: float = CAP_MAX_PCT, method: str = "exact") -> DataFrame:
    """``(column, ord, outlier_count, outlier_pct, lower_bound, upper_bound, action)``
    with action ``capped`` / ``skipped`` (share >= max_pct) / ``none``."""
    cols = cols or _numeric(df, exclude=(ID, LABEL))
    p = fit_caps(df, cols, factor, max_pct, method)
    return p.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("ord"), F.col(f"{c}__n").alias("outlier_count"),
                 F.col(f"{c}__pct").alias("outlier_pct"), F.col(f"{c}__lo").alias("lower_bound"),
                 F.col(f"{c}__hi").alias("upper_bound"),
                 F.when(F.col(f"{c}__cap"), F.lit("capped")).when(F.col(f"{c}__n") > 0, F.lit("skipped"))
                 .otherwise(F.lit("none")).alias("action"))
        for i, c in enumerate(cols)])))
