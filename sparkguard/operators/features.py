"""Feature engineering: narrow projections, fused into one codegen'd stage."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import LABEL

# Day-period labels (in category order), right edges of the
# closed-right bins [0,6], (6,12], (12,18], (18,24], and the dummy prefix.
DAY_PERIODS = ["Madrugada", "Mañana", "Tarde", "Noche"]
DAY_PERIOD_EDGES = [0.0, 6.0, 12.0, 18.0, 24.0]
PERIOD_PREFIX = "Period_"
SECONDS_PER_HOUR = 3600.0
HOURS_PER_DAY = 24.0


def amount_log(amount: Column) -> Column:
    return F.log1p(amount)


def hour_of_day(time_s: Column) -> Column:
    """Non-negative (time / 3600) mod 24."""
    return F.pmod(time_s / F.lit(SECONDS_PER_HOUR), F.lit(HOURS_PER_DAY))


def day_period(hour: Column) -> Column:
    """Right-closed bins, lowest edge included; outside [0, 24] -> NULL."""
    e = DAY_PERIOD_EDGES
    expr = F.when((hour >= e[0]) & (hour <= e[1]), F.lit(DAY_PERIODS[0]))
    for i in range(1, len(DAY_PERIODS)):
        expr = expr.when((hour > e[i]) & (hour <= e[i + 1]), F.lit(DAY_PERIODS[i]))
    return expr


def period_dummy_names() -> list[str]:
    return [f"{PERIOD_PREFIX}{p}" for p in DAY_PERIODS]


def transform_features(df: DataFrame) -> DataFrame:
    """Add Amount_Log, Hour, Day_Period, V1_V2, V1_V3, V2_V3, V14_Sq, V17_Sq,
    PCA_Dist and the four Period_* booleans, each only if its inputs exist."""
    cols = set(df.columns)
    new: dict[str, Column] = {}
    if "Amount" in cols:
        new["Amount_Log"] = amount_log(F.col("Amount"))
    if "Time" in cols:
        new["Hour"] = hour_of_day(F.col("Time"))
        new["Day_Period"] = day_period(hour_of_day(F.col("Time")))
    if {"V1", "V2", "V3"} <= cols:
        new["V1_V2"] = F.col("V1") * F.col("V2")
        new["V1_V3"] = F.col("V1") * F.col("V3")
        new["V2_V3"] = F.col("V2") * F.col("V3")
    if {"V14", "V17"} <= cols:
        new["V14_Sq"] = F.col("V14") * F.col("V14")
        new["V17_Sq"] = F.col("V17") * F.col("V17")
    if {"V1", "V2", "V3", "V4", "V5"} <= cols:
        new["PCA_Dist"] = F.sqrt(sum((F.col(f"V{i}") * F.col(f"V{i}") for i in range(1, 6)), F.lit(0.0)))
    if "Time" in cols:
        dp = day_period(hour_of_day(F.col("Time")))
        for p, name in zip(DAY_PERIODS, period_dummy_names()):
            new[name] = F.coalesce(dp == F.lit(p), F.lit(False))
    return df.withColumns(new)


def new_feature_list(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns of ``after`` that are not in ``before`` (in ``after`` order)."""
    old = set(before.columns)
    return [c for c in after.columns if c not in old]


def one_hot(df: DataFrame, col: str, levels: list[str], prefix: str | None = None,
            drop_source: bool = True) -> DataFrame:
    """Boolean one-hot over a fixed level list (no level dropped)."""
    prefix = col if prefix is None else prefix
    out = df.withColumns({f"{prefix}_{lv}": F.coalesce(F.col(col) == F.lit(lv), F.lit(False)) for lv in levels})
    return out.drop(col) if drop_source else out


def categorical_levels(df: DataFrame, col: str, max_levels: int = 1000) -> list[str]:
    """Distinct levels of a categorical column, sorted; the output schema
    depends on them, so they are fetched (bounded: error above ``max_levels``)."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"{col}: more than {max_levels} levels; not a categorical column")
    return sorted(r[0] for r in rows)


def one_hot_categoricals(df: DataFrame, levels: dict[str, list[str]] | None = None,
                         max_levels: int = 1000, exclude: tuple[str, ...] = ("split",)) -> DataFrame:
    """One-hot every string column (known levels used as given, e.g. the day
    periods; others fetched with a bound)."""
    levels = dict(levels or {})
    if "Day_Period" in df.columns:
        levels.setdefault("Day_Period", DAY_PERIODS)
    out = df
    for f in df.schema.fields:
        if f.dataType.simpleString() == "string" and f.name not in exclude:
            lv = levels.get(f.name) or categorical_levels(df, f.name, max_levels)
            out = one_hot(out, f.name, lv)
    return out


def align_columns(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep the columns common to both, in ``train`` order (stable order)."""
    common = [c for c in train.columns if c in set(test.columns)]
    return train.select(*common), test.select(*common)


def drop_target(df: DataFrame, label: str = LABEL) -> DataFrame:
    if label not in df.columns:
        raise ValueError(f"column {label!r} is not present")
    return df.drop(label)
