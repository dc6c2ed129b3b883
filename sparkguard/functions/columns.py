"""Column-level helpers shared by every operator (all JVM-side expressions)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the transaction data model.
LABEL = "Class"
ID = "id"
V_COLS = [f"V{i}" for i in range(1, 29)]
FEATURE_COLS = ["Time", *V_COLS, "Amount"]
INF = float("inf")

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, _NUMERIC)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    """Numeric columns in source order (booleans are not numeric)."""
    return [f.name for f in df.schema.fields
            if is_numeric_type(f.dataType) and f.name not in exclude]


def require_columns(df: DataFrame, cols, what: str = "operator") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN -> NULL on floating columns, so NaN counts as missing (NULL and NaN
    are distinct in Spark, one value in pandas)."""
    float_cols = {f.name for f in df.schema.fields
                  if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    targets = [c for c in (cols or df.columns) if c in float_cols]
    if not targets:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType))
                           for c in targets})


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero denominator (ANSI mode raises)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def rounded(c: Column, digits: int) -> Column:
    """``F.round`` of a double, without its decimal arithmetic where plain doubles give the same: a value that is not near the
    middle of two multiples goes to the nearest one, and a whole number by a power of ten is the double that a decimal becomes."""
    x = c * F.lit(10.0 ** digits)
    n = F.rint(x)
    plain = (F.abs(x) < F.lit(1e11)) & (F.abs(x - n) < F.lit(0.499))      # false for NaN and infinities
    return F.when(plain, n / F.lit(10.0 ** digits) + F.lit(0.0)).otherwise(F.round(c, digits))     # -0.0 becomes 0.0


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for engine-independent comparison)."""
    return df.withColumns({f.name: rounded(F.col(f.name), digits) if isinstance(f.dataType, T.DoubleType) else F.round(F.col(f.name), digits)
                           for f in df.schema.fields
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})
