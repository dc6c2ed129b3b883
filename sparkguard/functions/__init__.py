from .columns import (  # noqa: F401
    FEATURE_COLS, V_COLS, LABEL, ID, numeric_columns, nan_to_null, safe_div,
    round_doubles, is_numeric_type, require_columns, INF,
)
