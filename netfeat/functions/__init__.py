"""Column expressions (all JVM-side built-ins, so whole-stage codegen holds)."""

from netfeat.functions.columns import (
    country_flag,
    lookback_date,
    month_index,
    prefix_flag,
    safe_ratio,
    strip_text,
    valid_id,
)

__all__ = [
    "country_flag",
    "lookback_date",
    "month_index",
    "prefix_flag",
    "safe_ratio",
    "strip_text",
    "valid_id",
]
