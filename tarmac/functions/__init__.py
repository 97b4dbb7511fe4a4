"""Column builders: JVM-side expressions, no Python UDFs."""

from tarmac.functions.metrics import (
    clipped_mean, count_where, max_where, mean_where, min_where, nan_to_null,
    rate, safe_ratio, stable_round,
)
from tarmac.functions.text import cause_label, fmt_duration, list_text, map_values

__all__ = [
    "cause_label", "clipped_mean", "count_where", "fmt_duration", "list_text", "map_values",
    "max_where", "mean_where", "min_where", "nan_to_null", "rate", "safe_ratio",
    "stable_round",
]
