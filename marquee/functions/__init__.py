"""Column expressions shared by the operators (all JVM-side, no UDF)."""

from marquee.functions.columns import (  # noqa: F401
    joined_names, joined_strings, role_names, size_or_zero,
    nonzero, placeholder_to_null, empty_to_null,
    profit, roi, category, non_null_count, to_whole, to_finite, exact_avg, exact_sum,
)
