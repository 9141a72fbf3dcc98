"""Column-expression builders; all run JVM-side inside whole-stage codegen."""

from staffwise.functions.columns import (  # noqa: F401
    bronze_key,
    ccn,
    contains_any_ci,
    hours,
    missing_severity,
    parse_date,
    percent_text,
    round_half_up,
    safe_ratio,
    sum_columns,
    thousands_text,
    to_double,
    to_int,
    to_percent,
    fixed_text,
    typed_null,
)
