"""Column builders shared by all operators.

Every builder returns a ``Column`` made of built-in Spark SQL expressions.
Casts use ``try_cast`` / ``try_to_date`` / ``try_divide`` so that results do
not depend on ``spark.sql.ansi.enabled``: a bad value becomes NULL in both
modes instead of failing the job in ANSI mode.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Iterable, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Facility key width and pad character of the CMS certification
# number, the texts that count as whole numbers, and the two date layouts of the
# source files.
CCN_WIDTH = 6
CCN_PAD = "0"
DECIMAL_PATTERN = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)\s*$"
STAFFING_DATE_FORMAT = "yyyyMMdd"
SURVEY_DATE_FORMAT = "MM/dd/yyyy"


def ccn(c: ColumnOrName) -> Column:
    """Facility key: text, trimmed of spaces, left-padded with zeros to 6.

    ``lpad`` also cuts longer strings to 6 characters and turns '' into
    '000000'; NULL stays NULL.
    """
    return F.lpad(F.trim(_col(c).cast("string")), CCN_WIDTH, CCN_PAD)


def to_double(c: ColumnOrName) -> Column:
    """Text to double; unparsable text gives NULL in every ANSI mode."""
    return _col(c).try_cast("double")


def to_int(c: ColumnOrName) -> Column:
    """Text to int with the legacy truncation of decimals ('12.7' -> 12).

    A direct ``try_cast(... as int)`` would give NULL for '12.7'; going
    through double first keeps the truncating behaviour, and values outside
    the int range become NULL. Only digits with an optional fraction count:
    the double parser would also take '12d' and '1e2'.
    """
    x = _col(c)
    return F.when(x.cast("string").rlike(DECIMAL_PATTERN), x.try_cast("double").try_cast("int"))


def hours(c: ColumnOrName) -> Column:
    """Hour value as double; missing or unparsable hours count as 0."""
    return F.coalesce(to_double(c), F.lit(0.0))


def sum_columns(cols: Iterable[ColumnOrName]) -> Column:
    """Horizontal sum of columns, left to right."""
    return reduce(add, [_col(c) for c in cols])


def parse_date(c: ColumnOrName, fmt: str) -> Column:
    """Text to date with an exact pattern; non-matching text gives NULL."""
    return F.try_to_date(_col(c), fmt)


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den when den > 0, else NULL (also when den is NULL)."""
    n, d = _col(num), _col(den)
    return F.when(d > 0, F.try_divide(n.cast("double"), d.cast("double")))


def round_half_up(c: ColumnOrName, scale: int = 2) -> Column:
    """Round a double half-up through decimal(30, 9), back to double.

    Rounding the double directly gives different answers across engines
    near .xx5 ties because of summation noise in the last bits; fixing the
    value at 9 decimals first gives one stable definition. Values that do
    not fit (NaN, infinity, 1e21 and more) are rounded as they are.
    """
    x = _col(c)
    return F.coalesce(F.round(x.try_cast("decimal(30,9)"), scale).cast("double"), F.round(x.cast("double"), scale))


def to_percent(c: ColumnOrName) -> Column:
    """Fraction to percent (x 100)."""
    return _col(c) * F.lit(100.0)


def contains_any_ci(c: ColumnOrName, patterns: Iterable[str]) -> Column:
    """True when lower(c) contains any of the patterns (LIKE '%p%')."""
    low = F.lower(_col(c))
    return reduce(lambda a, b: a | b, [low.like(f"%{p.lower()}%") for p in patterns])


def typed_null(spark_type: str) -> Column:
    return F.lit(None).cast(spark_type)


def bronze_key(prefix: Union[str, Column], file_name: ColumnOrName) -> Column:
    """Object key for a landed file: prefix without outer slashes, '/',
    base name of the file. No slash when the prefix is empty."""
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    clean_prefix = F.nullif(F.regexp_replace(p, r"^/+|/+$", ""), F.lit(""))
    base_name = F.element_at(F.split(_col(file_name), "/"), -1)
    return F.concat_ws("/", clean_prefix, base_name)


def thousands_text(c: ColumnOrName) -> Column:
    """Integer with thousands separators: 12345 -> '12,345'."""
    return F.format_number(_col(c), 0)


def fixed_text(c: ColumnOrName, decimals: int) -> Column:
    """Number with a fixed count of decimals, no separators; NULL stays
    NULL (Java's formatter would print 'null')."""
    x = _col(c)
    return F.when(x.isNotNull(), F.format_string(f"%.{decimals}f", x.cast("double")))


def percent_text(c: ColumnOrName, decimals: int = 1) -> Column:
    """Number already in percent units with a percent sign: 87.25 -> '87.3%'."""
    x = _col(c)
    return F.when(x.isNotNull(), F.format_string(f"%.{decimals}f%%", x.cast("double")))


# Severity bands of the missing-value percentage (unit is
# percent), as coloured in the profiling report.
SEVERITY_WARN_LOW = 0.0001
SEVERITY_WARN_HIGH = 0.10


def missing_severity(pct: ColumnOrName) -> Column:
    """'ok' for 0, 'warn' for 0.0001..0.10, 'bad' above 0.10 (percent)."""
    p = _col(pct)
    return (
        F.when(p == 0, F.lit("ok"))
        .when((p >= SEVERITY_WARN_LOW) & (p <= SEVERITY_WARN_HIGH), F.lit("warn"))
        .when(p > SEVERITY_WARN_HIGH, F.lit("bad"))
    )
