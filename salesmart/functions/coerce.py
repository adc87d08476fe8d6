"""Column expressions that turn raw report text into typed values.

Every function takes a column (or name) holding the landed string and
returns a built-in Spark expression, so coercion stays inside whole-stage
codegen. ANSI mode is on in Spark 4, therefore only ``try_*`` conversions
are used on raw input: a bad value becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text shapes accepted by the source system's parsers.
# A number after spaces are removed and the decimal comma becomes a point.
NUMBER_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\s*$"
# Date-time with seconds and an optional 1 to 6 digit fraction, no zone
# (the separator letter is matched without regard to case).
TIMESTAMP_PATTERN = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}[Tt]\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?$"
# Calendar date (text before the first 'T' when a time part is present).
DATE_PATTERN = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$"


def quote(name: str) -> str:
    """SQL reference to a column name (any characters)."""
    return "`" + name.replace("`", "``") + "`"


def _ref(c) -> str:
    if not isinstance(c, str):
        raise TypeError("coercions take a column name")
    return quote(c)


def empty_to_null_sql(ref: str) -> str:
    """OP-4: the empty string means "no value"."""
    return f"nullif({ref}, '')"


def to_number_sql(ref: str) -> str:
    """OP-5: numeric text -> double; spaces removed, comma -> point.

    ``try_cast`` alone accepts Java literal forms such as ``1d`` or hex
    that the source rejects, so a pattern guard runs first. JSON booleans
    (landed as ``true``/``false``) become 1.0/0.0.
    """
    cleaned = f"translate({ref}, ', ', '.')"
    return (f"CASE WHEN {ref} IS NULL OR {ref} = '' THEN CAST(NULL AS DOUBLE) "
            f"WHEN {ref} = 'true' THEN 1.0D WHEN {ref} = 'false' THEN 0.0D "
            f"WHEN {cleaned} RLIKE r'{NUMBER_PATTERN}' THEN try_cast({cleaned} AS DOUBLE) "
            f"ELSE CAST(NULL AS DOUBLE) END")


def to_timestamp_sql(ref: str) -> str:
    """OP-6: ``yyyy-MM-ddTHH:mm:ss[.ffffff]`` -> timestamp without zone.

    The shape check rejects zones, 7+ fraction digits and partial values;
    the cast (Spark's own string parser, no formatter) rejects impossible
    dates and times.
    """
    return (f"CASE WHEN {ref} RLIKE r'{TIMESTAMP_PATTERN}' THEN try_cast(replace({ref}, 't', 'T') AS TIMESTAMP_NTZ) "
            f"ELSE CAST(NULL AS TIMESTAMP_NTZ) END")


def to_date_sql(ref: str) -> str:
    """OP-7: date from the text before the first ``T``; anything else -> null."""
    head = f"substring_index({ref}, 'T', 1)"
    return f"CASE WHEN {head} RLIKE r'{DATE_PATTERN}' THEN try_cast({head} AS DATE) ELSE CAST(NULL AS DATE) END"


def empty_to_null(c) -> Column:
    return F.expr(empty_to_null_sql(_ref(c)))


def to_number(c) -> Column:
    return F.expr(to_number_sql(_ref(c)))


def to_timestamp(c) -> Column:
    return F.expr(to_timestamp_sql(_ref(c)))


def to_date(c) -> Column:
    return F.expr(to_date_sql(_ref(c)))


SQL_BY_KIND = {"number": to_number_sql, "timestamp": to_timestamp_sql, "date": to_date_sql,
               "string": empty_to_null_sql}


def coerce_sql(name: str, kind: str) -> str:
    """Dispatch by mart column kind: ``number``, ``timestamp``, ``date`` or ``string``."""
    return SQL_BY_KIND.get(kind, empty_to_null_sql)(quote(name))


def coerce(c, kind: str) -> Column:
    return F.expr(coerce_sql(c, kind))
