"""Column expressions that turn landing text into typed values.

Dirty text never fails a job: what cannot be read becomes NULL, with ANSI mode on or off and
without touching the session configuration. Every function is a built-in expression, so a clean
step stays one narrow stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The texts accepted as a whole or decimal number, the usual shape of a date, and the
# texts accepted as a year-month-day date.
NUMBER_TEXT = r"^\s*[+-]?\d*\.?\d*\s*$"
PLAIN_DATE = "____-__-__"
DATE_TEXT = r"(?s)^\s*(\d{1,4})-0*(\d{1,2})-0*(\d{1,2})(?!\d).*$|^.*$"


def trim_text(column: Column, blank_is_null: bool = False) -> Column:
    """Strip spaces (U+0020 only). ``''`` stays ``''`` unless ``blank_is_null``."""
    trimmed = F.trim(column)
    return F.nullif(trimmed, F.lit("")) if blank_is_null else trimmed


def title_case(column: Column) -> Column:
    return F.initcap(column)


def to_int(column: Column, source_type: T.DataType | None = None) -> Column:
    """Read a whole number; ``12.5`` gives 12, exponents, suffixes and overflow give NULL."""
    if source_type is not None and not isinstance(source_type, T.StringType):
        return column.try_cast("int")
    return F.when(column.rlike(NUMBER_TEXT), column.try_cast("double").try_cast("int"))


def to_double(column: Column) -> Column:
    return column.try_cast("double")


def default_when_null(column: Column, parsed: Column, default) -> Column:
    """``default`` where the raw value is missing; unreadable text stays NULL."""
    return F.when(column.isNull(), F.lit(default)).otherwise(parsed)


def parse_date(column: Column, source_type: T.DataType | None = None) -> Column:
    """Read ``y-m-d`` leniently: short parts, extra zeros and trailing text are accepted.

    One regular-expression pass rewrites the text to ``000y-m-d`` (the cast takes up to seven year
    digits); text of any other shape collapses to ``000--``, which casts to NULL. Most text is of the plain
    shape, and where the cast reads that, it reads the same date: only the rest meets the expression.
    """
    if source_type is not None and not isinstance(source_type, T.StringType):
        return column.try_cast("date")
    plain = F.when(column.like(PLAIN_DATE), column.try_cast("date"))
    return F.coalesce(plain, F.regexp_replace(column, DATE_TEXT, "000$1-$2-$3").try_cast("date"))
