from shelfwise.functions.cleaning import (
    default_when_null,
    parse_date,
    title_case,
    to_double,
    to_int,
    trim_text,
)
from shelfwise.functions.measures import first_known, ratio, sum_money

__all__ = [
    "default_when_null",
    "first_known",
    "parse_date",
    "ratio",
    "sum_money",
    "title_case",
    "to_double",
    "to_int",
    "trim_text",
]
