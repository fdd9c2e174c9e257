"""Ordered data-quality rules.

All rules are evaluated in one pass: a row is tagged with the first rule it fails, and accepted
and rejected rows are two filters over the tagged rows. No rule counts, no rule rescans the input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "dq_failure_reason"
# Tag of a row whose first unmet rule is neither true nor false, under null_policy="drop".
UNDECIDED = ""
# Reason of a row that lost to another one with its key.
DUPLICATE = "duplicate_key"


@dataclass(frozen=True)
class Rule:
    """``condition`` builds the test a good row meets; it takes the as-of date column."""

    name: str
    condition: Callable[[Column], Column]


def present(name: str, column: str) -> Rule:
    return Rule(name, lambda as_of: F.col(column).isNotNull())


def not_negative(name: str, column: str, nan_is_invalid: bool = False) -> Rule:
    if nan_is_invalid:
        return Rule(name, lambda as_of: (F.col(column) >= 0) & ~F.isnan(column))
    return Rule(name, lambda as_of: F.col(column) >= 0)


def dated_by(name: str, column: str) -> Rule:
    return Rule(name, lambda as_of: F.col(column).isNotNull() & (F.col(column) <= as_of))


def as_of_column(as_of: str | None) -> Column:
    """A fixed date, or today's when none is given."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def tag_first_failure(
    df: DataFrame, rules: Sequence[Rule], as_of: str | None = None, null_policy: str = "reject"
) -> DataFrame:
    """Add ``dq_failure_reason``: the first rule the row fails, NULL for a good row.

    ``null_policy="reject"`` counts a rule that comes out NULL as failed, so no row is lost.
    ``"drop"`` tags such a row ``UNDECIDED``: neither ``accepted`` nor ``rejected`` returns it.
    """
    if null_policy not in ("reject", "drop"):
        raise ValueError(f"unknown null_policy {null_policy!r}")
    today = as_of_column(as_of)
    marks = []
    for rule in rules:
        met = rule.condition(today)
        if null_policy == "reject":
            marks.append(F.when(~F.coalesce(met, F.lit(False)), F.lit(rule.name)))
        else:
            marks.append(F.when(met.isNull(), F.lit(UNDECIDED)).when(~met, F.lit(rule.name)))
    return df.withColumn(REASON, F.coalesce(*marks) if marks else F.lit(None).cast("string"))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON) != UNDECIDED)


def quarantine_records(tagged: DataFrame, dataset_name: str) -> DataFrame:
    """Audit rows: dataset, the cleaned row as JSON (null fields left out), first failed rule."""
    fields = [c for c in tagged.columns if c != REASON]
    return rejected(tagged).select(
        F.lit(dataset_name).alias("dataset_name"),
        F.to_json(F.struct(*fields)).alias("original_record"),
        F.col(REASON),
    )


def duplicate_records(lost: DataFrame, dataset_name: str) -> DataFrame:
    """Audit rows of what lost to another row of its key (``dedupe.losers``), with the number of copies."""
    fields = [c for c in lost.columns if c != "n_copies"]
    return lost.select(
        F.lit(dataset_name).alias("dataset_name"),
        F.to_json(F.struct(*fields)).alias("original_record"),
        F.lit(DUPLICATE).alias(REASON),
        "n_copies",
    )


def failure_summary(records: DataFrame) -> DataFrame:
    return records.groupBy("dataset_name", REASON).agg(F.count("*").alias("n_rows"))
