"""Value functions: missing values, dates and durations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseline.functions.codes import one_of


def fill_missing(value: Column, literal: object) -> Column:
    return F.coalesce(value, F.lit(literal))


def null_zero_unless(amount: Column, decision: Column, meaningful: Sequence[str]) -> Column:
    """Drop a zero amount unless the decision is one for which zero means something."""
    return F.when((amount == 0) & ~one_of(decision, meaningful), None).otherwise(amount)


def later_date(base: Column, other: Column) -> Column:
    """The later of two days when both are known, else ``base`` even if that is missing."""
    base_day, other_day = base.cast("date"), other.cast("date")
    return F.when(other_day > base_day, other_day).otherwise(base_day)


def utc_date(moment: Column) -> Column:
    """Day of a timestamp; the session time zone is UTC."""
    return moment.cast("date")


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start).cast("double")
