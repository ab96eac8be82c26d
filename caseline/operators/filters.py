"""Row filters. Plain predicates, so they reach the scan and pass below left joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseline.functions.codes import one_of


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is missing."""
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def in_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.where(one_of(F.col(column), values))


def cohort(df: DataFrame, start: str, not_before: str, code: str, codes: Sequence[str]) -> DataFrame:
    """Cases that started on or after a day and have one of the wanted types."""
    on_time = F.col(start) >= F.lit(not_before).cast("date")
    return df.where(F.col(start).isNotNull() & on_time & F.col(code).isin(list(codes)))
