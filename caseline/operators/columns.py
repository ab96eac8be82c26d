"""Projection operators. All of them read the schema only and build one ``select``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField


def _require(df: DataFrame, names: Sequence[str]) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"no such column: {', '.join(absent)}")


def rename(df: DataFrame, new_by_old: Mapping[str, str]) -> DataFrame:
    _require(df, list(new_by_old))
    return df.withColumnsRenamed(dict(new_by_old))


def drop_columns(df: DataFrame, names: Sequence[str], missing_ok: bool = False) -> DataFrame:
    if not missing_ok:
        _require(df, names)
    return df.drop(*names)


def without_shared(right: DataFrame, left: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns of ``right`` that ``left`` does not have yet, and the keys."""
    return right.select(*keys, *[c for c in right.columns if c not in left.columns])


def project(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Keep exactly these columns; each is given as an expression or as a source name."""
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    )


def to_front(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """These columns first and in this order, all others after them."""
    _require(df, names)
    return df.select(*names, *[c for c in df.columns if c not in set(names)])


def map_columns(
    df: DataFrame, chosen: Callable[[StructField], bool], change: Callable[[Column], Column]
) -> DataFrame:
    """Apply ``change`` to every column whose schema field is ``chosen``; the order stays."""
    return df.withColumns({f.name: change(F.col(f"`{f.name}`")) for f in df.schema if chosen(f)})
