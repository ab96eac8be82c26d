"""Collapse many rows per key to one row, in a given order.

Every operator here shrinks groups before the shuffle, so a key that holds a large part of the
table costs no more than another one. First and last are ``min``/``max`` over a struct whose
leading fields are the order; first-N is a ``row_number`` filter, for which Spark puts a per-key
limit in front of the exchange. No list of a group's rows is ever collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OrderItem = str | Column


def _column(item: OrderItem) -> Column:
    return F.col(item) if isinstance(item, str) else item


def order_fields(order: Sequence[OrderItem], nulls: str = "last") -> list[Column]:
    """Fields whose struct comparison sorts ascending with missing values last or first.

    Struct comparison itself puts NULL first; a leading is-NULL flag moves it to the end.
    """
    if nulls not in ("last", "first"):
        raise ValueError("nulls must be 'last' or 'first'")
    fields = []
    for i, item in enumerate(order):
        column = _column(item)
        if nulls == "last":
            fields.append(column.isNull().alias(f"_n{i}"))
        fields.append(column.alias(f"_o{i}"))
    return fields


def sort_columns(order: Sequence[OrderItem], nulls: str = "last") -> list[Column]:
    """The same order for a window or an ``orderBy``."""
    if nulls == "last":
        return [_column(c).asc_nulls_last() for c in order]
    return [_column(c).asc_nulls_first() for c in order]


def _payload(columns: Mapping[str, OrderItem]) -> list[Column]:
    return [_column(source).alias(f"_p{i}") for i, source in enumerate(columns.values())]


def _unpack(struct: str, columns: Mapping[str, OrderItem]) -> list[Column]:
    return [F.col(f"{struct}._p{i}").alias(name) for i, name in enumerate(columns)]


def collapse_ends(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[OrderItem],
    first: Mapping[str, OrderItem] | None = None,
    last: Mapping[str, OrderItem] | None = None,
    nulls: str = "last",
    constant: str | None = None,
) -> DataFrame:
    """First and last row of each key, as ``{output: source}`` columns. Missing values count.

    ``constant`` names a column that must have one distinct value in the group, a missing value
    counting as a value; other groups are dropped. Checking it inside this aggregation saves the
    second pass that filtering the rows beforehand would take.
    """
    first, last = first or {}, last or {}
    by = order_fields(order, nulls)
    aggregates = []
    if first:
        aggregates.append(F.min(F.struct(*by, *_payload(first))).alias("_first"))
    if last:
        aggregates.append(F.max(F.struct(*by, *_payload(last))).alias("_last"))
    if constant:
        aggregates.append(_is_constant(F.col(constant)).alias("_constant"))
    out = df.groupBy(*keys).agg(*aggregates)
    if constant:
        out = out.where("_constant")
    return out.select(*keys, *_unpack("_first", first), *_unpack("_last", last))


def _is_constant(column: Column) -> Column:
    present = F.count(column)
    return (present == 0) | ((present == F.count(F.lit(1))) & (F.min(column) == F.max(column)))


def keep_constant_groups(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows of the groups in which ``column`` has one distinct value, missing counting as one.

    The mixed groups are found by a pre-aggregated count and removed by an anti join, which
    splits a hot key; a window would bring each whole group into one task.
    """
    mixed = df.groupBy(*keys).agg(_is_constant(F.col(column)).alias("_constant")).where("not _constant")
    marks = mixed.select(*[F.col(k).alias(f"_mixed{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_mixed{i}")) for i, k in enumerate(keys)]
    return df.join(marks, same, "left_anti")


def _first_rows(
    df: DataFrame, keys: Sequence[str], by: Sequence[Column], n: int, payload: Sequence[Column]
) -> DataFrame:
    # The payload breaks ties, so a retried task picks the same rows.
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*by, F.struct(*payload)))
    ranked = df.withColumn("_place", place).where(F.col("_place") <= n)
    return ranked.select(*keys, "_place", F.struct(*payload).alias("_row"))


def _pick(place: int) -> Column:
    return F.max(F.when(F.col("_place") == place, F.col("_row"))).alias(f"_row{place}")


def first_n_wide(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[OrderItem],
    n: int,
    columns: Mapping[str, OrderItem],
    nulls: str = "last",
) -> DataFrame:
    """The first ``n`` rows of each key side by side: output ``{name}_{1..n}``, padded with NULL."""
    rows = _first_rows(df, keys, sort_columns(order, nulls), n, _payload(columns))
    wide = rows.groupBy(*keys).agg(*[_pick(i) for i in range(1, n + 1)])
    return wide.select(
        *keys,
        *[
            F.col(f"_row{i}._p{j}").alias(f"{name}_{i}")
            for j, name in enumerate(columns)
            for i in range(1, n + 1)
        ],
    )


def first_second_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[OrderItem],
    columns: Mapping[str, OrderItem],
    nulls: str = "last",
) -> DataFrame:
    """First, second and last row of each key; the second is NULL for a single row.

    Two reads of the input, each shuffled only after its rows shrink to at most two per key and
    task. Both sides arrive hashed on the key, so merging them needs no further exchange.
    """
    payload = _payload(columns)
    head = _first_rows(df, keys, sort_columns(order, nulls), 2, payload)
    tail = df.groupBy(*keys).agg(
        F.max(F.struct(*order_fields(order, nulls), F.struct(*payload).alias("_row"))).alias("_last")
    )
    tail = tail.select(*keys, F.lit(-1).alias("_place"), F.col("_last._row").alias("_row"))
    merged = head.unionByName(tail).groupBy(*keys).agg(_pick(1), _pick(2), _pick(-1).alias("_row_last"))
    places = {"first": "_row1", "second": "_row2", "last": "_row_last"}
    return merged.select(
        *keys,
        *[
            F.col(f"{row}._p{j}").alias(f"{name}_{place}")
            for place, row in places.items()
            for j, name in enumerate(columns)
        ],
    )


def last_per_code(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[OrderItem],
    code: str,
    value: str,
    outputs: Mapping[str, str],
    nulls: str = "first",
) -> DataFrame:
    """Last ``value`` among a key's rows of each ``code``; ``outputs`` is ``{output: code}``.

    Keys without a row of the code get NULL, and so do keys whose last such value is missing.
    """
    entry = F.struct(*order_fields(order, nulls), F.col(value).alias("_value"))
    aggregates = [
        F.max(F.when(F.col(code) == wanted, entry)).alias(f"_last{i}") for i, wanted in enumerate(outputs.values())
    ]
    return (
        df.groupBy(*keys)
        .agg(*aggregates)
        .select(*keys, *[F.col(f"_last{i}._value").alias(name) for i, name in enumerate(outputs)])
    )


def distinct_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[OrderItem], nulls: str = "last"
) -> DataFrame:
    """One whole row per distinct key, the first by ``order``.

    Where the order is the only other column, its smallest value is the row; unlike a struct, a number needs no sort
    to be aggregated.
    """
    rest = {c: c for c in df.columns if c not in keys}
    if nulls == "last" and len(rest) == len(order) == 1 and isinstance(order[0], str) and order[0] in rest:
        return df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in rest]).select(*df.columns)
    kept = collapse_ends(df, keys, order, first=rest, nulls=nulls)
    return kept.select(*df.columns)


def top_by_weight(
    df: DataFrame, keys: Sequence[str], weight: str, tie: Sequence[str], columns: Mapping[str, OrderItem]
) -> DataFrame:
    """Row with the largest weight per key; equal weights go to the smallest tie columns."""
    order = [-F.col(weight), *tie]
    return collapse_ends(df, keys, order, first=columns)
