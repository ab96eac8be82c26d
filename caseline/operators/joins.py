"""Joins: by-case assembly, guarded decodes, profile joins and row-count checks.

No join is forced to broadcast here. A small lookup is broadcast by Spark's own size estimate or
after ``bounded`` has measured it; everything else stays a shuffle join, whose hot keys adaptive
execution splits.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseline.operators.columns import without_shared


def bounded(lookup: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Mark a lookup for broadcast if measuring it proves it small; return it unchanged if not.

    The measurement reads at most ``max_rows + 1`` rows.
    """
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in lookup.columns), F.lit(16))
    size = lookup.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    small = size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes
    return F.broadcast(lookup) if small else lookup


def left_by_key(base: DataFrame, key: str, *others: DataFrame, drop_shared: bool = False) -> DataFrame:
    """Left-join tables that hold one row per key. They share one partitioning on the key."""
    for other in others:
        base = base.join(without_shared(other, base, [key]) if drop_shared else other, key, "left")
    return base


def inner_by_key(base: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Inner join that adds only the columns ``base`` lacks."""
    return base.join(without_shared(other, base, [key]), key, "inner")


def inner_join_report(base: DataFrame, other: DataFrame, key: str, warn_above: float = 0.01) -> DataFrame:
    """What an inner join keeps and drops: one row with counts, dropped share and level."""
    hits = other.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_hits"))
    counts = base.select(key).join(hits, key, "left").agg(
        F.count(F.lit(1)).alias("n_before"), F.coalesce(F.sum("_hits"), F.lit(0)).alias("n_after")
    )
    share = F.coalesce((F.col("n_before") - F.col("n_after")) / F.nullif(F.col("n_before"), F.lit(0)), F.lit(0.0))
    return counts.select(
        "n_before",
        "n_after",
        (F.col("n_before") - F.col("n_after")).alias("n_dropped"),
        share.alias("fraction_dropped"),
        F.when(share > warn_above, "warn").otherwise("pass").alias("level"),
    )


def one_row_per_key(
    lookup: DataFrame, keys: Sequence[str], values: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Lookup with one row per key, its values as ``_v0..``, keys as ``_k0..`` and a row count ``_rows``."""
    if not null_safe:
        for k in keys:
            lookup = lookup.where(F.col(k).isNotNull())
    renamed = lookup.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.struct(*[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)]).alias("_row"),
    )
    return (
        renamed.groupBy(*[f"_k{i}" for i in range(len(keys))])
        .agg(F.min("_row").alias("_row"), F.count(F.lit(1)).alias("_rows"))
        .select(*[f"_k{i}" for i in range(len(keys))], "_row.*", "_rows")
    )


def many_to_one(
    base: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    null_safe: bool = False,
) -> DataFrame:
    """Left join that never changes the row count.

    ``on`` is ``{base column: lookup key}`` and ``take`` is ``{output: lookup value}``. A base row
    that would match more than one lookup row raises an error when its value is read; duplicate
    keys nobody uses are harmless. ``null_safe`` lets a missing key match a missing key.
    """
    right = one_row_per_key(lookup, list(on.values()), list(take.values()), null_safe)
    return _attach(base, right, list(on), [(0, list(take))], null_safe)


def _attach(
    base: DataFrame, right: DataFrame, lefts: Sequence[str], uses: Sequence[tuple[int, Sequence[str]]], null_safe: bool
) -> DataFrame:
    """Join a prepared lookup once per use, ``(place of its first left column, outputs)``, then read all values."""
    n_keys = sum(1 for c in right.columns if c.startswith("_k"))
    outputs, helpers = [], []
    for use, (at, names) in enumerate(uses):
        mine = {c: f"{c}_{use}" for c in right.columns}
        keys = lefts[at : at + n_keys]
        condition = [
            F.col(left).eqNullSafe(F.col(f"_k{i}_{use}")) if null_safe else F.col(left) == F.col(f"_k{i}_{use}")
            for i, left in enumerate(keys)
        ]
        message = F.concat_ws(
            " ", F.lit("more than one lookup row for"), *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys]
        )
        base = base.drop(*names) if set(names) & set(base.columns) else base
        base = base.join(right.withColumnsRenamed(mine), condition, "left")
        helpers += mine.values()
        for i, name in enumerate(names):
            value = F.when(F.col(f"_rows_{use}") > 1, F.raise_error(message)).otherwise(F.col(f"_v{i}_{use}"))
            outputs.append(value.alias(name))
    return base.select("*", *outputs).drop(*helpers)


def decode(
    base: DataFrame,
    lookup: DataFrame,
    key: str,
    value: str,
    columns: Mapping[str, str],
    label: Callable[[Column], Column] | None = None,
    measure: bool = False,
) -> DataFrame:
    """Decode several code columns, ``{code column: output}``, with one lookup.

    Each decode reads the same prepared lookup, so its broadcast is built once. ``label`` reshapes
    the value on the lookup side, once per code instead of once per row. ``measure`` runs
    ``bounded`` on the lookup first.
    """
    source = lookup.select(F.col(key).alias("_key"), (label(F.col(value)) if label else F.col(value)).alias("_value"))
    right = one_row_per_key(source, ["_key"], ["_value"])
    if measure:
        right = bounded(right)
    return _attach(base, right, list(columns), [(i, [out]) for i, out in enumerate(columns.values())], False)


def unique_keys_only(lookup: DataFrame, key: str) -> DataFrame:
    """Lookup rows whose key occurs once; ambiguous keys cannot be resolved."""
    rest = [c for c in lookup.columns if c != key]
    counted = lookup.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_rows")
    )
    return counted.where("_rows = 1").select(key, "_row.*").select(*lookup.columns)


def join_profiles(new: DataFrame, old: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join of two profiles; all other columns get ``_new`` and ``_old`` suffixes."""
    def suffixed(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(*on, *[F.col(c).alias(c + suffix) for c in df.columns if c not in on])

    return suffixed(new, "_new").join(suffixed(old, "_old"), list(on), "inner")


def row_count_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Expected and actual row count of a step that must keep its rows."""
    expected = before.agg(F.count(F.lit(1)).alias("expected"))
    return after.agg(F.count(F.lit(1)).alias("actual")).select(
        expected.scalar().alias("expected"),
        "actual",
        (F.col("actual") == expected.scalar()).alias("matches"),
    )


def require_row_count(before: DataFrame, after: DataFrame) -> None:
    row = row_count_report(before, after).first()
    if not row["matches"]:
        raise ValueError(f"expected {row['expected']} rows, got {row['actual']}")


def duplicate_keys(lookups: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Keys that occur more than once in their lookup, for all lookups at once: lookup, key and lines.

    ``lookups`` maps a name to a table and its key columns. Rows whose key has a missing part can't be
    matched by a plain join and don't count. The tables are reduced to their keys and united, so one
    aggregation checks them all, whatever columns a later plan reads.
    """
    keys = None
    for name, (lookup, columns) in lookups.items():
        known = lookup.dropna(subset=list(columns)).select(
            F.lit(name).alias("lookup"), F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).alias("key")
        )
        keys = known if keys is None else keys.unionByName(known)
    return keys.groupBy("lookup", "key").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1")


def used_duplicates(duplicates: DataFrame, base: DataFrame, uses: Sequence[tuple[str, str]]) -> DataFrame:
    """Duplicate keys that code columns of ``base`` use: lookup, key, lines and the rows that use them.

    ``uses`` lists (lookup, code column). The rows are reduced to counted codes before the join.
    """
    cells = [F.struct(F.lit(lookup).alias("lookup"), F.col(c).cast("string").alias("key")) for lookup, c in uses]
    used = base.select(F.inline(F.array(*cells))).where(F.col("key").isNotNull()).groupBy("lookup", "key").agg(F.count(F.lit(1)).alias("rows"))
    return duplicates.join(used, ["lookup", "key"])
