"""Profiles, label codes and the comparison of two releases.

Every profile is one aggregation over the table; the long form comes from unfolding its single row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseline.operators.joins import bounded, join_profiles
from caseline.session import cut_lineage

ROW_GROWTH_MIN_PCT = 0.01
RECENCY_TOLERANCE_DAYS = 7
MISSING_SHIFT = 0.02
MEAN_SHIFT = 0.05


def global_stats(df: DataFrame, **aggregates: Column) -> DataFrame:
    """One row of named aggregates over the whole table."""
    return df.agg(*[c.alias(name) for name, c in aggregates.items()])


def _unfold(wide: DataFrame, entries: Sequence[Column]) -> DataFrame:
    return wide.select(F.inline(F.array(*entries)))


def missingness(df: DataFrame) -> DataFrame:
    """Share of missing values per column, largest first."""
    names = df.columns
    wide = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("int")).alias(f"m{i}") for i, c in enumerate(names)])
    entries = [
        F.struct(F.lit(c).alias("variable"), F.col(f"m{i}").alias("prop_missing")) for i, c in enumerate(names)
    ]
    return _unfold(wide, entries).orderBy(F.desc("prop_missing"), "variable")


def kind_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, T.BooleanType):
        return "logical"
    if isinstance(data_type, T.DateType):
        return "Date"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "POSIXct"
    return "character"


def column_profile(df: DataFrame) -> DataFrame:
    """Type, completeness and the statistics of its type for every column.

    ``mean`` covers numbers and flags, ``sd`` numbers, ``low`` and ``high`` numbers, the date
    columns days, and the length columns text.
    """
    aggregates, entries = [F.count(F.lit(1)).alias("n")], []
    for i, field in enumerate(df.schema):
        c, kind = F.col(f"`{field.name}`"), kind_of(field.dataType)
        stats = {"present": F.count(c)}
        if kind == "numeric":
            stats |= {"mean": F.avg(c), "sd": F.stddev_samp(c.cast("double")), "low": F.min(c), "high": F.max(c)}
        elif kind == "logical":
            stats |= {"mean": F.avg(c.cast("int"))}
        elif kind in ("Date", "POSIXct"):
            stats |= {"date_min": F.min(c).cast("date"), "date_max": F.max(c).cast("date")}
        else:
            stats |= {"length_min": F.min(F.length(c)), "length_max": F.max(F.length(c)), "empty": F.count_if(c == "")}
        aggregates += [value.alias(f"{name}_{i}") for name, value in stats.items()]

        def got(name: str, as_type: str) -> Column:
            value = F.col(f"{name}_{i}") if name in stats else F.lit(None)
            return value.cast(as_type).alias(name)

        present = F.col(f"present_{i}")
        entries.append(
            F.struct(
                F.lit(kind).alias("kind"),
                F.lit(field.name).alias("variable"),
                (F.col("n") - present).alias("n_missing"),
                (present / F.nullif(F.col("n"), F.lit(0))).alias("complete_rate"),
                *[got(x, "double") for x in ("mean", "sd", "low", "high")],
                *[got(x, "date") for x in ("date_min", "date_max")],
                *[got(x, "long") for x in ("length_min", "length_max", "empty")],
            )
        )
    return _unfold(df.agg(*aggregates), entries)


def distributions(df: DataFrame) -> DataFrame:
    """Distinct values, blanks, flag counts, quartiles and the median day of every column.

    Quartiles interpolate between neighbours; the median day is the floor of that. Timestamps count by
    day. Blank text has no character but white space. A table without rows has no lines.

    Equal values are counted first. The counted values are range-partitioned and ranked by their place
    within a partition and the counts of earlier partitions, so no task holds a whole column.
    """
    entries = []
    for field in df.schema:
        c, kind = F.col(f"`{field.name}`"), kind_of(field.dataType)
        number = {
            "numeric": lambda: c.cast("double"),
            "logical": lambda: c.cast("int").cast("double"),
            "Date": lambda: F.unix_date(c).cast("double"),
            "POSIXct": lambda: F.unix_date(c.cast("date")).cast("double"),
        }.get(kind, lambda: F.lit(None).cast("double"))()
        text = c.cast("string") if kind == "character" else F.lit(None).cast("string")
        entries.append(
            F.struct(F.lit(kind).alias("kind"), F.lit(field.name).alias("variable"), number.alias("number"), text.alias("text"))
        )
    counted = df.select(F.inline(F.array(*entries))).groupBy("kind", "variable", "number", "text").agg(F.count(F.lit(1)).alias("n"))
    ranged = counted.repartitionByRange("variable", "number", F.xxhash64("text")).withColumn("_part", F.spark_partition_id())
    ranked_n = F.when(F.col("number").isNotNull(), F.col("n")).otherwise(0)
    placed = cut_lineage(ranged.withColumn("_n", ranked_n))
    sizes = placed.groupBy("variable", "_part").agg(F.sum("_n").alias("_size"))
    column = Window.partitionBy("variable")
    earlier = column.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "variable", "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"), F.sum("_size").over(column).alias("_total")
    )
    here = Window.partitionBy("variable", "_part").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.withColumn("_upto", F.sum("_n").over(here)).join(bounded(offsets), ["variable", "_part"])
    upto = F.col("_upto") + F.col("_offset")

    def quantile(share: float) -> Column:
        at = (F.col("_total") - 1) * F.lit(share)
        low, high = (F.min(F.when((F.col("_n") > 0) & (upto > side(at)), F.col("number"))) for side in (F.floor, F.ceil))
        return low + (high - low) * F.max(at - F.floor(at))

    present = F.col("number").isNotNull() | F.col("text").isNotNull()
    flag = lambda value: F.sum(F.when((F.col("kind") == "logical") & (F.col("number") == value), F.col("n")))
    stats = ranked.groupBy("kind", "variable").agg(
        F.count_if(present).alias("n_distinct"),
        F.sum(F.when(~F.col("text").rlike(r"\S"), F.col("n"))).alias("n_blank"),
        flag(1).alias("n_true"),
        flag(0).alias("n_false"),
        *[quantile(share).alias(f"_q{i}") for i, share in enumerate((0.25, 0.5, 0.75))],
    )
    only = lambda kind, value: F.when(F.col("kind") == kind, value)
    return stats.select(
        "kind",
        "variable",
        "n_distinct",
        only("character", F.coalesce("n_blank", F.lit(0))).alias("n_blank"),
        only("logical", F.coalesce("n_true", F.lit(0))).alias("n_true"),
        only("logical", F.coalesce("n_false", F.lit(0))).alias("n_false"),
        *[only("numeric", F.col(f"_q{i}")).alias(name) for i, name in enumerate(("q25", "median", "q75"))],
        F.when(F.col("kind").isin("Date", "POSIXct"), F.date_from_unix_date(F.floor("_q1").cast("int"))).alias("date_median"),
    )


def combined_profile(new: DataFrame, old: DataFrame) -> DataFrame:
    """Both profiles under each other, marked by release. Each release is profiled on its own."""
    mark = lambda df, release: df.withColumn("release", F.lit(release))
    return mark(column_profile(old), "old").unionByName(mark(column_profile(new), "new"), allowMissingColumns=True)


def drift_flags(new_profile: DataFrame, old_profile: DataFrame) -> DataFrame:
    """Columns whose missing share, mean or latest date moved, with the reasons as text."""
    both = join_profiles(new_profile, old_profile, ["kind", "variable"])
    missing_shift = (1 - F.col("complete_rate_new")) - (1 - F.col("complete_rate_old"))
    mean_shift = (F.col("mean_new") - F.col("mean_old")) / F.nullif(F.col("mean_old"), F.lit(0.0))
    reasons = [
        F.when(F.abs(missing_shift) >= MISSING_SHIFT, F.format_string("missing %+.1fpp", 100 * missing_shift)),
        F.when(
            (F.col("kind") == "numeric") & (F.abs(mean_shift) >= MEAN_SHIFT),
            F.format_string("mean %+.1f%%", 100 * mean_shift),
        ),
        F.when(
            (F.col("kind") == "Date") & (F.col("date_max_new") < F.col("date_max_old")),
            F.concat(
                F.lit("max date "), F.col("date_max_old").cast("string"), F.lit(" → "), F.col("date_max_new").cast("string")
            ),
        ),
    ]
    return both.select("variable", F.concat_ws("; ", *reasons).alias("flag")).where(F.col("flag") != "")


def schema_delta(new: DataFrame, old: DataFrame) -> tuple[list[str], list[str]]:
    """Columns added and removed since the earlier release."""
    return (
        [c for c in new.columns if c not in old.columns],
        [c for c in old.columns if c not in new.columns],
    )


def schema_delta_report(new: DataFrame, old: DataFrame) -> DataFrame:
    """Added and removed columns with the rows and filled cells of the release that has them."""
    added, removed = schema_delta(new, old)

    def part(df: DataFrame, names: list[str], change: str) -> DataFrame:
        wide = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)])
        schema = "array<struct<change:string,column_name:string,n_rows:bigint,n_filled:bigint>>"
        entries = [
            F.struct(F.lit(change), F.lit(c), F.col("n"), F.col(f"c{i}")) for i, c in enumerate(names)
        ]
        return wide.select(F.inline(F.array(*entries).cast(schema)))

    return part(new, added, "added").unionByName(part(old, removed, "removed"))


def row_delta(new: DataFrame, old: DataFrame) -> DataFrame:
    """Row counts of two releases, their difference and what to warn about."""
    n_old = old.agg(F.count(F.lit(1)).alias("n")).scalar()
    delta = F.col("n_new") - F.col("n_old")
    pct = 100.0 * delta / F.nullif(F.col("n_old"), F.lit(0))
    warning = F.when(delta < 0, "row count decreased").when(pct < ROW_GROWTH_MIN_PCT, "row count hardly grew")
    counts = new.agg(F.count(F.lit(1)).alias("n_new")).withColumn("n_old", n_old)
    return counts.select("n_new", "n_old", delta.alias("delta"), pct.alias("pct"), warning.alias("warning"))


def parse_last_modified(text: str | None) -> dt.date | None:
    """Day of a ``Last-Modified`` header such as ``Tue, 02 Jun 2026 11:59:25 GMT``."""
    try:
        return dt.datetime.strptime((text or "")[:16].strip(), "%a, %d %b %Y").date()
    except ValueError:
        return None


def recency(df: DataFrame, column: str, last_modified: str | None, as_of: dt.date) -> DataFrame:
    """Gap between the file date and the latest plausible event; more than a week warns.

    Events later than the day after ``as_of`` are errors and do not count.
    """
    file_day = F.lit(parse_last_modified(last_modified)).cast("date")
    if column in df.columns:
        day = F.col(column).cast("date")
        latest = df.agg(F.max(F.when(day <= F.lit(as_of + dt.timedelta(days=1)), day)).alias("event_max"))
    else:
        latest = df.agg(F.lit(None).cast("date").alias("event_max"))
    gap = F.datediff(file_day, F.col("event_max"))
    return latest.select(
        file_day.alias("last_modified"),
        "event_max",
        gap.alias("gap_days"),
        F.when(gap > RECENCY_TOLERANCE_DAYS, "data is older than the file").alias("warning"),
    )


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Dictionary of codes 1..k for the sorted distinct values: variable, value, code.

    The distinct values are range-partitioned and sorted, so no task sees a whole column. Their
    places are written out once; a code is the place within the partition plus the count of
    earlier partitions, a table of one row per partition and column.
    """
    values = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").alias("value")) for c in columns]))
    )
    ranged = (
        values.where(F.col("value").isNotNull())
        .distinct()
        .repartitionByRange("variable", "value")
        .sortWithinPartitions("variable", "value")
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
    )
    placed = cut_lineage(ranged)
    sizes = placed.groupBy("variable", "_part").agg(F.count(F.lit(1)).alias("_size"), F.min("_id").alias("_start"))
    earlier = Window.partitionBy("variable").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size")
    return placed.join(bounded(offsets), ["variable", "_part"]).select(
        "variable", "value", (F.col("_id") - F.col("_start") + F.col("_offset") + 1).alias("code")
    )


def label_encode(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Replace text columns by their codes; returns the table and the dictionary.

    A column's codes are broadcast if measuring proves them small; only larger ones shuffle the table.
    """
    dictionary = label_codes(df, columns)
    encoded = df
    for i, c in enumerate(columns):
        codes = dictionary.where(F.col("variable") == c).select(
            F.col("value").alias(f"_value{i}"), F.col("code").alias(f"_code{i}")
        )
        encoded = encoded.join(bounded(codes), F.col(f"`{c}`") == F.col(f"_value{i}"), "left")
    at = {c: i for i, c in enumerate(columns)}
    return (
        encoded.select(*[F.col(f"_code{at[c]}").alias(c) if c in at else F.col(f"`{c}`") for c in df.columns]),
        dictionary,
    )


def short_names(names: Sequence[str], limit: int = 32) -> list[str]:
    """Names of at most ``limit`` characters where vowels and small letters allow it, made unique.

    Small vowels go first, from the right, then other small letters, then anything; the first
    letter stays. Names are only touched if one of them is too long.
    """
    if all(len(n) <= limit for n in names):
        return list(names)

    def shorten(name: str) -> str:
        for droppable in ("aeiou", "abcdefghijklmnopqrstuvwxyz", None):
            at = len(name) - 1
            while len(name) > limit and at > 0:
                if droppable is None or name[at] in droppable:
                    name = name[:at] + name[at + 1:]
                at -= 1
        return name

    result, taken = [], set()
    shortened = [shorten(n) for n in names]
    for name in shortened:
        unique, i = name, 0
        while unique in taken or (i and unique in shortened):
            i += 1
            suffix = f"_{i}"
            unique = name[: limit - len(suffix)] + suffix
        taken.add(unique)
        result.append(unique)
    return result


def label_release(df: DataFrame, limit: int = 32) -> tuple[DataFrame, DataFrame]:
    """The table with all text columns as label codes and short column names; returns it and the dictionary.

    The dictionary names variables by their short names.
    """
    encoded, dictionary = label_encode(df, [f.name for f in df.schema if isinstance(f.dataType, T.StringType)])
    short = dict(zip(df.columns, short_names(df.columns, limit)))
    renamed = F.create_map(*[F.lit(x) for pair in short.items() for x in pair])
    return encoded.toDF(*short.values()), dictionary.withColumn("variable", renamed[F.col("variable")])
