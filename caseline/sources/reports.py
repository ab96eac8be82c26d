"""Markdown rendering of the small release reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseline.operators import profile
from caseline.sources.tables import read_optional, read_table, write_table


def _signed(n: int) -> str:
    return f"{n:+,d}"


def sanity_report(
    new: DataFrame, old: DataFrame | None, recency_column: str, last_modified: str | None, as_of: dt.date
) -> str:
    """Row counts, recency, schema changes and warnings of a new release."""
    warnings: list[str] = []
    lines = ["## Data sanity check", "", "### Row counts", ""]
    if old is not None:
        r = profile.row_delta(new, old).first()
        pct = "NA" if r["pct"] is None else f"{r['pct']:+.3f}%"
        lines += ["| Metric | New | Prior | Δ |", "|---|---:|---:|---:|"]
        lines.append(f"| rows | {r['n_new']:,} | {r['n_old']:,} | {_signed(r['delta'])} ({pct}) |")
        if r["delta"] < 0:
            warnings.append(f"Row count decreased by {abs(r['delta']):,} ({pct}).")
        elif r["warning"] is not None:
            warnings.append(f"Row count grew by only {r['delta']:,} ({r['pct']:+.4f}%).")
    else:
        lines.append(f"- rows: **{new.count():,}** (no prior version)")

    r = profile.recency(new, recency_column, last_modified, as_of).first()
    lines += ["", "### Data recency", ""]
    lines.append(f"- File `Last-Modified`: **{r['last_modified'] or '(unparsed)'}**")
    lines.append(f"- Latest `{recency_column}`: **{r['event_max'] or '(missing)'}**")
    if r["gap_days"] is not None:
        lines.append(f"- Gap: **{r['gap_days']} day(s)** (tolerance: {profile.RECENCY_TOLERANCE_DAYS})")
        if r["warning"] is not None:
            warnings.append(f"Latest `{recency_column}` is {r['gap_days']} day(s) before the file date.")

    if old is not None:
        added, removed = profile.schema_delta(new, old)
        if added or removed:
            lines += ["", "### Schema changes", ""]
            lines += _column_lines(added, removed)
            warnings.append("Schema changed since prior release.")

    lines += ["", "### Warnings", ""] + ([f"- {w}" for w in warnings] or ["- None."])
    return "\n".join(lines) + "\n"


def _column_lines(added: list[str], removed: list[str]) -> list[str]:
    lines = []
    for title, names in (("Added", added), ("Removed", removed)):
        if names:
            lines.append(f"- {title}: " + ", ".join(f"`{n}`" for n in names))
    return lines


def comparison_report(new: DataFrame, old: DataFrame) -> str:
    """Distribution comparison of two releases."""
    new_profile, old_profile = profile.column_profile(new), profile.column_profile(old)
    compared = [c for c in new.schema if c.name in old.columns and profile.kind_of(old.schema[c.name].dataType) == profile.kind_of(c.dataType)]
    flags = profile.drift_flags(new_profile, old_profile).orderBy("variable").collect()
    lines = ["### Distribution comparison"]
    lines.append(f"Compared {len(compared)} columns (new={len(new.columns)}, old={len(old.columns)}).")
    lines += _column_lines(*profile.schema_delta(new, old)) + [""]
    if not flags:
        lines.append("All distributions broadly similar; no flags.")
    else:
        lines.append(f"**{len(flags)} flag(s):**")
        lines += [f"- `{r['variable']}`: {r['flag']}" for r in flags]
    return "\n".join(lines) + "\n"


def release_check(
    new: DataFrame, old: DataFrame | None, recency_column: str, last_modified: str | None, as_of: dt.date
) -> DataFrame:
    """The checks of a release as rows: part, name, value and warning (null if there is nothing to warn about).

    Without an earlier release the rows and the recency alone are there.
    """
    none = F.lit(None).cast("string")

    def lines(df: DataFrame, part: str, **cells: tuple[Column, Column]) -> DataFrame:
        made = [F.struct(F.lit(part).alias("part"), F.lit(n).alias("name"), v.cast("string").alias("value"), w.alias("warning")) for n, (v, w) in cells.items()]
        return df.select(F.inline(F.array(*made)))

    gap = profile.recency(new, recency_column, last_modified, as_of)
    parts = lines(
        gap, "recency", last_modified=(F.col("last_modified"), none), latest=(F.col("event_max"), none), gap_days=(F.col("gap_days"), F.col("warning"))
    )
    if old is None:
        return lines(new.agg(F.count(F.lit(1)).alias("n")), "rows", new=(F.col("n"), none)).unionByName(parts)
    delta = profile.row_delta(new, old)
    parts = parts.unionByName(lines(delta, "rows", new=(F.col("n_new"), none), old=(F.col("n_old"), none), delta=(F.col("delta"), F.col("warning"))))
    changes = profile.schema_delta_report(new, old)
    parts = parts.unionByName(
        changes.select(F.lit("schema").alias("part"), F.col("column_name").alias("name"), F.col("n_filled").cast("string").alias("value"), F.concat(F.lit("column "), "change").alias("warning"))
    )
    flags = profile.drift_flags(profile.column_profile(new), profile.column_profile(old))
    return parts.unionByName(flags.select(F.lit("drift").alias("part"), F.col("variable").alias("name"), none.alias("value"), F.col("flag").alias("warning")))


def write_reports(
    spark: SparkSession, release: str, earlier: str | None, folder: str, recency_column: str, last_modified: str | None, as_of: dt.date
) -> DataFrame:
    """Check a published release against an earlier one, if there is one, and write the reports to ``folder``.

    ``sanity`` and ``comparison`` hold the texts, ``checks`` the rows, which are returned as read back.
    """
    new, old = read_optional(spark, release), read_optional(spark, earlier)
    if new is None:
        raise FileNotFoundError(f"no release at {release}")
    texts = {"sanity": sanity_report(new, old, recency_column, last_modified, as_of)}
    if old is not None:
        texts["comparison"] = comparison_report(new, old)
    for name, text in texts.items():
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder.rstrip('/')}/{name}")
    write_table(release_check(new, old, recency_column, last_modified, as_of), f"{folder.rstrip('/')}/checks")
    return read_table(spark, f"{folder.rstrip('/')}/checks")
