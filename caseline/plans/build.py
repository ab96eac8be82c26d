"""The whole release: read the sources, write the stage tables, join them, publish the result.

Every count that decides anything is taken from committed files, and nothing is published before all
checks have passed. Readers of the release meet the former version until then.
"""

from __future__ import annotations

import datetime as dt
import logging
import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from caseline.operators import repair, rules
from caseline.plans import final, specs, stages
from caseline.sources import delimited, tables

log = logging.getLogger(__name__)


class ReleaseFailure(ValueError):
    """The release can't be built from these sources."""


@dataclass
class Release:
    """The published table and every check made on the way."""

    table: DataFrame
    version: str
    rule_lines: list[dict]
    manifest_lines: list[dict]
    join_line: dict
    repair_counts: dict[str, dict] = field(default_factory=dict)
    overridden: int = 0
    warnings: list[str] = field(default_factory=list)


def read_lookups(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: delimited.read_lookup(spark, os.path.join(folder, f"{name}.csv")) for name in specs.LOOKUP_FILES}


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {s.name: delimited.read_ragged(spark, os.path.join(folder, s.file)) for s in specs.TABLES}


def build_stages(
    spark: SparkSession, made: dict[str, stages.Stage], work: str, max_share: float | None = None, buckets: int | None = None
) -> tuple[dict[str, DataFrame], list[dict], dict[str, dict]]:
    """Write and check every stage; return the by-case tables, all rule lines and the repairs' counts.

    Per stage, ``work`` receives the typed rows with their marks (``<name>.rows``), the repair's log
    (``<name>.repairs``) and the by-case table in buckets of the case (``<name>``). Each is checked in its
    committed files before anything reads it.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    written, lines, repairs = {}, [], {}
    for name, stage in made.items():
        path = os.path.join(work, name)
        tables.write_table(stage.checked, f"{path}.rows")
        checked = tables.read_table(spark, f"{path}.rows")
        tables.write_table(repair.log_of(checked), f"{path}.repairs")
        repairs[name], found = stage.check_rows(checked, max_share)
        written[name] = tables.write_bucketed(stage.collapse(stage.rows(checked)), path, "idncase", buckets)
        lines += found + stage.check_result(written[name])
    return written, lines, repairs


def build_release(
    spark: SparkSession,
    sources: str,
    work: str,
    output: str,
    crosswalk: str,
    as_of: dt.date,
    manifest: str | None = None,
    max_share: float | None = None,
    check_areas: bool = True,
    excused: Sequence[str] = specs.CHECKED_GRANTS,
    buckets: int | None = None,
    keep: int = 2,
) -> Release:
    """Build one release from a folder of extracts and publish it at ``output``.

    The stage tables and the assembled cases go to ``work`` and are checked there. The release is a new
    version under ``output``; readers see it once a pointer is swapped, after all checks, and ``keep``
    versions stay. ``max_share`` is the share of a table's rows that the repair may touch, None for no
    limit; ``check_areas`` turns off the rules that expect a crosswalk of the whole country; a zero bond
    amount passes for the decisions in ``excused``; ``buckets`` defaults to the shuffle partitions.
    """
    lookups = read_lookups(spark, sources)
    made = stages.all_stages(read_sources(spark, sources), lookups, as_of)
    written, lines, repairs = build_stages(spark, made, work, max_share, buckets)
    warnings = []

    manifest_lines: list[dict] = []
    if manifest is not None:
        counted = [(os.path.splitext(made[name].spec.file)[0], counts["rows_in"]) for name, counts in repairs.items()]
        counts = spark.createDataFrame(counted, "table_name string, actual bigint")
        report = delimited.manifest_check(counts, delimited.read_manifest(spark, manifest))
        manifest_lines = [r.asDict() for r in report.collect()]
        warnings += [f"{r['table_name']}: {r['actual']} rows, {r['expected']} expected" for r in manifest_lines if r["level"] == "warn"]

    areas = tables.read_crosswalk(spark, crosswalk)
    if check_areas:
        final.check_crosswalk(areas)
    join_line = final.join_report(written).first().asDict()
    if join_line["level"] == "warn":
        warnings.append(f"{join_line['n_dropped']} of {join_line['n_before']} cases are not in the case table")
    overridden = final.override_count(written).first()["overridden"]
    twice = final.used_duplicates(written, lookups).orderBy("lookup", "key").take(20)
    if twice:
        raise ReleaseFailure("more than one lookup row for " + "; ".join(f"{r['lookup']}: {r['key']} ({r['rows']} uses)" for r in twice))

    path = os.path.join(work, "assembled")
    tables.write_table(final.assembled(written, lookups, areas, excused), path)
    cases = tables.read_table(spark, path)
    checked = [r.asDict() for r in final.final_lines(cases, lookups, excused).collect()]
    lines += checked
    rules.enforce(checked)
    warnings += [f"{r['table']}: {r['rule']}: {r['failed']} of {r['total']}" for r in lines if r["level"] == "warn"]
    warnings += [f"{r['table']}: {r['rule']}: {r['failed']} cells, e.g. {r['examples']}" for r in lines if r.get("examples")]
    for warning in warnings:
        log.warning(warning)

    version = tables.write_version(final.finished(cases), output)
    tables.point_to(spark, output, version)
    tables.prune_versions(spark, output, keep)
    return Release(tables.read_current(spark, output), version, lines, manifest_lines, join_line, repairs, overridden, warnings)
