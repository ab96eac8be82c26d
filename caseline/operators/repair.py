"""Repair of rows whose cells a stray separator pushed to the right.

A row is suspect if it has filled cells beyond the header or a date in a column that never holds
one. Only suspect rows evaluate the repair; all others pass through the same scan untouched. The
audit log is a second, lazily evaluated view of the same rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from caseline.functions.codes import bind as _bind
from caseline.functions.text import clean_cell, may_be_unclean
from caseline.operators.rules import DATE_START

OVERFLOW = "_overflow"
CLEANED = "_cleaned"

Cell = Callable[[str], Column]


class RepairFailure(ValueError):
    """The repair touched more than it may, or a row it had no reason to touch."""


@dataclass(frozen=True)
class Merge:
    """Join two neighbouring cells with a blank before the shift that removes the second."""

    into: str
    source: str


@dataclass(frozen=True)
class ShiftRules:
    """Columns that must look like a date, columns that must not, and special start rules.

    ``special`` gets the trimmed cells and returns ``(condition, start column, merge)`` entries,
    tried in order before the date rules; ``merge`` is a ``Merge`` or None. After the first shift a row
    is shifted by one cell up to ``retries`` times more; a row that still breaks a rule is dropped and
    logged as ``dropped_after_fix``.
    """

    dates: tuple[str, ...] = ()
    others: tuple[str, ...] = ()
    special: Callable[[Cell], Sequence[tuple[Column, str, Merge | None]]] | None = None
    retries: int = 3


def _texts(values: Sequence[str]) -> Column:
    """Array literal of texts."""
    return F.expr("array(" + ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values) + ")")


def _blank(cell: Column) -> Column:
    return F.coalesce(F.trim(cell) == "", F.lit(True))


def _not_a_date(cell: Column) -> Column:
    return ~_blank(cell) & ~F.trim(cell).rlike(DATE_START)


def _is_a_date(cell: Column) -> Column:
    return F.coalesce(F.trim(cell).rlike(DATE_START), F.lit(False))


class _Layout:
    """Positions of the header columns inside the array of a row's cells.

    Checks run over the array with one small expression each, whatever the number of columns.
    """

    def __init__(self, names: Sequence[str], rules: ShiftRules):
        self.names = list(names)
        self.rules = rules
        self.dates = [c for c in rules.dates if c in self.names]
        self.others = [c for c in rules.others if c in self.names]
        self.checked = list(dict.fromkeys(self.dates + self.others))

    def position(self, name: str) -> int:
        return self.names.index(name) + 1

    def cell(self, cells: Column, name: str) -> Column:
        return F.get(cells, F.lit(self.position(name) - 1))

    def first_violation(self, cells: Column) -> Column:
        """Position of the first cell that breaks its column's date rule, NULL without one."""
        if not self.checked:
            return F.lit(None).cast("int")
        # places of the columns with a rule alone, those of columns that never hold a date below zero
        places = [i if c in self.dates else -i for i, c in enumerate(self.names, 1) if c in self.checked]

        def wrong(place: Column) -> Column:
            cell = F.get(cells, F.abs(place) - 1)
            return F.when(place > 0, _not_a_date(cell)).otherwise(_is_a_date(cell))

        return F.abs(F.get(F.filter(F.expr("array(" + ", ".join(map(str, places)) + ")"), wrong), F.lit(0)))

    def _picked(self, cells: Column, names: Sequence[str]) -> Column:
        """The cells of these columns, in this order."""
        places = F.expr("array(" + ", ".join(str(self.position(c) - 1) for c in names) + ")")
        return F.transform(places, lambda i: F.get(cells, i))

    def describe_violations(self, cells: Column) -> Column:
        """Violations as text, NULL without one."""
        def lines(names: Sequence[str], wrong: Callable[[Column], Column], what: str) -> list[Column]:
            if not names:
                return []
            texts = F.zip_with(
                _texts(names),
                self._picked(cells, names),
                lambda name, cell: F.when(wrong(cell), F.concat(name, F.lit("='"), F.trim(cell), F.lit(f"' ({what})"))),
            )
            return [F.nullif(F.array_join(texts, "; "), F.lit(""))]

        found = lines(self.dates, _not_a_date, "expected date") + lines(self.others, _is_a_date, "unexpected date")
        return F.nullif(F.concat_ws("; ", *found), F.lit(""))

    def snapshot(self, cells: Column) -> Column:
        texts = F.zip_with(
            _texts(self.checked),
            self._picked(cells, self.checked),
            lambda name, cell: F.concat(name, F.lit("="), F.coalesce(cell, F.lit("NA"))),
        )
        return F.array_join(texts, "; ")

    def find(self, cells: Column, n: Column) -> Column:
        """Where to start shifting by ``n``: struct of start (NULL if unknown) and merge number."""
        def answer(start: Column, merge: int) -> Column:
            return F.struct(start.cast("int").alias("start"), F.lit(merge).alias("merge"))

        start = self.first_violation(cells) - n
        result = answer(F.when(start >= 1, start), -1)
        for i, (condition, column, merge) in reversed(list(enumerate(self._special(cells)))):
            result = F.when(condition, answer(F.lit(self.position(column)), i if merge else -1)).otherwise(result)
        return result

    def _special(self, cells: Column) -> Sequence[tuple[Column, str, Merge | None]]:
        if self.rules.special is None:
            return []
        return self.rules.special(lambda name: F.trim(self.cell(cells, name)))

    def shift(self, cells: Column, found: Column, n: Column) -> Column:
        """Merge if asked to, then replace each cell from the start on by the one ``n`` to its right."""
        merged = cells
        for i, (_, _, merge) in enumerate(self._special(cells)):
            if merge:
                at = self.position(merge.into)
                joined = F.concat_ws(" ", F.trim(self.cell(cells, merge.into)), F.trim(self.cell(cells, merge.source)))
                changed = F.concat(F.slice(cells, 1, at - 1), F.array(joined), F.slice(cells, at + 1, F.size(cells)))
                merged = F.when(found["merge"] == i, changed).otherwise(merged)
        return shift_left(merged, found["start"], n)

    def fix(self, cells: Column, found: Column, n: Column) -> Column:
        """One shift, then up to ``retries`` more by one cell while a start is still found; without one the row is done."""
        one = F.lit(1)

        def again(current: Column, left: int) -> Column:
            if left == 0:
                return current
            return _bind(
                self.find(current, one),
                lambda f: F.when(f["start"].isNull(), current).otherwise(_bind(self.shift(current, f, one), lambda c: again(c, left - 1))),
            )

        return _bind(self.shift(cells, found, n), lambda c: again(c, self.rules.retries))


def shift_left(cells: Column, start: Column, n: Column) -> Column:
    """Drop the ``n`` cells at 1-based ``start`` and move the rest left; the tail reads as NULL."""
    return F.concat(F.slice(cells, F.lit(1), start - 1), F.slice(cells, start + n, F.size(cells)))


@dataclass
class Repaired:
    """Rows after the repair, and the log of every row it fixed or dropped.

    ``marked`` holds all rows, dropped ones too, with what happened to each in the column ``_mend``; written
    once, it is the evidence for counts, log and fingerprints.
    """

    rows: DataFrame
    log: DataFrame
    staged: DataFrame
    marked: DataFrame

    def summary(self) -> DataFrame:
        """One row of counts over all input rows."""
        return self.staged.agg(*summary_metrics())

    def fingerprints(self, raw: DataFrame) -> DataFrame:
        """Sums of row prints: of all rows of ``raw``, of the touched ones among them, of the untouched ones that come out.

        The first sum reads ``raw`` by itself, so it knows nothing of the repair.
        """
        names = [c for c in raw.columns if c != OVERFLOW]
        before = raw.agg(_total(row_print(names)).alias("before"))
        return self.marked.agg(
            before.scalar().alias("print_before"),
            _total(F.when(~_untouched(), F.col(f"{MEND}.print_in"))).alias("print_touched"),
            _total(F.when(_untouched(), F.col(f"{MEND}.print_out"))).alias("print_after"),
        ).withColumn("unchanged", F.expr("print_before - print_touched = print_after"))


#: What the repair did to a row: status (null if untouched), whether it broke a rule, whether it was longer
#: than the header, prints of the cells before and after, and its log entry.
MEND = "_mend"
DROPPED = ("dropped", "dropped_after_fix")


def row_print(names: Sequence[str]) -> Column:
    """60 bits of a hash of the named cells of a row; missing cells differ from empty ones."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in names]
    return F.conv(F.substring(F.md5(F.concat_ws("\x1f", *cells)), 1, 15), 16, 10).cast("long")


def _total(prints: Column) -> Column:
    """Sum that no order and no number of rows can change."""
    return F.coalesce(F.sum(prints.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))


def _untouched() -> Column:
    return F.col(f"{MEND}.status").isNull()


def kept(marked: DataFrame) -> DataFrame:
    """The rows of a marked table that the repair keeps, without its marks."""
    return marked.where(_untouched() | (F.col(f"{MEND}.status") == "fixed")).drop(MEND)


def counts_of(marked: DataFrame) -> DataFrame:
    """One row of counts and fingerprints of a marked table that was written."""
    status = F.col(f"{MEND}.status")
    return marked.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(status == "fixed").alias("fixed"),
        F.count_if(status == "dropped").alias("dropped"),
        F.count_if(status == "dropped_after_fix").alias("dropped_after_fix"),
        F.count_if(_untouched() | (status == "fixed")).alias("rows_out"),
        F.count_if(status.isin("fixed", "dropped_after_fix") & ~F.col(f"{MEND}.violated")).alias("fixed_without_cause"),
        _total(F.col(f"{MEND}.print_in")).alias("print_before"),
        _total(F.when(~_untouched(), F.col(f"{MEND}.print_in"))).alias("print_touched"),
        _total(F.when(_untouched(), F.col(f"{MEND}.print_out"))).alias("print_after"),
    )


def log_of(marked: DataFrame) -> DataFrame:
    """The audit log of a marked table that was written.

    Rows without extra cells are handled in the overflow pass of a table that has any longer row.
    """
    longer = marked.agg(F.coalesce(F.max(F.col(f"{MEND}.wide")), F.lit(False)).alias("longer")).scalar()
    entry, status = F.col(f"{MEND}.log"), F.col(f"{MEND}.status")
    return marked.where(~_untouched()).select(
        entry["row_n"].alias("row_n"),
        entry["n_extra"].alias("n_extra"),
        entry["shift_col"].alias("shift_col"),
        F.when(longer, "overflow").otherwise("hidden").alias("pass"),
        status.alias("status"),
        *[entry[c].alias(c) for c in ("original_violations", "original_vals", "fixed_violations", "fixed_vals")],
    )


def summary_metrics() -> list[Column]:
    status = F.col("_repair.status")
    dropped = status.isin("dropped", "dropped_after_fix")
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(status == "fixed").alias("fixed"),
        F.count_if(status == "dropped").alias("dropped"),
        F.count_if(status == "dropped_after_fix").alias("dropped_after_fix"),
        F.count_if(F.coalesce(~dropped, F.lit(True))).alias("rows_out"),
        F.count_if(status.isin("fixed", "dropped_after_fix") & ~F.col("_repair.violated")).alias("fixed_without_cause"),
    ]


def repair_shifts(
    df: DataFrame, rules: ShiftRules, row_id: str | None = None, observation: Observation | None = None
) -> Repaired:
    """Repair shifted rows of a ragged table.

    ``df`` holds the header columns and, if the reader met longer rows, their further cells in the
    array column ``_overflow``. ``row_id`` names the column the log identifies rows by; without one
    the log numbers rows by their place in the scan. An ``observation`` receives the summary counts
    of whichever job writes the rows.
    """
    names = [c for c in df.columns if c != OVERFLOW]
    layout = _Layout(names, rules)
    if OVERFLOW not in df.columns:
        df = df.withColumn(OVERFLOW, F.lit(None).cast("array<string>"))

    spilled = F.col(OVERFLOW)
    n_spilled = F.when(spilled.isNotNull(), F.size(F.filter(spilled, lambda x: ~_blank(x)))).otherwise(0)
    # one look at the cells that must not be dates, with bars between them, spares nearly all rows the look at each
    others = [F.col(c) for c in layout.others]
    hinted = F.concat_ws("|", *others).rlike(DATE_START.lstrip("^"))
    misplaced = hinted & F.exists(F.array(*others), _is_a_date) if others else F.lit(False)

    def attempt(cells: Column, n: Column) -> Column:
        return _bind(layout.find(cells, n), lambda f: outcome(cells, f, n))

    def outcome(cells: Column, found: Column, n: Column) -> Column:
        def result(status: Column, after: Column) -> Column:
            return F.struct(
                status.alias("status"),
                n.cast("int").alias("n_extra"),
                found["start"].alias("start"),
                layout.first_violation(cells).isNotNull().alias("violated"),
                cells.alias("before"),
                after.alias("after"),
            )

        def judged(after: Column) -> Column:
            clean = layout.first_violation(after).isNull()
            return result(F.when(clean, "fixed").otherwise("dropped_after_fix"), after)

        unknown = F.when(F.col("_spilled") > 0, result(F.lit("dropped"), cells))
        return F.when(found["start"].isNull(), unknown).otherwise(_bind(layout.fix(cells, found, n), judged))

    cells = F.concat(F.array(*[F.col(c) for c in names]), F.coalesce(spilled, F.array().cast("array<string>")))
    n_extra = F.greatest(F.col("_spilled"), F.lit(1))
    staged = df.withColumn("_spilled", n_spilled)
    if row_id is None:
        staged = staged.withColumn("_row", F.monotonically_increasing_id())
    suspect = (F.col("_spilled") > 0) | misplaced
    staged = staged.withColumn("_repair", F.when(suspect, _bind(cells, lambda c: attempt(c, n_extra))))
    watched = _watched(staged, observation)

    status = F.col("_repair.status")
    kept = watched.where(status.isNull() | (status == "fixed"))
    rows = kept.select(
        *[F.when(status == "fixed", F.get(F.col("_repair.after"), F.lit(i))).otherwise(F.col(c)).alias(c) for i, c in enumerate(names)]
    )
    entry = F.struct(*_entries(layout, row_id))
    marked = watched.select(
        *[F.when(status == "fixed", F.get(F.col("_repair.after"), F.lit(i))).otherwise(F.col(c)).alias(c) for i, c in enumerate(names)],
        status.alias("_status"),
        F.col("_repair.violated").alias("_violated"),
        (F.coalesce(F.size(OVERFLOW), F.lit(0)) > 0).alias("_wide"),
        row_print(names).alias("_in"),
        F.when(status.isNotNull(), entry).alias("_entry"),
    )
    mend = F.struct(
        F.col("_status").alias("status"),
        F.col("_violated").alias("violated"),
        F.col("_wide").alias("wide"),
        F.col("_in").alias("print_in"),
        row_print(names).alias("print_out"),
        F.col("_entry").alias("log"),
    )
    return Repaired(rows, _log(_watched(staged), staged, layout, row_id), staged, marked.select(*names, mend.alias(MEND)))


def _watched(staged: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Count outcomes in passing. The metrics also stop the optimiser from copying the whole repair
    into each filter and column that reads its outcome."""
    return staged.observe(observation or f"repair_{uuid.uuid4().hex}", *summary_metrics())


def _entries(layout: _Layout, row_id: str | None) -> list[Column]:
    """The entries of the log that a row knows by itself."""
    before, after = F.col("_repair.before"), F.col("_repair.after")
    return [
        F.col(row_id or "_row").alias("row_n"),
        F.col("_repair.n_extra").alias("n_extra"),
        F.get(_texts(layout.names), F.col("_repair.start") - 1).alias("shift_col"),
        F.col("_repair.status").alias("status"),
        layout.describe_violations(before).alias("original_violations"),
        layout.snapshot(before).alias("original_vals"),
        F.when(F.col("_repair.status") != "dropped", layout.describe_violations(after)).alias("fixed_violations"),
        layout.snapshot(after).alias("fixed_vals"),
    ]


def _log(watched: DataFrame, staged: DataFrame, layout: _Layout, row_id: str | None) -> DataFrame:
    # Rows without extra cells are handled in the overflow pass of a table that has any longer row.
    longer = staged.agg(F.coalesce(F.max(F.size(OVERFLOW) > 0), F.lit(False)).alias("longer")).scalar()
    entries = _entries(layout, row_id)
    place = F.when(longer, "overflow").otherwise("hidden").alias("pass")
    return watched.where(F.col("_repair").isNotNull()).select(*entries[:3], place, *entries[3:])


def check_repair(counts: dict, max_share: float | None = None) -> dict:
    """Raise if the repair broke one of its limits; ``counts`` is a summary row as a dict.

    ``max_share`` is the largest share of the rows that may be touched, None for no limit.
    """
    touched = counts["fixed"] + counts["dropped"] + counts["dropped_after_fix"]
    if max_share is not None and touched > max_share * counts["rows_in"]:
        raise RepairFailure(f"{touched} of {counts['rows_in']} rows edited, limit is {max_share:.2%}")
    if counts["fixed_without_cause"]:
        raise RepairFailure(f"{counts['fixed_without_cause']} rows fixed without a violation")
    if counts["rows_in"] - counts["dropped"] - counts["dropped_after_fix"] != counts["rows_out"]:
        raise RepairFailure("row count does not add up")
    if "print_before" in counts and counts["print_before"] - counts["print_touched"] != counts["print_after"]:
        raise RepairFailure("a row that the repair had no reason to touch has changed")
    return counts


def clean_columns(df: DataFrame) -> DataFrame:
    """Clean every text column and drop left-over overflow columns.

    One check of all cells of a row decides whether they are looked at one by one.
    """
    df = df.drop(*[c for c in df.columns if c == OVERFLOW or re.fullmatch(r"V\d+", c)])
    names = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    if not names:
        return df
    cells = [F.col(f"`{c}`") for c in names]
    cleaned = F.when(may_be_unclean(cells), F.transform(F.array(*cells), clean_cell))
    at = {c: i for i, c in enumerate(names)}

    def clean(name: str) -> Column:
        cell = F.col(f"`{name}`")
        if name not in at:
            return cell
        return F.when(F.col(CLEANED).isNull(), F.nullif(cell, F.lit(""))).otherwise(F.get(CLEANED, F.lit(at[name]))).alias(name)

    return df.withColumn(CLEANED, cleaned).select(*[clean(c) for c in df.columns])
