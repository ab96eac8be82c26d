"""Declarative data-quality rules, evaluated together in one aggregation.

A rule says which rows fail. All rules of a table become columns of a single aggregate (``evaluate``), or
marks that are written beside the rows and counted in the committed files (``marks``, ``count_marks``).
Membership in lookups is counted by code (``count_members``). ``Watch`` observes metrics in passing; they
are a view of a running job, as Spark adds the metrics of a task that has to be run again once more.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DATE_START = r"^\d{4}-\d{2}-\d{2}"
DIGITS = r"^\d+$"


class RuleFailure(ValueError):
    """A rule reached its stop level."""


@dataclass(frozen=True)
class Rule:
    """``fails`` marks failing rows, ``where`` (if any) the rows the rule looks at.

    Without levels a single failing row stops. ``value`` replaces both for a rule on an aggregate:
    it is a boolean aggregate that must hold. ``code`` names the column of a membership rule and
    ``extra`` the codes that pass besides the lookup's.
    """

    name: str
    fails: Column | None = None
    where: Column | None = None
    warn_at: float | None = None
    stop_at: float | None = None
    value: Column | None = None
    code: str | None = None
    extra: tuple[str, ...] = ()

    def when(self, where: Column) -> Rule:
        return replace(self, where=where)

    def at(self, warn_at: float | None, stop_at: float | None) -> Rule:
        return replace(self, warn_at=warn_at, stop_at=stop_at)

    def failed(self) -> Column:
        """Aggregate that counts failures."""
        if self.value is not None:
            return F.when(self.value, F.lit(0)).otherwise(F.lit(1)).cast("long")
        fails = F.coalesce(self.fails, F.lit(True))
        return F.count_if(fails if self.where is None else F.coalesce(self.where, F.lit(False)) & fails)

    def total(self) -> Column | None:
        """Aggregate that counts the rows looked at, None where those are all rows."""
        if self.value is not None:
            return F.lit(1).cast("long")
        return None if self.where is None else F.count_if(self.where)


def _metrics(rules: Sequence[Rule]) -> tuple[list[Column], list[str]]:
    """Aggregates for all rules, and the name of each rule's total; most rules share one total."""
    aggregates, totals = [F.count(F.lit(1)).alias("rows")], []
    for i, rule in enumerate(rules):
        aggregates.append(rule.failed().alias(f"f{i}"))
        total = rule.total()
        if total is not None:
            aggregates.append(total.alias(f"t{i}"))
        totals.append("rows" if total is None else f"t{i}")
    return aggregates, totals


def not_null(column: str) -> Rule:
    return Rule(f"not_null({column})", F.col(column).isNull())


def matches(column: str, pattern: str, na_pass: bool = True) -> Rule:
    c = F.col(column)
    return Rule(f"matches({column})", F.coalesce(~c.rlike(pattern), F.lit(not na_pass)))


def in_set(column: str, values: Sequence[object], na_pass: bool = True) -> Rule:
    c = F.col(column)
    return Rule(f"in_set({column})", F.coalesce(~c.isin(list(values)), F.lit(not na_pass)))


def not_in_set(column: str, values: Sequence[object]) -> Rule:
    return Rule(f"not_in_set({column})", F.coalesce(F.col(column).isin(list(values)), F.lit(False)))


def at_least(column: str, bound: object, na_pass: bool = True) -> Rule:
    return Rule(f"at_least({column})", F.coalesce(F.col(column) < F.lit(bound), F.lit(not na_pass)))


def above(column: str, bound: object, na_pass: bool = True) -> Rule:
    return Rule(f"above({column})", F.coalesce(F.col(column) <= F.lit(bound), F.lit(not na_pass)))


def between(column: str, low: object, high: object, na_pass: bool = True) -> Rule:
    inside = F.col(column).between(F.lit(low), F.lit(high))
    return Rule(f"between({column})", F.coalesce(~inside, F.lit(not na_pass)))


def holds(name: str, expression: Column) -> Rule:
    """Row expression that must be true; it has to deal with missing values itself."""
    return Rule(f"holds({name})", ~F.coalesce(expression, F.lit(False)))


def ordered(earlier: str, later: str) -> Rule:
    """``earlier <= later`` where both are known."""
    a, b = F.col(earlier), F.col(later)
    return holds(f"{earlier} <= {later}", a.isNull() | b.isNull() | (a <= b))


def valid_text(column: str, na_pass: bool = True) -> Rule:
    """Text is valid UTF-8 without replacement characters."""
    c = F.col(column)
    good = F.is_valid_utf8(c) & ~c.contains("�")
    return Rule(f"valid_text({column})", F.coalesce(~good, F.lit(not na_pass)))


def aggregate_holds(name: str, expression: Column) -> Rule:
    """Boolean aggregate over the whole table that must be true."""
    return Rule(f"aggregate({name})", value=F.coalesce(expression, F.lit(False)))


def known_column(column: str) -> str:
    return f"_known_{column}"


def in_lookup(column: str, extra: Sequence[str] = ()) -> Rule:
    """Membership in a lookup's keys, read from the flag that ``flag_known`` adds."""
    c = F.col(column)
    known = F.coalesce(F.col(known_column(column)), F.lit(False))
    if extra:
        known = known | F.coalesce(c.isin(list(extra)), F.lit(False))
    return Rule(f"in_lookup({column})", c.isNotNull() & ~known, code=column, extra=tuple(extra))


def flag_known(df: DataFrame, lookup: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Add a flag per code column that tells whether the lookup has the code."""
    keys = lookup.where(F.col(key).isNotNull()).select(F.col(key).alias("_code")).distinct()
    for c in columns:
        flagged = keys.select("_code", F.lit(True).alias(known_column(c)))
        df = df.join(flagged, F.col(c) == F.col("_code"), "left").drop("_code")
    return df


def _level(rule_warn: Column, rule_stop: Column, failed: Column, fraction: Column) -> Column:
    no_levels = rule_warn.isNull() & rule_stop.isNull()
    return (
        F.when(no_levels, F.when(failed > 0, "stop").otherwise("pass"))
        .when(fraction >= rule_stop, "stop")
        .when(fraction >= rule_warn, "warn")
        .otherwise("pass")
    )


def _report(rows: DataFrame) -> DataFrame:
    fraction = F.coalesce(F.col("failed") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0))
    return rows.select(
        "rule",
        "failed",
        "total",
        fraction.alias("fraction"),
        _level(F.col("warn_at"), F.col("stop_at"), F.col("failed"), fraction).alias("level"),
    )


def _entry(rule: Rule, failed: Column, total: Column) -> Column:
    return F.struct(
        F.lit(rule.name).alias("rule"),
        failed.alias("failed"),
        total.alias("total"),
        F.lit(rule.warn_at).cast("double").alias("warn_at"),
        F.lit(rule.stop_at).cast("double").alias("stop_at"),
    )


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Report of all rules in one pass: rule, failed, total, fraction, level."""
    aggregates, totals = _metrics(rules)
    entries = [_entry(rule, F.col(f"f{i}"), F.col(totals[i])) for i, rule in enumerate(rules)]
    return _report(df.agg(*aggregates).select(F.inline(F.array(*entries))))


def distinct_rows(
    df: DataFrame, keys: Sequence[str], warn_at: float | None = None, stop_at: float | None = None
) -> DataFrame:
    """Report of the rule that keys do not repeat; every row of a repeated key fails."""
    name = f"distinct({', '.join(keys)})"
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counts = sizes.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    rule = Rule(name, warn_at=warn_at, stop_at=stop_at)
    return _report(counts.select(F.inline(F.array(_entry(rule, F.col("failed"), F.col("total"))))))


def level_of(failed: int, total: int, warn_at: float | None, stop_at: float | None) -> str:
    """The same level for counts that are already on the driver."""
    if warn_at is None and stop_at is None:
        return "stop" if failed else "pass"
    fraction = failed / total if total else 0.0
    if stop_at is not None and fraction >= stop_at:
        return "stop"
    return "warn" if warn_at is not None and fraction >= warn_at else "pass"


def enforce(report: Iterable[dict]) -> list[dict]:
    """Raise if a line of the report says stop; return the lines that warn."""
    lines = [r if isinstance(r, dict) else r.asDict() for r in report]
    stops = [r for r in lines if r["level"] == "stop"]
    if stops:
        detail = "; ".join(f"{r['rule']}: {r['failed']} of {r['total']}" for r in stops)
        raise RuleFailure(f"{len(stops)} rule(s) failed: {detail}")
    return [r for r in lines if r["level"] == "warn"]


# One character per rule and row: passed, failed, not looked at.
PASSED, FAILED, SKIPPED = "p", "f", "-"


def marks(rules: Sequence[Rule]) -> Column:
    """What every rule says of a row, as a text with one character per rule.

    Rows of one table share few such texts, so they cost little where they are written, and counting
    the texts of committed files gives exact counts however often a task had to be run again.
    """
    verdicts = []
    for rule in rules:
        if rule.value is not None or rule.code is not None:
            raise ValueError(f"{rule.name} is no rule on single rows")
        verdict = F.when(F.coalesce(rule.fails, F.lit(True)), FAILED).otherwise(PASSED)
        verdicts.append(verdict if rule.where is None else F.when(F.coalesce(rule.where, F.lit(False)), verdict).otherwise(SKIPPED))
    return F.concat(F.lit(""), *verdicts)


def _lines(counts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Report of counts (at, failed, total) by the places of the rules; what has no count has zero rows."""
    spark = counts.sparkSession
    places = [(i, r.name, r.warn_at, r.stop_at) for i, r in enumerate(rules)]
    named = spark.createDataFrame(places, "at int, rule string, warn_at double, stop_at double")
    zero = F.lit(0).cast("long")
    joined = named.join(counts, "at", "left").withColumns({c: F.coalesce(c, zero) for c in ("failed", "total")})
    return _report(joined)


def count_marks(df: DataFrame, column: str, rules: Sequence[Rule]) -> DataFrame:
    """Report of the rules behind the marks in ``column``; rows without marks don't count."""
    texts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    places = F.transform(
        F.sequence(F.lit(1), F.length(column)),
        lambda i: F.struct((i - 1).cast("int").alias("at"), F.substring(F.col(column), i, F.lit(1)).alias("mark")),
    )
    verdicts = texts.where(F.length(column) > 0).select("n", F.inline(places))
    counts = verdicts.groupBy("at").agg(
        F.sum(F.when(F.col("mark") == FAILED, F.col("n"))).alias("failed"),
        F.sum(F.when(F.col("mark") != SKIPPED, F.col("n"))).alias("total"),
    )
    return _lines(counts, rules)


def code_histogram(df: DataFrame, codes: Sequence[Column]) -> DataFrame:
    """Rows per code column and code as (at, code, n), with ``at`` the place of the column and null codes kept."""
    cells = [F.struct(F.lit(i).alias("at"), c.cast("string").alias("code")) for i, c in enumerate(codes)]
    return df.select(F.inline(F.array(*cells))).groupBy("at", "code").agg(F.count(F.lit(1)).alias("n"))


def count_members(
    df: DataFrame, rules: Sequence[Rule], known: Sequence[tuple[DataFrame, str, Sequence[str]]], names: Mapping[str, str] | None = None
) -> DataFrame:
    """Report of membership rules from counted codes: rows are reduced to one line per column and code, and
    these lines meet all lookups in one join.

    ``known`` lists (lookup, key, columns); ``names`` are the columns' names in ``df`` where they differ.
    """
    names = names or {}
    used = code_histogram(df, [F.col(names.get(r.code, r.code)) for r in rules])
    at = {r.code: i for i, r in enumerate(rules)}
    members = df.sparkSession.createDataFrame(
        [(i, code) for i, r in enumerate(rules) for code in r.extra], "at int, code string"
    )
    for lookup, key, columns in known:
        places = [F.lit(at[c]) for c in columns if c in at]
        if places:
            codes = lookup.where(F.col(key).isNotNull()).select(F.explode(F.array(*places)).alias("at"), F.col(key).cast("string").alias("code"))
            members = members.unionByName(codes)
    members = members.distinct().withColumn("member", F.lit(True))
    failed = F.sum(F.when(F.col("code").isNotNull() & F.col("member").isNull(), F.col("n")).otherwise(0))
    counts = used.join(members, ["at", "code"], "left").groupBy("at").agg(failed.alias("failed"), F.sum("n").alias("total"))
    return _lines(counts, rules)


class Watch:
    """Rules counted while a table passes through a job that writes it.

    ``attach`` returns the table with the counts observed. After the action, ``report`` gives the
    lines and ``enforce`` raises if one of them stops.
    """

    def __init__(self, label: str, rules: Sequence[Rule]):
        self.label = label
        self.rules = list(rules)
        self._observation: Observation | None = None
        self._totals: list[str] = []

    def attach(self, df: DataFrame) -> DataFrame:
        if not self.rules:
            return df
        self._observation = Observation()
        metrics, self._totals = _metrics(self.rules)
        return df.observe(self._observation, *metrics)

    def report(self) -> list[dict]:
        if self._observation is None:
            return []
        got = self._observation.get
        lines = []
        for i, r in enumerate(self.rules):
            failed, total = got[f"f{i}"], got[self._totals[i]]
            lines.append(
                {
                    "table": self.label,
                    "rule": r.name,
                    "failed": failed,
                    "total": total,
                    "fraction": failed / total if total else 0.0,
                    "level": level_of(failed, total, r.warn_at, r.stop_at),
                }
            )
        return lines

    def enforce(self) -> list[dict]:
        return enforce(self.report())
