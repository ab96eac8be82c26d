"""Typing of text columns with a limit on parse failures."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseline.operators.rules import Rule

EXAMPLES = 5
MAX_FAIL_RATE = 0.001


class ConvertFailure(ValueError):
    """Too many cells of a column could not be parsed."""


# Days and times, with months, days and time parts of one digit or two; the plain cast behind them is much
# faster than a format, but laxer. What follows a complete date or time doesn't matter.
_DAY = r"^\d{4}-\d{1,2}-\d{1,2}"
_MOMENT = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}"


def _number(text: Column) -> Column:
    # A trailing type letter, as in ``1d``, is a Java habit and not a number.
    suffixed = F.substring(F.rtrim(text), -1, 1).isin("d", "D", "f", "F")
    return F.nanvl(F.when(~suffixed, text.try_cast("double")), F.lit(None).cast("double"))


def parse(text: Column, kind: str) -> Column:
    """Typed value of a text cell, NULL if it does not parse.

    Integers lose a fraction, timestamps need a time, and whatever follows a complete date or
    time is ignored.
    """
    if kind == "integer":
        return _number(text).try_cast("int")
    if kind == "double":
        return _number(text)
    if kind == "datetime":
        return F.regexp_substr(text, F.lit(_MOMENT)).try_cast("timestamp")
    if kind == "date":
        return F.regexp_substr(text, F.lit(_DAY)).try_cast("date")
    raise ValueError(f"unknown type {kind!r}")


def _filled(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def failed(text: Column, kind: str) -> Column:
    """True where a filled cell does not parse."""
    return F.coalesce(_filled(text), F.lit(False)) & parse(text, kind).isNull()


def convert(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; a cell that does not parse becomes NULL."""
    return df.withColumns({c: parse(F.col(c), kind) for c, kind in kinds.items()})


def rule_name(column: str, kind: str) -> str:
    return f"parses({column}: {kind})"


def parsed_column(column: str) -> str:
    return f"_parsed_{column}"


def with_parsed(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Add the typed value next to each text column, so that checks and result share one parse."""
    return df.withColumns({parsed_column(c): parse(F.col(c), kind) for c, kind in kinds.items()})


def keep_parsed(df: DataFrame, kinds: Mapping[str, str], names: Sequence[str]) -> DataFrame:
    """The named columns, typed where ``with_parsed`` has typed them."""
    return df.select(*[F.col(parsed_column(c)).alias(c) if c in kinds else F.col(c) for c in names])


def failure_rules(
    kinds: Mapping[str, str], max_fail_rate: float | None = MAX_FAIL_RATE, parsed: bool = False
) -> list[Rule]:
    """The same failures as rules, to be counted while the table is written.

    The limit is exceeded only above the rate, so the stop level is the next representable value.
    ``parsed`` says that the table comes from ``with_parsed``.
    """
    stop = 2.0 if max_fail_rate is None else math.nextafter(max_fail_rate, 1.0)

    def fails(c: str, kind: str) -> Column:
        if parsed:
            return F.coalesce(_filled(F.col(c)), F.lit(False)) & F.col(parsed_column(c)).isNull()
        return failed(F.col(c), kind)

    return [Rule(rule_name(c, kind), fails(c, kind)).at(None, stop) for c, kind in kinds.items()]


def failure_examples(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Up to five distinct failing values per column, the smallest ones, as one text."""
    cells = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("variable"), F.when(failed(F.col(c), k), F.col(c)).alias("value"))
                    for c, k in kinds.items()
                ]
            )
        )
    ).where(F.col("value").isNotNull())
    return smallest_values(cells)


def unparsed(kinds: Mapping[str, str]) -> Column:
    """The filled cells of a row of ``with_parsed`` that did not parse, as (variable, value); null if all did."""
    wrong = {c: F.coalesce(_filled(F.col(c)), F.lit(False)) & F.col(parsed_column(c)).isNull() for c in kinds}
    cells = F.array(*[F.when(w, F.struct(F.lit(c).alias("variable"), F.col(c).alias("value"))) for c, w in wrong.items()])
    return F.when(reduce(or_, wrong.values(), F.lit(False)), F.filter(cells, lambda x: x.isNotNull()))


def smallest_values(cells: DataFrame) -> DataFrame:
    """The five smallest distinct values of each variable of (variable, value), as one text.

    Distinct values are found task by task, and each task hands on five of a variable, so what meets is bounded.
    """
    place = F.row_number().over(Window.partitionBy("variable").orderBy("value"))
    kept = cells.distinct().withColumn("place", place).where(F.col("place") <= EXAMPLES)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]), ", ")
    return kept.groupBy("variable").agg(text.alias("examples"))


def convert_report(df: DataFrame, kinds: Mapping[str, str], max_fail_rate: float = MAX_FAIL_RATE) -> DataFrame:
    """Failures per column: variable, failed, total, rate, exceeds, examples."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(failed(F.col(c), k)).alias(f"f{i}") for i, (c, k) in enumerate(kinds.items())],
    )
    entries = [
        F.struct(F.lit(c).alias("variable"), F.col(f"f{i}").alias("failed"), F.col("total"))
        for i, c in enumerate(kinds)
    ]
    rate = F.coalesce(F.col("failed") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0))
    lines = counts.select(F.inline(F.array(*entries))).select(
        "variable", "failed", "total", rate.alias("rate"), (rate > max_fail_rate).alias("exceeds")
    )
    return lines.join(failure_examples(df, kinds), "variable", "left")


def check_converted(df: DataFrame, kinds: Mapping[str, str], max_fail_rate: float = MAX_FAIL_RATE) -> list[str]:
    """Raise if a column fails too often, naming all of them; return messages for the others."""
    messages, stops = [], []
    for r in convert_report(df, kinds, max_fail_rate).where("failed > 0").orderBy("variable").collect():
        line = f"{r['variable']}: {r['failed']} ({100 * r['rate']:.4f}%) e.g. {r['examples']}"
        (stops if r["exceeds"] else messages).append(line)
    if stops:
        raise ConvertFailure(f"parse failures above {100 * max_fail_rate:.3f}% in {'; '.join(stops)}")
    return messages


def stop_on(lines: Sequence[Mapping[str, object]], variables: Mapping[str, str], max_fail_rate: float | None) -> None:
    """Raise if there are rule lines of columns that fail too often; they have their examples."""
    if lines:
        said = [f"{variables[r['rule']]}: {r['failed']} ({100 * r['fraction']:.4f}%) e.g. {r['examples']}" for r in lines]
        raise ConvertFailure(f"parse failures above {100 * max_fail_rate:.3f}% in {'; '.join(sorted(said))}")
