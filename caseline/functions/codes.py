"""Code functions: recoding, ranking, flags and statute citations."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Charge codes that the general citation rule reads wrongly.
CITATION_OVERRIDES = {
    "212a03F": "212(a)(3)(F)",
    "215a": "215(a)",
    "215b": "215(b)",
    "237s02AiI": "237(a)(2)(A)(i)(I)",
    "2153g": "215(g)",
    "2153h": "215(h)",
}


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _table(pairs: Mapping[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def recode(code: Column, labels: Mapping[str, str]) -> Column:
    """Label of a code; a code without a label passes through."""
    return F.coalesce(F.try_element_at(_table(labels), code), code)


def recode_strict(code: Column, labels: Mapping[str, str]) -> Column:
    """Label of a code; a code without a label becomes NULL."""
    return F.try_element_at(_table(labels), code)


def priority_rank(code: Column, best_first: Sequence[str]) -> Column:
    """Rank by a priority list: the first entry ranks highest, unknown and missing rank 0."""
    ranks = {code_: len(best_first) - i for i, code_ in enumerate(best_first)}
    return F.coalesce(F.try_element_at(_table(ranks), code), F.lit(0))


def flag_from_code(code: Column, value: str = "Y") -> Column:
    """True for one code, false for everything else, a missing code included."""
    return F.coalesce(code == value, F.lit(False))


def one_of(code: Column, values: Sequence[object]) -> Column:
    """Set membership that is false, not NULL, for a missing code."""
    return F.coalesce(code.isin(list(values)), F.lit(False))


def citation(code: Column, overrides: Mapping[str, str] = CITATION_OVERRIDES) -> Column:
    """Statute citation of a charge code: ``212a6Ci`` becomes ``212(a)(6)(C)(i)``.

    The number in front names the section; what follows is read as levels, each a run of digits, of
    small or of capital letters. A lone capital over a number stands for the small ``a``.

    A code of nothing but plain letters and digits, as nearly all are, needs no list of its levels: two patterns
    bracket them in place.
    """
    simple = code.rlike(r"\A[0-9][0-9A-Za-z]*\z")
    small = F.when(code.rlike("^[0-9]+[A-Z][0-9]"), F.regexp_replace(code, "^([0-9]+)[A-Z](?=[0-9])", "$1a")).otherwise(code)
    in_place = F.regexp_replace(small, "(?<=[A-Za-z])0*([0-9]+)|([a-z]+|[A-Z]+)", "($1$2)")
    zeros = "^0+(?=[0-9])"

    def levels(marks: Column) -> Column:
        lone = F.get(marks, F.lit(1)).rlike("^[A-Z]$") & F.get(marks, F.lit(2)).rlike("^[0-9]")
        plain = F.slice(marks, 2, F.size(marks))
        return F.when(lone, F.concat(F.array(F.lit("a")), F.slice(marks, 3, F.size(marks)))).otherwise(plain)

    def bracketed(level: Column) -> Column:
        return F.concat(F.lit("("), F.when(level.startswith("0"), F.regexp_replace(level, zeros, "")).otherwise(level), F.lit(")"))

    def cited(plain: Column) -> Column:
        # inside a function on arrays nothing is evaluated once by itself
        marks = F.regexp_extract_all(plain, F.lit("[0-9]+|[a-z]+|[A-Z]+"), F.lit(0))
        return F.when(
            plain.rlike("^[0-9]"),
            bind(marks, lambda m: F.concat(F.get(m, F.lit(0)), F.array_join(F.transform(levels(m), bracketed), ""))),
        )

    plain = F.regexp_replace(code, r"[\p{P}\s]+", "")
    return F.coalesce(F.try_element_at(_table(overrides), code), F.when(simple, in_place).otherwise(bind(plain, cited)))
