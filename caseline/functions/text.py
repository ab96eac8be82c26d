"""Text functions. Every one takes and returns a Column, so they stay inside generated code."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that a squish collapses, and the abbreviations kept in capitals.
BLANKS = r"[\t\n\f\r\p{Z}]+"
CAPITALS = (
    "ABC", "BIA", "CAT", "CFV", "CPC", "DHS", "EOIR", "IJ", "INA", "ORR", "PD", "ROP", "V/D", "VD", "WCAT",
)

# A blank at an end or two of them; anything but printable ASCII may hide a control character or an exotic blank.
# Each begins with a class of characters, so that a search passes over all others quickly.
_UNCLEAN = r"[^!-~](?:(?<=[^ -~])|(?= |$)|(?<=^ ))"
# The same for cells with bars between them.
_UNCLEAN_ROW = r"[^!-~](?:(?<=[^ -~])|(?=[ |]|$)|(?<=^ |\| ))"

# One word by Unicode word breaking: letters and digits run together, and an apostrophe or full
# stop joins only if there is a letter on both sides.
_WORD = (
    r"[\p{L}\p{N}][\p{L}\p{M}\p{N}_]*"
    r"(?:(?<=[\p{L}\p{M}])['’.](?=\p{L})[\p{L}\p{M}\p{N}_]+)*"
)
_MARK = "\u0001 "


def squish(text: Column) -> Column:
    """Trim, and collapse each run of white space to one blank."""
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def strip_controls(text: Column) -> Column:
    """Remove control characters, C1 controls such as U+0085 included."""
    return F.regexp_replace(text, r"\p{Cc}", "")


def clean_cell(text: Column) -> Column:
    """Strip controls, squish, and turn an empty cell into NULL.

    Nearly all cells are clean already, so a cheap check decides whether the rewriting runs at all.
    """
    cleaned = F.when(text.rlike(_UNCLEAN), squish(strip_controls(text))).otherwise(text)
    return F.nullif(cleaned, F.lit(""))


def may_be_unclean(cells: Sequence[Column]) -> Column:
    """Whether one of a row's cells may need cleaning, by one check of them all; a cell with a bar beside a blank does no harm."""
    return F.concat_ws("|", *cells).rlike(_UNCLEAN_ROW)


def zip5(text: Column) -> Column:
    """Leading three to five digits of a postal code, padded to five; NULL without them."""
    return F.lpad(F.regexp_substr(text, F.lit(r"^\d{3,5}")), 5, "0")


def year_of(text: Column) -> Column:
    """First run of four digits as an integer."""
    return F.regexp_substr(text, F.lit(r"\d{4}")).try_cast("int")


def title_case(text: Column) -> Column:
    """Capitalise every word, where words break at punctuation too.

    ``initcap`` only breaks at blanks, so each word gets a marker ending in a blank before it and
    loses the marker after it. No lambda is involved: literals fold and rows stay in codegen.
    """
    marked = F.regexp_replace(F.lower(text), _WORD, _MARK + "$0")
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def keep_capitals(text: Column, abbreviations: tuple[str, ...] = CAPITALS) -> Column:
    """Put known abbreviations back into capitals: whole words, or anywhere if they hold a slash."""
    def pattern(item: str) -> str:
        return re.escape(item) if "/" in item else rf"\b{re.escape(item)}\b"

    restored = text
    for item in abbreviations:
        restored = F.regexp_replace(restored, "(?i)" + pattern(item), item)
    any_of = "(?i)" + "|".join(pattern(item) for item in abbreviations)
    return F.when(text.rlike(any_of), restored).otherwise(text)


def label_case(text: Column) -> Column:
    """Casing of a readable label: title case with abbreviations in capitals."""
    return keep_capitals(title_case(text))


def label_literal(text: str) -> Column:
    """A fixed label with its casing, which Spark computes while planning."""
    used = tuple(a for a in CAPITALS if a.lower() in text.lower())
    titled = title_case(F.lit(text))
    return keep_capitals(titled, used) if used else titled


def title_before_bracket(text: Column) -> Column:
    """Title-case what stands before the first ``(`` and leave the bracketed code alone."""
    head = F.regexp_extract(text, r"^([^(]*)", 1)
    return F.concat(title_case(head), F.substring(text, F.length(head) + 1, F.length(text)))


def name_with_code(name: Column, code: Column) -> Column:
    """``name (code)``; a missing part reads ``NA``, as a text template prints it."""
    missing = F.lit("NA")
    return F.concat(F.coalesce(name, missing), F.lit(" ("), F.coalesce(code, missing), F.lit(")"))


def snake_case(name: str) -> str:
    """Column name in snake case: ``datBIADecision`` becomes ``dat_bia_decision``."""
    text = name.replace("'", "").replace('"', "").replace("%", "_percent_").replace("#", "_number_")
    text = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", text)
    text = re.sub(r"[^A-Za-z0-9]+", "_", text).strip("_").lower()
    if not text:
        return "x"
    return "x" + text if text[0].isdigit() else text


def snake_names(names: list[str]) -> list[str]:
    """Snake-case a whole header; repeated names get ``_2``, ``_3`` and so on."""
    seen: dict[str, int] = {}
    result = []
    for name in map(snake_case, names):
        seen[name] = seen.get(name, 0) + 1
        result.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return result
