"""The seven by-case tables: repaired, cleaned, checked, typed and collapsed to one row per case.

A stage has two steps. The first turns the raw text into typed rows in one scan without a shuffle; every
row carries what the repair did to it and what each rule says of it. A job writes these rows and counts
the committed files, so the counts are exact however often a task has to be run again. The second step
collapses the rows that the repair keeps. Queries may chain both without writing.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseline.functions import codes, text
from caseline.operators import collapse, columns, convert, repair, rules
from caseline.operators.rules import Rule
from caseline.plans import specs
from caseline.plans.specs import TableSpec

Lookups = Mapping[str, DataFrame]
Known = Sequence[tuple[str, str, Sequence[str]]]

#: What the rules say of a row before and after typing, and its cells that didn't parse.
SOURCE_MARKS, TYPED_MARKS, UNPARSED = "_source_marks", "_typed_marks", "_unparsed"


def _same(df: DataFrame) -> DataFrame:
    return df


@dataclass
class Stage:
    """A by-case table in the making: ``checked`` are its typed rows with their marks, ``collapse`` makes the table of them.

    ``read_twice`` says that the collapse reads its rows twice.
    """

    spec: TableSpec
    lookups: Lookups
    checked: DataFrame
    collapse: Callable[[DataFrame], DataFrame] = _same
    extra_rules: Sequence[Rule] = field(default_factory=list)
    result_known: Known = ()
    read_twice: bool = False

    @property
    def table(self) -> DataFrame:
        """The by-case table, planned in one piece from the raw text.

        The count of rows in passing keeps the optimiser from copying whole typing expressions into filters.
        """
        return self.collapse(self.rows(self.checked).observe(f"rows_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows")))

    @staticmethod
    def rows(checked: DataFrame) -> DataFrame:
        """The typed rows that the repair keeps."""
        return repair.kept(checked.drop(SOURCE_MARKS, TYPED_MARKS, UNPARSED))

    def _known(self, known: Known) -> list[tuple[DataFrame, str, Sequence[str]]]:
        return [(self.lookups[name], key, names) for name, key, names in known]

    def _labelled(self, lines: DataFrame, part: str) -> DataFrame:
        return lines.select(F.lit(f"{self.spec.name} {part}").alias("table"), *lines.columns)

    def row_lines(self, checked: DataFrame) -> DataFrame:
        """Rule lines of the rows: the marks that were written, and the codes counted against the lookups."""
        source = [r for r in _source_checks(self.spec) if r.code is None]
        members = [r for r in _source_checks(self.spec) if r.code is not None]
        lines = self._labelled(rules.count_marks(checked, SOURCE_MARKS, source), "source")
        if members:
            coded = [r.code for r in members]
            names = dict(zip(coded, _renamed(self.spec, coded)))
            counted = rules.count_members(self.rows(checked), members, self._known(self.spec.known), names)
            lines = lines.unionByName(self._labelled(counted, "source"))
        typed = self.spec.typed_rules()
        return lines.unionByName(self._labelled(rules.count_marks(checked, TYPED_MARKS, typed), "typed")) if typed else lines

    def result_lines(self, table: DataFrame) -> DataFrame | None:
        """Rule lines of the by-case table."""
        every = [*self.spec.result_rules(), *self.extra_rules]
        plain, members = [r for r in every if r.code is None], [r for r in every if r.code is not None]
        parts = []
        if plain:
            parts.append(rules.evaluate(table, plain))
        if members:
            parts.append(rules.count_members(table, members, self._known(self.result_known)))
        for part in parts[1:]:
            parts[0] = parts[0].unionByName(part)
        return self._labelled(parts[0], "result") if parts else None

    def unparsed(self, checked: DataFrame) -> DataFrame:
        """Examples of the cells that did not parse, below the limit too: variable and examples."""
        return convert.smallest_values(checked.where(F.col(UNPARSED).isNotNull()).select(F.inline(UNPARSED)))

    def check_rows(self, checked: DataFrame, max_share: float | None = None) -> tuple[dict, list[dict]]:
        """Raise if the repair, the typing or a rule stops; return the repair's counts and all rule lines.

        Lines of columns with cells that did not parse have ``examples`` of them.
        """
        counts = repair.check_repair(repair.counts_of(checked).first().asDict(), max_share)
        lines = [r.asDict() for r in self.row_lines(checked).collect()]
        parses = {convert.rule_name(c, kind): c for c, kind in self.spec.kinds.items()}
        failing = [line for line in lines if line["rule"] in parses and line["failed"]]
        if failing:
            shown = {r["variable"]: r["examples"] for r in self.unparsed(checked).collect()}
            for line in failing:
                line["examples"] = shown[parses[line["rule"]]]
            convert.stop_on([line for line in failing if line["level"] == "stop"], parses, self.spec.max_fail_rate)
        rules.enforce(lines)
        return counts, lines

    def check_result(self, table: DataFrame) -> list[dict]:
        """Raise if a rule on the by-case table stops; return its lines."""
        lines = self.result_lines(table)
        found = [] if lines is None else [r.asDict() for r in lines.collect()]
        rules.enforce(found)
        return found


def _source_checks(spec: TableSpec) -> list[Rule]:
    return spec.source_rules() + convert.failure_rules(spec.kinds, spec.max_fail_rate, parsed=True)


def _renamed(spec: TableSpec, names: Sequence[str]) -> list[str]:
    """Final names of source columns."""
    return [spec.renames.get(n, n) for n in text.snake_names(names)]


def _prepare(spec: TableSpec, raw: DataFrame, tidy: Callable[[DataFrame], DataFrame] = _same) -> DataFrame:
    """Typed rows under their final names, with marks; rows that the repair dropped have no rule marks."""
    marked = repair.repair_shifts(raw, spec.shift).marked
    clean = tidy(repair.clean_columns(marked))
    names = [c for c in clean.columns if c != repair.MEND]
    parsed = convert.with_parsed(clean, spec.kinds)
    status = F.col(f"{repair.MEND}.status")
    stays = status.isNull() | (status == "fixed")
    source = [r for r in _source_checks(spec) if r.code is None]
    checked = parsed.select(
        "*", F.when(stays, rules.marks(source)).alias(SOURCE_MARKS), F.when(stays, convert.unparsed(spec.kinds)).alias(UNPARSED)
    )
    typed = convert.keep_parsed(checked, spec.kinds, [*names, repair.MEND, SOURCE_MARKS, UNPARSED])
    named = typed.toDF(*_renamed(spec, names), repair.MEND, SOURCE_MARKS, UNPARSED)
    return named.withColumn(TYPED_MARKS, F.when(F.col(SOURCE_MARKS).isNotNull(), rules.marks(spec.typed_rules())))


def proceedings(raw: DataFrame, lookups: Lookups) -> Stage:
    """First and last proceeding per case, for cases with one case type."""
    return Stage(specs.PROCEEDINGS, lookups, _prepare(specs.PROCEEDINGS, raw), _case_proceedings)


def _case_proceedings(df: DataFrame) -> DataFrame:
    df = df.where(F.col("idncase").isNotNull()).withColumn("in_absentia", codes.flag_from_code(F.col("in_absentia")))
    return collapse.collapse_ends(
        df,
        ["idncase"],
        ["comp_date", "dec_code", "other_comp", "idnproceeding"],
        first={
            "nta_date": "nta_date",
            "first_court_code": "base_city_code",
            "case_type_code": "case_type_code",
            "first_hearing_location_code": "hearing_loc_code",
            "first_judge_code": "judge_code",
        },
        last={
            "final_completion_date": "comp_date",
            "final_court_code": "base_city_code",
            "dec_code": "dec_code",
            "other_comp": "other_comp",
            "in_absentia": "in_absentia",
            "last_hearing_location_code": "hearing_loc_code",
            "last_judge_code": "judge_code",
            "deported_1_code": "deported_1",
            "deported_2_code": "deported_2",
        },
        constant="case_type_code",
    )


def cases(raw: DataFrame, lookups: Lookups, as_of: dt.date) -> Stage:
    """The case table, which has one row per case already."""
    checked = _prepare(specs.CASES, raw, lambda c: c.withColumn("ALIEN_ZIPCODE", text.zip5(F.col("ALIEN_ZIPCODE"))))
    return Stage(specs.CASES, lookups, checked, _case_columns, specs.birth_year_rules(as_of))


def _case_columns(df: DataFrame) -> DataFrame:
    df = columns.drop_columns(df, specs.CASE_DROPPED, missing_ok=True)
    df = df.withColumn("birth_year", text.year_of(F.col("c_birthdate"))).withColumn("represented", F.col("e28_date").isNotNull())
    return df.drop("c_birthdate")


def custody(raw: DataFrame, lookups: Lookups) -> Stage:
    """The first four detention spells per case."""
    spells = {"detention_start": "date_detained", "detention_end": "date_released"}
    return Stage(
        specs.CUSTODY,
        lookups,
        _prepare(specs.CUSTODY, raw),
        lambda df: collapse.first_n_wide(df, ["idncase"], ["date_detained", "idncustody"], 4, spells),
    )


def appeals(raw: DataFrame, lookups: Lookups) -> Stage:
    """The last appeal per case."""
    kept = (
        "bia_decision", "bia_decision_type_code", "appeal_type", "appeal_filed_by_code", "custody_at_appeal_code",
        "e27_date", "bia_decision_date", "appeal_filed_date",
    )
    order = ["bia_decision_date", "appeal_filed_date", "idn_appeal"]
    return Stage(
        specs.APPEALS,
        lookups,
        _prepare(specs.APPEALS, raw),
        lambda df: collapse.collapse_ends(df, ["idncase"], order, last={c: c for c in kept}),
    )


def applications(raw: DataFrame, lookups: Lookups) -> Stage:
    """The last decision per kind of application, the weightier one within a day."""
    known = (("tblLookupCourtAppDecisions", "str_court_appln_dec_desc", list(specs.APPLICATION_COLUMNS)),)
    return Stage(specs.APPLICATIONS, lookups, _prepare(specs.APPLICATIONS, raw), _case_applications, result_known=known)


def _case_applications(df: DataFrame) -> DataFrame:
    rank = codes.priority_rank(F.col("appl_dec"), tuple(specs.APPLICATION_DECISIONS))
    order = [F.col("appl_recd_date").cast("date"), rank, "appl_recd_date", "idnproceedingappln"]
    table = collapse.last_per_code(
        df.where(F.col("idncase").isNotNull()), ["idncase"], order, "appl_code", "appl_dec", specs.APPLICATION_COLUMNS
    )
    return columns.map_columns(
        table, lambda f: f.name.endswith("_decision_last"), lambda c: codes.recode(c, specs.APPLICATION_DECISIONS)
    )


def bonds(raw: DataFrame, lookups: Lookups) -> Stage:
    """First, second and last bond hearing per case."""
    return Stage(specs.BONDS, lookups, _prepare(specs.BONDS, raw), _case_bonds, read_twice=True)


def _case_bonds(df: DataFrame) -> DataFrame:
    kept = {
        "bond_completion_date": "bond_completion_date",
        "bond_court_code": "base_city_code",
        "bond_judge_code": "ij_code",
        "hearing_location_code": "hearing_location_code",
        "bond_hearing_request_date": "bond_hearing_request_date",
        "bond_decision": "bond_decision",
        "initial_bond_amount": "initial_bond_amount",
        "new_bond_amount": "new_bond_amount",
    }
    table = collapse.first_second_last(df, ["idncase"], ["bond_completion_date", "bond_hearing_request_date", "idnassocbond"], kept)
    return columns.map_columns(
        table, lambda f: f.name.startswith("bond_decision_"), lambda c: codes.recode(c, specs.BOND_DECISIONS)
    )


def charges(raw: DataFrame, lookups: Lookups) -> Stage:
    """The first four charges per case, each counted once per proceeding."""
    return Stage(specs.CHARGES, lookups, _prepare(specs.CHARGES, raw), _case_charges)


def _case_charges(df: DataFrame) -> DataFrame:
    cited = df.select("idncase", "idnproceeding", "idnprcdchg", codes.citation(F.col("charge")).alias("charge_section"))
    unique = collapse.distinct_first(cited, ["idncase", "idnproceeding", "charge_section"], ["idnprcdchg"])
    return collapse.first_n_wide(
        unique, ["idncase"], ["idnproceeding", "idnprcdchg"], 4, {"charge_section": "charge_section"}, nulls="first"
    )


def court_decisions(lookups: Lookups) -> tuple[DataFrame, DataFrame]:
    """The decision lookup split into decisions proper and other completions."""
    both = lookups["tblLookupCourtDecision"]
    decided = columns.project(
        both.where("str_dec_type = 'C'"),
        case_type_code="str_case_type",
        dec_code="str_dec_code",
        case_outcome="str_dec_description",
    )
    other = columns.project(
        both.where("str_dec_type = 'O'"),
        case_type_code="str_case_type",
        other_comp="str_dec_code",
        other_completion="str_dec_description",
    )
    return decided, other


def all_stages(raw: Mapping[str, DataFrame], lookups: Lookups, as_of: dt.date) -> dict[str, Stage]:
    """All stages by table name; ``raw`` holds the ragged source tables by the same names."""
    return {
        "proceedings": proceedings(raw["proceedings"], lookups),
        "cases": cases(raw["cases"], lookups, as_of),
        "custody": custody(raw["custody"], lookups),
        "appeals": appeals(raw["appeals"], lookups),
        "applications": applications(raw["applications"], lookups),
        "bonds": bonds(raw["bonds"], lookups),
        "charges": charges(raw["charges"], lookups),
    }
