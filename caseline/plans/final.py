"""The final table: by-case tables joined, decoded, labelled and put in order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseline.functions import codes, text, values
from caseline.operators import columns, filters, joins, rules
from caseline.operators.rules import Rule
from caseline.plans import specs
from caseline.plans.specs import CODES, FILLED, KEYS
from caseline.plans.stages import Lookups, court_decisions

# Labels, days, case types and name parts that must equal those of the release.
NO_APPLICATION = "No application"
FIRST_DAY = "1997-10-01"
CASE_TYPES = ("RMV", "WHO")
MAX_DROPPED = 0.01
#: What the final rules say of a row.
MARKS = "_marks"

# Labels of custody and asylum claim codes.
CUSTODY_LABELS = {"N": "never detained", "R": "released", "D": "detained throughout"}
CLAIM_LABELS = {"I": "affirmative", "E": "defensive", "J": "J"}

# Postal codes of states, the federal district and territories.
STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME",
    "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA",
    "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC", "AS", "GU", "MP", "PR", "VI",
)

PLACES = ("first", "second", "last")

# Lookup, key, description and the columns it decodes.
DECODES = (
    ("tblLanguage", "str_code", "str_description", {"language_code": "language"}),
    ("tblLookup_CasePriority", "str_code", "str_description", {"case_priority_code": "case_priority"}),
    (
        "tblLookupAlienNat",
        "str_code",
        "str_description",
        {"nationality_code": "nationality", "deported_1_code": "deported_1", "deported_2_code": "deported_2"},
    ),
    ("tbllookupAppealType", "str_appl_code", "str_appl_description", {"appeal_type_code": "appeal_type"}),
    ("tblLookupBIADecision", "str_code", "str_description", {"bia_decision_code": "bia_decision"}),
    ("tblLookupBIADecisionType", "str_code", "str_description", {"bia_decision_type_code": "bia_decision_type"}),
    ("tblLookupFiledBy", "str_code", "str_description", {"appeal_filed_by_code": "appeal_filed_by"}),
    ("tblLookupCaseType", "str_code", "str_description", {"case_type_code": "case_type"}),
    ("tblLookupSex", "strcode", "str_description", {"sex_code": "sex"}),
)

# Labels that must be there wherever their code is.
RESOLVED = {
    "language": "language_code", "nationality": "nationality_code", "deported_1": "deported_1_code",
    "deported_2": "deported_2_code", "sex": "sex_code", "case_priority": "case_priority_code",
    "case_type": "case_type_code", "last_judge_name": "last_judge_code", "first_judge_name": "first_judge_code",
    "appeal_type": "appeal_type_code", "appeal_filed_by": "appeal_filed_by_code", "bia_decision": "bia_decision_code",
    "bia_decision_type": "bia_decision_type_code", "custody": "custody_code",
    "custody_at_appeal": "custody_at_appeal_code",
}

RENAMES = {
    "first_court_code": "court_code_first", "first_court": "court_first", "final_court_code": "court_code_last",
    "final_court": "court_last", "first_judge_code": "judge_code_first", "first_judge_name": "judge_first",
    "last_judge_code": "judge_code_last", "last_judge_name": "judge_last", "bond_judge_name_first": "bond_judge_first",
    "bond_judge_name_second": "bond_judge_second", "bond_judge_name_last": "bond_judge_last",
    "final_completion_date": "ij_completion_date_last",
}

# Days from the first to the second date, named ``{from}_to_{to}_days``.
DURATIONS = (
    ("nta_date", "ij_completion_date_last"),
    ("nta_date", "ij_or_bia_completion_date_last"),
    ("nta_date", "bond_completion_date_first"),
    ("nta_date", "bond_completion_date_second"),
    ("nta_date", "bond_completion_date_last"),
    ("appeal_filed_date", "bia_decision_date"),
    ("bond_hearing_request_date_first", "bond_completion_date_first"),
    ("bond_hearing_request_date_second", "bond_completion_date_second"),
    ("bond_hearing_request_date_last", "bond_completion_date_last"),
)


def _bond_columns(place: str) -> list[str]:
    """Bond columns of one hearing in output order."""
    return [
        f"bond_{name}_{place}"
        for name in (
            "court_code", "court", "hearing_location_code", "hearing_location", "judge_code", "judge",
            "hearing_request_date", "completion_date", "decision",
        )
    ] + [f"initial_bond_amount_{place}", f"new_bond_amount_{place}"]


def column_order() -> list[str]:
    """Leading columns of the final table."""
    # Output column names in output order.
    return [
        "idncase",
        "case_type_code", "case_type", "case_priority_code", "case_priority",
        "sex_code", "sex", "birth_year", "nationality_code", "nationality", "language_code", "language",
        "state", "state_fips_code", "county", "county_fips_code", "place", "place_fips_code",
        "entry_date", "nta_date", *[f"charge_section_{i}" for i in range(1, 5)],
        "court_code_first", "court_first", "court_code_last", "court_last",
        "hearing_location_code_first", "hearing_location_first", "hearing_location_code_last", "hearing_location_last",
        "judge_code_first", "judge_first", "judge_code_last", "judge_last",
        "deported_1_code", "deported_1", "deported_2_code", "deported_2", "e28_date", "represented", "in_absentia",
        "ij_completion_date_last", "ij_or_bia_completion_date_last",
        "custody_code", "custody", *[f"detention_{end}_{i}" for i in range(1, 5) for end in ("start", "end")],
        *[c for place in PLACES for c in _bond_columns(place)],
        "asylum_claim_type_code", "asylum_claim_type", *specs.APPLICATION_COLUMNS,
        "case_outcome",
        "appeal_type_code", "appeal_type", "appeal_filed_by_code", "appeal_filed_by", "appeal_filed_date", "e27_date",
        "custody_at_appeal_code", "custody_at_appeal", "bia_decision_code", "bia_decision", "bia_decision_type_code",
        "bia_decision_type", "bia_decision_date",
        *[f"{start}_to_{end}_days" for start, end in DURATIONS],
    ]


def crosswalk_rules() -> list[Rule]:
    """Rules on the postal crosswalk; its areas must also be distinct."""
    def no_state_suffix(column: str) -> Column:
        return F.col(column).isNull() | ~F.col(column).rlike(",? [A-Z]{2}$")

    return [
        *[rules.not_null(c) for c in ("zcta", "state", "state_fips_code", "county", "county_fips_code")],
        rules.matches("zcta", r"^\d{5}$", na_pass=False),
        rules.matches("state_fips_code", r"^\d{2}$", na_pass=False),
        rules.matches("county_fips_code", r"^\d{5}$", na_pass=False),
        rules.matches("place_fips_code", r"^\d{7}$"),
        rules.holds("county without state", ~F.col("county").rlike(",? [A-Z]{2}$")).at(*CODES),
        rules.holds("place without state", no_state_suffix("place")).at(*CODES),
        rules.valid_text("county", na_pass=False),
        rules.valid_text("place"),
        rules.aggregate_holds("diacritics kept", F.count_if(F.col("county") == "Añasco Municipio") >= 1),
        rules.in_set("state", STATES, na_pass=False).at(*CODES),
        rules.aggregate_holds("51 to 56 states", F.count_distinct("state").between(51, 56)),
        rules.aggregate_holds("32,000 to 34,000 areas", F.count_distinct("zcta").between(32_000, 34_000)),
    ]


def check_crosswalk(crosswalk: DataFrame) -> list[dict]:
    report = rules.evaluate(crosswalk, crosswalk_rules()).unionByName(rules.distinct_rows(crosswalk, ["zcta"]))
    return rules.enforce(report.collect())


def final_rules(excused: Sequence[str] = specs.CHECKED_GRANTS) -> list[Rule]:
    """Rules on the assembled table, before its labels are re-cased.

    A zero bond amount passes for the decisions in ``excused``.
    """
    amounts = [f"{kind}_bond_amount_{place}" for kind in ("initial", "new") for place in PLACES]
    return [
        rules.in_set("state", STATES).at(*CODES),
        rules.matches("county_fips_code", r"^\d{5}$").at(*CODES),
        rules.matches("place_fips_code", r"^\d{7}$").at(*CODES),
        rules.not_null("idncase").at(*KEYS),
        rules.in_set("asylum_claim_type", tuple(CLAIM_LABELS.values())).at(*CODES),
        rules.in_lookup("case_type_code", ("BND",)).at(*CODES),
        rules.in_lookup("bia_decision_type_code").at(*CODES),
        rules.in_set("custody", tuple(CUSTODY_LABELS.values())).at(*CODES),
        *[rules.at_least(c, 0.0).at(*CODES) for c in amounts],
        *[
            rules.above(f"new_bond_amount_{place}", 0.0)
            .when(~codes.one_of(F.col(f"bond_decision_{place}"), excused))
            .at(*CODES)
            for place in PLACES
        ],
        *[rules.not_null(label).when(F.col(code).isNotNull()).at(*FILLED) for label, code in RESOLVED.items()],
    ]


#: Columns that the final table needs only for a join.
USED_UP = ("alien_zipcode", "dec_code", "other_comp")


def _packed(stages: Mapping[str, DataFrame]) -> tuple[DataFrame, dict[str, str]]:
    """The seven tables joined on the case, their columns in one struct ``_case``, and where each column is.

    A join copies every column of a row by itself but a struct in one piece, so rows stay cheap through all joins and decodes.
    Columns that are used up on the way stay outside: Spark takes a struct apart below the joins where a plan drops a field of it.
    Stage tables that were written in buckets of the case join without an exchange.
    """
    bonds = stages["bonds"].withColumnsRenamed({f"hearing_location_code_{p}": f"bond_hearing_location_code_{p}" for p in PLACES})
    tables = {**stages, "bonds": bonds}
    places, packed = {"idncase": "idncase"}, {}
    for name in ("proceedings", "custody", "cases", "appeals", "applications", "bonds", "charges"):
        rest = [c for c in tables[name].columns if c != "idncase"]
        if name == "cases":  # an inner join that adds only the columns that are not there yet
            rest = [c for c in rest if c not in places]
        twice = [c for c in rest if c in places]
        if twice:
            raise ValueError(f"{name} repeats columns of other tables: {', '.join(twice)}")
        kept = [c for c in rest if c not in USED_UP]
        packed[name] = tables[name].select("idncase", *[c for c in rest if c in USED_UP], F.struct(*kept).alias(f"_{name}"))
        places |= {c: c if c in USED_UP else f"_case._{name}.{c}" for c in rest}
    cases = joins.left_by_key(packed["proceedings"], "idncase", packed["custody"])
    cases = joins.inner_by_key(cases, packed["cases"], "idncase")
    cases = joins.left_by_key(cases, "idncase", *[packed[n] for n in ("appeals", "applications", "bonds", "charges")])
    return _pack(cases, [f"_{name}" for name in packed], "_case"), places


def _pack(cases: DataFrame, names: Sequence[str], into: str) -> DataFrame:
    """These columns in one struct."""
    return cases.select(*[c for c in cases.columns if c not in names], F.struct(*names).alias(into))


def by_case(stages: Mapping[str, DataFrame]) -> DataFrame:
    """The seven tables joined on the case, one row per case."""
    cases, places = _packed(stages)
    return cases.select(*[F.col(at).alias(c) for c, at in places.items()])


#: Names in the joined tables of the columns that are renamed on the way.
RENAMED = {
    "first_hearing_location_code": "hearing_location_code_first",
    "last_hearing_location_code": "hearing_location_code_last",
    "lang": "language_code",
    "nat": "nationality_code",
    "appeal_type": "appeal_type_code",
    "bia_decision": "bia_decision_code",
}


def _attach_areas(cases: DataFrame, places: Mapping[str, str], crosswalk: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Areas in one struct, and where each is."""
    areas = [c for c in crosswalk.columns if c != "zcta"]
    cases = joins.many_to_one(cases, crosswalk, {places["alien_zipcode"]: "zcta"}, {c: c for c in areas}).drop("alien_zipcode")
    return _pack(cases, areas, "_areas"), {c: f"_areas.{c}" for c in areas}


def _attach_outcomes(cases: DataFrame, places: Mapping[str, str], lookups: Lookups) -> DataFrame:
    decided, other = court_decisions(lookups)
    for lookup, code, label in ((decided, "dec_code", "case_outcome"), (other, "other_comp", "other_completion")):
        on = {places[c]: c for c in ("case_type_code", code)}
        cases = joins.many_to_one(cases, lookup, on, {label: label}, null_safe=True).drop(code)
    return cases.withColumn("case_outcome", F.coalesce("case_outcome", "other_completion")).drop("other_completion")


def _settled(cases: DataFrame) -> DataFrame:
    """Dates and amounts settled, codes with fixed labels decoded."""
    settled = {
        "ij_or_bia_completion_date_last": values.later_date(F.col("final_completion_date"), F.col("bia_decision_date")),
        **{
            f"new_bond_amount_{p}": values.null_zero_unless(
                F.col(f"new_bond_amount_{p}"), F.col(f"bond_decision_{p}"), specs.BOND_GRANTS
            )
            for p in PLACES
        },
        **{c: values.fill_missing(F.col(c), NO_APPLICATION) for c in specs.APPLICATION_COLUMNS},
        "custody": codes.recode_strict(F.col("custody_code"), CUSTODY_LABELS),
        "asylum_claim_type": codes.recode_strict(F.col("asylum_claim_type_code"), CLAIM_LABELS),
        "custody_at_appeal": codes.recode_strict(F.col("custody_at_appeal_code"), CUSTODY_LABELS),
    }
    return cases.withColumns(settled)


def _decode_all(cases: DataFrame, lookups: Lookups, at: Mapping[str, str], measure: bool) -> tuple[DataFrame, dict[str, str]]:
    """All codes decoded, and where each label is; ``at`` says where each code is.

    Labels are cased inside the lookups, once per code instead of per case.
    """
    def placed(targets: Mapping[str, str]) -> dict[str, str]:
        return {at[c]: out for c, out in targets.items()}

    done: dict[str, str] = {}

    def packed(cases: DataFrame, names: Sequence[str], into: str) -> DataFrame:
        done.update({c: f"{into}.{c}" for c in names})
        return _pack(cases, names, into)

    for name, key, value, targets in DECODES:
        cases = joins.decode(cases, lookups[name], key, value, placed(targets), label=text.label_case, measure=measure)
    cases = packed(cases, [out for *_, targets in DECODES for out in targets.values()], "_labels")

    city = lookups["tblLookupBaseCity"]
    courts = city.select("base_city_code", text.name_with_code(F.col("base_city"), F.col("base_city_code")).alias("court"))
    targets = {"first_court_code": "first_court", "final_court_code": "final_court"}
    targets |= {f"bond_court_code_{p}": f"bond_court_{p}" for p in PLACES}
    cases = joins.decode(
        cases, courts, "base_city_code", "court", placed(targets), label=text.title_before_bracket, measure=measure
    )
    cases = packed(cases, list(targets.values()), "_courts")

    targets = {"first_judge_code": "first_judge_name", "last_judge_code": "last_judge_name"}
    targets |= {f"bond_judge_code_{p}": f"bond_judge_name_{p}" for p in PLACES}
    cases = joins.decode(cases, lookups["tblLookupJudge"], "judge_code", "judge_name", placed(targets), measure=measure)
    cases = packed(cases, list(targets.values()), "_judges")

    # A place code shared by several places cannot be resolved and stays without a name.
    places = lookups["tblLookupHloc"].select("hearing_loc_code", "hearing_loc_name")
    targets = {f"hearing_location_code_{p}": f"hearing_location_{p}" for p in ("first", "last")}
    targets |= {f"bond_hearing_location_code_{p}": f"bond_hearing_location_{p}" for p in PLACES}
    cases = joins.decode(
        cases,
        joins.unique_keys_only(places, "hearing_loc_code"),
        "hearing_loc_code",
        "hearing_loc_name",
        placed(targets),
        label=text.label_case,
        measure=measure,
    )
    return cases, {**done, **{c: c for c in targets.values()}}


def _is_label(name: str) -> bool:
    """Whether a text column is a label to be cased: not a code, court, judge, charge or area."""
    lowered = name.lower()
    parts = ("_code", "_court", "judge_name", "charge_section", "fips", "state")
    return not any(p in lowered for p in parts) and name not in ("county", "place", "first_court", "final_court")


def _case_labels(cases: DataFrame) -> DataFrame:
    """Case the labels that no lookup has cased yet.

    Known labels map to literals that Spark cases while planning; other text takes the slow way.
    """
    done = {out for *_, targets in DECODES for out in targets.values()} | {f"hearing_location_{p}" for p in PLACES}
    done |= {f"bond_hearing_location_{p}" for p in PLACES}
    known = [
        *specs.BOND_DECISIONS.values(), *specs.APPLICATION_DECISIONS.values(), NO_APPLICATION,
        *CUSTODY_LABELS.values(), *CLAIM_LABELS.values(),
    ]
    table = F.create_map(*[c for label in dict.fromkeys(known) for c in (F.lit(label), text.label_literal(label))])
    names = [f.name for f in cases.schema if f.dataType.simpleString() == "string" and f.name not in done and _is_label(f.name)]
    # one expression over all labels, so that the slow way stands in the plan once
    cased = F.transform(F.array(*names), lambda c: F.coalesce(F.try_element_at(table, c), text.label_case(c)))
    at = {c: i for i, c in enumerate(names)}
    return cases.withColumn("_cased", cased).select(
        *[F.get("_cased", F.lit(at[c])).alias(c) if c in at else F.col(c) for c in cases.columns]
    )


def assembled(
    stages: Mapping[str, DataFrame], lookups: Lookups, crosswalk: DataFrame, excused: Sequence[str] = specs.CHECKED_GRANTS, measure: bool = False
) -> DataFrame:
    """All cases with their labels as decoded, before the cohort filter, and in ``_marks`` what the final rules say.

    A job writes this table, counts the marks of the committed files and goes on only if they pass.
    ``measure`` measures each lookup before it may be broadcast instead of trusting the size estimate.
    """
    cases, places = _packed(stages)
    named = {RENAMED.get(c, c): at for c, at in places.items()}
    cases, areas = _attach_areas(cases, places, crosswalk)
    cases, labels = _decode_all(_attach_outcomes(cases, places, lookups), lookups, named, measure)
    added = {**areas, "case_outcome": "case_outcome", **labels}
    every = {c: at for c, at in named.items() if c not in added and c not in USED_UP} | added
    cases = _settled(cases.select(*[F.col(at).alias(c) for c, at in every.items()]))
    cases = columns.to_front(cases, [c for c in cases.columns if c not in labels])
    return cases.withColumn(MARKS, rules.marks([r for r in final_rules(excused) if r.code is None]))


def final_lines(cases: DataFrame, lookups: Lookups, excused: Sequence[str] = specs.CHECKED_GRANTS) -> DataFrame:
    """Rule lines of an assembled table."""
    every = final_rules(excused)
    plain, members = [r for r in every if r.code is None], [r for r in every if r.code is not None]
    known = [(lookups["tblLookupCaseType"], "str_code", ["case_type_code"]), (lookups["tblLookupBIADecisionType"], "str_code", ["bia_decision_type_code"])]
    lines = rules.count_marks(cases, MARKS, plain).unionByName(rules.count_members(cases, members, known))
    return lines.select(F.lit("final").alias("table"), *lines.columns)


def finished(cases: DataFrame) -> DataFrame:
    """The release of an assembled table: labels cased, names, durations and column order, the cohort alone."""
    cases = columns.map_columns(cases.drop(MARKS), lambda f: f.dataType.simpleString() == "timestamp", values.utc_date)
    cases = columns.rename(_case_labels(cases), RENAMES)
    cases = cases.withColumns({f"{a}_to_{b}_days": values.days_between(F.col(b), F.col(a)) for a, b in DURATIONS})
    return filters.cohort(columns.to_front(cases, column_order()), "nta_date", FIRST_DAY, "case_type_code", CASE_TYPES)


def build_final(stages: Mapping[str, DataFrame], lookups: Lookups, crosswalk: DataFrame, measure: bool = False) -> DataFrame:
    """The final table in its column order, for cases since the cohort's first day, in one plan.

    Its rules aren't looked at, so the cohort filter moves below all joins.
    """
    return finished(assembled(stages, lookups, crosswalk, measure=measure))


def unique_lookups(lookups: Lookups) -> dict[str, tuple[DataFrame, list[str]]]:
    """Lookups that a key may occur in only once, with their keys; the others are decoded null-safe or where they are unique."""
    plain = {name: key for name, key, _, _ in DECODES} | {"tblLookupBaseCity": "base_city_code", "tblLookupJudge": "judge_code"}
    return {name: (lookups[name], [key]) for name, key in plain.items()}


def lookup_uses() -> list[tuple[str, str]]:
    """Which code columns of the joined by-case tables are decoded with which of them."""
    named = {"language_code": "lang", "nationality_code": "nat", "appeal_type_code": "appeal_type", "bia_decision_code": "bia_decision"}
    uses = [(name, named.get(c, c)) for name, _, _, targets in DECODES for c in targets]
    uses += [("tblLookupBaseCity", c) for c in ("first_court_code", "final_court_code", *[f"bond_court_code_{p}" for p in PLACES])]
    return uses + [("tblLookupJudge", c) for c in ("first_judge_code", "last_judge_code", *[f"bond_judge_code_{p}" for p in PLACES])]


def used_duplicates(stages: Mapping[str, DataFrame], lookups: Lookups) -> DataFrame:
    """Lookup keys that occur more than once and that a case uses."""
    return joins.used_duplicates(joins.duplicate_keys(unique_lookups(lookups)), by_case(stages), lookup_uses())


def join_report(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Cases the inner join with the case table keeps and drops."""
    return joins.inner_join_report(stages["proceedings"], stages["cases"], "idncase", MAX_DROPPED)


def override_count(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Cases whose appeal was decided after the first court's completion, or without one."""
    both = joins.left_by_key(stages["proceedings"], "idncase", stages["appeals"])
    later = F.col("final_completion_date").isNull() | (F.col("bia_decision_date").cast("date") > F.col("final_completion_date"))
    return both.agg(F.count_if(F.col("bia_decision_date").isNotNull() & later).alias("overridden"))
