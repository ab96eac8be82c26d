"""Declarations of the seven source tables: files, date layout, types, names and quality rules.

Rules are built by functions because column expressions need a running session.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from caseline.operators import rules as r
from caseline.operators.repair import Cell, Merge, ShiftRules
from caseline.operators.rules import DATE_START, DIGITS, Rule

# Warning and stop shares used by many rules.
# Fixed values throughout this module: column and file names, warn and stop levels, code lists, labels,
# the columns of the shift rules, the kinds and the renames must equal those of the source tables.
KEYS = (0.005, 0.01)
CODES = (0.0001, 0.001)
DATES = (0.001, 0.01)
FILLED = (0.01, 0.05)

NUMBER = r"^\d*(\.\d+)?$"


@dataclass(frozen=True)
class TableSpec:
    """One source table.

    ``known`` lists ``(lookup, key, columns)`` whose codes are checked. ``source_rules`` see clean
    text under source names, ``typed_rules`` typed columns under final names, ``result_rules`` the
    table the stage writes.
    """

    name: str
    file: str
    shift: ShiftRules
    kinds: Mapping[str, str]
    renames: Mapping[str, str] = field(default_factory=dict)
    known: Sequence[tuple[str, str, Sequence[str]]] = ()
    max_fail_rate: float | None = 0.001
    source_rules: Callable[[], list[Rule]] = list
    typed_rules: Callable[[], list[Rule]] = list
    result_rules: Callable[[], list[Rule]] = list


def _lookups(*columns: str, at: tuple[float, float] = CODES, extra: Sequence[str] = ()) -> list[Rule]:
    return [r.in_lookup(c, extra).at(*at) for c in columns]


def _keys(*columns: str) -> list[Rule]:
    return [r.not_null(c).at(*KEYS) for c in columns]


def _digits(*columns: str) -> list[Rule]:
    return [r.matches(c, DIGITS) for c in columns]


def _sets(**values: Sequence[str]) -> list[Rule]:
    return [r.in_set(c, v).at(*CODES) for c, v in values.items()]


# --- proceedings ---------------------------------------------------------------------------------

PROCEEDINGS = TableSpec(
    name="proceedings",
    file="B_TblProceeding.csv",
    shift=ShiftRules(
        dates=(
            "OSC_DATE", "INPUT_DATE", "TRANS_IN_DATE", "HEARING_DATE", "COMP_DATE", "VENUE_CHG_GRANTED",
            "DATE_APPEAL_DUE_STATUS", "DATE_DETAINED", "DATE_RELEASED",
        ),
        others=("CUSTODY", "CASE_TYPE", "NAT", "LANG", "ABSENTIA", "TRANSFER_STATUS"),
    ),
    kinds={
        "IDNPROCEEDING": "integer", "IDNCASE": "integer", "OSC_DATE": "date", "INPUT_DATE": "date",
        "TRANS_IN_DATE": "date", "HEARING_DATE": "date", "COMP_DATE": "date", "VENUE_CHG_GRANTED": "date",
        "DATE_APPEAL_DUE_STATUS": "date", "DATE_DETAINED": "date", "DATE_RELEASED": "date",
    },
    max_fail_rate=None,
    renames={"osc_date": "nta_date", "absentia": "in_absentia", "case_type": "case_type_code", "ij_code": "judge_code"},
    known=(
        ("tblLookupCaseType", "str_code", ("CASE_TYPE",)),
        ("tblLookupCustodyStatus", "str_code", ("CUSTODY",)),
        ("tblLookupAlienNat", "str_code", ("NAT", "DEPORTED_1", "DEPORTED_2")),
        ("tblLanguage", "str_code", ("LANG",)),
        ("tblLookupBaseCity", "base_city_code", ("BASE_CITY_CODE", "PREV_HEARING_BASE", "TRANSFER_TO")),
        ("tblLookupHloc", "hearing_loc_code", ("HEARING_LOC_CODE", "SCHEDULED_HEAR_LOC", "PREV_HEARING_LOC")),
        ("tblLookupJudge", "judge_code", ("IJ_CODE", "PREV_IJ_CODE")),
        ("tblLookupCourtDecision", "str_dec_code", ("DEC_CODE", "OTHER_COMP")),
    ),
    source_rules=lambda: [
        *_keys("IDNPROCEEDING", "IDNCASE"),
        r.matches("IDNPROCEEDING", DIGITS).at(*CODES),
        *_digits("IDNCASE"),
        *_lookups("CASE_TYPE", extra=("BND",)),
        *_lookups("CUSTODY"),
        *_sets(ABSENTIA=("Y", "N"), TRANSFER_STATUS=("C", "T", "V")),
        r.in_set("DEC_TYPE", ("A", "C", "O", "R", "T", "W", "X", "6", "7")).at(*DATES),
        *_lookups("NAT", "DEPORTED_1", "DEPORTED_2"),
        r.holds(
            "second country needs a first", F.col("DEPORTED_2").isNull() | F.col("DEPORTED_1").isNotNull()
        ).at(*KEYS),
        r.holds(
            "countries differ",
            F.col("DEPORTED_1").isNull() | F.col("DEPORTED_2").isNull() | (F.col("DEPORTED_1") != F.col("DEPORTED_2")),
        ).at(*DATES),
        r.holds(
            "deportation has a country",
            F.col("DEC_CODE").isNull() | (F.col("DEC_CODE") != "D") | F.col("DEPORTED_1").isNotNull(),
        ).at(*FILLED),
        *_lookups("LANG", "BASE_CITY_CODE", "HEARING_LOC_CODE", "SCHEDULED_HEAR_LOC", "PREV_HEARING_LOC"),
        *_lookups("PREV_HEARING_BASE"),
        *_lookups("TRANSFER_TO", at=(0.0001, 0.025)),
        *_lookups("IJ_CODE", "PREV_IJ_CODE", at=(0.0001, 0.0025)),
        *_lookups("DEC_CODE", "OTHER_COMP"),
    ],
    typed_rules=lambda: [
        r.ordered("nta_date", "comp_date").at(*DATES),
        r.ordered("date_detained", "date_released").at(*DATES),
    ],
    result_rules=lambda: [
        r.not_null("final_completion_date").at(0.25, 0.5),
        r.not_null("nta_date").at(*FILLED),
        r.ordered("nta_date", "final_completion_date").at(*DATES),
        *[
            r.not_null(c).at(*FILLED)
            for c in ("first_court_code", "final_court_code", "first_judge_code", "last_judge_code")
        ],
    ],
)

# --- cases ---------------------------------------------------------------------------------------


def _address_starts(cell: Cell):
    """A postal code holding two capitals is a state that was pushed one cell to the right."""
    pushed = F.coalesce(cell("ALIEN_ZIPCODE").rlike("^[A-Z]{2}$"), F.lit(False))
    no_city = F.coalesce(cell("ALIEN_CITY") == "", F.lit(True))
    state = cell("ALIEN_STATE")
    split_city = F.coalesce((state != "") & ~state.rlike("^[A-Z]{2}$"), F.lit(False))
    return [
        (pushed & no_city, "ALIEN_CITY", None),
        (pushed & split_city, "ALIEN_STATE", Merge("ALIEN_CITY", "ALIEN_STATE")),
        (pushed, "ALIEN_STATE", None),
    ]


CASE_DATES = (
    "E_28_DATE", "LATEST_HEARING", "UP_BOND_DATE", "DATE_OF_ENTRY", "C_RELEASE_DATE", "ADDRESS_CHANGEDON",
    "DATE_DETAINED", "DATE_RELEASED",
)

# Columns of the case table that the final table does without.
CASE_DROPPED = (
    "lpr", "site_type", "atty_nbr", "update_site", "latest_hearing", "latest_time", "latest_cal_type", "up_bond_date",
    "up_bond_rsn", "correctional_fac", "release_year", "release_month", "inmate_housing", "updated_state",
    "updated_city", "updated_zipcode", "alien_city", "alien_state", "address_changedon", "zbond_mrg_flag",
    "dco_location", "detention_facility_type", "case_type", "c_release_date", "date_detained", "date_released",
    "detention_date", "detention_location",
)

CASES = TableSpec(
    name="cases",
    file="A_TblCase.csv",
    shift=ShiftRules(
        dates=(*CASE_DATES, "DETENTION_DATE"),
        others=(
            "Sex", "CUSTODY", "NAT", "LANG", "CASE_TYPE", "C_ASY_TYPE", "LPR", "CASEPRIORITY_CODE",
            "DETENTION_LOCATION", "DCO_LOCATION", "DETENTION_FACILITY_TYPE",
        ),
        special=_address_starts,
    ),
    kinds={"IDNCASE": "integer", **{c: "datetime" for c in CASE_DATES}},
    renames={
        "c_asy_type": "asylum_claim_type_code", "sex": "sex_code", "custody": "custody_code",
        "casepriority_code": "case_priority_code", "e_28_date": "e28_date", "date_of_entry": "entry_date",
    },
    known=(
        ("tblLookupSex", "strcode", ("Sex",)),
        ("tblLookupCaseType", "str_code", ("CASE_TYPE",)),
        ("tblLookupCustodyStatus", "str_code", ("CUSTODY",)),
        ("tblLookupAlienNat", "str_code", ("NAT",)),
        ("tblLanguage", "str_code", ("LANG",)),
        ("tblLookup_CasePriority", "str_code", ("CASEPRIORITY_CODE",)),
    ),
    source_rules=lambda: [
        *_keys("IDNCASE"),
        *_digits("IDNCASE"),
        *_lookups("Sex", extra=("N", "U")),
        *_sets(C_ASY_TYPE=("E", "I", "J")),
        *_lookups("CASE_TYPE", extra=("BND",)),
        *_lookups("CUSTODY"),
        *_sets(LPR=("0", "1")),
        *_lookups("NAT", "LANG", "CASEPRIORITY_CODE"),
        r.matches("ALIEN_STATE", "^[A-Z]{2}$").at(*DATES),
        r.matches("ALIEN_ZIPCODE", r"^\d{5}$").at(*DATES),
        r.matches("DETENTION_DATE", DATE_START).at(*CODES),
    ],
)


def birth_year_rules(as_of: dt.date) -> list[Rule]:
    return [r.between("birth_year", 1900, as_of.year).at(*DATES)]


# --- charges -------------------------------------------------------------------------------------

CHARGES = TableSpec(
    name="charges",
    file="B_TblProceedCharges.csv",
    shift=ShiftRules(others=("CHARGE", "CHG_STATUS")),
    kinds={"IDNPRCDCHG": "integer", "IDNCASE": "integer", "IDNPROCEEDING": "integer"},
    source_rules=lambda: [
        *_keys("IDNPRCDCHG", "IDNCASE", "IDNPROCEEDING"),
        *_digits("IDNPRCDCHG", "IDNCASE", "IDNPROCEEDING"),
        r.not_null("CHARGE").at(0.0001, 0.005),
        r.matches("CHARGE", r"^(212|237|241|242|246|215)[a-zA-Z]\d").at(*DATES),
        *_sets(CHG_STATUS=("N", "O", "S", "W", "s", "w")),
    ],
    result_rules=lambda: [r.not_null("charge_section_1").at(*FILLED)],
)

# --- bonds ---------------------------------------------------------------------------------------

# Bond decisions by code, and those for which a zero amount is meaningful.
BOND_DECISIONS = {
    "G": "AMELIORATION GRANTED",
    "W": "BOND REQUEST WITHDRAWN",
    "D": "AMELIORATION DENIED-NO JURISDICTION",
    "I": "BOND AMOUNT INCREASED",
    "E": "AMELIORATION DENIED",
    "O": "OTHER",
    "F": "FLORES - RELEASE",
    "L": "FLORES - NO RELEASE",
    "A": "BOND DENIED-MOOT",
    "C": "BOND GRANTED-AMOUNT DECREASED",
    "J": "BOND DENIED-NO JURISDICTION",
    "N": "BOND DENIED- NO CHANGE (NO BOND SET BY DHS)",
    "S": "BOND DENIED- NO CHANGE (DHS BOND AMOUNT UNCHANGED)",
    "R": "BOND GRANTED-OWN RECOGNIZANCE",
}
# The grants whose zero amounts the stage keeps, and those that the release check excuses.
BOND_GRANTS = (
    "AMELIORATION GRANTED", "BOND GRANTED-AMOUNT DECREASED", "BOND GRANTED-OWN RECOGNIZANCE", "FLORES - RELEASE",
)
CHECKED_GRANTS = ("AMELIORATION GRANTED", "BOND GRANTED-AMOUNT DECREASED", "BOND GRANTED-OWN RECOGNIZANCE")

BONDS = TableSpec(
    name="bonds",
    file="D_TblAssociatedBond.csv",
    shift=ShiftRules(
        dates=(
            "OSC_DATE", "UPDATE_DATE", "INPUT_DATE", "COMP_DATE", "BOND_HEAR_REQ_DATE", "DATE_APPEAL_DUE", "E_28_DATE",
            "DECISION_DUE_DATE",
        ),
        others=(
            "NEW_BOND", "BOND_TYPE", "FILING_METHOD", "FILING_PARTY", "INITIAL_BOND", "REL_CON", "APPEAL_REVD",
            "APPEAL_NOT_FILED", "DEC", "INS_TA",
        ),
    ),
    kinds={
        "IDNASSOCBOND": "integer", "IDNPROCEEDING": "integer", "IDNCASE": "integer", "OSC_DATE": "datetime",
        "UPDATE_DATE": "datetime", "INPUT_DATE": "datetime", "COMP_DATE": "date", "BOND_HEAR_REQ_DATE": "date",
        "DATE_APPEAL_DUE": "datetime", "E_28_DATE": "datetime", "DECISION_DUE_DATE": "datetime",
        "INITIAL_BOND": "double", "NEW_BOND": "double",
    },
    renames={
        "comp_date": "bond_completion_date", "bond_hear_req_date": "bond_hearing_request_date", "dec": "bond_decision",
        "initial_bond": "initial_bond_amount", "new_bond": "new_bond_amount", "hearing_loc_code": "hearing_location_code",
    },
    known=(
        ("tblLookupCourtDecision", "str_dec_code", ("DEC",)),
        ("tblLookupBaseCity", "base_city_code", ("BASE_CITY_CODE",)),
        ("tblLookupHloc", "hearing_loc_code", ("HEARING_LOC_CODE",)),
        ("tblLookupJudge", "judge_code", ("IJ_CODE",)),
        ("tblLookupFiling_Method", "str_filing_method_code", ("FILING_METHOD",)),
        ("tblLookupFiling_Method_Party", "str_filing_party_code", ("FILING_PARTY",)),
    ),
    source_rules=lambda: [
        *_keys("IDNASSOCBOND", "IDNPROCEEDING", "IDNCASE"),
        *_digits("IDNASSOCBOND", "IDNPROCEEDING", "IDNCASE"),
        *_lookups("DEC", extra=("I", "R")),
        *_sets(BOND_TYPE=("BB", "BD", "SB")),
        *_lookups("BASE_CITY_CODE", "HEARING_LOC_CODE"),
        *_lookups("IJ_CODE", at=(0.001, 0.005)),
        *_lookups("FILING_METHOD", "FILING_PARTY"),
        r.matches("INITIAL_BOND", NUMBER).at(*CODES),
        r.matches("NEW_BOND", NUMBER).at(*CODES),
    ],
    typed_rules=lambda: [
        r.at_least("initial_bond_amount", 0.0),
        r.at_least("new_bond_amount", 0.0),
        r.ordered("bond_hearing_request_date", "bond_completion_date").at(*DATES),
    ],
    result_rules=lambda: [
        r.not_in_set(f"bond_decision_{place}", tuple(BOND_DECISIONS)).at(*CODES) for place in ("first", "second", "last")
    ],
)

# --- applications ----------------------------------------------------------------------------------

# Application decisions, substantive ones before administrative ones, and the
# application types with a column of their own.
APPLICATION_DECISIONS = {
    "F": "FULL GRANT",
    "G": "GRANT",
    "D": "DENY",
    "C": "CONDITIONAL GRANT",
    "I": "IN COURT STIPULATED GRANT",
    "L": "GRANT WCAT",
    "P": "PAPER STIPULATED GRANT",
    "S": "ADMIN CLOSURE",
    "A": "ABANDONMENT",
    "R": "RESERVED",
    "O": "OTHER",
    "T": "COV/TRANSFER",
    "W": "WITHDRAWN",
    "M": "NOT ADJUDICATED",
}
APPLICATION_COLUMNS = {
    "asylum_decision_last": "ASYL",
    "withholding_decision_last": "ASYW",
    "cat_decision_last": "WCAT",
    "adjustment_decision_last": "245",
    "non_lpr_cancellation_decision_last": "42B",
    "lpr_cancellation_decision_last": "42A",
}

APPLICATIONS = TableSpec(
    name="applications",
    file="tbl_Court_Appln.csv",
    shift=ShiftRules(dates=("APPL_RECD_DATE",), others=("APPL_CODE", "APPL_DEC")),
    kinds={
        "IDNPROCEEDINGAPPLN": "integer", "IDNPROCEEDING": "integer", "IDNCASE": "integer", "APPL_RECD_DATE": "datetime",
    },
    known=(
        ("tblLookUp_Appln", "strcode", ("APPL_CODE",)),
        ("tblLookupCourtAppDecisions", "str_court_appln_dec_code", ("APPL_DEC",)),
    ),
    source_rules=lambda: [
        *_keys("IDNPROCEEDINGAPPLN", "IDNPROCEEDING", "IDNCASE"),
        *_digits("IDNPROCEEDINGAPPLN", "IDNPROCEEDING", "IDNCASE"),
        *_lookups("APPL_CODE", "APPL_DEC", at=(0.0001, 0.005)),
        r.matches("APPL_RECD_DATE", DATE_START).at(*CODES),
    ],
    result_rules=lambda: _lookups(*APPLICATION_COLUMNS),
)

# --- custody and appeals -----------------------------------------------------------------------------

CUSTODY = TableSpec(
    name="custody",
    file="tbl_CustodyHistory.csv",
    shift=ShiftRules(dates=("DATDETAINED", "DATRELEASED"), others=("CUSTODY",)),
    kinds={"IDNCUSTODY": "integer", "IDNCASE": "integer", "DATDETAINED": "datetime", "DATRELEASED": "datetime"},
    renames={"datdetained": "date_detained", "datreleased": "date_released"},
    known=(("tblLookupCustodyStatus", "str_code", ("CUSTODY",)),),
    source_rules=lambda: [*_keys("IDNCUSTODY", "IDNCASE"), *_lookups("CUSTODY")],
    typed_rules=lambda: [r.ordered("date_detained", "date_released").at(*DATES)],
    result_rules=lambda: [
        r.ordered("detention_start_1", "detention_start_2").at(*DATES),
        r.ordered("detention_start_2", "detention_start_3").at(*DATES),
    ],
)

APPEALS = TableSpec(
    name="appeals",
    file="tblAppeal.csv",
    shift=ShiftRules(
        dates=("datAppealFiled", "datAttorneyE27", "datBIADecision"),
        others=(
            "strAppealCategory", "strAppealType", "strFiledBy", "strBIADecision", "strBIADecisionType", "strCaseType",
            "strLang", "strNat", "strCustody", "strProbono",
        ),
    ),
    kinds={
        "idnAppeal": "integer", "idnProceeding": "integer", "idncase": "integer", "datAppealFiled": "datetime",
        "datBIADecision": "datetime", "datAttorneyE27": "datetime",
    },
    renames={
        "dat_appeal_filed": "appeal_filed_date", "dat_bia_decision": "bia_decision_date", "dat_attorney_e27": "e27_date",
        "str_bia_decision": "bia_decision", "str_bia_decision_type": "bia_decision_type_code",
        "str_appeal_type": "appeal_type", "str_filed_by": "appeal_filed_by_code", "str_custody": "custody_at_appeal_code",
    },
    known=(
        ("tblLookupBIADecision", "str_code", ("strBIADecision",)),
        ("tblLookupBIADecisionType", "str_code", ("strBIADecisionType",)),
        ("tbllookupAppealType", "str_appl_code", ("strAppealType",)),
        ("tblLookupCaseType", "str_code", ("strCaseType",)),
        ("tblLookupAlienNat", "str_code", ("strNat",)),
        ("tblLanguage", "str_code", ("strLang",)),
    ),
    source_rules=lambda: [
        *_keys("idncase"),
        *_digits("idncase", "idnAppeal"),
        r.matches("idnProceeding", DIGITS).at(*CODES),
        r.in_set("strAppealCategory", ("DD", "IJ", "MA", "ij")),
        *_lookups("strBIADecision"),
        *_lookups("strBIADecisionType", at=(0.00001, 0.0001)),
        *_lookups("strAppealType"),
        *_lookups("strCaseType", extra=("BND",)),
        *_sets(strCustody=("D", "N", "R")),
        *_lookups("strNat", "strLang"),
        *_sets(strProbono=("Y", "N")),
    ],
    typed_rules=lambda: [r.ordered("appeal_filed_date", "bia_decision_date").at(*DATES)],
    result_rules=lambda: _sets(custody_at_appeal_code=("D", "N", "R")),
)

TABLES = (PROCEEDINGS, CASES, CUSTODY, APPEALS, APPLICATIONS, BONDS, CHARGES)

# Names of the lookup files.
LOOKUP_FILES = (
    "tblLanguage", "tblLookup_CasePriority", "tblLookupAlienNat", "tbllookupAppealType", "tblLookupBaseCity",
    "tblLookupBIADecision", "tblLookupBIADecisionType", "tblLookupJudge", "tblLookupHloc", "tblLookupFiledBy",
    "tblLookupCaseType", "tblLookupSex", "tblLookupCourtDecision", "tblLookupCourtAppDecisions", "tblLookUp_Appln",
    "tblLookupCustodyStatus", "tblLookupFiling_Method", "tblLookupFiling_Method_Party",
)
