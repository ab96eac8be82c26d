"""A small set of source files covering the edge cases of the release."""

from __future__ import annotations

import os

LOOKUPS = {
    "tblLanguage": (["strCode", "strDescription"], [["SP", "SPANISH"], ["EN", "ENGLISH"]]),
    "tblLookup_CasePriority": (["strCode", "strDescription"], [["D1", "detained  case"]]),
    "tblLookupAlienNat": (["strCode", "strDescription"], [["MX", "MEXICO"], ["GT", "GUATEMALA"], ["XX", "A"], ["XX", "B"]]),
    "tbllookupAppealType": (["strApplCode", "strApplDescription"], [["IJ", "CASE APPEAL from ij"]]),
    "tblLookupBaseCity": (["BASE_CITY_CODE", "BASE_CITY"], [["SFR", "SAN FRANCISCO, CA"], ["LOS", "LOS ANGELES"]]),
    "tblLookupBIADecision": (["strCode", "strDescription"], [["AFF", "AFFIRM bia"]]),
    "tblLookupBIADecisionType": (["strCode", "strDescription"], [["M", "MERIT"]]),
    "tblLookupJudge": (["JUDGE_CODE", "JUDGE_NAME"], [["AB", "Mc Adams, B."], ["CD", "Doe, C."]]),
    "tblLookupHloc": (
        ["HEARING_LOC_CODE", "HEARING_LOC_NAME"],
        [["SFR", "SAN FRANCISCO V/D"], ["IAD", "ONE"], ["IAD", "TWO"]],
    ),
    "tblLookupFiledBy": (["strCode", "strDescription"], [["A", "ALIEN"]]),
    "tblLookupCaseType": (["strCode", "strDescription"], [["RMV", "REMOVAL"], ["WHO", "WITHHOLDING ONLY"], ["EXC", "EXCLUSION"]]),
    "tblLookupSex": (["strcode", "strDescription"], [["M", "MALE"], ["F", "FEMALE"]]),
    "tblLookupCourtDecision": (
        ["idnCourtDecision", "strCaseType", "strDecType", "strDecCode", "strDecDescription"],
        [["1", "RMV", "C", "R", "RELIEF GRANTED"], ["2", "RMV", "C", "D", "REMOVE"], ["3", "RMV", "O", "A", "ADMIN CLOSING - other"],
         ["4", "WHO", "C", "", "no code given"], ["5", "BND", "C", "C", "DECREASED"], ["6", "BND", "C", "J", "NO JURISDICTION"],
         ["7", "BND", "C", "F", "FLORES"]],
    ),
    "tblLookupCourtAppDecisions": (
        ["strCourtApplnDecCode", "strCourtApplnDecDesc"],
        [["F", "FULL GRANT"], ["W", "WITHDRAWN"], ["L", "GRANT WCAT"], ["D", "DENY"]],
    ),
    "tblLookUp_Appln": (["strcode", "strdescription"], [["ASYL", "ASYLUM"], ["WCAT", "CAT"], ["245", "ADJUSTMENT"]]),
    "tblLookupCustodyStatus": (["strCode", "strDescription"], [["N", "NEVER"], ["R", "RELEASED"], ["D", "DETAINED"]]),
    "tblLookupFiling_Method": (["strFilingMethodCode", "strDescription"], [["W", "WRITTEN"]]),
    "tblLookupFiling_Method_Party": (["strFilingPartyCode", "strDescription"], [["A", "ALIEN"]]),
}

# Header names of the source tables.
PROCEEDING = [
    "IDNPROCEEDING", "IDNCASE", "OSC_DATE", "INPUT_DATE", "BASE_CITY_CODE", "HEARING_LOC_CODE", "IJ_CODE", "CASE_TYPE",
    "ABSENTIA", "COMP_DATE", "DEC_CODE", "OTHER_COMP", "DEC_TYPE", "CUSTODY", "NAT", "LANG", "TRANSFER_STATUS",
    "TRANS_IN_DATE", "HEARING_DATE", "VENUE_CHG_GRANTED", "DATE_APPEAL_DUE_STATUS", "DATE_DETAINED", "DATE_RELEASED",
    "DEPORTED_1", "DEPORTED_2", "SCHEDULED_HEAR_LOC", "PREV_HEARING_LOC", "PREV_HEARING_BASE", "TRANSFER_TO",
    "PREV_IJ_CODE", "AGGRAVATE_FELON",
]
CASE = [
    "IDNCASE", "ALIEN_CITY", "ALIEN_STATE", "ALIEN_ZIPCODE", "NAT", "LANG", "CUSTODY", "Sex", "C_BIRTHDATE", "C_ASY_TYPE",
    "CASE_TYPE", "LPR", "CASEPRIORITY_CODE", "E_28_DATE", "LATEST_HEARING", "UP_BOND_DATE", "DATE_OF_ENTRY",
    "C_RELEASE_DATE", "ADDRESS_CHANGEDON", "DATE_DETAINED", "DATE_RELEASED", "DETENTION_DATE", "DETENTION_LOCATION",
    "DCO_LOCATION", "DETENTION_FACILITY_TYPE",
]
BOND = [
    "IDNASSOCBOND", "IDNPROCEEDING", "IDNCASE", "OSC_DATE", "UPDATE_DATE", "INPUT_DATE", "COMP_DATE", "BOND_HEAR_REQ_DATE",
    "DATE_APPEAL_DUE", "E_28_DATE", "DECISION_DUE_DATE", "INITIAL_BOND", "NEW_BOND", "BASE_CITY_CODE", "HEARING_LOC_CODE",
    "IJ_CODE", "BOND_TYPE", "FILING_METHOD", "FILING_PARTY", "REL_CON", "APPEAL_REVD", "APPEAL_NOT_FILED", "DEC", "INS_TA",
]
APPEAL = [
    "idnAppeal", "idnProceeding", "idncase", "strAppealCategory", "strAppealType", "datAppealFiled", "strFiledBy",
    "datAttorneyE27", "datBIADecision", "strBIADecision", "strBIADecisionType", "strCaseType", "strLang", "strNat",
    "strCustody", "strProbono",
]
APPLICATION = ["IDNPROCEEDINGAPPLN", "IDNPROCEEDING", "IDNCASE", "APPL_CODE", "APPL_RECD_DATE", "APPL_DEC"]
HISTORY = ["IDNCUSTODY", "IDNCASE", "CUSTODY", "CHARGE", "DATDETAINED", "DATRELEASED"]
CHARGE = ["IDNPRCDCHG", "IDNCASE", "IDNPROCEEDING", "CHARGE", "CHG_STATUS"]


def at(day: str) -> str:
    return f"{day} 00:00:00.000" if day else ""


def row(names, **cells):
    return [cells.get(n, "") for n in names]


def proceeding(number, case, kind, nta, comp, dec="", other="", court="SFR", judge="AB", **more):
    base = dict(IDNPROCEEDING=str(number), IDNCASE=str(case), OSC_DATE=at(nta), BASE_CITY_CODE=court, HEARING_LOC_CODE="SFR",
                IJ_CODE=judge, CASE_TYPE=kind, COMP_DATE=at(comp), DEC_CODE=dec, OTHER_COMP=other, NAT="MX", LANG="SP")
    return row(PROCEEDING, **(base | more))


def case(number, city="SAN JOSE", state="CA", zipcode="95112-1234", **more):
    base = dict(IDNCASE=str(number), ALIEN_CITY=city, ALIEN_STATE=state, ALIEN_ZIPCODE=zipcode, NAT="MX", LANG="SP", CUSTODY="N",
                Sex="F", C_BIRTHDATE="3/1980", C_ASY_TYPE="I", CASE_TYPE="RMV", CASEPRIORITY_CODE="D1", E_28_DATE=at("2001-02-03"),
                DATE_OF_ENTRY=at("1999-01-01"))
    return row(CASE, **(base | more))


def bond(number, case_, comp, asked, dec, new, **more):
    base = dict(IDNASSOCBOND=str(number), IDNPROCEEDING="1", IDNCASE=str(case_), COMP_DATE=at(comp), BOND_HEAR_REQ_DATE=at(asked),
                INITIAL_BOND="5000", NEW_BOND=new, BASE_CITY_CODE="LOS", HEARING_LOC_CODE="IAD", IJ_CODE="CD", DEC=dec)
    return row(BOND, **(base | more))


def shifted(cells, before, names, stray=""):
    """The row with a stray cell before a column; blank trailing cells make room first."""
    cells = list(cells)
    cells.insert(names.index(before), stray)
    while len(cells) > len(names) and cells[-1] == "":
        cells.pop()
    return cells


def sources():
    proceedings = [
        PROCEEDING,
        # Case 1: an open proceeding sorts last; case 2: tie on the day, broken by the decision.
        proceeding(10, 1, "RMV", "1998-01-01", "2000-05-05", dec="D", court="LOS", judge="CD", ABSENTIA="Y", DEPORTED_1="MX"),
        proceeding(11, 1, "RMV", "1998-02-01", "", court="SFR"),
        proceeding(12, 2, "RMV", "1997-10-01", "2001-01-01", dec="R"),
        proceeding(13, 2, "RMV", "1997-10-01", "2001-01-01", dec="D", DEPORTED_1="GT", ABSENTIA="N"),
        # Case 3 mixes types with a missing one, case 4 has none, case 5 is too early, case 6 of another kind.
        proceeding(14, 3, "RMV", "2000-01-01", "2001-01-01", dec="R"),
        proceeding(15, 3, "", "2000-01-01", "2001-01-01", dec="R"),
        proceeding(16, 4, "", "2000-01-01", "2001-01-01", dec="R"),
        proceeding(17, 5, "RMV", "1997-09-30", "2001-01-01", dec="R"),
        proceeding(18, 6, "EXC", "2000-01-01", "2001-01-01", other="A"),
        # Case 7 without decision: the lookup's missing code matches; case 8 closed otherwise.
        proceeding(19, 7, "WHO", "2002-01-01", "2003-01-01", dec="", other=""),
        shifted(proceeding(20, 8, "RMV", "2002-01-01", "2003-01-01", other="A", court="LOS", ABSENTIA="N", AGGRAVATE_FELON="0"), "ABSENTIA", PROCEEDING),
    ]
    cases = [
        CASE,
        case(1), case(2, zipcode="2139", C_BIRTHDATE="1/1975"), case(3), case(4), case(5), case(6),
        # Stray tab inside the city; the rest moved one to the right.
        shifted(case(7, city="EAST", state="CA", zipcode="94601", CASE_TYPE="WHO", DETENTION_FACILITY_TYPE="P"), "ALIEN_STATE", CASE, "PALO ALTO"),
        case(8, zipcode="K1A", E_28_DATE="", Sex="M"),
    ]
    history = [HISTORY] + [
        row(HISTORY, IDNCUSTODY=str(i), IDNCASE="1", CUSTODY="D", DATDETAINED=at(f"2000-0{6 - i}-01"), DATRELEASED=at(f"2000-0{6 - i}-15"))
        for i in range(1, 6)
    ] + [row(HISTORY, IDNCUSTODY="9", IDNCASE="2", CUSTODY="R", DATDETAINED="", DATRELEASED="")]
    appeals = [
        APPEAL,
        row(APPEAL, idnAppeal="1", idnProceeding="13", idncase="2", strAppealType="IJ", datAppealFiled=at("2001-02-01"), strFiledBy="A",
            datBIADecision=at("2002-02-02"), strBIADecision="AFF", strBIADecisionType="M", strCustody="N", strProbono="Y"),
        row(APPEAL, idnAppeal="2", idnProceeding="10", idncase="1", strAppealType="IJ", datAppealFiled=at("2000-06-01"), strFiledBy="A",
            datBIADecision=at("2000-09-09"), strBIADecision="AFF", strBIADecisionType="M", strCustody="D", strProbono="N"),
        row(APPEAL, idnAppeal="3", idnProceeding="20", idncase="8", strAppealType="IJ", datAppealFiled=at("2002-06-01"), strFiledBy="A",
            datBIADecision=at("2002-09-09"), strBIADecision="AFF", strBIADecisionType="M", strCustody="R", strProbono="N"),
    ]
    applications = [
        APPLICATION,
        ["1", "10", "1", "ASYL", at("2000-01-01"), "F"],
        ["2", "10", "1", "ASYL", at("2000-01-01"), "W"],
        ["3", "10", "1", "WCAT", at("2000-01-02"), "L"],
        ["4", "13", "2", "ASYL", at("2000-01-01"), "D"],
        ["5", "13", "2", "ASYL", "", "F"],
        ["6", "13", "2", "245", at("2000-01-01"), ""],
    ]
    bonds = [
        BOND,
        bond(1, 1, "2000-01-10", "2000-01-01", "C", "1500"),
        bond(2, 1, "2000-03-10", "2000-03-01", "J", "0"),
        bond(3, 1, "2000-02-10", "2000-02-01", "R", "0"),
        bond(4, 2, "2000-02-10", "2000-02-01", "F", "0"),
        bond(5, 8, "", "2000-02-01", "", "0"),
    ]
    charges = [
        CHARGE,
        ["1", "1", "10", "212a6Ci", "S"],
        ["2", "1", "10", "212a06Ci", "S"],
        ["3", "1", "11", "212a6Ci", "O"],
        ["4", "1", "11", "237s02AiI", "O"],
        ["5", "1", "10", "237a2Biv", "O"],
        ["6", "1", "11", "212a07B", "O"],
        ["7", "2", "13", "212A06Ci", "O"],
    ]
    return {
        "B_TblProceeding": proceedings,
        "A_TblCase": cases,
        "tbl_CustodyHistory": history,
        "tblAppeal": appeals,
        "tbl_Court_Appln": applications,
        "D_TblAssociatedBond": bonds,
        "B_TblProceedCharges": charges,
    }


CROSSWALK = [
    ("95112", "CA", "06085", "Santa Clara County", "0668000", "San Jose city"),
    ("02139", "MA", "25017", "Middlesex County", "2511000", "Cambridge city"),
    ("94601", "CA", "06001", "Alameda County", None, None),
]
CROSSWALK_SCHEMA = "zcta string, stusps string, county_geoid string, county string, place_geoid string, place string"


def write_all(folder: str) -> None:
    os.makedirs(folder, exist_ok=True)

    def write(name, lines):
        with open(os.path.join(folder, name), "w", newline="") as f:
            f.write("".join("\t".join(cells) + "\n" for cells in lines))

    for name, lines in sources().items():
        write(f"{name}.csv", lines)
    for name, (header, lines) in LOOKUPS.items():
        write(f"{name}.csv", [header, *lines])
    counts = {name: len(lines) - 1 for name, lines in sources().items()}
    counts["tblAppeal"] += 4
    counts["tbl_Court_Appln"] += 5
    write("Count.txt", [[name, str(n)] for name, n in counts.items()])
