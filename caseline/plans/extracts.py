"""The analytics tables in the shape of raw extracts, so that the stages can run over them.

Customers are the cases; orders, order lines and events are what happens in them. Every table keeps
all rows of its source. Some rows get a stray cell, as real extracts have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseline.operators.repair import OVERFLOW

# Header lines; columns nobody fills are left empty.
# Header names of the source tables.
PROCEEDING = (
    "IDNPROCEEDING", "IDNCASE", "OSC_DATE", "INPUT_DATE", "BASE_CITY_CODE", "HEARING_LOC_CODE", "IJ_CODE", "CASE_TYPE",
    "ABSENTIA", "COMP_DATE", "DEC_CODE", "OTHER_COMP", "DEC_TYPE", "CUSTODY", "NAT", "LANG", "TRANSFER_STATUS",
    "TRANS_IN_DATE", "HEARING_DATE", "VENUE_CHG_GRANTED", "DATE_APPEAL_DUE_STATUS", "DATE_DETAINED", "DATE_RELEASED",
    "DEPORTED_1", "DEPORTED_2", "SCHEDULED_HEAR_LOC", "PREV_HEARING_LOC", "PREV_HEARING_BASE", "TRANSFER_TO",
    "PREV_IJ_CODE", "AGGRAVATE_FELON",
)
CASE = (
    "IDNCASE", "ALIEN_CITY", "ALIEN_STATE", "ALIEN_ZIPCODE", "NAT", "LANG", "CUSTODY", "Sex", "C_BIRTHDATE", "C_ASY_TYPE",
    "CASE_TYPE", "LPR", "CASEPRIORITY_CODE", "E_28_DATE", "LATEST_HEARING", "UP_BOND_DATE", "DATE_OF_ENTRY",
    "C_RELEASE_DATE", "ADDRESS_CHANGEDON", "DATE_DETAINED", "DATE_RELEASED", "DETENTION_DATE", "DETENTION_LOCATION",
    "DCO_LOCATION", "DETENTION_FACILITY_TYPE",
)
BOND = (
    "IDNASSOCBOND", "IDNPROCEEDING", "IDNCASE", "OSC_DATE", "UPDATE_DATE", "INPUT_DATE", "COMP_DATE", "BOND_HEAR_REQ_DATE",
    "DATE_APPEAL_DUE", "E_28_DATE", "DECISION_DUE_DATE", "INITIAL_BOND", "NEW_BOND", "BASE_CITY_CODE", "HEARING_LOC_CODE",
    "IJ_CODE", "BOND_TYPE", "FILING_METHOD", "FILING_PARTY", "REL_CON", "APPEAL_REVD", "APPEAL_NOT_FILED", "DEC", "INS_TA",
)
APPEAL = (
    "idnAppeal", "idnProceeding", "idncase", "strAppealCategory", "strAppealType", "datAppealFiled", "strFiledBy",
    "datAttorneyE27", "datBIADecision", "strBIADecision", "strBIADecisionType", "strCaseType", "strLang", "strNat",
    "strCustody", "strProbono",
)
APPLICATION = ("IDNPROCEEDINGAPPLN", "IDNPROCEEDING", "IDNCASE", "APPL_CODE", "APPL_RECD_DATE", "APPL_DEC")
HISTORY = ("IDNCUSTODY", "IDNCASE", "CUSTODY", "CHARGE", "DATDETAINED", "DATRELEASED")
CHARGE = ("IDNPRCDCHG", "IDNCASE", "IDNPROCEEDING", "CHARGE", "CHG_STATUS")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _stamp(moment: str, days: int = 0) -> Column:
    return F.concat(F.date_add(F.col(moment).cast("date"), days).cast("string"), F.lit(" 00:00:00.000"))


def _pick(column: Column, **values: str | None) -> Column:
    """Value by the first letter or digit of a text, NULL for others."""
    chosen = F.lit(None).cast("string")
    for key, value in values.items():
        chosen = F.when(F.substring(column, 1, 1) == key[-1], F.lit(value)).otherwise(chosen)
    return chosen


def _ragged(
    df: DataFrame, header: tuple[str, ...], cells: dict[str, Column], stray: tuple[str, str | None, Column] | None = None
) -> DataFrame:
    """Text table; where ``stray = (column, text, condition)`` holds, an extra cell stands before the column."""
    texts = [cells[c].cast("string") if c in cells else F.lit(None).cast("string") for c in header]
    if stray is None:
        return df.select(*[t.alias(c) for t, c in zip(texts, header)], F.lit(None).cast("array<string>").alias(OVERFLOW))
    before, text, condition = stray
    at = header.index(before)
    longer = [*texts[:at], F.lit(text).cast("string"), *texts[at:]]
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[F.when(hit, longer[i]).otherwise(texts[i]).alias(c) for i, c in enumerate(header)],
        F.when(hit, F.array(longer[-1])).alias(OVERFLOW),
    )


def proceedings(spark: SparkSession, folder: str) -> DataFrame:
    """Every order is a proceeding; a few urgent ones are of another case type."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    other_type = (status == "P") & (priority == "1-URGENT") & (F.col("o_totalprice") > 450_000)
    done = status != "O"
    cells = {
        "IDNPROCEEDING": F.col("o_orderkey"),
        "IDNCASE": F.col("o_custkey"),
        "OSC_DATE": _stamp("o_orderdate", 800),
        "BASE_CITY_CODE": F.substring(priority, 3, 3),
        "HEARING_LOC_CODE": F.substring(priority, 1, 1),
        "IJ_CODE": F.substring(priority, 3, 2),
        "CASE_TYPE": F.when(other_type, "WHO").otherwise("RMV"),
        "ABSENTIA": F.when(status == "F", "Y").otherwise("N"),
        "COMP_DATE": F.when(done, _stamp("o_orderdate", 30)),
        "DEC_CODE": F.when(done, _pick(priority, p1="R", p2="D")),
        "OTHER_COMP": F.when(done, _pick(priority, p3="A")),
        "NAT": F.concat(F.lit("N"), (F.col("o_custkey") % 25).cast("string")),
        "DEPORTED_1": _pick(priority, p2="N2"),
        "AGGRAVATE_FELON": F.lit("0"),
    }
    return _ragged(_table(spark, folder, "orders"), PROCEEDING, cells, ("ABSENTIA", None, done & (priority == "5-LOW") & (status == "P")))


def cases(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer is a case; builders' addresses have a stray cell inside the city."""
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    cells = {
        "IDNCASE": F.col("c_custkey"),
        "ALIEN_CITY": F.lit("EAST"),
        "ALIEN_STATE": F.lit("CA"),
        "ALIEN_ZIPCODE": F.concat(F.col("c_custkey").cast("string"), F.lit("-1234")),
        "NAT": F.concat(F.lit("N"), F.col("c_nationkey").cast("string")),
        "LANG": F.substring(segment, 1, 3),
        "CUSTODY": _pick(segment, sA="N", sB="R", sF="D"),
        "Sex": F.when(balance < 5000, "F").otherwise("M"),
        "C_BIRTHDATE": F.concat(F.lit("1/"), (F.col("c_nationkey") + 1950).cast("string")),
        "C_ASY_TYPE": _pick(segment, sA="I", sB="E", sF="J"),
        "CASE_TYPE": F.when(balance < 9000, "RMV").otherwise("WHO"),
        "LPR": F.lit("0"),
        "CASEPRIORITY_CODE": F.when(balance < 5000, "D1").otherwise("D2"),
        "E_28_DATE": F.when(balance > 1000, F.lit("2001-02-03 00:00:00.000")),
        "DATE_OF_ENTRY": F.lit("1999-01-01 00:00:00.000"),
        "DETENTION_FACILITY_TYPE": F.lit("P"),
    }
    return _ragged(_table(spark, folder, "customer"), CASE, cells, ("ALIEN_STATE", "TOWN", segment == "BUILDING"))


def custody(spark: SparkSession, folder: str) -> DataFrame:
    """Every event is a detention spell."""
    kind = F.col("event_type")
    cells = {
        "IDNCUSTODY": F.col("event_id"),
        "IDNCASE": F.col("user_id"),
        "CUSTODY": F.when(kind == "error", "R").otherwise("D"),
        "DATDETAINED": F.when(kind != "error", _stamp("ts")),
        "DATRELEASED": F.when(kind == "click", _stamp("ts", 5)),
    }
    return _ragged(_table(spark, folder, "events"), HISTORY, cells)


def appeals(spark: SparkSession, folder: str) -> DataFrame:
    """Every order is appealed; urgent appeals are open."""
    priority = F.col("o_orderpriority")
    cells = {
        "idnAppeal": F.col("o_orderkey"),
        "idnProceeding": F.col("o_orderkey"),
        "idncase": F.col("o_custkey"),
        "strAppealCategory": F.lit("IJ"),
        "strAppealType": F.substring(priority, 1, 1),
        "datAppealFiled": _stamp("o_orderdate", 40),
        "strFiledBy": F.when(F.col("o_orderstatus") == "F", "A"),
        "datBIADecision": F.when(priority != "1-URGENT", _stamp("o_orderdate", 100)),
        "strBIADecision": F.substring(priority, 3, 3),
        "strBIADecisionType": F.col("o_orderstatus"),
        "strCustody": _pick(priority, p2="N", p3="R", p4="D"),
    }
    return _ragged(_table(spark, folder, "orders"), APPEAL, cells)


def applications(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line is an application in the supplier's case."""
    line = F.col("l_linenumber").cast("string")
    cells = {
        "IDNPROCEEDINGAPPLN": F.col("l_orderkey"),
        "IDNPROCEEDING": F.col("l_orderkey"),
        "IDNCASE": F.col("l_suppkey"),
        "APPL_CODE": F.coalesce(_pick(line, l1="ASYL", l2="ASYW", l3="WCAT", l4="245", l5="42B", l6="42A"), F.lit("XX")),
        "APPL_RECD_DATE": _stamp("l_shipdate"),
        "APPL_DEC": F.when(F.col("l_linestatus") == "F", _pick(F.col("l_returnflag"), fA="D", fN="F", fR="Q")).when(
            F.col("l_returnflag") == "A", "W"
        ),
    }
    return _ragged(_table(spark, folder, "lineitem"), APPLICATION, cells)


def bonds(spark: SparkSession, folder: str) -> DataFrame:
    """Every order has a bond hearing; a low priority leaves it open."""
    priority = F.col("o_orderpriority")
    cells = {
        "IDNASSOCBOND": F.col("o_orderkey"),
        "IDNPROCEEDING": F.col("o_orderkey"),
        "IDNCASE": F.col("o_custkey"),
        "COMP_DATE": F.when(priority != "5-LOW", _stamp("o_orderdate", 10)),
        "BOND_HEAR_REQ_DATE": _stamp("o_orderdate"),
        "INITIAL_BOND": F.lit("5000"),
        "NEW_BOND": F.when(F.col("o_totalprice") < 250_000, "0").otherwise("1500.50"),
        "BASE_CITY_CODE": F.substring(priority, 3, 3),
        "HEARING_LOC_CODE": F.substring(priority, 1, 1),
        "IJ_CODE": F.substring(priority, 3, 2),
        "DEC": _pick(priority, p1="C", p2="J", p3="R", p4="F"),
    }
    return _ragged(_table(spark, folder, "orders"), BOND, cells)


def charges(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line is a charge in the part's case."""
    line = F.col("l_linenumber").cast("string")
    cells = {
        "IDNPRCDCHG": F.col("l_suppkey") * 10 + F.col("l_linenumber"),
        "IDNCASE": F.col("l_partkey"),
        "IDNPROCEEDING": F.col("l_orderkey"),
        "CHARGE": _pick(line, l1="212a6Ci", l2="237a2Biv", l3="212A06Ci", l4="237s02AiI", l5="2153g", l6="212a07B"),
        "CHG_STATUS": F.lit("S"),
    }
    return _ragged(_table(spark, folder, "lineitem"), CHARGE, cells)


def sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    builders = (proceedings, cases, custody, appeals, applications, bonds, charges)
    return {b.__name__: b(spark, folder) for b in builders}


def lookups(
    spark: SparkSession, folder: str, keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df
) -> dict[str, DataFrame]:
    """Code tables made of the codes that occur in the tables.

    Every key comes from a column: a constant one would fold into the join condition and leave no equality.
    ``keep`` may write the codes of a table down, so that all code tables made of them read it once.
    """
    orders, segments, letters = (
        keep(_table(spark, folder, name).select(code).distinct(), f"{name}.codes")
        for name, code in (("orders", "o_orderpriority"), ("customer", "c_mktsegment"), ("lineitem", "l_returnflag"))
    )
    nation = _table(spark, folder, "nation")
    word = F.substring("o_orderpriority", 3, 20)

    def codes(key: str, code: Column, value: str, label: Column, source: DataFrame = orders) -> DataFrame:
        return source.select(code.alias(key), label.alias(value)).distinct()

    digit, three, two = (F.substring("o_orderpriority", *x) for x in ((1, 1), (3, 3), (3, 2)))
    flag = F.col("l_returnflag")

    def by_flag(a: str, n: str, r: str) -> Column:
        return F.when(flag == "A", a).when(flag == "N", n).otherwise(r)

    plain = codes("str_code", by_flag("RMV", "WHO", "CFR"), "str_description", by_flag("REMOVAL", "WITHHOLDING", "CREDIBLE FEAR"), letters)
    decisions = orders.select(
        F.when(digit == "5", "WHO").otherwise("RMV").alias("str_case_type"),
        F.when(digit == "3", "O").otherwise("C").alias("str_dec_type"),
        _pick(F.col("o_orderpriority"), p1="R", p2="D", p3="A").alias("str_dec_code"),
        F.concat(word, F.lit(" OUTCOME")).alias("str_dec_description"),
    )
    return {
        "tblLanguage": codes("str_code", F.substring("c_mktsegment", 1, 3), "str_description", F.col("c_mktsegment"), segments),
        "tblLookup_CasePriority": codes("str_code", by_flag("D1", "D2", "D3"), "str_description", by_flag("DETAINED", "RELEASED", "NEVER DETAINED"), letters),
        "tblLookupAlienNat": codes("str_code", F.concat(F.lit("N"), "n_nationkey"), "str_description", F.col("n_name"), nation),
        "tbllookupAppealType": codes("str_appl_code", digit, "str_appl_description", F.concat(word, F.lit(" to bia"))),
        "tblLookupBaseCity": codes("base_city_code", three, "base_city", F.concat(word, F.lit(" TOWN"))),
        "tblLookupBIADecision": codes("str_code", three, "str_description", word),
        "tblLookupBIADecisionType": codes("str_code", F.col("l_returnflag"), "str_description", F.lit("TYPE"), letters),
        "tblLookupJudge": codes("judge_code", two, "judge_name", F.concat(word, F.lit(", J."))),
        "tblLookupHloc": codes("hearing_loc_code", F.when(digit.isin("4", "5"), "4").otherwise(digit), "hearing_loc_name", word),
        "tblLookupFiledBy": codes("str_code", F.col("l_returnflag"), "str_description", F.lit("filed"), letters),
        "tblLookupCaseType": plain,
        "tblLookupSex": codes("strcode", F.when(F.col("l_returnflag") == "A", "F").otherwise("M"), "str_description", F.when(F.col("l_returnflag") == "A", "FEMALE").otherwise("MALE"), letters.where("l_returnflag != 'N'")),
        "tblLookupCourtDecision": decisions,
        "tblLookupCourtAppDecisions": codes("str_court_appln_dec_code", F.col("l_returnflag"), "str_court_appln_dec_desc", by_flag("DENY", "FULL GRANT", "WITHDRAWN"), letters),
        "tblLookUp_Appln": codes("strcode", by_flag("ASYL", "ASYW", "WCAT"), "description", by_flag("ASYLUM", "WITHHOLDING", "TORTURE"), letters),
        "tblLookupCustodyStatus": codes("str_code", by_flag("D", "N", "R"), "str_description", by_flag("DETAINED", "NEVER", "RELEASED"), letters),
        "tblLookupFiling_Method": codes("str_filing_method_code", F.col("l_returnflag"), "str_description", F.lit("W"), letters),
        "tblLookupFiling_Method_Party": codes("str_filing_party_code", F.col("l_returnflag"), "str_description", F.lit("A"), letters),
    }


def crosswalk(spark: SparkSession, folder: str) -> DataFrame:
    """One area per leading five digits of a supplier number."""
    number = F.col("s_suppkey").cast("string")
    zcta = F.substring(F.lpad(number, 5, "0"), 1, 5)
    areas = _table(spark, folder, "supplier").groupBy(zcta.alias("zcta")).agg(F.min("s_nationkey").alias("n"))
    return areas.select(
        "zcta",
        F.lit("CA").alias("state"),
        F.lit("06").alias("state_fips_code"),
        F.concat(F.lit("County "), "n").alias("county"),
        F.lpad(F.col("n").cast("string"), 5, "0").alias("county_fips_code"),
        F.when(F.col("n") > 10, F.concat(F.lit("place "), "n")).alias("place"),
        F.when(F.col("n") > 10, F.lpad(F.col("n").cast("string"), 7, "0")).alias("place_fips_code"),
    )
