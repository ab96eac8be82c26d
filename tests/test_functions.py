import pytest
from pyspark.sql import functions as F

from caseline.functions import codes, text, values
from conftest import rows


def apply(spark, fn, *inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_clean_cell(spark):
    got = apply(spark, text.clean_cell, " a  b ", "a\tb", "x\u0085y", " z  w", "", "   ", "plain", None, "é\u0007")
    assert got == ["a b", "ab", "xy", "z w", None, None, "plain", None, "é"]
    again = apply(spark, text.clean_cell, *got)
    assert again == got


def test_squish(spark):
    assert apply(spark, text.squish, "a\n b", " 　c ") == ["a b", "c"]


def test_zip_and_year(spark):
    assert apply(spark, text.zip5, "2139", "02139-1234", "K1A", "12", "123456", None) == ["02139", "02139", None, None, "12345", None]
    assert apply(spark, text.year_of, "3/1980", "born 1975-1980", "80", None) == [1980, 1975, None, None]


@pytest.mark.parametrize(
    "raw, cased",
    [
        ("DENIED-NO CHANGE (NO BOND SET BY DHS)", "Denied-No Change (No Bond Set By DHS)"),
        ("GRANT WCAT", "Grant WCAT"),
        ("V/D", "V/D"),
        ("voluntary v/d granted", "Voluntary V/D Granted"),
        ("catalog of ij", "Catalog Of IJ"),
        ("o'brien's u.s. 3rd 212a", "O'brien's U.s. 3rd 212a"),
        ("ÉCOLE ÇA-VA", "École Ça-Va"),
        (" two  blanks", " Two  Blanks"),
        (None, None),
    ],
)
def test_label_case(spark, raw, cased):
    assert apply(spark, text.label_case, raw) == [cased]
    if raw is not None:
        assert spark.range(1).select(text.label_literal(raw)).first()[0] == cased


def test_title_before_bracket(spark):
    got = apply(spark, text.title_before_bracket, "LOS ANGELES, CA (LOS)", "(ABC) DEF", "PLAIN", None)
    assert got == ["Los Angeles, Ca (LOS)", "(ABC) DEF", "Plain", None]


def test_name_with_code(spark):
    df = spark.createDataFrame([("Rome", "R"), (None, "X")], "n string, c string")
    assert rows(df.select(text.name_with_code(F.col("n"), F.col("c")))) == [("NA (X)",), ("Rome (R)",)]


def test_snake_case():
    names = ["datBIADecision", "IDNPROCEEDING", "E_28_DATE", "datAttorneyE27", "strAppealType", "Sex", "idncase", "C_ASY_TYPE", "2nd col", "a.b", "Sex"]
    assert text.snake_names(names) == [
        "dat_bia_decision", "idnproceeding", "e_28_date", "dat_attorney_e27", "str_appeal_type", "sex", "idncase", "c_asy_type", "x2nd_col", "a_b", "sex_2",
    ]


@pytest.mark.parametrize(
    "code, cited",
    [
        ("212a6Ci", "212(a)(6)(C)(i)"),
        ("237a2Biv", "237(a)(2)(B)(iv)"),
        ("212A06Ci", "212(a)(6)(C)(i)"),
        ("212 (a)(06)-Ci", "212(a)(6)(C)(i)"),
        ("237s02AiI", "237(a)(2)(A)(i)(I)"),
        ("2153g", "215(g)"),
        ("212a03F", "212(a)(3)(F)"),
        ("212", "212"),
        ("abc", None),
        ("", None),
        (None, None),
    ],
)
def test_citation(spark, code, cited):
    assert apply(spark, codes.citation, code) == [cited]


def test_codes(spark):
    labels = {"A": "alpha", "B": "beta"}
    assert apply(spark, lambda c: codes.recode(c, labels), "A", "Z", None) == ["alpha", "Z", None]
    assert apply(spark, lambda c: codes.recode_strict(c, labels), "A", "Z", None) == ["alpha", None, None]
    assert apply(spark, lambda c: codes.priority_rank(c, ["F", "G", "M"]), "F", "M", "?", None) == [3, 1, 0, 0]
    assert apply(spark, codes.flag_from_code, "Y", "N", None) == [True, False, False]
    assert apply(spark, lambda c: codes.one_of(c, ["A"]), "A", "B", None) == [True, False, False]


def test_values(spark):
    df = spark.createDataFrame(
        [("2001-01-01", "2002-02-02 10:00:00"), ("2001-01-01", "2000-01-01 00:00:00"), ("2001-01-01", None), (None, "2002-02-02 00:00:00"),
         ("2001-01-01", "2001-01-01 23:00:00")],
        "a string, b string",
    ).select(F.to_date("a").alias("a"), F.to_timestamp("b").alias("b"))
    got = [str(r[0]) for r in df.select(values.later_date(F.col("a"), F.col("b"))).collect()]
    assert got == ["2002-02-02", "2001-01-01", "2001-01-01", "None", "2001-01-01"]
    amounts = spark.createDataFrame([(0.0, "G"), (0.0, "D"), (0.0, None), (5.0, "D"), (None, "D")], "x double, d string")
    kept = [r[0] for r in amounts.select(values.null_zero_unless(F.col("x"), F.col("d"), ["G"])).collect()]
    assert kept == [0.0, None, None, 5.0, None]
    days = df.select(values.days_between(values.utc_date(F.col("b")), F.col("a"))).collect()
    assert [r[0] for r in days] == [397.0, -366.0, None, None, 0.0]
    assert apply(spark, lambda c: values.fill_missing(c, "none"), "a", None) == ["a", "none"]
