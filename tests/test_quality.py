import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from caseline.operators import convert, profile, rules
from conftest import rows


def test_parse(spark):
    def parsed(kind, *cells):
        df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, x string")
        return [r[0] for r in df.orderBy("i").select(convert.parse(F.col("x"), kind)).collect()]

    assert parsed("integer", "12", "12.7", " 7 ", "x", "99999999999", "", None, "1d", "NaN", "-3") == [12, 12, 7, None, None, None, None, None, None, -3]
    assert parsed("double", "1.5", ".5", "1e3", "FC", "NaN") == [1.5, 0.5, 1000.0, None, None]
    assert parsed("datetime", "2001-02-03 04:05:06", "2001-02-03 04:05:06.000", "2001-02-03", "2001-02-30 00:00:00") == [
        dt.datetime(2001, 2, 3, 4, 5, 6), dt.datetime(2001, 2, 3, 4, 5, 6), None, None,
    ]
    assert parsed("date", "2001-02-03", "2001-02-03 00:00:00.000", "01-02-03", "1000") == [dt.date(2001, 2, 3), dt.date(2001, 2, 3), None, None]
    with pytest.raises(ValueError, match="unknown type"):
        convert.parse(F.col("x"), "logical")


def test_fail_rate_limit(spark):
    below = spark.createDataFrame([("x" if i == 0 else str(i),) for i in range(1000)], "n string")
    assert convert.check_converted(below, {"n": "integer"}) == ["n: 1 (0.1000%) e.g. x"]
    above = below.unionByName(spark.createDataFrame([("y",)], "n string"))
    with pytest.raises(convert.ConvertFailure, match="n: 2 .*x, y"):
        convert.check_converted(above, {"n": "integer"})
    levels = [r["level"] for r in rules.evaluate(below, convert.failure_rules({"n": "integer"})).collect()]
    assert levels == ["pass"]
    levels = [r["level"] for r in rules.evaluate(above, convert.failure_rules({"n": "integer"})).collect()]
    assert levels == ["stop"]
    assert rules.evaluate(above, convert.failure_rules({"n": "integer"}, None)).first()["level"] == "pass"


def test_examples_are_at_most_five(spark):
    df = spark.createDataFrame([(f"v{i % 9}",) for i in range(90)], "n string")
    report = convert.convert_report(df, {"n": "double"}).first()
    assert report["failed"] == 90 and report["examples"] == "v0, v1, v2, v3, v4"


def test_rules(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2), (None, 3), ("a", None)], "c string, n int")

    def failed(rule):
        return rules.evaluate(df, [rule]).first()["failed"]

    assert failed(rules.not_null("c")) == 1
    assert failed(rules.matches("c", "^[A-Z]$")) == 1 and failed(rules.matches("c", "^[A-Z]$", na_pass=False)) == 2
    assert failed(rules.in_set("c", ["A", "B"])) == 1 and failed(rules.in_set("c", ["A", "B"], na_pass=False)) == 2
    assert failed(rules.not_in_set("c", ["A", "a"])) == 2
    assert failed(rules.at_least("n", 2)) == 1 and failed(rules.above("n", 2)) == 2 and failed(rules.above("n", 2, na_pass=False)) == 3
    assert failed(rules.between("n", 2, 3)) == 1
    assert failed(rules.holds("x", F.col("n") > 1)) == 2
    assert failed(rules.ordered("n", "n")) == 0
    assert failed(rules.not_null("c").when(F.col("n") == 3)) == 1
    assert failed(rules.aggregate_holds("x", F.count("c") == 3)) == 0 and failed(rules.aggregate_holds("x", F.count("c") == 4)) == 1
    codes = spark.createDataFrame([("A",), ("B",), (None,), ("A",)], "k string")
    flagged = rules.flag_known(df, codes, "k", ["c"])
    assert flagged.count() == 4
    assert rules.evaluate(flagged, [rules.in_lookup("c"), rules.in_lookup("c", ["a"])]).select("failed").collect() == [(1,), (0,)]


def test_valid_text(spark):
    df = spark.createDataFrame([("Añasco",), ("A�b",), (None,)], "c string")
    assert rules.evaluate(df, [rules.valid_text("c")]).first()["failed"] == 1
    assert rules.evaluate(df, [rules.valid_text("c", na_pass=False)]).first()["failed"] == 2


def test_levels(spark):
    df = spark.range(100).select((F.col("id") < 1).alias("bad"))
    rule = rules.Rule("r", F.col("bad"))
    for warn, stop, level in ((None, None, "stop"), (0.01, 0.02, "warn"), (0.001, 0.01, "stop"), (0.02, 0.5, "pass"), (None, 0.01, "stop")):
        assert rules.evaluate(df, [rule.at(warn, stop)]).first()["level"] == level
        assert rules.level_of(1, 100, warn, stop) == level
    empty = rules.evaluate(df.limit(0), [rule, rule.at(0.1, 0.2)]).collect()
    assert [(r["failed"], r["total"], r["fraction"], r["level"]) for r in empty] == [(0, 0, 0.0, "pass")] * 2


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert tuple(rules.distinct_rows(df, ["k"]).first()) == ("distinct(k)", 4, 5, 0.8, "stop")
    assert rules.distinct_rows(df.limit(0), ["k"]).first()["level"] == "pass"


def test_watch_counts_while_writing(spark, tmp_path):
    df = spark.createDataFrame([("A",), (None,)], "c string")
    watch = rules.Watch("t", [rules.not_null("c").at(0.1, 0.9), rules.in_set("c", ["A"])])
    watch.attach(df).write.parquet(str(tmp_path / "out"))
    assert [(r["rule"], r["failed"], r["total"], r["level"]) for r in watch.report()] == [("not_null(c)", 1, 2, "warn"), ("in_set(c)", 0, 2, "pass")]
    assert [r["rule"] for r in watch.enforce()] == ["not_null(c)"]
    strict = rules.Watch("t", [rules.not_null("c")])
    strict.attach(df).write.parquet(str(tmp_path / "out2"))
    with pytest.raises(rules.RuleFailure, match="not_null"):
        strict.enforce()
    assert rules.Watch("t", []).report() == []


def test_missingness_order(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None)], "a int, b string, c string")
    assert [tuple(r) for r in profile.missingness(df).collect()] == [("c", 1.0), ("b", 0.5), ("a", 0.0)]


def test_drift_thresholds(spark):
    def flags(new, old, schema):
        a, b = (profile.column_profile(spark.createDataFrame(x, schema)) for x in (new, old))
        return rows(profile.drift_flags(a, b))

    filled = [(float(i),) for i in range(100)]
    holes = [(None,) if i < 2 else (49.5,) for i in range(100)]
    assert flags(holes, filled, "x double") == [("x", "missing +2.0pp")]
    assert flags([(105.0,)], [(100.0,)], "x double") == [("x", "mean +5.0%")]
    assert flags([(104.9,)], [(100.0,)], "x double") == [] and flags([(5.0,)], [(0.0,)], "x double") == []
    new, old = [(dt.date(2001, 1, 1),)], [(dt.date(2001, 1, 2),)]
    assert flags(new, old, "d date") == [("d", "max date 2001-01-02 → 2001-01-01")]
    assert flags([("b",)], [("aaaa",)], "s string") == []


def test_label_codes_over_partitions(spark):
    values = [f"v{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(v, values[0]) for v in values * 2] + [(None, "z")], "a string, b string").repartition(7)
    got = {(r["variable"], r["value"]): r["code"] for r in profile.label_codes(df, ["a", "b"]).collect()}
    assert got == {("a", v): i + 1 for i, v in enumerate(values)} | {("b", "v0000"): 1, ("b", "z"): 2}
    encoded, dictionary = profile.label_encode(df, ["b"])
    assert encoded.columns == ["a", "b"] and encoded.where("b = 2").count() == 1 and dictionary.count() == 2


def test_distributions(spark):
    day = dt.date(2020, 1, 1)
    data = [(float(i % 7) if i % 5 else None, i % 3 == 0, day + dt.timedelta(days=i), ("", " \t", "a", None)[i % 4]) for i in range(40)]
    df = spark.createDataFrame(data, "x double, f boolean, d date, s string").repartition(5)
    found = {r["variable"]: r for r in profile.distributions(df).collect()}
    numbers = [x for x, *_ in data if x is not None]
    cuts = statistics.quantiles(numbers, n=4, method="inclusive")
    assert [found["x"][c] for c in ("q25", "median", "q75")] == cuts and found["x"]["n_distinct"] == 7
    assert (found["f"]["n_true"], found["f"]["n_false"], found["f"]["n_distinct"]) == (14, 26, 2)
    assert found["d"]["date_median"] == day + dt.timedelta(days=19) and found["d"]["n_distinct"] == 40
    assert (found["s"]["n_blank"], found["s"]["n_distinct"], found["s"]["median"]) == (20, 3, None)
    nothing = {r["variable"]: r for r in profile.distributions(spark.createDataFrame([(None, None)], "x int, s string")).collect()}
    assert nothing["x"]["n_distinct"] == 0 and nothing["x"]["median"] is None and nothing["s"]["n_blank"] == 0
    assert profile.distributions(df.limit(0)).count() == 0


def test_label_release(spark):
    wide = spark.createDataFrame([(1, "b", "x"), (2, "a", None)], "id int, a_text_column_with_a_name_far_too_long_for_it string, t string")
    table, dictionary = profile.label_release(wide)
    assert all(len(c) <= 32 for c in table.columns) and sorted(tuple(r) for r in table.collect()) == [(1, 2, 1), (2, 1, None)]
    assert {r["variable"] for r in dictionary.collect()} == set(table.columns[1:])


def test_short_names():
    long = ["bond_hearing_request_date_first_to_bond_completion_date_first_days", "bond_hearing_request_date_last_to_bond_completion_date_last_days", "id"]
    got = profile.short_names(long)
    assert all(len(n) <= 32 for n in got) and len(set(got)) == 3 and got[2] == "id"
    assert profile.short_names(["a", "b" * 32]) == ["a", "b" * 32]
    twins = profile.short_names(["x" * 40 + "1", "x" * 40 + "1"])
    assert len(set(twins)) == 2


def test_recency_and_dates(spark):
    df = spark.createDataFrame([(dt.date(2026, 6, 1),), (dt.date(2026, 6, 3),), (dt.date(2026, 6, 4),)], "d date")
    got = profile.recency(df, "d", "Tue, 09 Jun 2026 00:00:00 GMT", dt.date(2026, 6, 2)).first()
    assert (got["event_max"], got["gap_days"], got["warning"]) == (dt.date(2026, 6, 3), 6, None)
    assert profile.recency(df, "e", "Tue, 09 Jun 2026", dt.date(2026, 6, 2)).first()["event_max"] is None
    assert profile.parse_last_modified("nonsense") is None and profile.parse_last_modified(None) is None


def test_row_delta(spark):
    many, few = spark.range(100000), spark.range(99995)
    assert profile.row_delta(many, few).first()["warning"] == "row count hardly grew"
    assert profile.row_delta(few, many).first()["warning"] == "row count decreased"
    assert profile.row_delta(spark.range(2), spark.range(1)).first()["warning"] is None
    assert profile.row_delta(spark.range(2), spark.range(0)).first()["pct"] is None
