import dataclasses
import datetime as dt
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import release_data as data
from caseline.operators import convert, repair, rules
from caseline.operators.rules import RuleFailure
from caseline.plans import areas, build, final, specs, stages
from caseline.plans.final import column_order
from caseline.session import shuffle_partitions
from caseline.sources import reports, tables
from conftest import rows

AS_OF = dt.date(2026, 6, 2)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("extract")
    data.write_all(str(path))
    return path


@pytest.fixture(scope="module")
def lookups(spark, folder):
    return build.read_lookups(spark, str(folder))


@pytest.fixture(scope="module")
def crosswalk(spark, folder):
    path = str(folder / "xwalk")
    spark.createDataFrame(data.CROSSWALK, data.CROSSWALK_SCHEMA).write.mode("overwrite").parquet(path)
    return path


@pytest.fixture(scope="module")
def release(spark, folder, crosswalk):
    return build.build_release(
        spark,
        str(folder),
        str(folder / "work"),
        str(folder / "cases"),
        crosswalk,
        AS_OF,
        excused=specs.BOND_GRANTS,  # one of the bonds has a zero amount with the fourth
        manifest=str(folder / "Count.txt"),
        check_areas=False,
    )


@pytest.fixture(scope="module")
def written(spark, folder, release):
    return {t.name: tables.read_table(spark, str(folder / "work" / t.name)) for t in specs.TABLES}


def test_proceedings(written):
    got = {r["idncase"]: r for r in written["proceedings"].collect()}
    assert sorted(got) == [1, 2, 4, 5, 6, 7, 8]  # case 3 mixes a type with a missing one
    one, two, eight = got[1], got[2], got[8]
    assert one["final_completion_date"] is None and one["first_court_code"] == "LOS" and one["final_court_code"] == "SFR"
    assert one["nta_date"] == dt.date(1998, 1, 1) and one["in_absentia"] is False
    assert two["dec_code"] == "R" and two["deported_1_code"] is None  # D sorts before R on the same day
    assert eight["final_court_code"] == "LOS" and eight["other_comp"] == "A"  # repaired


def test_cases(written):
    got = {r["idncase"]: r for r in written["cases"].collect()}
    assert got[2]["alien_zipcode"] == "02139" and got[2]["birth_year"] == 1975
    assert got[1]["alien_zipcode"] == "95112" and got[1]["represented"] is True
    assert got[8]["alien_zipcode"] is None and got[8]["represented"] is False
    assert got[7]["alien_zipcode"] == "94601" and got[7]["sex_code"] == "F"
    assert "alien_city" not in written["cases"].columns


def test_case_repair_log(spark, folder):
    raw = build.read_sources(spark, str(folder))["cases"]
    (line,) = repair.repair_shifts(raw, specs.CASES.shift, row_id="IDNCASE").log.collect()
    assert line["row_n"] == "7"
    assert (line["n_extra"], line["shift_col"], line["pass"], line["status"]) == (1, "ALIEN_STATE", "overflow", "fixed")
    assert "E_28_DATE='D1' (expected date)" in line["original_violations"] and line["fixed_violations"] is None


def test_custody(written):
    got = {r["idncase"]: r for r in written["custody"].collect()}
    assert [got[1][f"detention_start_{i}"].month for i in range(1, 5)] == [1, 2, 3, 4]
    assert got[1]["detention_end_4"].day == 15
    assert got[2]["detention_start_1"] is None


def test_applications(written):
    got = {r["idncase"]: r for r in written["applications"].collect()}
    assert got[1]["asylum_decision_last"] == "FULL GRANT" and got[1]["cat_decision_last"] == "GRANT WCAT"
    assert got[2]["asylum_decision_last"] == "DENY"  # the undated one sorts first
    assert got[2]["adjustment_decision_last"] is None


def test_bonds(written):
    got = {r["idncase"]: r for r in written["bonds"].collect()}
    one, two = got[1], got[2]
    assert one["bond_decision_first"] == "BOND GRANTED-AMOUNT DECREASED"
    assert one["bond_decision_second"] == "BOND GRANTED-OWN RECOGNIZANCE"
    assert one["bond_decision_last"] == "BOND DENIED-NO JURISDICTION"
    assert two["bond_decision_first"] == two["bond_decision_last"] == "FLORES - RELEASE"
    assert two["bond_decision_second"] is None


def test_charges(written):
    got = {r["idncase"]: r for r in written["charges"].collect()}
    assert [got[1][f"charge_section_{i}"] for i in range(1, 5)] == [
        "212(a)(6)(C)(i)", "237(a)(2)(B)(iv)", "212(a)(6)(C)(i)", "237(a)(2)(A)(i)(I)",
    ]
    assert got[2]["charge_section_1"] == "212(a)(6)(C)(i)"


def test_release(release):
    got = {r["idncase"]: r for r in release.table.collect()}
    assert sorted(got) == [1, 2, 7, 8]
    assert release.table.columns[:119] == column_order()
    assert len(column_order()) == 119
    assert not [c for c, t in release.table.dtypes if t == "timestamp"]

    one = got[1]
    assert one["nationality"] == "Mexico" and one["language"] == "Spanish" and one["case_priority"] == "Detained Case"
    assert one["court_first"] == "Los Angeles (LOS)" and one["court_last"] == "San Francisco, Ca (SFR)"
    assert one["judge_first"] == "Doe, C." and one["hearing_location_first"] == "San Francisco V/D"
    assert one["bond_hearing_location_first"] is None  # the code is shared by two places
    assert one["bond_decision_first"] == "Bond Granted-Amount Decreased"
    assert (one["new_bond_amount_first"], one["new_bond_amount_second"], one["new_bond_amount_last"]) == (1500.0, 0.0, None)
    assert one["asylum_decision_last"] == "Full Grant" and one["cat_decision_last"] == "Grant WCAT"
    assert one["adjustment_decision_last"] == "No Application"
    assert one["ij_or_bia_completion_date_last"] is None  # no completion to compare the appeal with
    assert one["appeal_type"] == "Case Appeal From IJ" and one["bia_decision"] == "Affirm BIA"
    assert one["custody"] == "Never Detained" and one["custody_at_appeal"] == "Detained Throughout"
    assert one["case_outcome"] is None and one["asylum_claim_type"] == "Affirmative"
    assert one["state"] == "CA" and one["county"] == "Santa Clara County" and one["state_fips_code"] == "06"
    assert one["bond_hearing_request_date_first_to_bond_completion_date_first_days"] == 9.0

    two = got[2]
    assert two["ij_completion_date_last"] == dt.date(2001, 1, 1)
    assert two["ij_or_bia_completion_date_last"] == dt.date(2002, 2, 2)
    assert two["nta_date_to_ij_completion_date_last_days"] == 1188.0
    assert two["case_outcome"] == "Relief Granted" and two["deported_1"] is None
    assert two["new_bond_amount_first"] == 0.0  # a release keeps its zero
    assert got[7]["case_outcome"] == "No Code Given"  # missing code matches missing code
    assert got[7]["place"] is None and got[7]["county"] == "Alameda County"
    assert got[8]["case_outcome"] == "Admin Closing - Other"
    assert got[8]["ij_or_bia_completion_date_last"] == dt.date(2003, 1, 1)
    assert got[8]["new_bond_amount_first"] is None  # zero without a decision


def test_release_checks(release):
    assert release.join_line["n_dropped"] == 0
    levels = {r["table_name"]: r["level"] for r in release.manifest_lines}
    assert levels["tblAppeal"] == "pass" and levels["tbl_Court_Appln"] == "warn"
    assert {line["table"] for line in release.rule_lines} >= {"proceedings source", "proceedings result", "final"}
    assert not [line for line in release.rule_lines if line["level"] == "stop"]


def test_final_without_checks_filters_first(spark, release, written, lookups, crosswalk):
    plain = final.build_final(written, lookups, tables.read_crosswalk(spark, crosswalk), measure=True)
    assert rows(plain) == rows(release.table)
    plan = plain._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "final_completion_date" in line and "FileScan" in line)
    assert "PushedFilters" in plan and "nta_date,1997-10-01" in plan.replace(" ", "")
    assert scan


def test_override_count(written):
    assert final.override_count(written).first()["overridden"] == 2


def test_stage_stops_on_bad_codes(spark, folder, lookups, tmp_path):
    raw = build.read_sources(spark, str(folder))["custody"].withColumn("CUSTODY", F.lit("Z"))
    with pytest.raises(RuleFailure, match="in_lookup"):
        build.build_stages(spark, {"custody": stages.custody(raw, lookups)}, str(tmp_path))


def test_crosswalk_rules(spark, crosswalk):
    with pytest.raises(RuleFailure) as failure:
        final.check_crosswalk(tables.read_crosswalk(spark, crosswalk))
    assert "areas" in str(failure.value) and "states" in str(failure.value)
    assert "not_null" not in str(failure.value) and "distinct" not in str(failure.value)


def test_stage_shows_unparsable_cells(spark, folder, lookups, tmp_path):
    raw = build.read_sources(spark, str(folder))["custody"].withColumn("IDNCUSTODY", F.lit("FC"))
    with pytest.raises(convert.ConvertFailure, match="IDNCUSTODY: 6 .* e.g. FC"):
        build.build_stages(spark, {"custody": stages.custody(raw, lookups)}, str(tmp_path))


def test_crosswalk_from_shares(spark):
    counties = spark.createDataFrame(
        [("00501", "36103", "Suffolk NY", 0.4), ("00501", "36059", "Nassau NY", 0.6), ("02139", "25017", "Middlesex", 0.5),
         ("02139", "25009", "Essex", 0.5), (" ", "25009", "Essex", 1.0)],
        "zcta string, county_fips_code string, county string, share double",
    )
    places = spark.createDataFrame([("02139", "2511000", "Cambridge", 1.0)], "zcta string, place_fips_code string, place string, share double")
    states = spark.createDataFrame([("36", "NY"), ("25", "MA")], "state_fips_code string, state string")
    territory = spark.createDataFrame(
        [("96799", "AS", "60", "Eastern", "60010", None, None)],
        "zcta string, state string, state_fips_code string, county string, county_fips_code string, place string, place_fips_code string",
    )
    got = areas.with_territories(areas.build_crosswalk(counties, places, states), territory)
    assert rows(got) == [
        ("00501", "NY", "36", "Nassau NY", "36059", None, None),
        ("02139", "MA", "25", "Essex", "25009", "Cambridge", "2511000"),
        ("96799", "AS", "60", "Eastern", "60010", None, None),
    ]


def test_shuffle_partitions():
    assert shuffle_partitions(10**9) == 200
    assert shuffle_partitions(10 << 40) == 81920


@pytest.fixture
def again(spark, folder, crosswalk, release, written, monkeypatch, tmp_path):
    """Build the release anew from the stage tables that are there."""
    monkeypatch.setattr(build, "build_stages", lambda *a: (written, release.rule_lines, release.repair_counts))

    def run():
        return build.build_release(
            spark, str(folder), str(tmp_path / "w"), str(tmp_path / "out"), crosswalk, AS_OF, check_areas=False, excused=specs.BOND_GRANTS
        )

    return run


def test_unchecked_result_is_not_published(spark, again, monkeypatch, tmp_path):
    strict = [*final.final_rules(specs.BOND_GRANTS), rules.not_null("deported_1")]
    monkeypatch.setattr(final, "final_rules", lambda excused: strict)
    with pytest.raises(RuleFailure, match="deported_1"):
        again()
    assert tables.current_version(spark, str(tmp_path / "out")) is None and not tables.versions(spark, str(tmp_path / "out"))


def test_release_stopped_before_the_swap_leaves_the_old_one(spark, again, monkeypatch, tmp_path):
    out = str(tmp_path / "out")
    first = again()
    before = rows(tables.read_current(spark, out), "idncase")

    def stopped(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(tables, "point_to", stopped)
        with pytest.raises(KeyboardInterrupt):
            again()
    assert len(tables.versions(spark, out)) == 2  # the second is written, but nobody reads it
    assert tables.current_version(spark, out) == first.version
    assert rows(tables.read_current(spark, out), "idncase") == before == rows(tables.read_optional(spark, out), "idncase")


def test_by_case_joins_need_no_exchange(spark, folder, release, lookups):
    """Joins of stage tables that were written in buckets, opened anew as another job would."""
    opened = {t.name: tables.read_bucketed(spark, str(folder / "work" / t.name), "idncase", 8) for t in specs.TABLES}
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = final.by_case(opened)
        assert joined.count() == 7
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    assert plan.count("SortMergeJoin") == 6 and "Exchange" not in plan and "Bucketed: true" in plan


def joined_widths(df):
    """Columns that come out of each join of the optimised plan."""
    nodes, widths = [df._jdf.queryExecution().optimizedPlan()], []
    while nodes:
        node = nodes.pop()
        widths += [node.output().size()] if node.nodeName() == "Join" else []
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return widths


def test_joins_carry_few_columns(spark, release, written, lookups, crosswalk):
    """Each join copies its columns one by one, so a case's columns go through all of them in one piece."""
    area = tables.read_crosswalk(spark, crosswalk)
    made = final.assembled(written, lookups, area, excused=specs.BOND_GRANTS)
    published = final.build_final(written, lookups, area).select(*column_order())
    for df in (made, published):
        widths = joined_widths(df)
        assert len(widths) == 35 and max(widths) <= 25 < len(df.columns)
    by_number = {r["idncase"]: r.asDict() for r in final.by_case(written).collect()}
    assert by_number.keys() == {r["idncase"] for r in made.select("idncase").collect()}
    kept = [c for c in made.columns if c in written["custody"].columns + written["charges"].columns + ["nta_date", "birth_year", "e27_date"]]
    assert all({c: by_number[r["idncase"]][c] for c in kept} == r.asDict() for r in made.select(*kept).collect())


def test_a_bucket_is_one_file(folder, release):
    for spec in specs.TABLES:
        names = [p.name for p in (folder / "work" / spec.name).iterdir() if p.name.startswith("part-")]
        assert len({n.split("_")[1].split(".")[0] for n in names}) == len(names) <= 8


def test_repairs_are_logged_and_counted(spark, folder, release):
    log = spark.read.parquet(str(folder / "work" / "cases.repairs")).collect()
    assert [(r["status"], r["shift_col"], r["pass"]) for r in log] == [("fixed", "ALIEN_STATE", "overflow")]
    counts = release.repair_counts["cases"]
    assert (counts["rows_in"], counts["fixed"], counts["rows_out"]) == (8, 1, 8)
    assert counts["print_before"] - counts["print_touched"] == counts["print_after"] != 0


def test_warnings_come_with_the_release(release):
    assert release.overridden == 2
    assert any(w.startswith("tbl_Court_Appln:") for w in release.warnings)


def test_dropped_cases_warn(again, monkeypatch):
    monkeypatch.setattr(final, "MAX_DROPPED", -1.0)
    got = again()
    assert any("are not in the case table" in w for w in got.warnings)


def test_release_stops_on_a_used_duplicate_key(spark, again, monkeypatch, tmp_path):
    plain = build.read_lookups

    def doubled(*a):
        found = plain(*a)
        language = found["tblLanguage"]
        return {**found, "tblLanguage": language.unionByName(language)}

    monkeypatch.setattr(build, "read_lookups", doubled)
    with pytest.raises(build.ReleaseFailure, match="tblLanguage: SP"):
        again()


def test_examples_below_the_limit(spark, folder, lookups, tmp_path):
    raw = build.read_sources(spark, str(folder))["custody"].withColumn("DATRELEASED", F.concat(F.lit("never "), F.col("IDNCUSTODY")))
    stage = stages.custody(raw, lookups)
    stage.spec = dataclasses.replace(stage.spec, max_fail_rate=None)
    _, lines, _ = build.build_stages(spark, {"custody": stage}, str(tmp_path))
    (line,) = [x for x in lines if x.get("examples")]
    assert line["rule"].startswith("parses(DATRELEASED") and line["failed"] == 6 and line["level"] == "pass"
    assert line["examples"].split(", ") == sorted(line["examples"].split(", ")) and len(line["examples"].split(", ")) == 5


def test_counts_are_exact_though_a_task_fails(tmp_path):
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "failing_task.py")
    run = subprocess.run([sys.executable, script, str(tmp_path)], capture_output=True, text=True, timeout=300)
    got = json.loads(run.stdout.strip().split("\n")[-1])
    assert got == {"rows_in": 2000, "failed": {"in_lookup(CUSTODY)": [4, 2000], "parses(DATRELEASED: datetime)": [2, 2000]}}


def test_reports_are_written(spark, release, folder, tmp_path):
    out = str(folder / "cases")
    first = reports.write_reports(spark, out, None, str(tmp_path / "first"), "nta_date", "Tue, 02 Jun 2026 11:59:25 GMT", AS_OF)
    assert {r["part"] for r in first.collect()} == {"rows", "recency"}
    text = "\n".join(r[0] for r in spark.read.text(str(tmp_path / "first" / "sanity")).collect())
    assert "no prior version" in text and not (tmp_path / "first" / "comparison").exists()
    earlier = str(tmp_path / "earlier")
    tables.write_table(release.table.where("idncase <> 8").drop("place").withColumn("gone", F.lit(1)), earlier)
    second = reports.write_reports(spark, out, earlier, str(tmp_path / "second"), "nta_date", None, AS_OF)
    got = {(r["part"], r["name"]): r for r in second.collect()}
    assert got["rows", "delta"]["value"] == "1" and got["schema", "gone"]["warning"] == "column removed" and ("schema", "place") in got
    assert (tmp_path / "second" / "comparison").exists()


def test_rule_levels_of_marks_and_members(spark):
    df = spark.range(1000).select(F.when(F.col("id") >= 5, F.col("id")).alias("a"), F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("c"))
    plain = [rules.not_null("a").at(0.01, 0.1), rules.not_null("a").at(0.001, 0.1), rules.not_null("a").at(0.001, 0.005), rules.not_null("a").when(F.col("c") == "x").at(None, 0.5)]
    marked = df.withColumn("m", rules.marks(plain))
    lines = {(r["level"], r["failed"], r["total"]) for r in rules.count_marks(marked, "m", plain).collect()}
    assert lines == {("pass", 5, 1000), ("warn", 5, 1000), ("stop", 5, 1000), ("pass", 3, 500)}
    members = [rules.in_lookup("c").at(0.1, 0.9), rules.in_lookup("a", ("7",)).at(0.1, 0.99)]
    known = [(spark.createDataFrame([("x",), ("x",), (None,)], "k string"), "k", ["c"]), (spark.createDataFrame([(9,)], "k int"), "k", ["a"])]
    got = {r["rule"]: (r["failed"], r["total"], r["level"]) for r in rules.count_members(df, members, known).collect()}
    assert got == {"in_lookup(c)": (500, 1000, "warn"), "in_lookup(a)": (993, 1000, "stop")}
    empty = rules.count_marks(marked.limit(0), "m", plain).collect()
    assert [(r["failed"], r["total"], r["level"]) for r in empty] == [(0, 0, "pass")] * 4
    with pytest.raises(ValueError, match="single rows"):
        rules.marks(members)


def test_a_changed_untouched_row_raises(spark):
    raw = spark.createDataFrame([("1", "2001-01-01", "x", None), ("2", "2001-01-02", None, None)], "ID string, D string, N string, _overflow array<string>")
    fixed = repair.repair_shifts(raw, repair.ShiftRules(dates=("D",), others=("N",)))
    assert fixed.fingerprints(raw).first()["unchanged"] is True
    repair.check_repair(repair.counts_of(fixed.marked).first().asDict())
    changed = raw.withColumn("N", F.when(F.col("ID") == "2", "").otherwise(F.col("N")))
    assert fixed.fingerprints(changed).first()["unchanged"] is False  # an empty cell is not a missing one
    status = F.col("_mend")
    broken = fixed.marked.withColumn("_mend", status.withField("print_out", status["print_out"] + F.when(F.col("ID") == "1", 1).otherwise(0)))
    with pytest.raises(repair.RepairFailure, match="has changed"):
        repair.check_repair(repair.counts_of(broken).first().asDict())
