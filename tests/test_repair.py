import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from caseline.operators import repair
from caseline.operators.repair import OVERFLOW, ShiftRules
from caseline.plans.specs import CASES
from conftest import rows

NAMES = ["ID", "CITY", "CODE", "FILED", "KIND", "DECIDED"]
RULES = ShiftRules(dates=("FILED", "DECIDED", "ABSENT"), others=("CODE", "KIND"))
D1, D2 = "2001-01-01 00:00:00", "2002-02-02 00:00:00"
GOOD = ["1", "Rome", "C", D1, "K", D2]


def ragged(spark, *lines, names=NAMES):
    schema = ", ".join(f"{n} string" for n in names) + f", {OVERFLOW} array<string>"
    data = [
        tuple((line + [None] * len(names))[: len(names)]) + (line[len(names):] or None,) for line in lines
    ]
    return spark.createDataFrame(data, schema)


def outcome(spark, *lines):
    fixed = repair.repair_shifts(ragged(spark, *lines), RULES, row_id="ID")
    log = {r["row_n"]: r for r in fixed.log.collect()}
    return {r["ID"]: list(r) for r in fixed.rows.collect()}, log, fixed.summary().first().asDict()


def test_untouched_rows_pass_through(spark):
    kept, log, counts = outcome(spark, GOOD, ["2"], ["3", None, " ", "", "K"])
    assert kept["1"] == GOOD and kept["2"] == ["2"] + [None] * 5 and kept["3"] == ["3", None, " ", "", "K", None]
    assert not log and counts["rows_in"] == counts["rows_out"] == 3


def test_overflow_of_one_cell(spark):
    kept, log, _ = outcome(spark, ["1", "Rome", None, "C", D1, "K", D2])
    assert kept["1"] == GOOD
    line = log["1"]
    assert (line["n_extra"], line["shift_col"], line["pass"], line["status"]) == (1, "CODE", "overflow", "fixed")
    assert line["original_violations"] == f"FILED='C' (expected date); DECIDED='K' (expected date); KIND='{D1}' (unexpected date)"
    assert line["original_vals"] == f"FILED=C; DECIDED=K; CODE=NA; KIND={D1}"
    assert line["fixed_violations"] is None and line["fixed_vals"] == f"FILED={D1}; DECIDED={D2}; CODE=C; KIND=K"


def test_overflow_of_two_cells(spark):
    kept, log, _ = outcome(spark, ["1", None, None, "Rome", "C", D1, "K", D2])
    assert log["1"]["n_extra"] == 2
    # The first violation is FILED holding the code's neighbour, so the shift starts two to its left.
    assert log["1"]["shift_col"] == "CITY" and log["1"]["status"] == "fixed" and kept["1"] == GOOD


def test_hidden_shift(spark):
    kept, log, _ = outcome(spark, ["1", "Rome", None, "C", D1, "K"])
    assert kept["1"] == ["1", "Rome", "C", D1, "K", None]
    assert log["1"]["pass"] == "hidden" and log["1"]["n_extra"] == 1


def test_two_separate_tabs_need_a_retry(spark):
    kept, log, _ = outcome(spark, ["1", "Rome", None, "C", D1, None, "K", None])
    assert log["1"]["status"] == "fixed"
    assert kept["1"][:3] == ["1", "Rome", "C"] and kept["1"][3] == D1


def test_unfixable_rows_are_dropped_and_logged(spark):
    spilled = ["1", "Rome", "C", D1, "K", D2, "x"]
    stubborn = ["2", "Rome", "C", "junk", "junk", "junk", "junk", "junk", "junk", "junk", "junk", "junk"]
    first = ["3", "Rome", D1, D1, "K", D2, "more"]
    kept, log, counts = outcome(spark, GOOD[:], spilled, stubborn, first)
    assert log["1"]["status"] == "dropped" and log["1"]["shift_col"] is None and log["1"]["original_violations"] is None
    assert log["2"]["status"] == "dropped"  # six further cells would start before the row
    assert set(kept) <= {"1", "3"}
    assert counts["rows_in"] - counts["dropped"] - counts["dropped_after_fix"] == counts["rows_out"]


def test_still_violating_after_retries(spark):
    kept, log, counts = outcome(spark, ["1", "x", D1, D1, D1, D1, D1])
    assert log["1"]["status"] == "dropped_after_fix" and log["1"]["fixed_violations"] is not None
    assert not kept and counts["dropped_after_fix"] == 1


def test_shift_left_moves_the_tail(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d", "e"],)], "x array<string>")
    for start, n, left in ((1, 1, "bcde"), (3, 2, "abe"), (5, 1, "abcd"), (4, 3, "abc")):
        assert "".join(df.select(repair.shift_left(F.col("x"), F.lit(start), F.lit(n))).first()[0]) == left


def test_summary_and_limits(spark):
    counts = repair.repair_shifts(ragged(spark, GOOD, ["2", "Rome", None, "C", D1, "K", D2]), RULES).summary().first().asDict()
    assert repair.check_repair(counts)["fixed"] == 1
    with pytest.raises(repair.RepairFailure, match="limit is 0.00%"):
        repair.check_repair(counts, max_share=0.0)
    with pytest.raises(repair.RepairFailure, match="without a violation"):
        repair.check_repair(counts | {"fixed_without_cause": 1})
    with pytest.raises(repair.RepairFailure, match="add up"):
        repair.check_repair(counts | {"rows_out": 1})


def test_observation_counts_the_writing_job(spark, tmp_path):
    seen = Observation()
    fixed = repair.repair_shifts(ragged(spark, GOOD, ["2", "Rome", None, "C", D1, "K", D2]), RULES, observation=seen)
    fixed.rows.write.parquet(str(tmp_path / "out"))
    assert seen.get["rows_in"] == 2 and seen.get["fixed"] == 1


def test_repair_is_planned_once(spark):
    fixed = repair.repair_shifts(ragged(spark, GOOD), RULES)
    plan = fixed.rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("dropped_after_fix") <= 6


ADDRESS = ["IDNCASE", "ALIEN_CITY", "ALIEN_STATE", "ALIEN_ZIPCODE", "E_28_DATE", "NAT"]


@pytest.mark.parametrize(
    "line, address, start",
    [
        (["1", None, "San Jose", "CA", "95112", D1, "MX"], ["San Jose", "CA", "95112"], "ALIEN_CITY"),
        (["1", "East", "Palo Alto", "CA", "94303", D1, "MX"], ["East Palo Alto", "CA", "94303"], "ALIEN_STATE"),
        (["1", "San Jose", "XX", "CA", "95112", D1, "MX"], ["San Jose", "CA", "95112"], "ALIEN_STATE"),
        (["1", "San Jose", None, "CA", "95112", D1, "MX"], ["San Jose", "CA", "95112"], "ALIEN_STATE"),
    ],
)
def test_address_shift(spark, line, address, start):
    fixed = repair.repair_shifts(ragged(spark, line, names=ADDRESS), CASES.shift)
    assert [list(r) for r in fixed.rows.collect()] == [["1", *address, D1, "MX"]]
    assert fixed.log.first()["shift_col"] == start


def test_clean_columns_is_idempotent(spark):
    df = spark.createDataFrame([(" a  b", "\u0007", 3, "tail", ["x"])], f"s string, t string, n int, V1 string, {OVERFLOW} array<string>")
    once = repair.clean_columns(df)
    assert once.columns == ["s", "t", "n"] and rows(once) == [("a b", None, 3)]
    assert rows(repair.clean_columns(once)) == rows(once)
