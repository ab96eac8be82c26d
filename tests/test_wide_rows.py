"""Work per row that used to be done per cell, over and over, or in methods that the JVM only interprets."""

import itertools
import re

from pyspark.sql import functions as F

from caseline import session
from caseline.functions import codes, text
from caseline.operators import collapse, repair
from caseline.plans import extracts, queries, stages

ODD = ["a", "", None, " a", "a ", "a  b", "a|b", "a| b", "a |b", "|", "a\x1fb", "a\n", "é", "2001-02-03 00:00:00", " 2001-02-03", "x|2001-02-03"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_columns_looks_at_a_row_once(spark):
    n = len(ODD)
    rows = [tuple(ODD[(i + j * k) % n] for j in range(6)) for i in range(n) for k in range(n)]
    names = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))
    got = repair.clean_columns(df)
    each = df.select(*[text.clean_cell(F.col(c)).alias(c) for c in names])
    assert got.collect() == each.collect()
    plain = [None if t == "" else text_of(t) for t in ODD]
    assert [r[0] for r in spark.createDataFrame([(t,) for t in ODD], "t string").select(text.clean_cell(F.col("t"))).collect()] == plain
    assert plan(got).count("RLIKE") <= 3  # the row, and a cell of a row that needs it


def text_of(cell):
    if cell is None:
        return None
    cell = "".join(c for c in cell if ord(c) >= 32)
    return re.sub(" +", " ", cell).strip(" ") or None


def test_one_look_finds_misplaced_dates(spark):
    names = ["ID", "A", "B", "D"]
    rules = repair.ShiftRules(dates=("D",), others=("A", "B"))
    rows = [(str(i), a, b, None) for i, (a, b) in enumerate((a, b) for a in ODD for b in ODD)]
    df = spark.createDataFrame(rows, "ID string, A string, B string, D string")
    fixed = repair.repair_shifts(df, rules, row_id="ID")

    def date(cell):
        return cell is not None and re.match(r"\d{4}-\d{2}-\d{2}", cell.strip(" ")) is not None

    found = {r["row_n"] for r in fixed.log.collect()}
    assert found == {i for i, a, b, _ in rows if date(a) or date(b)}
    assert fixed.rows.columns == names


def test_citation_splits_a_code_once(spark):
    df = spark.createDataFrame([("212a6Ci",), ("0212A07B",), ("A12b",), ("237",), ("$12a",), ("212-A-06",), ("",), (None,)], "c string")
    cited = df.select(codes.citation(F.col("c")).alias("c"))
    assert [r[0] for r in cited.collect()] == ["212(a)(6)(C)(i)", "0212(a)(7)(B)", None, "237", None, "212(a)(6)", None, None]
    assert plan(cited).count("regexp_extract_all") == 1


def test_smallest_number_needs_no_sort(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 2), (1, "a", None), (2, None, None), (2, None, 7), (None, "b", None)], "k int, c string, n int")
    got = collapse.distinct_first(df, ["k", "c"], ["n"])
    assert {tuple(r) for r in got.collect()} == {(1, "a", 2), (2, None, 7), (None, "b", None)}
    assert "SortAggregate" not in plan(got)


def test_small_methods_in_any_session(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, "65535")
    assert session.with_small_methods(spark).conf.get(name) == session.SETTINGS[name]


def test_no_constraints_of_wide_plans_in_any_session(spark):
    name = "spark.sql.constraintPropagation.enabled"
    spark.conf.set(name, "true")
    assert session.with_small_methods(spark).conf.get(name) == session.SETTINGS[name] == "false"


def cited(code):
    """The citation of a code of plain letters and digits, mark by mark."""
    marks = re.findall("[0-9]+|[a-z]+|[A-Z]+", code)
    if len(marks) > 2 and re.fullmatch("[A-Z]", marks[1]) and marks[2].isdigit():
        marks[1] = "a"
    return marks[0] + "".join(f"({re.sub('^0+(?=[0-9])', '', m)})" for m in marks[1:])


def test_plain_codes_are_cited_in_place(spark):
    every = ["2" + "".join(t) for n in range(6) for t in itertools.product("10aBC", repeat=n)]
    df = spark.createDataFrame([(c,) for c in every], "c string").select("c", codes.citation(F.col("c"), {"x": "x"}).alias("cited"))
    assert [(r["c"], r["cited"]) for r in df.collect() if r["cited"] != cited(r["c"])] == []
    in_place, levels = plan(df).index("0*([0-9]+)"), plan(df).index("regexp_extract_all")
    assert in_place < levels  # looked at first, so that the list of levels is left to other codes


def test_violations_are_looked_for_in_checked_cells_alone(spark):
    names = [f"c{i}" for i in range(8)]
    layout = repair._Layout(names, repair.ShiftRules(dates=("c2", "c5"), others=("c5", "c6")))
    rows = [([ODD[(i + j * k) % len(ODD)] for j in range(n)],) for i in range(len(ODD)) for k in range(1, 6) for n in (0, 4, 8, 10)]
    found = spark.createDataFrame(rows, "cells array<string>").select("cells", layout.first_violation(F.col("cells")).alias("at"))

    def first(cells):
        for at, cell in enumerate(cells, 1):
            shown = "" if cell is None else cell.strip(" ")
            date = re.match(r"\d{4}-\d{2}-\d{2}", shown) is not None
            if at in (3, 6) and shown and not date or at == 7 and date:
                return at
        return None

    assert [r["at"] for r in found.collect()] == [first(r[0]) for r in rows]
    assert "transform(" not in plan(found)
    none = repair._Layout(names, repair.ShiftRules())
    assert found.select(none.first_violation(F.col("cells")).alias("at")).where("at is not null").count() == 0


def small_tables(spark, folder):
    made = {
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
                   "select id, id % 3, 'F', 1e5 * id, timestamp_ntz'2000-01-02 00:00:00', element_at(array('1-URGENT', '5-LOW'), int(id % 2) + 1) from range(9)"),
        "customer": ("c_custkey long, c_mktsegment string", "select id, 'BUILDING' from range(3)"),
        "nation": ("n_nationkey long, n_name string, n_regionkey long", "select id, 'N', id from range(3)"),
        "lineitem": ("l_orderkey long, l_returnflag string", "select id, element_at(array('A', 'N', 'R'), int(id % 3) + 1) from range(9)"),
    }
    for name, (schema, rows) in made.items():
        spark.sql(rows).toDF(*[c.split()[0] for c in schema.split(", ")]).write.parquet(f"{folder}/{name}.parquet")


def test_codes_of_lookups_are_read_once(spark, tmp_path):
    small_tables(spark, tmp_path)
    kept = []

    def keep(df, name):
        kept.append(name)
        return session.written(df, name)

    once = extracts.lookups(spark, str(tmp_path), keep)
    assert sorted(kept) == ["customer.codes", "lineitem.codes", "orders.codes"]
    each = extracts.lookups(spark, str(tmp_path))
    for name, lookup in once.items():
        assert not any(f"{t}.parquet" in f for f in lookup.inputFiles() for t in ("orders", "customer", "lineitem"))
        assert sorted(map(tuple, lookup.collect()), key=repr) == sorted(map(tuple, each[name].collect()), key=repr)


def test_bonds_are_typed_once(spark, tmp_path):
    small_tables(spark, tmp_path)
    stage = stages.bonds(extracts.bonds(spark, str(tmp_path)), {})
    built = queries._by_case(stage)
    assert not any("orders.parquet" in f for f in built.inputFiles())
    assert sorted(map(tuple, built.collect()), key=repr) == sorted(map(tuple, stage.table.collect()), key=repr)
