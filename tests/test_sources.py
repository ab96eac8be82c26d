import pytest
import datetime as dt

from caseline.operators.repair import OVERFLOW
from caseline.sources import delimited, reports, tables
from conftest import rows


def test_read_ragged(spark, write_lines):
    path = write_lines("T.csv", [["A", "B", "C"], ["1", ' "x ', "y"], ["2"], ["3", "", "z", "more", ""], ["4", "N/A", ""]])
    df = delimited.read_ragged(spark, path)
    assert df.columns == ["A", "B", "C", OVERFLOW]
    assert rows(df) == [
        ("1", '"x', "y", None), ("2", None, None, None), ("3", None, "z", ["more", ""]), ("4", "N/A", None, None),
    ]


def test_read_ragged_windows_lines_and_mark(spark, write_lines):
    path = write_lines("T.csv", [["﻿A", "B"], ["1", "x"]], end="\r\n")
    df = delimited.read_ragged(spark, path)
    assert df.columns == ["A", "B", OVERFLOW] and rows(df) == [("1", "x", None)]


def test_read_ragged_splits_of_one_file(spark, write_lines):
    lines = [["A", "B"]] + [[str(i), "v" * 50] for i in range(2000)]
    path = write_lines("T.csv", lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        df = delimited.read_ragged(spark, path)
        assert df.rdd.getNumPartitions() > 4 and df.columns[0] == "A"
        assert df.selectExpr("count(*)", "count(distinct A)", "min(length(B))").first()[:] == (2000, 2000, 50)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_lookup(spark, write_lines):
    path = write_lines("L.csv", [["strCode", "strDescription\x00"], ["A\x00", "  two   words "], ['"B"', '"say ""hi"""'], ["C", ""], ["", "x"]])
    df = delimited.read_lookup(spark, path)
    assert df.columns == ["str_code", "str_description"]
    assert rows(df) == [("A", "two words"), ("B", 'say "hi"'), ("C", None), (None, "x")]


def test_manifest(spark, write_lines):
    path = write_lines("Count.txt", [["tblA", "100"], ["tblB", "100"], ["tblC", "many"], ["note"]])
    counts = spark.createDataFrame([("tblA", 96), ("tblB", 105), ("tblC", 1), ("tblD", 1)], "table_name string, actual bigint")
    got = rows(delimited.manifest_check(counts, delimited.read_manifest(spark, path)), "table_name", "diff", "level")
    assert got == [("tblA", 4, "pass"), ("tblB", 5, "warn"), ("tblC", None, "pass"), ("tblD", None, "pass")]


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_optional(spark, path) is None and tables.read_optional(spark, None) is None
    tables.write_table(spark.range(3), path)
    assert tables.read_table(spark, path).count() == 3 and tables.read_optional(spark, path).count() == 3
    assert any(f.name.endswith(".zstd.parquet") for f in (tmp_path / "t").iterdir())


def test_crosswalk(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.createDataFrame([("00601", "PR", "72001", "Adjuntas Municipio", None, "720")], "zcta string, stusps string, county_geoid string, county string, place string, place_geoid string").write.parquet(path)
    got = tables.read_crosswalk(spark, path).first()
    assert (got["state"], got["state_fips_code"], got["county_fips_code"], got["place"]) == ("PR", "72", "72001", None)


def releases(spark):
    new = spark.createDataFrame([(1, 10.0, "2026-05-30"), (2, 30.0, "2026-07-30"), (3, None, "2026-05-01")], "id int, x double, d string")
    old = spark.createDataFrame([(1, 10.0, "2026-06-30", "q")], "id int, x double, d string, gone string")
    return [df.withColumn("day", df["d"].cast("date")).drop("d") for df in (new, old)]


def test_sanity_report(spark):
    new, old = releases(spark)
    text = reports.sanity_report(new, old, "day", "Tue, 09 Jun 2026 11:59:25 GMT", dt.date(2026, 6, 9))
    assert "| rows | 3 | 1 | +2 (+200.000%) |" in text
    assert "- Latest `day`: **2026-05-30**" in text and "- Gap: **10 day(s)** (tolerance: 7)" in text
    assert "- Removed: `gone`" in text and "- Schema changed since prior release." in text
    assert "before the file date" in text


def test_sanity_report_without_prior(spark):
    new, _ = releases(spark)
    text = reports.sanity_report(new, None, "nothing", "garbled", dt.date(2026, 6, 9))
    assert "- rows: **3** (no prior version)" in text and "(unparsed)" in text and "(missing)" in text
    assert text.rstrip().endswith("- None.")


def test_sanity_report_warns_of_shrinking(spark):
    new, old = releases(spark)
    text = reports.sanity_report(old.drop("gone"), new, "day", None, dt.date(2026, 6, 9))
    assert "- Row count decreased by 2 (-66.667%)." in text


def test_comparison_report(spark):
    new, old = releases(spark)
    text = reports.comparison_report(new, old)
    assert "Compared 3 columns (new=3, old=4)." in text and "**2 flag(s):**" in text
    assert "- `x`: missing +33.3pp; mean +100.0%" in text and "- `id`: mean +100.0%" in text
    assert "no flags" in reports.comparison_report(new, new)


def test_header_equal_data_lines_stay(spark, write_lines, tmp_path):
    one = write_lines("one/table.csv", [["A", "B"], ["1", "2"], ["A", "B"], ["3", "4"]])
    assert rows(delimited.read_ragged(spark, one), "A", "B") == [("1", "2"), ("3", "4"), ("A", "B")]
    write_lines("two/a.csv", [["A", "B"], ["1", "2"], ["A", "B"]])
    write_lines("two/b.csv", [["A", "B"], ["A", "B"], ["A", "B"], ["5", "6"]])
    assert rows(delimited.read_ragged(spark, str(tmp_path / "two")), "A", "B") == [("1", "2"), ("5", "6"), *[("A", "B")] * 3]


def test_versions_and_pointer(spark, tmp_path):
    root = str(tmp_path / "table")
    assert tables.current_version(spark, root) is None and tables.versions(spark, root) == []
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, root)
    names = [tables.write_version(spark.range(n), root) for n in (3, 4, 5, 6)]
    assert tables.current_version(spark, root) is None and tables.versions(spark, root) == names
    for name, n in zip(names, (3, 4, 5, 6)):
        tables.point_to(spark, root, name)
        assert tables.read_current(spark, root).count() == n and tables.current_version(spark, root) == name
    tables.point_to(spark, root, names[0])  # back to the first
    assert tables.prune_versions(spark, root) == [names[1]]
    assert tables.read_optional(spark, root).count() == 3
    with pytest.raises(FileNotFoundError):
        tables.point_to(spark, root, names[1])
    assert tables.current_version(spark, root) == names[0]


def test_buckets_outlive_the_session_catalog(spark, tmp_path):
    path = str(tmp_path / "by key")
    df = spark.range(100).selectExpr("cast(id % 30 as int) k", "id v").unionByName(spark.sql("select cast(null as int) k, -1L v"))
    got = tables.write_bucketed(df, path, "k", 4)
    assert rows(got) == rows(df) == rows(tables.read_bucketed(spark, path, "k", 4))
    grouped = tables.read_bucketed(spark, path, "k", 4).groupBy("k").count()
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
