import pytest
from pyspark.sql import functions as F

from caseline.operators import columns, filters, joins
from conftest import rows


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(1, "A", "B"), (2, "Z", None), (3, None, "A")], "id int, c string, d string")


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame([("A", "alpha"), ("B", "beta"), (None, "none"), ("D", "one"), ("D", "two")], "code string, label string")


def test_decode_keeps_rows(facts, lookup):
    got = joins.decode(facts, lookup, "code", "label", {"c": "c_label", "d": "d_label"})
    assert rows(got) == [(1, "A", "B", "alpha", "beta"), (2, "Z", None, None, None), (3, None, "A", None, "alpha")]
    joins.require_row_count(facts, got)


def test_decode_cases_labels_in_the_lookup(facts, lookup):
    got = joins.decode(facts, lookup, "code", "label", {"c": "label"}, label=F.upper, measure=True)
    assert rows(got, "label") == [("ALPHA",), (None,), (None,)]


def test_duplicate_key_matters_only_if_used(spark, lookup):
    used = spark.createDataFrame([("D",)], "c string")
    with pytest.raises(Exception, match="more than one lookup row for D"):
        joins.decode(used, lookup, "code", "label", {"c": "x"}).collect()
    unused = spark.createDataFrame([("A",)], "c string")
    assert rows(joins.decode(unused, lookup, "code", "label", {"c": "x"})) == [("A", "alpha")]


def test_unique_keys_only(lookup, spark):
    clean = joins.unique_keys_only(lookup, "code")
    assert rows(clean) == [("A", "alpha"), ("B", "beta")]
    used = spark.createDataFrame([("D",)], "c string")
    assert rows(joins.decode(used, clean, "code", "label", {"c": "x"})) == [("D", None)]


def test_missing_matches_missing_only_if_asked(spark):
    base = spark.createDataFrame([("R", None), ("R", "x"), (None, None)], "t string, c string")
    look = spark.createDataFrame([("R", None, "open"), ("R", "x", "done"), (None, None, "nothing")], "lt string, lc string, v string")
    safe = joins.many_to_one(base, look, {"t": "lt", "c": "lc"}, {"v": "v"}, null_safe=True)
    assert rows(safe) == [("R", "x", "done"), ("R", None, "open"), (None, None, "nothing")]
    plain = joins.many_to_one(base, look, {"t": "lt", "c": "lc"}, {"v": "v"})
    assert rows(plain) == [("R", "x", "done"), ("R", None, None), (None, None, None)]


def test_bounded(spark, lookup):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(joins.bounded(lookup))
    assert not hinted(joins.bounded(lookup, max_rows=3))
    assert not hinted(joins.bounded(lookup, max_bytes=10))


def test_hot_key_beyond_broadcast(spark):
    """Without any broadcast the decode is a shuffle join and still exact for a hot code."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("c"))
        look = spark.range(3000).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
        got = joins.decode(facts, look, "k", "v", {"c": "label"})
        assert got.count() == 3000
        assert got.where(F.coalesce(F.col("label") != F.concat(F.lit("v"), "c"), F.lit(True))).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_assembly_adds_no_shared_columns(spark):
    left = spark.createDataFrame([(1, "l"), (2, "l")], "id int, v string")
    right = spark.createDataFrame([(1, "r", 9)], "id int, v string, w int")
    assert rows(joins.left_by_key(left, "id", right, drop_shared=True)) == [(1, "l", 9), (2, "l", None)]
    assert rows(joins.inner_by_key(left, right, "id")) == [(1, "l", 9)]


def test_inner_join_report(spark):
    left = spark.createDataFrame([(i,) for i in range(100)], "id int")
    right = spark.createDataFrame([(i,) for i in range(99)], "id int")
    assert tuple(joins.inner_join_report(left, right, "id").first()) == (100, 99, 1, 0.01, "pass")
    right = right.where("id < 98")
    assert tuple(joins.inner_join_report(left, right, "id").first()) == (100, 98, 2, 0.02, "warn")
    assert tuple(joins.inner_join_report(left.limit(0), right, "id").first()) == (0, 0, 0, 0.0, "pass")


def test_row_count_failure(facts):
    with pytest.raises(ValueError, match="expected 3 rows, got 2"):
        joins.require_row_count(facts, facts.limit(2))


def test_bucketed_tables_join_without_shuffle(spark):
    from caseline.sources.tables import save_bucketed

    data = spark.range(200).select("id", (F.col("id") * 2).alias("v"))
    save_bucketed(data, "cases_a", "id", 4)
    save_bucketed(data.withColumnRenamed("v", "w"), "cases_b", "id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.left_by_key(spark.table("cases_a"), "id", spark.table("cases_b"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.where("v = w").count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_columns(spark):
    df = spark.createDataFrame([(1, "a", "b")], "id int, x string, y_code string")
    assert columns.rename(df, {"x": "z"}).columns == ["id", "z", "y_code"]
    with pytest.raises(ValueError, match="no such column: q"):
        columns.rename(df, {"q": "z"})
    with pytest.raises(ValueError):
        columns.drop_columns(df, ["q"])
    assert columns.drop_columns(df, ["q", "x"], missing_ok=True).columns == ["id", "y_code"]
    assert columns.to_front(df, ["y_code"]).columns == ["y_code", "id", "x"]
    assert rows(columns.project(df, n="id", t=F.upper("x"))) == [(1, "A")]
    mapped = columns.map_columns(df, lambda f: f.dataType.simpleString() == "string" and "_code" not in f.name, F.upper)
    assert rows(mapped) == [(1, "A", "b")]


def test_filters(spark):
    df = spark.createDataFrame([(1, "RMV", "1997-10-01"), (2, "RMV", "1997-09-30"), (3, "WHO", None), (4, None, "2000-01-01"), (5, "WHO", "2000-01-01")], "id int, t string, d string").withColumn("d", F.to_date("d"))
    assert rows(filters.cohort(df, "d", "1997-10-01", "t", ["RMV", "WHO"]), "id") == [(1,), (5,)]
    assert rows(filters.present(df, "t", "d"), "id") == [(1,), (2,), (5,)]
    assert rows(filters.in_values(df, "t", ["WHO"]), "id") == [(3,), (5,)]
