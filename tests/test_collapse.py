import pytest
from pyspark.sql import functions as F

from caseline.operators import collapse
from conftest import rows


@pytest.fixture
def cases(spark):
    return spark.createDataFrame(
        [
            (1, 1, None, "x", "RMV"), (1, 2, 5, "y", "RMV"), (1, 3, 5, None, "RMV"),
            (2, 4, 7, "z", "RMV"), (2, 5, 1, "w", None),
            (3, 6, None, None, None),
            (None, 7, 2, "n", "WHO"), (None, 8, 3, "m", "WHO"),
        ],
        "k int, id int, d int, v string, kind string",
    )


def test_missing_sorts_last_and_is_not_skipped(cases):
    got = collapse.collapse_ends(cases, ["k"], ["d", "id"], {"f": "v"}, {"l": "v", "d": "d"})
    assert rows(got) == [(1, "y", "x", None), (2, "w", "z", 7), (3, None, None, None), (None, "n", "m", 3)]


def test_missing_sorts_first(cases):
    got = collapse.collapse_ends(cases, ["k"], ["d", "id"], {"f": "v"}, {"l": "v"}, nulls="first")
    assert rows(got) == [(1, "x", None), (2, "w", "z"), (3, None, None), (None, "n", "m")]


def test_unknown_null_order(cases):
    with pytest.raises(ValueError):
        collapse.order_fields(["d"], "middle")


def test_constant_groups_agree(cases):
    """The fused check keeps the groups that the row filter keeps: {RMV}, {NULL}, {WHO}; not {RMV, NULL}."""
    kept = collapse.keep_constant_groups(cases, ["k"], "kind")
    assert {r[0] for r in rows(kept, "k")} == {1, 3, None}
    assert kept.count() == 6
    fused = collapse.collapse_ends(cases, ["k"], ["id"], last={"v": "v"}, constant="kind")
    assert {r[0] for r in rows(fused, "k")} == {1, 3, None}


def test_first_second_last(cases):
    got = collapse.first_second_last(cases, ["k"], ["d", "id"], {"v": "v"})
    assert rows(got) == [(1, "y", None, "x"), (2, "w", "z", "z"), (3, None, None, None), (None, "n", "m", "m")]


def test_first_n_is_padded(cases):
    got = collapse.first_n_wide(cases, ["k"], ["d", "id"], 2, {"v": "v", "d": "d"})
    assert got.columns == ["k", "v_1", "v_2", "d_1", "d_2"]
    assert rows(got)[2] == (3, None, None, None, None)


def test_last_per_code(spark):
    df = spark.createDataFrame(
        [(1, "A", 1, "F"), (1, "A", 2, None), (1, "B", 1, "W"), (2, "C", 1, "F")], "k int, code string, o int, v string"
    )
    got = collapse.last_per_code(df, ["k"], ["o"], "code", "v", {"a": "A", "b": "B"})
    assert rows(got) == [(1, None, "W"), (2, None, None)]


def test_top_by_weight_tie(spark):
    df = spark.createDataFrame([(1, 0.5, "b"), (1, 0.5, "a"), (1, 0.1, "c"), (2, None, "d")], "k int, w double, c string")
    assert rows(collapse.top_by_weight(df, ["k"], "w", ["c"], {"c": "c"})) == [(1, "a"), (2, "d")]


def test_distinct_first_keeps_whole_row(spark):
    df = spark.createDataFrame([(1, "a", 3, "late"), (1, "a", 2, "early"), (1, None, 9, "x")], "k int, c string, id int, v string")
    assert rows(collapse.distinct_first(df, ["k", "c"], ["id"])) == [(1, "a", 2, "early"), (1, None, 9, "x")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_groups_shrink_before_the_shuffle(spark):
    """A key that holds a third of all rows must not travel whole."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    ends = _plan(collapse.collapse_ends(df, ["k"], ["id"], {"f": "id"}, {"l": "id"}))
    assert ends.index("partial_min") > ends.index("Exchange")
    wide = _plan(collapse.first_n_wide(df, ["k"], ["id"], 4, {"v": "id"}))
    assert "WindowGroupLimit" in wide[wide.index("Exchange"):] and "Partial" in wide[wide.index("Exchange"):]
    assert wide.count("Exchange hashpartitioning") == 1
    three = collapse.first_second_last(df, ["k"], ["id"], {"v": "id"})
    assert _plan(three).count("Exchange hashpartitioning") == 2 and "collect_list" not in _plan(three)
    hot = three.where("k = 0").first()
    assert (hot["v_first"], hot["v_second"], hot["v_last"]) == (0, 3, 2997)


def test_first_second_last_merges_right_after_coalescing(spark):
    """Both sides of the merge have very different sizes; adaptive execution must not misalign them."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = spark.range(20000).select((F.col("id") % 5000).alias("k"), "id", F.repeat(F.lit("x"), 50).alias("pad"))
        got = collapse.first_second_last(df, ["k"], ["id"], {"v": "id", "pad": "pad"})
        assert got.count() == 5000
        wrong = got.where("v_first != k or v_second != k + 5000 or v_last != k + 15000 or v_first is null or v_last is null")
        assert wrong.count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
