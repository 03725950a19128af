"""Profiles, limits and table sizes."""

from pyspark.sql import functions as F

from yellowstar.operators import (
    value_lists,
    bounded_count,
    cardinality_profile,
    count_where,
    limit_ordered,
    row_count,
    schema_rows,
    table_sizes,
    value_counts,
)


def test_cardinality_counts_null_as_value(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (None, "b")], "x int, y string")
    got = {r["column"]: (r["n_distinct"], r["has_null"]) for r in cardinality_profile(df, ["x", "y"]).collect()}
    assert got == {"x": (3, True), "y": (3, True)}


def test_value_counts_keep_null_group(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    assert sorted(value_counts(df, "x").collect(), key=lambda r: (r[0] is None, r[0])) == [(1, 2), (None, 1)]


def test_count_where_and_row_count(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (None,)], "v double")
    r = count_where(df, neg=F.col("v") < 0, zero=F.col("v") == 0).first()
    assert (r.neg, r.zero) == (1, 1)
    assert row_count(df).first().rows == 3


def test_limit_ordered_is_deterministic(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 101).alias("a"), (F.col("id") % 7).alias("b"))
    a = [tuple(r) for r in limit_ordered(df, 50).collect()]
    b = [tuple(r) for r in limit_ordered(df.repartition(5), 50).collect()]
    assert a == b and len(a) == 50


def test_bounded_count(spark):
    assert bounded_count(spark.range(1000), 100).first().rows == 100
    assert bounded_count(spark.range(7), 100).first().rows == 7


def test_schema_rows_and_sizes(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert [tuple(r) for r in schema_rows(df).collect()] == [("x", "int"), ("y", "string")]
    sizes = {r.table: r.rows for r in table_sizes({"one": df, "range": spark.range(5)}).collect()}
    assert sizes == {"one": 1, "range": 5}


def test_scale_conf_bounds():
    from yellowstar.session import scale_conf

    assert scale_conf(100 * 1024**4, 8000)["spark.sql.shuffle.partitions"] == "100000"
    assert scale_conf(10 * 1024**2, 8)["spark.sql.shuffle.partitions"] == "16"
    assert scale_conf(500 * 1024**3, 100)["spark.sql.shuffle.partitions"] == "500"


def test_limit_ordered_two_level_equals_single_merge(spark):
    from yellowstar.plans.inspect import count_nodes

    df = spark.range(0, 50000, 1, 25).select(
        (F.col("id") * 7919 % 10007).alias("a"), (F.col("id") % 11).alias("b")
    )
    single = limit_ordered(df, 300)
    two = limit_ordered(df, 300, single_merge_max_rows=1000)
    assert count_nodes(two, "WindowGroupLimit") == 2 and count_nodes(single, "WindowGroupLimit") == 0
    assert [tuple(r) for r in two.collect()] == [tuple(r) for r in single.collect()]


def test_value_lists_are_whole(spark):
    df = spark.createDataFrame([(1, "b", i) for i in range(1000)] + [(2, None, 7), (None, "a", 7)], "x int, y string, z int")
    got = {(r["column"], r["value"]): r["rows"] for r in value_lists(df, ["x", "y", "z"]).collect()}
    assert (got["x", "1"], got["x", "2"], got["x", None]) == (1000, 1, 1)
    assert (got["y", "b"], got["y", "a"], got["y", None]) == (1000, 1, 1)
    assert sum(c == "z" for c, _ in got) == 1000 and got["z", "7"] == 3
