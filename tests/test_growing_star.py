"""Stable keys across loads, loads that can be run again, and crashes in between."""

import datetime

import pytest
from pyspark.sql import functions as F

from yellowstar.operators import KeyRegistry, build_fact, clean_trips, register_load, registries
from yellowstar.operators.dimensions import DimSpec
from yellowstar.pipeline import read_star, run_load
from yellowstar.sinks import committed_loads, read_loads, write_load

SPEC = DimSpec("k_DIM", "k", "k_key", ("k",))


def _book(spark, tmp_dir):
    return KeyRegistry(spark, f"{tmp_dir}/book", SPEC, spark.range(0).schema["id"].dataType)


def _values(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k bigint")


def _keys(book, version=None):
    return {r["k"]: r["k_key"] for r in book.members(version).collect()}


def test_known_keys_stay_and_new_ones_follow(spark, tmp_dir):
    book = _book(spark, tmp_dir)
    assert book.add(_values(spark, 30, 10, 20), "a").high_water == 3
    first = _keys(book)
    assert first == {10: 0, 20: 1, 30: 2}
    commit = book.add(_values(spark, 5, 20, None, 40), "b")
    assert (commit.version, commit.first_key, commit.members, commit.high_water) == (2, 3, 3, 6)
    assert _keys(book) == first | {5: 3, 40: 4, None: 5}
    # null is a member like any other, and known from then on
    assert book.add(_values(spark, None, 5), "c").members == 0
    assert [c.load for c in book.commits()] == ["a", "b"]
    assert _keys(book, version=1) == first


def test_repeated_load_adds_only_what_is_new(spark, tmp_dir):
    book = _book(spark, tmp_dir)
    book.add(_values(spark, 1, 2), "a")
    assert book.add(_values(spark, 1, 2), "a").members == 0
    assert book.add(_values(spark, 1, 2, 3), "a").members == 1
    assert _keys(book) == {1: 0, 2: 1, 3: 2}
    empty = _book(spark, f"{tmp_dir}/other")
    assert empty.add(_values(spark, 1).limit(0), "a").high_water == 0
    assert empty.members().count() == 0 and empty.dimension().row_count() == 0


def test_members_without_a_commit_are_not_read_and_are_replaced(spark, tmp_dir):
    book = _book(spark, tmp_dir)
    book.add(_values(spark, 1), "a")
    # a load that died after its members and before its commit
    spark.createDataFrame([(7, 99)], "k bigint, k_key bigint").write.parquet(f"{tmp_dir}/book/members/version=2")
    assert _keys(book) == {1: 0}
    book.add(_values(spark, 8), "b")
    assert _keys(book) == {1: 0, 8: 1}


def test_many_keys_take_the_same_numbers_as_few(spark, tmp_dir):
    book = _book(spark, tmp_dir)
    book.add(spark.range(0, 30_000, 2).toDF("k"), "even")
    book.add(spark.range(0, 30_000).toDF("k"), "all")
    keys = _keys(book)
    assert len(keys) == len(set(keys.values())) == 30_000
    assert all(keys[k] == k // 2 + (15_000 if k % 2 else 0) for k in keys)


def test_registry_dimension_has_no_block_lookup(spark, trips_small, tmp_dir):
    """Block lookups need keys that rise with the value; a registry's need not."""
    clean = clean_trips(trips_small)
    half = F.col("tpep_pickup_datetime") >= F.lit("1995-06-17").cast("timestamp_ntz")
    register_load(clean.filter(half), tmp_dir, "late")
    dims = register_load(clean, tmp_dir, "all", hot_key_rows=50)
    assert all(d.block_lookup(8_000_000) is None for d in dims.values())
    assert dims["vendor_DIM"].hot_values
    natural = clean.count()
    # every path gives the same fact rows: broadcast, and shuffle joins with hot values apart
    small, large = build_fact(clean, dims), build_fact(clean, dims, broadcast_rows=0)
    assert small.count() <= natural and small.exceptAll(large).count() == large.exceptAll(small).count() == 0


def test_growing_star(spark, trips_small, tmp_dir):
    split = F.col("tpep_pickup_datetime") < F.lit("1995-06-17").cast("timestamp_ntz")
    first, second = trips_small.filter(split), trips_small.filter(~split)
    n1 = run_load(spark, first, tmp_dir, "2023-01")
    before = {n: {tuple(r) for r in b.members().collect()} for n, b in registries(spark, f"{tmp_dir}/keys", clean_trips(trips_small)).items()}
    files = sorted(read_loads(spark, f"{tmp_dir}/fact_table").inputFiles())
    # a first attempt with a part of the trips, then all of them, then once more
    run_load(spark, second.limit(50), tmp_dir, "2023-02")
    n2 = run_load(spark, second, tmp_dir, "2023-02")
    assert run_load(spark, second, tmp_dir, "2023-02") == n2
    assert committed_loads(spark, f"{tmp_dir}/fact_table") == {"2023-01": n1, "2023-02": n2}
    star = read_star(spark, tmp_dir, clean_trips(trips_small))
    assert n1 + n2 == star["fact_table"].count() == 2980
    # the first load's files and keys are those of before
    assert sorted(read_loads(spark, f"{tmp_dir}/fact_table", ["2023-01"]).inputFiles()) == files
    for name, book in registries(spark, f"{tmp_dir}/keys", clean_trips(trips_small)).items():
        assert before[name] <= {tuple(r) for r in book.members().collect()}
    times = star["datetime_DIM"]
    lost = star["fact_table"].join(times.select(F.col("datetime_key").alias("putime_key")), "putime_key", "left_anti")
    assert lost.count() == 0


def test_rewriting_one_load_leaves_the_others(spark, tmp_dir):
    table = lambda *v: spark.createDataFrame([(x,) for x in v], "a bigint")
    write_load(table(1, 2), tmp_dir, "01")
    write_load(table(3), tmp_dir, "02")
    write_load(table(4, 5, 6), tmp_dir, "01")
    rows = sorted(tuple(r) for r in read_loads(spark, tmp_dir).collect())
    assert rows == [(3, "02"), (4, "01"), (5, "01"), (6, "01")]
    # a load that has become empty hides what it had
    assert write_load(table(1).limit(0), tmp_dir, "01") == 0
    assert [tuple(r) for r in read_loads(spark, tmp_dir).collect()] == [(3, "02")]
    with pytest.raises(ValueError):
        write_load(table(1), tmp_dir, "../x")


def test_a_load_that_dies_is_not_read(spark, tmp_dir):
    write_load(spark.createDataFrame([(1,)], "a bigint"), tmp_dir, "m1")
    write_load(spark.createDataFrame([(2,)], "a bigint"), tmp_dir, "m2")
    bad = spark.createDataFrame([(9,)], "a bigint").select(F.raise_error(F.lit("lost")).cast("bigint").alias("a"))
    with pytest.raises(Exception, match="lost"):
        write_load(bad, tmp_dir, "m2")
    assert committed_loads(spark, tmp_dir) == {"m1": 1}
    assert [tuple(r) for r in read_loads(spark, tmp_dir).collect()] == [(1, "m1")]
    assert write_load(spark.createDataFrame([(3,)], "a bigint"), tmp_dir, "m2") == 1
    assert sorted(r["a"] for r in read_loads(spark, tmp_dir).collect()) == [1, 3]


def test_time_keys(spark, tmp_dir):
    spec = DimSpec("t_DIM", "timestamp", "datetime_key", ("t",))
    times = spark.createDataFrame([(datetime.datetime(2023, 1, 1, 0, 0, s),) for s in (5, 1, 3)], "timestamp timestamp_ntz")
    book = KeyRegistry(spark, f"{tmp_dir}/t", spec, times.schema["timestamp"].dataType)
    book.add(times, "a")
    book.add(spark.createDataFrame([(datetime.datetime(2023, 1, 1),)], "timestamp timestamp_ntz"), "b")
    got = sorted((r["timestamp"].second, r["datetime_key"]) for r in book.members().collect())
    assert got == [(0, 3), (1, 0), (3, 1), (5, 2)]
