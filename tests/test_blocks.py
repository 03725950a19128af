"""Block-bitmap key lookup: equals the dense key, falls back when it cannot be exact."""

import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yellowstar.operators import build_dimensions, build_fact, clean_trips, ranged_dense_key
from yellowstar.operators.blocks import build_block_lookup, join_by_blocks
from yellowstar.plans.inspect import count_nodes


def _lookup_equals_keys(spark, values, ddl):
    keys = spark.createDataFrame([(v,) for v in values], ddl).distinct()
    dim, _ = ranged_dense_key(keys, "k", "key")
    lookup = build_block_lookup(dim, "k", "key")
    assert lookup is not None
    fact = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{ddl}, i int")
    got = {r["i"]: r["k_key"] for r in join_by_blocks(fact, lookup, "k", "k_key", "left").collect()}
    expected = {r["k"]: r["key"] for r in dim.collect()}
    for i, v in enumerate(values):
        assert got[i] == (None if v is None else expected[v])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-(2**40), 2**40), st.integers(-200, 200)), min_size=1, max_size=200))
def test_integer_lookup_equals_dense_key(spark, values):
    _lookup_equals_keys(spark, values, "k long")


def test_timestamp_lookup_including_pre_epoch(spark):
    base = datetime.datetime(1969, 12, 31, 23, 58)
    values = [base + datetime.timedelta(seconds=s) for s in (0, 1, 63, 64, 65, 119, 120, 3600, 86400 * 400)] + [None]
    _lookup_equals_keys(spark, values, "k timestamp_ntz")


def test_sub_second_timestamps_fall_back(spark):
    values = [datetime.datetime(2023, 1, 1, 0, 0, 0, 500000), datetime.datetime(2023, 1, 1, 0, 0, 1)]
    keys = spark.createDataFrame([(v,) for v in values], "k timestamp_ntz")
    dim, _ = ranged_dense_key(keys, "k", "key")
    assert build_block_lookup(dim, "k", "key") is None


def test_strings_have_no_lookup(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    dim, _ = ranged_dense_key(keys, "k", "key")
    assert build_block_lookup(dim, "k", "key") is None


def test_fact_via_blocks_is_map_side(spark, trips_small):
    clean = clean_trips(trips_small)
    plain = build_fact(clean, build_dimensions(clean))
    dims = build_dimensions(clean, window_max_rows=0)
    fact = build_fact(clean, dims, broadcast_rows=0)
    assert fact.exceptAll(plain).count() == 0 and plain.exceptAll(fact).count() == 0
    # beside the test input's own lineitem-orders join there is no shuffle join
    for join in ("SortMergeJoin", "ShuffledHashJoin"):
        assert count_nodes(fact, join) == count_nodes(clean, join)
    assert all(d.block_lookup(8_000_000) is not None for d in dims.values())


def test_ntz_ordinals_ignore_the_session_time_zone(spark):
    """Wall-clock values inside a daylight-saving gap of the session zone stay distinct."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        values = [
            datetime.datetime(2023, 3, 12, 2, 30),  # does not exist in New York
            datetime.datetime(2023, 3, 12, 3, 30),
            datetime.datetime(2023, 11, 5, 1, 30),  # exists twice in New York
            datetime.datetime(2023, 11, 5, 2, 30),
            None,
        ]
        _lookup_equals_keys(spark, values, "k timestamp_ntz")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_driver_result_size_caps_block_tables(spark):
    from types import SimpleNamespace

    from yellowstar.operators.blocks import _size_bytes, driver_row_cap

    assert _size_bytes("1g") == 1 << 30 and _size_bytes("512m") == 512 << 20
    assert _size_bytes("2048") == 2048 and _size_bytes("64k") == 64 << 10 and _size_bytes("1gb") == 1 << 30

    def session(value):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: value))

    assert driver_row_cap(session("64k"), 8_000_000) == 1024
    assert driver_row_cap(session("1g"), 8_000_000) == 8_000_000
    assert driver_row_cap(session("0"), 8_000_000) == 8_000_000  # unlimited
    # a table above the cap falls back instead of overflowing the driver
    values = list(range(0, 64 * 2000, 64))  # 2000 blocks
    keys = spark.createDataFrame([(v,) for v in values], "k long")
    dim, _ = ranged_dense_key(keys, "k", "key")
    assert build_block_lookup(dim, "k", "key", max_rows=1024) is None
    assert build_block_lookup(dim, "k", "key", max_rows=4096) is not None
