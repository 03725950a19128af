"""Dimensions, fact build, key integrity and the plans they run with."""

import pytest
from pyspark.sql import functions as F

from yellowstar.operators import build_dimensions, build_fact, clean_trips, key_integrity
from yellowstar.operators.facts import ROLES
from yellowstar.plans.inspect import count_nodes, python_nodes
from yellowstar.schemas import FACT_COLUMNS

GOLDEN_SUMS = {
    "count": 2980,
    "total_amount": 208752.5,
    "vendor_key": 1509,
    "putime_key": 2985407,
    "dotime_key": 3130530,
    "ratecode_key": 6658,
    "puzone_key": 10278,
    "dozone_key": 273080,
    "paymenttype_key": 10310,
}


@pytest.fixture(scope="module")
def star(spark, trips_small):
    clean = clean_trips(trips_small)
    dims = build_dimensions(clean)
    return clean, dims, build_fact(clean, dims)


def _sums(fact):
    aggs = [F.count(F.lit(1)).alias("count")] + [F.sum(c).alias(c) for c in list(GOLDEN_SUMS)[1:]]
    return fact.agg(*aggs).first().asDict()


def test_dimension_sizes(star):
    _, dims, _ = star
    assert {n: d.row_count() for n, d in dims.items()} == {
        "vendor_DIM": 2,
        "datetime_DIM": 2096,
        "taxizone_DIM": 183,
        "paymenttype_DIM": 8,
        "ratecode_DIM": 6,
    }


def test_dimension_columns_and_keys(star):
    _, dims, _ = star
    assert dims["vendor_DIM"].df.columns == ["vendorid", "vendor_key", "vendor_name"]
    assert dims["datetime_DIM"].df.columns == ["timestamp", "datetime_key"]
    assert dims["taxizone_DIM"].df.columns == ["locationid", "zone_key"]
    assert dims["paymenttype_DIM"].df.columns == ["payment_type", "paymenttype_key", "description"]
    assert dims["ratecode_DIM"].df.columns == ["ratecodeid", "ratecode_key", "description"]
    for d in dims.values():
        keys = sorted(r[0] for r in d.df.select(d.key).collect())
        assert keys == list(range(len(keys)))
        assert dict(d.df.dtypes)[d.key] == "bigint"


def test_payment_labels_and_null_member(star):
    _, dims, _ = star
    rows = {r["payment_type"]: (r["paymenttype_key"], r["description"]) for r in dims["paymenttype_DIM"].df.collect()}
    assert rows[None] == (7, None)
    assert rows[0] == (0, None)  # unknown code: null label, not a failure
    assert rows[1] == (1, "Credit card") and rows[6] == (6, "Voided trip")
    vendors = {r["vendorid"]: r["vendor_name"] for r in dims["vendor_DIM"].df.collect()}
    assert vendors == {1: "Creative Mobile Technologies, LLC", 2: "VeriFone Inc."}


def test_strict_labels_fail_on_unknown_code(spark, trips_small):
    dims = build_dimensions(clean_trips(trips_small), ["paymenttype_DIM"], strict=True)
    with pytest.raises(Exception, match="unknown code"):
        dims["paymenttype_DIM"].df.collect()


def test_fact_golden(star):
    _, _, fact = star
    assert fact.columns == FACT_COLUMNS
    assert _sums(fact) == GOLDEN_SUMS


def test_fact_keys_exist_in_dimensions(star):
    _, dims, fact = star
    for role in ROLES:
        d = dims[role.dimension]
        missing = fact.join(d.df.select(F.col(d.key).alias(role.key)), role.key, "left_anti")
        assert missing.count() == 0, role


def test_facts_plus_dropped_equal_clean(star):
    clean, dims, fact = star
    report = {r["role"]: r for r in key_integrity(clean, dims).collect()}
    assert all(r["duplicate_keys"] == 0 for r in report.values())
    assert report["paymenttype_key"]["unmatched_rows"] == 58  # null payment types
    assert sum(r["unmatched_rows"] for r in report.values()) == 58
    assert clean.count() - fact.count() == 58


def test_shuffle_path_equals_broadcast_path(spark, star):
    clean, _, fact = star
    dims = build_dimensions(clean, window_max_rows=0)
    big = build_fact(clean, dims, broadcast_rows=0, block_rows=0)
    assert _sums(big) == GOLDEN_SUMS
    assert big.exceptAll(fact).count() == 0 and fact.exceptAll(big).count() == 0


def test_stable_under_shuffle_partitions(spark, trips_small, star):
    _, _, fact = star
    reference = sorted(tuple(r) for r in fact.collect())
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        clean = clean_trips(trips_small)
        again = build_fact(clean, build_dimensions(clean, window_max_rows=0))
        assert sorted(tuple(r) for r in again.collect()) == reference
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_left_join_keeps_rows(star):
    clean, dims, _ = star
    assert build_fact(clean, dims, how="left").count() == clean.count()


def test_fact_plan(star):
    _, dims, fact = star
    assert python_nodes(fact) == []
    # all seven lookups are map-side hash joins against checked-size dimensions
    assert count_nodes(fact, "BroadcastHashJoin") >= 7
    assert count_nodes(fact, "SortMergeJoin") == 0


def test_fact_plan_large_dimensions_shuffle(star):
    clean, _, _ = star
    dims = build_dimensions(clean, window_max_rows=0)
    big = build_fact(clean, dims, broadcast_rows=0, block_rows=0)
    # every dimension lookup is a shuffle join; the only broadcasts left are
    # the per-partition offset tables of the ranged keys (one row per partition)
    # and what the test input's own lineitem-orders join takes
    def own(join):
        return count_nodes(big, join) - count_nodes(clean, join)

    assert own("SortMergeJoin") + own("ShuffledHashJoin") >= len(ROLES)
    assert own("BroadcastHashJoin") == len(ROLES)


def test_left_join_shuffle_path_keeps_null_keys(star):
    clean, _, _ = star
    dims = build_dimensions(clean, ["paymenttype_DIM"], window_max_rows=0)
    from yellowstar.operators import join_role

    out = join_role(clean, dims["paymenttype_DIM"], "payment_type", "paymenttype_key", how="left", broadcast_rows=0, block_rows=0)
    assert out.count() == clean.count()
    assert out.filter(F.col("paymenttype_key").isNull()).count() == 58


def test_hot_key_split_is_exact(spark, trips_small, star):
    import datetime

    from yellowstar.operators import join_role

    # a third of all trips share one pickup time
    hot = datetime.datetime(1996, 1, 1)
    skewed = trips_small.withColumn(
        "tpep_pickup_datetime",
        F.when(F.col("VendorID") == 1, F.lit(hot)).otherwise(F.col("tpep_pickup_datetime")),
    )
    clean = clean_trips(skewed)
    plain = build_fact(clean, build_dimensions(clean))
    dims = build_dimensions(clean, window_max_rows=0, hot_key_rows=500)
    assert "tpep_pickup_datetime" in dims["datetime_DIM"].hot_values
    split = build_fact(clean, dims, broadcast_rows=0, block_rows=0)
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
    left = join_role(clean, dims["paymenttype_DIM"], "payment_type", "paymenttype_key", "left", broadcast_rows=0, block_rows=0)
    assert left.count() == clean.count()
    assert left.filter(F.col("paymenttype_key").isNull()).count() == 58
    # the hot values are looked up map-side; the plan stays one chain
    text = count_nodes(split, "Union")
    assert text == 0


def test_block_dimension_row_counts_need_no_job(star):
    clean, _, _ = star
    dims = build_dimensions(clean, window_max_rows=0)
    for d in dims.values():
        assert d._rows is not None and d._rows == d.df.count()
    # the payment dimension has a null member: counted once
    assert dims["paymenttype_DIM"]._rows == 8


def test_broadcast_decision_uses_proof_before_measurement():
    from yellowstar.operators.dimensions import Dimension

    class CountingFrame:
        def __init__(self, n):
            self.n, self.calls = n, 0

        def count(self):
            self.calls += 1
            return self.n

    proven = CountingFrame(5)
    d = Dimension("d", proven, "k", "key", max_rows=6)
    assert d.fits_broadcast(10) and proven.calls == 0  # the code-domain bound decides
    measured = CountingFrame(50)
    d = Dimension("d", measured, "k", "key")
    assert not d.fits_broadcast(10) and d.fits_broadcast(50) and measured.calls == 1  # counted once
