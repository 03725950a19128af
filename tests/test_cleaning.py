"""Cleaning rules on literal edge rows and the golden funnel."""

import math

import pytest
from pyspark.sql import functions as F

from yellowstar.operators import clean_trips, cleaning_funnel, stage_frames
from yellowstar.operators.cleaning import filter_stages
from yellowstar.schemas import MONEY_COLUMNS

RAW_DDL = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
    "PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double, Airport_fee double"
)


def row(**over):
    import datetime

    base = dict(
        VendorID=1,
        tpep_pickup_datetime=datetime.datetime(2023, 1, 1, 10, 0),
        tpep_dropoff_datetime=datetime.datetime(2023, 1, 1, 10, 30),
        passenger_count=1.0,
        trip_distance=2.5,
        RatecodeID=1.0,
        store_and_fwd_flag="N",
        PULocationID=10,
        DOLocationID=20,
        payment_type=1,
        fare_amount=10.0,
        extra=0.5,
        mta_tax=0.5,
        tip_amount=1.0,
        tolls_amount=0.0,
        improvement_surcharge=1.0,
        total_amount=13.0,
        congestion_surcharge=2.5,
        Airport_fee=0.0,
    )
    base.update(over)
    return tuple(base.values())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_DDL)


def test_valid_row_survives_with_types(spark):
    out = clean_trips(frame(spark, row()))
    r = out.collect()
    assert len(r) == 1
    types = dict(out.dtypes)
    assert types["vendorid"] == "int"
    assert types["passenger_count"] == "int"
    assert types["trip_distance"] == "float"
    assert types["ratecodeid"] == "int"
    assert types["pulocationid"] == "int"
    assert types["payment_type"] == "bigint"
    assert types["fare_amount"] == "double"
    assert r[0]["errordata"] == "n"
    assert r[0]["store_and_fwd_flag"] == "n"
    assert out.columns[-1] == "errordata"
    assert all(c == c.lower() for c in out.columns)


@pytest.mark.parametrize(
    "over",
    [
        dict(VendorID=4294967297),  # bigint that wraps to 1 with a plain cast
        dict(VendorID=6),
        dict(VendorID=None),
        dict(passenger_count=0.9),  # truncates to 0
        dict(passenger_count=float("nan")),
        dict(passenger_count=None),
        dict(passenger_count=0.0),
        dict(passenger_count=-3.0),
        dict(trip_distance=0.0),
        dict(trip_distance=-1.5),
        dict(trip_distance=1e-50),  # 0 as float
        dict(RatecodeID=99.0),
        dict(RatecodeID=None),
        dict(RatecodeID=0.0),
    ],
)
def test_dirty_rows_dropped(spark, over):
    assert clean_trips(frame(spark, row(**over))).count() == 0


@pytest.mark.parametrize("pushdown", [True, False])
def test_truncation_keeps_fractional_codes(spark, pushdown):
    out = filter_stages(frame(spark, row(VendorID=2, passenger_count=2.7, RatecodeID=6.9)), pushdown).collect()
    assert len(out) == 1
    assert (out[0]["vendorid"], out[0]["passenger_count"], out[0]["ratecodeid"]) == (2, 2, 6)


def test_nan_distance_kept(spark):
    out = clean_trips(frame(spark, row(trip_distance=float("nan")))).collect()
    assert len(out) == 1 and math.isnan(out[0]["trip_distance"])


@pytest.mark.parametrize("col", MONEY_COLUMNS)
def test_null_or_negative_money_flags_y(spark, col):
    key = "Airport_fee" if col == "airport_fee" else col
    for value in (None, -0.5):
        r = clean_trips(frame(spark, row(**{key: value}))).collect()
        assert len(r) == 1 and r[0]["errordata"] == "y"


def test_fare_sign_flag_null_is_n(spark):
    r = clean_trips(frame(spark, row(fare_amount=None), row(fare_amount=-1.0)), with_fare_sign=True)
    got = sorted((x["fare_sign"], x["errordata"]) for x in r.collect())
    assert got == [("n", "y"), ("y", "y")]


def test_name_collision_rejected(spark):
    df = spark.createDataFrame([(1, 2)], "airport_fee int, Airport_fee int")
    with pytest.raises(ValueError):
        clean_trips(df)


def test_pushdown_and_exact_paths_agree(spark, trips_small):
    a = filter_stages(trips_small, pushdown=True)
    b = filter_stages(trips_small, pushdown=False)
    assert a.count() == b.count() == 3038
    assert a.exceptAll(b).count() == 0


def test_funnel_golden_sf0001(spark, trips_small):
    got = [(r["stage"], r["rows"]) for r in cleaning_funnel(trips_small).orderBy("step").collect()]
    assert got == [
        ("raw", 6000),
        ("vendor", 5082),
        ("passenger_present", 4814),
        ("passenger_positive", 4118),
        ("distance", 3769),
        ("ratecode", 3038),
    ]


def test_funnel_equals_stage_frames(spark, trips_small):
    frames = stage_frames(trips_small)
    funnel = {r["stage"]: r["rows"] for r in cleaning_funnel(trips_small).collect()}
    assert {k: v.count() for k, v in frames.items()} == funnel


def test_quality_and_sign_golden(spark, trips_small):
    c = clean_trips(trips_small, with_fare_sign=True)
    q = {r[0]: r[1] for r in c.groupBy("errordata").count().collect()}
    s = {r[0]: r[1] for r in c.groupBy("fare_sign").count().collect()}
    assert q == {"n": 2803, "y": 235}
    assert s == {"n": 2874, "y": 164}


def test_no_python_in_clean_plan(spark, trips_small):
    from yellowstar.plans.inspect import codegen_subtrees, python_nodes

    df = clean_trips(trips_small)
    assert python_nodes(df) == []
    assert codegen_subtrees(df) >= 1
