"""Cleaning against a plain-Python model of its rules on generated dirty rows."""

import math
import struct

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from yellowstar.operators import clean_trips
from yellowstar.schemas import MONEY_COLUMNS

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
RAW_DDL = (
    "VendorID bigint, passenger_count double, trip_distance double, RatecodeID double, "
    "store_and_fwd_flag string, PULocationID bigint, DOLocationID bigint, payment_type bigint, "
    + ", ".join(f"{c} double" for c in MONEY_COLUMNS)
)

doubles = st.one_of(
    st.none(),
    st.just(float("nan")),
    st.sampled_from([0.0, -0.0, 0.9, 1.0, 2.7, 6.5, 7.0, -1.5, 1e-50, 3e9]),
    st.floats(-20, 20, allow_nan=False),
)
money = st.one_of(st.none(), st.just(float("nan")), st.sampled_from([-1.0, 0.0, 2.5]))
row = st.tuples(
    st.one_of(st.none(), st.sampled_from([0, 1, 2, 6, 4294967297, -4294967295])),
    doubles,
    doubles,
    doubles,
    st.one_of(st.none(), st.sampled_from(["Y", "N", "y"])),
    st.one_of(st.none(), st.integers(-5, 300)),
    st.one_of(st.none(), st.sampled_from([1, 264, 4294967297])),
    st.one_of(st.none(), st.integers(0, 7)),
    *[money for _ in MONEY_COLUMNS],
)


def try_int(x):
    """Spark try_cast(x AS INT): truncate toward zero, null when out of range or NaN."""
    if x is None or (isinstance(x, float) and (math.isnan(x) or math.isinf(x))):
        return None
    v = math.trunc(x) if isinstance(x, float) else x
    return v if INT_MIN <= v <= INT_MAX else None


def to_float32(x):
    return None if x is None else struct.unpack("f", struct.pack("f", x))[0]


def spark_ge0(x):
    """Spark ``x >= 0``: NaN is the largest value; null stays null."""
    if x is None:
        return None
    return True if math.isnan(x) else x >= 0


def model(r):
    vendor, passengers, distance, rate, flag, pu, do, pay, *money_vals = r
    v = try_int(vendor)
    if v not in (1, 2):
        return None
    p = try_int(passengers)
    if p is None or p <= 0:
        return None
    d = to_float32(distance)
    if d is None or not (math.isnan(d) or d > 0):  # NaN > 0 holds in Spark
        return None
    rc = try_int(rate)
    if rc not in (1, 2, 3, 4, 5, 6):
        return None
    checks = [spark_ge0(m) for m in money_vals]
    errordata = "n" if all(c is True for c in checks) else "y"
    return (v, p, rc, None if flag is None else flag.lower(), try_int(pu), try_int(do), pay, errordata)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=40))
def test_clean_matches_model(spark, rows):
    df = spark.createDataFrame(rows, RAW_DDL)
    got = sorted(
        (
            tuple(r)
            for r in clean_trips(df)
            .select(
                "vendorid", "passenger_count", "ratecodeid", "store_and_fwd_flag",
                "pulocationid", "dolocationid", "payment_type", "errordata",
            )
            .collect()
        ),
        key=repr,
    )
    want = sorted((m for m in map(model, rows) if m is not None), key=repr)
    assert got == want
