"""Golden numbers of FIXTURES.md §3 at all three scales."""

import pytest
from pyspark.sql import functions as F

from yellowstar.operators import build_dimensions, build_fact, clean_trips, cleaning_funnel
from yellowstar.plans.inspect import count_nodes
from yellowstar.sources import trips_fixture

GOLDEN = {
    "0.001": dict(
        funnel=[6000, 5082, 4814, 4118, 3769, 3038],
        dims=[2, 2096, 183, 8, 6],
        fact=(2980, 208752.5, 1509, 2985407, 3130530, 6658, 10278, 273080, 10310),
    ),
    "0.01": dict(
        funnel=[60000, 51402, 48839, 41942, 38183, 30482],
        dims=[2, 2500, 265, 8, 6],
        fact=(29859, 2082145.5, 14999, 35905647, 37083085, 73960, 1470490, 3825648, 102512),
    ),
    "0.1": dict(
        funnel=[600000, 513864, 488041, 419547, 381993, 305242],
        dims=[2, 2500, 265, 8, 6],
        fact=(299129, 20825723.5, 149245, 359015204, 372895588, 746945, 37572849, 39470729, 1024500),
    ),
}
KEYS = ["vendor_key", "putime_key", "dotime_key", "ratecode_key", "puzone_key", "dozone_key", "paymenttype_key"]


@pytest.mark.parametrize("sf", sorted(GOLDEN))
def test_golden(spark, sf):
    trips = trips_fixture(spark, f"/root/testdata/sf{sf}")
    want = GOLDEN[sf]
    assert [r["rows"] for r in cleaning_funnel(trips).orderBy("step").collect()] == want["funnel"]
    clean = clean_trips(trips)
    dims = build_dimensions(clean)
    assert [d.row_count() for d in dims.values()] == want["dims"]
    fact = build_fact(clean, dims)
    got = fact.agg(F.count(F.lit(1)), F.sum("total_amount"), *[F.sum(k) for k in KEYS]).first()
    assert tuple(got) == want["fact"]


def test_growing_datetime_dimension_is_ranged(spark):
    clean = clean_trips(trips_fixture(spark, "/root/testdata/sf0.001"))
    dim = build_dimensions(clean, ["datetime_DIM"], window_max_rows=1000, block_rows=0)["datetime_DIM"]
    assert dim.partition_counts is not None and dim.max_rows is None
    # the only window left ranks per-partition counts (one row per range partition)
    assert count_nodes(dim.df, "Window") == 1
    assert dim.row_count() == 2096


def test_growing_datetime_dimension_from_blocks(spark):
    clean = clean_trips(trips_fixture(spark, "/root/testdata/sf0.001"))
    by_blocks = build_dimensions(clean, ["datetime_DIM"], window_max_rows=1000)["datetime_DIM"]
    ranged = build_dimensions(clean, ["datetime_DIM"], window_max_rows=1000, block_rows=0)["datetime_DIM"]
    assert by_blocks.partition_counts is None and by_blocks.block_lookup(8_000_000) is not None
    # no window over the dimension's values: only the running sum over block rows
    assert count_nodes(by_blocks.df, "Window") == 0
    assert by_blocks.df.exceptAll(ranged.df).count() == 0 and ranged.df.exceptAll(by_blocks.df).count() == 0
    assert by_blocks._rows == 2096  # known from the block table, no counting job
    assert by_blocks.row_count() == by_blocks.df.count() == 2096
