"""File listing, schema conforming and by-name union of drifting files."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yellowstar.schemas import GREEN_TRIPS, YELLOW_TRIPS
from yellowstar.sources import conform, list_data_files, load_trips, union_by_name
from yellowstar.sources.files import read_saved
from yellowstar.operators import clean_trips

SF_SMALL = "/root/testdata/sf0.001"


def test_list_data_files_sorted_and_filtered(spark):
    files = list_data_files(spark, SF_SMALL)
    names = [os.path.basename(f) for f in files]
    assert names == sorted(names)
    assert "lineitem.parquet" in names and len(names) == 14
    assert [os.path.basename(f) for f in list_data_files(spark, SF_SMALL, "orders.parquet")] == ["orders.parquet"]


def test_listing_skips_hidden_files(spark, tmp_dir):
    df = spark.range(3)
    df.write.parquet(f"{tmp_dir}/a.parquet")
    os.makedirs(f"{tmp_dir}/flat")
    for name in ["b.parquet", ".hidden.parquet", "_meta.parquet"]:
        src = [p for p in os.listdir(f"{tmp_dir}/a.parquet") if p.endswith(".parquet")][0]
        with open(f"{tmp_dir}/a.parquet/{src}", "rb") as a, open(f"{tmp_dir}/flat/{name}", "wb") as b:
            b.write(a.read())
    names = [os.path.basename(f) for f in list_data_files(spark, f"{tmp_dir}/flat")]
    assert names == ["b.parquet"]


def test_conform_case_missing_and_types(spark):
    df = spark.createDataFrame([(1, 2.9, "Y", 4294967297)], "VendorID bigint, PASSENGER_COUNT double, store_and_fwd_flag string, PULocationID bigint")
    out = conform(df, YELLOW_TRIPS)
    assert out.columns == [f.name for f in YELLOW_TRIPS.fields]
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in YELLOW_TRIPS.fields]
    r = out.first()
    assert r["vendorid"] == 1 and r["passenger_count"] == 2 and r["pulocationid"] is None
    assert r["airport_fee"] is None and r["fare_amount"] is None


def test_conform_green_schema_fills_missing(spark):
    df = spark.createDataFrame([(2, 1.0)], "vendorid int, ehail_fee double")
    out = conform(df, GREEN_TRIPS)
    assert out.first()["ehail_fee"] == 1.0 and out.first()["trip_type"] is None


def test_conform_rejects_case_duplicates(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "airport_fee double, Airport_fee double")
    with pytest.raises(ValueError):
        conform(df, YELLOW_TRIPS)


def test_union_by_name_no_value_mixing(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("y", 2)], "NAME string, ID bigint")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    got = sorted(tuple(r) for r in union_by_name([a, b], schema).collect())
    assert got == [(1, "x"), (2, "y")]


def _write_months(spark, trips, base):
    """Two monthly files with drifted layouts: reordered, renamed case, other types."""
    lowered = trips.toDF(*[c.lower() for c in trips.columns])
    jan = lowered.filter(F.col("vendorid") == 1)
    feb = lowered.filter(F.col("vendorid") != 1)
    jan.coalesce(1).write.parquet(f"{base}/tmp_jan")
    feb2 = feb.select(
        *[F.col(c).alias(c.upper() if c.startswith("tpep") else c) for c in reversed(feb.columns)]
    ).withColumn("passenger_count", F.col("passenger_count").cast("float"))
    feb2.coalesce(1).write.parquet(f"{base}/tmp_feb")
    os.makedirs(f"{base}/landing")
    for month in ["jan", "feb"]:
        part = [p for p in os.listdir(f"{base}/tmp_{month}") if p.endswith(".parquet")][0]
        os.rename(f"{base}/tmp_{month}/{part}", f"{base}/landing/yellow_tripdata_{month}.parquet")
    return f"{base}/landing"


def test_load_trips_drifting_months(spark, trips_small, tmp_dir):
    landing = _write_months(spark, trips_small, tmp_dir)
    loaded = load_trips(spark, landing)
    assert loaded.count() == 6000
    assert clean_trips(loaded).count() == 3038
    one = load_trips(spark, landing, max_files=1)
    assert 0 < one.count() < 6000
    flat = load_trips(spark, landing, group_by_schema=False)
    assert flat.columns == loaded.columns


def test_pushed_filters_reach_parquet_scan(spark, trips_small, tmp_dir):
    from yellowstar.plans.inspect import plan_text

    conform(trips_small, YELLOW_TRIPS).write.parquet(f"{tmp_dir}/y")
    df = clean_trips(read_saved(spark, f"{tmp_dir}/y"))
    text = plan_text(df)
    pushed = [line for line in text.splitlines() if "PushedFilters" in line][0]
    assert "vendorid" in pushed and "ratecodeid" in pushed and "trip_distance" in pushed
    assert df.count() == 3038
    assert "ReadSchema" in text


def test_load_trips_provenance(spark, trips_small, tmp_dir):
    landing = _write_months(spark, trips_small, tmp_dir)
    loaded = load_trips(spark, landing, provenance="source_file")
    names = {r.source_file: r["count"] for r in loaded.groupBy("source_file").count().collect()}
    assert set(names) == {"yellow_tripdata_jan.parquet", "yellow_tripdata_feb.parquet"}
    assert sum(names.values()) == 6000


def test_conform_keeps_extra_columns_lower_cased(spark):
    df = spark.createDataFrame([(1, 2.0)], "VendorID bigint, Ehail_Fee double")
    out = conform(df, YELLOW_TRIPS, keep_extra=True)
    assert out.columns[-1] == "ehail_fee" and out.first()["ehail_fee"] == 2.0


def test_single_scan_path_equals_grouped_path(spark, trips_small, tmp_dir):
    conform(trips_small, YELLOW_TRIPS).repartition(3).write.parquet(f"{tmp_dir}/same")
    grouped = load_trips(spark, f"{tmp_dir}/same")
    single = load_trips(spark, f"{tmp_dir}/same", group_by_schema=False)
    assert grouped.exceptAll(single).count() == 0 and single.exceptAll(grouped).count() == 0


def _layouts(spark, tmp_dir, n):
    """n small files of two layouts, written without Spark."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(f"{tmp_dir}/many")
    a = pa.table({"VendorID": pa.array([1], pa.int64()), "trip_distance": [1.5]})
    b = pa.table({"TRIP_DISTANCE": [2.5], "vendorid": pa.array([2], pa.int32())})
    for i in range(n):
        pq.write_table(b if i % 3 == 0 else a, f"{tmp_dir}/many/f{i:05d}.parquet")
    return list_data_files(spark, f"{tmp_dir}/many")


def test_footers_are_read_by_one_job(spark, tmp_dir):
    from yellowstar.sources import footer_groups

    paths = _layouts(spark, tmp_dir, 600)
    spark.sparkContext.setJobGroup("footers", "footers")
    groups = footer_groups(spark, paths)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("footers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
    assert groups == [paths[0::3], [p for i, p in enumerate(paths) if i % 3]]
    loaded = load_trips(spark, paths, YELLOW_TRIPS)
    assert loaded.count() == 600
    assert {r["vendorid"]: r["count"] for r in loaded.groupBy("vendorid").count().collect()} == {1: 400, 2: 200}


def test_footers_of_a_store_that_only_spark_reads(spark, tmp_dir):
    """Such files are read from the driver, with the same groups."""
    from yellowstar.sources import footer_groups

    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_dir}")
    local = _layouts(spark, tmp_dir, 7)
    far = [f"viewfs://store/in/many/{p.rsplit('/', 1)[1]}" for p in local]
    names = lambda groups: [[p.rsplit("/", 1)[1] for p in g] for g in groups]
    assert names(footer_groups(spark, far)) == names(footer_groups(spark, local))
    # and a mixture of both still loads every row
    assert load_trips(spark, far[:3] + local[3:], YELLOW_TRIPS).count() == 7
