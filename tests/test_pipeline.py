"""End-to-end pipeline to parquet, sink options, and the incremental stream."""

import os
from unittest import mock

from pyspark.sql import functions as F

from yellowstar.pipeline import jdbc_sink, run_pipeline
from yellowstar.schemas import DIMENSION_TABLES, FACT_COLUMNS, FACT_TABLE, YELLOW_TRIPS
from yellowstar.sinks import jdbc_options
from yellowstar.sources import conform
from yellowstar.streaming import land_clean_trips


def test_run_pipeline_to_parquet(spark, trips_small, tmp_dir):
    out = f"{tmp_dir}/star"
    star = run_pipeline(spark, trips_small, out)
    written = sorted(os.listdir(out))
    assert written == sorted(DIMENSION_TABLES + [FACT_TABLE])
    fact = spark.read.parquet(f"{out}/{FACT_TABLE}")
    assert fact.columns == FACT_COLUMNS and fact.count() == 2980
    dt = spark.read.parquet(f"{out}/datetime_DIM")
    # loaded fact keys match loaded dimension keys
    pu = fact.join(dt.select(F.col("datetime_key").alias("putime_key")), "putime_key", "left_anti")
    assert pu.count() == 0
    assert star.fact.count() == 2980


def test_run_pipeline_from_directory(spark, trips_small, tmp_dir):
    conform(trips_small, YELLOW_TRIPS).coalesce(1).write.parquet(f"{tmp_dir}/src")
    out = f"{tmp_dir}/star"
    from yellowstar.session import scale_conf

    keys = list(scale_conf(1, 1))
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        run_pipeline(spark, f"{tmp_dir}/src", out, auto_size=True)
        # a tiny input: two partitions per core
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(2 * spark.sparkContext.defaultParallelism)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert spark.read.parquet(f"{out}/{FACT_TABLE}").count() == 2980


def test_jdbc_options_and_sink_calls():
    opts = jdbc_options("jdbc:postgresql://db:5432/x", "fact_table", user="u", password="p", num_partitions=8)
    assert opts["dbtable"] == "fact_table" and opts["numPartitions"] == "8"
    assert opts["truncate"] == "true" and opts["batchsize"] == "10000"
    assert jdbc_options("jdbc:x", "t")["numPartitions"] == "32"  # connection cap by default
    df = mock.MagicMock()
    writer = df.write.format.return_value.options.return_value.mode.return_value
    jdbc_sink("jdbc:x", user="u")("vendor_DIM", df)
    df.write.format.assert_called_with("jdbc")
    assert df.write.format.return_value.options.call_args.kwargs["dbtable"] == "vendor_DIM"
    df.write.format.return_value.options.return_value.mode.assert_called_with("overwrite")
    writer.save.assert_called_once()


def test_incremental_stream_processes_each_file_once(spark, trips_small, tmp_dir):
    landing, out, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/clean", f"{tmp_dir}/ckpt"
    rows = conform(trips_small, YELLOW_TRIPS)
    rows.filter(F.col("vendorid") == 1).coalesce(1).write.parquet(landing, mode="append")
    land_clean_trips(spark, landing, out, ckpt)
    first = spark.read.parquet(out).count()
    rows.filter(F.col("vendorid") != 1).coalesce(1).write.parquet(landing, mode="append")
    land_clean_trips(spark, landing, out, ckpt)
    land_clean_trips(spark, landing, out, ckpt)  # nothing new: no duplicates
    assert 0 < first < 3038
    assert spark.read.parquet(out).count() == 3038


def test_rerun_gives_same_tables(spark, trips_small, tmp_dir):
    from yellowstar.pipeline import build_star

    a = build_star(trips_small).tables()
    b = build_star(trips_small.repartition(3)).tables()
    for name in a:
        assert a[name].exceptAll(b[name]).count() == 0, name
        assert b[name].exceptAll(a[name]).count() == 0, name


def test_fact_partitioned_by_month_prunes(spark, trips_small, tmp_dir):
    from yellowstar.plans.inspect import plan_text

    out = f"{tmp_dir}/star"
    run_pipeline(spark, trips_small, out, partition_by_month=True)
    months = os.listdir(f"{out}/{FACT_TABLE}")
    assert any(m.startswith("pickup_month=") for m in months)
    fact = spark.read.parquet(f"{out}/{FACT_TABLE}")
    assert fact.count() == 2980 and fact.columns[:20] == FACT_COLUMNS
    one = fact.filter(F.col("pickup_month") == "1995-03-01")
    assert "PartitionFilters: [isnotnull(pickup_month" in plan_text(one)


def test_load_order_dimensions_then_fact(spark, trips_small):
    written = []
    run_pipeline(spark, trips_small, lambda name, df: written.append((name, df.columns)))
    assert [n for n, _ in written] == DIMENSION_TABLES + [FACT_TABLE]
    assert written[-1][1] == FACT_COLUMNS


def test_pipeline_with_at_scale_paths(spark, trips_small, tmp_dir):
    out = f"{tmp_dir}/star"
    star = run_pipeline(spark, trips_small, out, broadcast_rows=0, window_max_rows=0)
    fact = spark.read.parquet(f"{out}/{FACT_TABLE}")
    assert fact.count() == 2980
    assert all(d.block_lookup(8_000_000) is not None for d in star.dimensions.values())
    plain = build_star_fact(spark, trips_small)
    assert fact.exceptAll(plain).count() == 0 and plain.exceptAll(fact).count() == 0


def build_star_fact(spark, trips):
    from yellowstar.pipeline import build_star

    return build_star(trips).fact


def test_incremental_stream_with_its_own_checkpoint(spark, trips_small, tmp_dir):
    landing, out = f"{tmp_dir}/landing2", f"{tmp_dir}/clean2"
    rows = conform(trips_small, YELLOW_TRIPS)
    rows.filter(F.col("vendorid") == 1).coalesce(1).write.parquet(landing, mode="append")
    land_clean_trips(spark, landing, out)
    rows.filter(F.col("vendorid") != 1).coalesce(1).write.parquet(landing, mode="append")
    land_clean_trips(spark, landing, out)
    assert spark.read.parquet(out).count() == 3038


def test_files_of_any_name_are_read(spark, trips_small, tmp_dir):
    import glob
    import shutil

    from yellowstar.sources import list_data_files

    trips_small.coalesce(1).write.parquet(f"{tmp_dir}/named")
    part = glob.glob(f"{tmp_dir}/named/part-*.parquet")[0]
    shutil.copy(part, f"{tmp_dir}/named/month.parq")
    assert any(p.endswith("month.parq") for p in list_data_files(spark, f"{tmp_dir}/named"))
