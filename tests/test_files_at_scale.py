"""Incremental listing, counts from footers, sketches per file, skipped pages, integrity without a join of the trips."""

import json
import os
import subprocess
import sys

from pyspark.sql import functions as F

from yellowstar.functions import lower_names
from yellowstar.operators import (
    build_dimensions,
    cardinality_profile,
    clean_trips,
    column_sketches,
    key_integrity,
    merged_cardinality,
)
from yellowstar.plans.inspect import plan_text
from yellowstar.sinks import write_clustered
from yellowstar.sources import Manifest, footer_counts

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _put(spark, area, month, name):
    spark.range(3).coalesce(1).write.parquet(f"{area}/month={month}/{name}")


def test_second_run_lists_only_new_folders(spark, tmp_dir):
    area = f"{tmp_dir}/area"
    book = Manifest(spark, area, f"{tmp_dir}/manifest")
    assert book.run().count() == 0 and book.commits() == []
    for month in ("2023-01", "2023-02"):
        _put(spark, area, month, "a")
    assert {r["folder"] for r in book.run().collect()} == {"month=2023-01", "month=2023-02"}
    assert book.pending() == [] and book.run().count() == 0
    _put(spark, area, "2023-03", "a")
    _put(spark, area, "2023-02", "late")
    assert book.pending() == ["month=2023-03"]
    assert book.pending(overlap=1) == ["month=2023-02", "month=2023-03"]
    new = book.run(overlap=1).collect()
    assert sorted(r["folder"] for r in new) == ["month=2023-02", "month=2023-03"]
    assert all(("late" in r["path"]) == (r["folder"] == "month=2023-02") for r in new)
    assert book.files().count() == 4 and book.files().select("path").distinct().count() == 4


def test_a_run_without_its_commit_is_done_again(spark, tmp_dir):
    area = f"{tmp_dir}/area"
    book = Manifest(spark, area, f"{tmp_dir}/manifest")
    _put(spark, area, "2023-01", "a")
    spark.createDataFrame([("x", "gone", 1)], "folder string, path string, length bigint").write.parquet(f"{tmp_dir}/manifest/files/run=1")
    assert [r["folder"] for r in book.run().collect()] == ["month=2023-01"]
    assert [r["folder"] for r in book.files().collect()] == ["month=2023-01"]


def test_counts_come_from_footers(spark, tmp_dir):
    rows = [(i if i % 5 else None, float(i)) for i in range(1000)]
    spark.createDataFrame(rows, "a int, b double").repartition(7).write.parquet(f"{tmp_dir}/t")
    out = footer_counts(spark, f"{tmp_dir}/t", columns=("a",))
    plan = plan_text(out)
    assert "PushedAggregation: [COUNT(*), COUNT(a), MIN(a), MAX(a)]" in plan
    assert "ReadSchema: struct<>" in plan or "count(*)" in plan.split("ReadSchema")[1][:40]
    assert tuple(out.first()) == (1000, 800, 1, 999)
    # the caller's own session reads as before
    assert "PushedAggregation: [COUNT" not in plan_text(spark.read.parquet(f"{tmp_dir}/t").agg(F.count(F.lit(1))))


def test_sketches_are_exact_below_their_size_and_close_above(spark):
    df = spark.range(60_000).select(
        F.col("id"), (F.col("id") % 300).cast("int").alias("few"), F.when(F.col("id") % 2 == 0, F.col("id") % 7).alias("half"),
        (F.col("id") % 4096).cast("double").alias("edge"), F.concat(F.lit("s"), F.col("id") % 50).alias("s"), F.lit(None).cast("int").alias("none"),
    )
    parts = column_sketches(df, ["id", "few", "half", "edge", "s", "none"], by=F.col("id") % 9)
    assert parts.count() == 9 * 6 and parts.agg(F.sum("rows")).first()[0] == 6 * 60_000
    got = {r["column"]: (r["n_distinct"], r["has_null"], r["exact"]) for r in merged_cardinality(parts).collect()}
    assert got["few"] == (300, False, True) and got["half"] == (8, True, True) and got["s"] == (50, False, True)
    assert got["edge"] == (4096, False, True) and got["none"] == (1, True, True)
    n, has_null, exact = got["id"]
    assert not exact and not has_null and abs(n - 60_000) < 5 * 60_000 / 4096**0.5


def test_sketches_equal_the_profile(trips_small):
    raw = lower_names(trips_small)
    cols = ["vendorid", "passenger_count", "ratecodeid", "store_and_fwd_flag", "payment_type"]
    want = {tuple(r) for r in cardinality_profile(raw, cols).collect()}
    got = merged_cardinality(column_sketches(raw, cols, by=F.col("payment_type"))).filter("exact").drop("exact")
    assert {tuple(r) for r in got.collect()} == want


def test_integrity_does_not_shuffle_the_trips(spark, trips_small):
    clean = clean_trips(trips_small)
    dims = build_dimensions(clean)
    # a dimension that has lost a member
    dims["vendor_DIM"].df = dims["vendor_DIM"].df.filter("vendorid <> 2")
    report = key_integrity(clean, dims)
    lost = {r["role"]: r["unmatched_rows"] for r in report.collect()}
    assert lost["vendor_key"] == clean.filter("vendorid = 2").count() and lost["paymenttype_key"] == 58
    # what is joined are the frozen value counts: no scan of a table is left in the plan
    assert "Scan parquet" not in plan_text(report)


_READ = """
import sys
from yellowstar.session import build_session
from yellowstar.operators import clean_trips
spark = build_session("local[2]", extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + sys.argv[1],
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
clean_trips(spark.read.parquet(sys.argv[2])).write.parquet(sys.argv[3])
spark.stop()
"""


def _rows_read(tmp_dir, name):
    os.makedirs(f"{tmp_dir}/log-{name}")
    args = [sys.executable, "-c", _READ, f"{tmp_dir}/log-{name}", f"{tmp_dir}/{name}", f"{tmp_dir}/{name}-clean"]
    subprocess.run(args, check=True, capture_output=True, timeout=300, cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT})
    read = 0
    for log in os.listdir(f"{tmp_dir}/log-{name}"):
        for line in open(f"{tmp_dir}/log-{name}/{log}"):
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                read += event["Task Metrics"]["Input Metrics"]["Records Read"]
    return read


def test_cleaning_skips_what_it_drops(spark, trips_small, tmp_dir):
    raw = lower_names(trips_small).repartition(2)
    raw.write.option("parquet.page.row.count.limit", "100").parquet(f"{tmp_dir}/plain")
    write_clustered(raw, f"{tmp_dir}/clustered", page_rows=100)
    plain, clustered = _rows_read(tmp_dir, "plain"), _rows_read(tmp_dir, "clustered")
    want = clean_trips(trips_small)
    kept = want.count()
    for name in ("plain", "clustered"):
        back = spark.read.parquet(f"{tmp_dir}/{name}-clean")
        assert back.exceptAll(want).count() == want.exceptAll(back).count() == 0
    assert plain > 0.9 * raw.count()
    # all rows that stay, and those of the pages where two rules meet
    assert kept <= clustered <= kept + 2 * 2 * 5 * 100 < plain
