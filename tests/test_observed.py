"""Counts taken on the write equal counts taken by queries, with one scan."""

import json
import os

from pyspark.sql import functions as F

from yellowstar.operators import build_dimensions, clean_trips, cleaning_funnel, table_sizes
from yellowstar.pipeline import run_pipeline
from yellowstar.sinks import Measured, MeasuredFunnel, write_clean, write_parquet
from yellowstar.sinks.observed import counted_once


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_funnel_of_the_write(spark, trips_small, tmp_dir):
    assert _rows(write_clean(trips_small, f"{tmp_dir}/c")) == _rows(cleaning_funnel(trips_small))
    back = spark.read.parquet(f"{tmp_dir}/c")
    want = clean_trips(trips_small)
    assert back.exceptAll(want).count() == want.exceptAll(back).count() == 0


def test_pipeline_counts(spark, trips_small, tmp_dir):
    star = run_pipeline(spark, trips_small, f"{tmp_dir}/star", measure=True)
    assert _rows(star.funnel) == _rows(cleaning_funnel(trips_small))
    dims = build_dimensions(clean_trips(trips_small))
    want = _rows(table_sizes({n: d.df for n, d in dims.items()})) + [("fact_table", 2980)]
    assert _rows(star.sizes) == sorted(want)


def test_an_exchange_above_the_counts_is_noticed(spark, tmp_dir):
    frame = spark.range(1000)
    measured = Measured(frame, {"rows": F.count(F.lit(1))})
    assert counted_once(measured.df.filter("id > 3"))
    assert counted_once(measured.df.join(F.broadcast(spark.range(5)), "id"))
    dealt = measured.df.repartition(3)
    assert not counted_once(dealt)
    assert measured.recount() == {"rows": 1000}


def test_funnel_with_an_exchange_above_is_counted_by_a_query(spark, trips_small, tmp_dir):
    funnel = MeasuredFunnel(trips_small)
    dealt = funnel.clean().repartition(3)
    write_parquet(dealt, f"{tmp_dir}/c")
    assert not counted_once(dealt)
    assert _rows(funnel.rows(dealt)) == _rows(cleaning_funnel(trips_small))


_ONE_SCAN = """
import sys
from yellowstar.session import build_session
from yellowstar.sinks import write_clean
spark = build_session("local[2]", extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + sys.argv[1],
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
trips = spark.read.parquet(sys.argv[2])
print(write_clean(trips, sys.argv[3]).count())
spark.stop()
"""


def test_one_scan_in_the_event_log(spark, trips_small, tmp_dir):
    import subprocess
    import sys

    trips_small.write.parquet(f"{tmp_dir}/trips")
    os.makedirs(f"{tmp_dir}/log")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    args = [sys.executable, "-c", _ONE_SCAN, f"{tmp_dir}/log", f"{tmp_dir}/trips", f"{tmp_dir}/clean"]
    subprocess.run(args, check=True, capture_output=True, timeout=300, cwd=root, env=os.environ | {"PYTHONPATH": root})
    read = 0
    for name in os.listdir(f"{tmp_dir}/log"):
        for line in open(f"{tmp_dir}/log/{name}"):
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                read += event["Task Metrics"]["Input Metrics"]["Records Read"]
    assert read == trips_small.count()
