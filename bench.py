"""Benchmark of the headline queries.

Runs each headline query of the catalogue on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` (default 8), forcing full
evaluation with the no-op sink, and prints one JSON line.

Each query runs ``$BENCH_REPEAT`` times (default 3) after one cold pass over
the whole set; the reported time per query is the median of the warm runs
(the cold pass, which includes JIT and code-generation warm-up, is reported
separately under ``cold``).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from yellowstar.plans.catalog import QUERIES  # noqa: E402
from yellowstar.session import build_session  # noqa: E402

HEADLINE = ["clean_trips", "dim_datetime", "fact_table", "cleaning_funnel", "cardinality_profile"]
# The fact plans used when dimensions outgrow a broadcast (timed, not in the headline).
AT_SCALE = ["fact_table_block_lookup", "fact_table_shuffle_join", "fact_table_hot_split"]


ERRORS: dict[str, str] = {}


def _run(spark, name: str, sf_dir: str) -> float:
    """Seconds to run one query to completion; NaN (and a recorded error) on failure."""
    start = time.perf_counter()
    try:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    except Exception as exc:  # keep benchmarking the others; report the failure
        ERRORS[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
        return float("nan")
    return time.perf_counter() - start


def _median(values) -> float | None:
    values = [v for v in values if v == v]
    return round(statistics.median(values), 3) if values else None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", app_name="yellowstar-bench", shuffle_partitions=2 * cpus)
    spark.sparkContext.setLogLevel("ERROR")
    cold = {name: _median([_run(spark, name, sf_dir)]) for name in HEADLINE}
    warm = {name: _median([_run(spark, name, sf_dir) for _ in range(repeat)]) for name in HEADLINE}
    _run(spark, AT_SCALE[0], sf_dir)
    at_scale = {name: _median([_run(spark, name, sf_dir) for _ in range(repeat)]) for name in AT_SCALE}
    input_rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    total = round(sum(v for v in warm.values() if v is not None), 3)
    sf_name = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        sf: float | str = float(sf_name)
    except ValueError:
        sf = sf_name
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": warm,
                "sf": sf,
                "cpus": cpus,
                "repeat": repeat,
                "cold": cold,
                "cold_total": round(sum(v for v in cold.values() if v is not None), 3),
                "at_scale_plans": at_scale,
                "input_rows": input_rows,
                "rows_per_sec": {k: round(input_rows / v) for k, v in warm.items() if v},
                "errors": ERRORS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
