"""Plan properties that matter at scale, checked on small data."""

from pyspark.sql import functions as F

from yellowstar.plans.inspect import plan_text
from yellowstar.sources.fixture import TRIPS_COLUMNS


def test_fixture_join_hot_order_key_is_split_by_aqe(spark):
    """One order key holding about a third of lineitem: adaptive execution
    splits that partition of the (two-table) shuffle-hash join."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        d = "/root/testdata/sf0.01"
        li = spark.read.parquet(f"{d}/lineitem.parquet").repartition(8)
        li = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 2, F.lit(1)).otherwise(F.col("l_orderkey")))
        orders = spark.read.parquet(f"{d}/orders.parquet")
        trips = li.join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey")).select(
            *[F.expr(e).alias(n) for n, e in TRIPS_COLUMNS]
        )
        df = trips.select("*")
        df.collect()
        assert "skew=true" in plan_text(df)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
