"""Sinks: parquet and JDBC writers for the star schema.

Tables are written one after another, dimensions first and the fact table
last, each as an independent overwrite (there is no cross-table
transaction, as in the reference). Because the dimensions are
materialised once and the fact table joins those same frames, the keys
loaded in every table agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None
) -> None:
    """Overwrite a parquet table (B3); optional partition columns."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    batchsize: int = 10_000,
    num_partitions: int | None = 32,
    truncate: bool = True,
) -> dict[str, str]:
    """Writer options for one JDBC table.

    ``truncate`` keeps the table definition on overwrite instead of
    dropping it; ``num_partitions`` caps concurrent connections (Spark
    coalesces down to it before writing; without it a large frame would open
    one connection per partition); ``batchsize`` sets rows per insert batch.
    A database is a narrow sink: at full scale write parquet and load from it.
    """
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize), "truncate": str(truncate).lower()}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if num_partitions is not None:
        opts["numPartitions"] = str(num_partitions)
    return opts


def write_jdbc(df: DataFrame, mode: str = "overwrite", **options) -> None:
    """Overwrite one table over JDBC (B1, B2); options as in ``jdbc_options``."""
    df.write.format("jdbc").options(**jdbc_options(**options)).mode(mode).save()


def write_star(tables: dict[str, DataFrame], write_one) -> list[str]:
    """Write tables in the given order with ``write_one(name, df)``; returns the order."""
    done = []
    for name, df in tables.items():
        write_one(name, df)
        done.append(name)
    return done
