"""Registry of the driver queries: one Spark callable and one SQL text per name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the decorated function under its name, with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scan_partitions(spark: SparkSession) -> int:
    """The driver's tables are single files, so a scan of their texts deals them out into so many partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
