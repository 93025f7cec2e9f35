"""Reading a table whose rows are expensive to scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_for_scan(spark: SparkSession, path: str, columns: Sequence[str], key: str, partitions: int | None = None) -> DataFrame:
    """Columns of a Parquet table; with ``partitions``, dealt into so many by its key.

    A text scan costs far more than moving the text once, so a table of few, large splits is worth dealing out; whether it is
    that, the caller says. Without a number the table is read as it is.
    """
    df = spark.read.parquet(path).select(*columns)
    return df if partitions is None else df.repartition(partitions, key)
