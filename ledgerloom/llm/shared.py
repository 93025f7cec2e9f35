"""Where jobs keep what must outlive a stage: the shared checkpoint folder, and how rows pass through Python."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.stages import cut, shared_dir, shuffles_removed

__all__ = ["cut", "partitions", "shared_dir", "whole_row", "written"]


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder: lineage ends here, once, for all later readers."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the caller's statement of how much data there is."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def whole_row(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` in one struct, so that no added column can clash with one of them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
