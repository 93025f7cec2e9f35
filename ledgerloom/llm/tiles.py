"""Families of rows dealt into tiles of bounded size, so that every two rows of a family meet in one tile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.joins import lookup_join
from ledgerloom.llm.shared import partitions

#: Rows of a family that a tile takes from each side, on average.
TILE = 256


def deal(members: DataFrame, family: str, key: str, size: int = TILE) -> DataFrame:
    """``members`` with ``tile`` (what to group by), ``low``, ``high`` and ``part``: a row is of side ``low`` or ``high`` by its ``part``.

    A family of m rows has m / ``size`` parts, dealt by a hash of ``key``, and a tile for every two of them; small families share a
    tile, apart by ``family``. Memory follows ``size``, not the family.
    """
    sizes = members.groupBy(family).agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    placed = lookup_join(members, sizes, [family]).withColumn("part", F.pmod(F.xxhash64(key), F.col("parts")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
    shared = F.pmod(F.xxhash64(family), F.lit(16 * partitions(members.sparkSession)))
    return dealt.withColumn("tile", F.when(F.col("parts") == 1, shared).otherwise(F.xxhash64(family, "low", "high"))).drop("parts", "other")
