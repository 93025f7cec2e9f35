"""Join helper for a row side that may hold hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = "__spread"


def lookup_join(rows: DataFrame, per_key: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows to an aggregated table that holds at most one row per key.

    A grouped table is already partitioned by its key, and Spark then joins it without a shuffle of
    its own; adaptive execution splits a hot key only between two plain shuffles. The extra join
    column, a function of the key, makes Spark shuffle both sides for the join. The grouped side is
    one row per key, so that shuffle is small, and a hot key on the row side is split over tasks.
    No broadcast is forced: adaptive execution broadcasts the grouped side only when its measured
    size is under the session's threshold.
    """
    on = list(on)
    spread = F.pmod(F.xxhash64(*[F.col(name) for name in on]), F.lit(1 << 20))
    joined = rows.withColumn(_SPREAD, spread).join(
        per_key.withColumn(_SPREAD, spread), [*on, _SPREAD], how
    )
    return joined.drop(_SPREAD)
