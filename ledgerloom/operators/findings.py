"""The one result table of every check, and what is done with it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.functions.ordered import positioned
from pyspark.sql import types as T

# Finding severities in report order.
SEVERITIES = ("error", "warning", "info")

FINDING_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("severity", "code", "path", "message", "key")]
)
FINDING_COLUMNS = tuple(FINDING_SCHEMA.names)


def _text(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value.cast("string")


def as_findings(
    df: DataFrame, code: Column | str, path: Column | str, message: Column | str, key: Column | str,
    severity: Column | str = "error",
) -> DataFrame:
    """Turn every row of ``df`` into one finding. Plain strings are literals."""
    values = zip(FINDING_COLUMNS, (severity, code, path, message, key), strict=True)
    return df.select(*[_text(value).alias(name) for name, value in values])


def union_findings(*findings: DataFrame) -> DataFrame:
    """All findings of several checks."""
    return reduce(DataFrame.unionByName, [f.select(*FINDING_COLUMNS) for f in findings])


def order_findings(findings: DataFrame) -> DataFrame:
    """Errors first, then path, code and message; a range-partitioned global sort."""
    return findings.orderBy(F.col("severity") != "error", "path", "code", "message")


def finding_positions(findings: DataFrame) -> DataFrame:
    """Findings with their 1-based ``position`` in report order (errors first, then path, code, message and key), without a single-task window."""
    return positioned(findings, [F.col("severity") != "error", *[F.col(c) for c in ("path", "code", "message", "key")]])


def observed_summary(findings: DataFrame) -> tuple[DataFrame, Observation]:
    """The findings, and an observation that holds the columns of :func:`finding_summary` once they have been written: no second job, no second scan."""
    seen = Observation()
    return findings.observe(seen, *_summary(), (F.count_if(F.col("severity") == SEVERITIES[0]) > 0).alias("failed")), seen


def _summary() -> list[Column]:
    counts = [F.count_if(F.col("severity") == s).alias(f"{s}s" if s != "info" else s) for s in SEVERITIES]
    return [*counts, F.count(F.lit(1)).alias("findings")]


def finding_summary(findings: DataFrame) -> DataFrame:
    """One row: findings per severity (zero-filled), their total, and whether the run fails."""
    return findings.agg(*_summary()).withColumn("failed", F.col("errors") > 0)


def finding_counts(findings: DataFrame) -> DataFrame:
    """Findings per severity and code."""
    return findings.groupBy("severity", "code").agg(F.count(F.lit(1)).alias("findings"))


def first_failure(failures: DataFrame, entity: Sequence[str], stage: str, outcome: Sequence[str]) -> DataFrame:
    """The earliest failing stage of each entity decides its outcome.

    Ties inside a stage go to the smallest outcome, so the choice does not depend on row order.
    """
    first = F.min(F.struct(F.col(stage), *[F.col(name) for name in outcome])).alias("__first")
    picked = failures.groupBy(*entity).agg(first)
    return picked.select(*entity, *[F.col("__first")[name].alias(name) for name in [stage, *outcome]])
