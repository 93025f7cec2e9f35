"""Sinks for findings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.operators.findings import finding_summary


def write_findings(findings: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write findings, one directory per severity."""
    findings.write.mode(mode).partitionBy("severity").format(fmt).save(path)


def write_summary(findings: DataFrame, records: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """Write the one-row summary of a run: records, errors, warnings, info and whether it failed."""
    counts = records.groupBy().count().withColumnRenamed("count", "records")
    # Both sides are global aggregates, one row each.
    finding_summary(findings).join(counts).write.mode(mode).format(fmt).save(path)
