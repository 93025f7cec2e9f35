"""Record files: one JSON object per file, found by a recursive scan."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.findings import as_findings

# The size limit of a record file and the directories a scan leaves out.
MAX_RECORD_BYTES = 1_048_576
EXCLUDED_DIRECTORIES = (".git", ".venv", "artifacts", "__pycache__", "node_modules", "tests")


def read_records(
    spark: SparkSession, root: str, schema: T.StructType | str | None = None, *, max_bytes: int = MAX_RECORD_BYTES,
    exclude_directories: Sequence[str] = EXCLUDED_DIRECTORIES,
) -> tuple[DataFrame, DataFrame]:
    """(records, findings) of every ``*.json`` file under ``root``.

    Records carry ``path`` (relative to the root) and ``raw`` (the JSON text), and ``record`` when a
    schema is given. A file that is too large, is not UTF-8, or does not parse (a repeated member
    name does not) is one ``json-parse`` finding; the scan goes on. Size is tested on file metadata,
    so an oversize file is skipped without being read.
    """
    files = (
        spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root)
    )
    listed = files.select(
        relative_path(F.col("_metadata.file_path"), root).alias("path"), F.col("_metadata.file_size").alias("size"), "value"
    )
    inside = listed.where(~_in_directory(F.col("path"), exclude_directories))
    small = inside.where(F.col("size") <= max_bytes)
    parsed = small.select("path", F.col("value").alias("raw"), json_problem(F.col("value")).alias("problem"))
    records = parsed.where(F.col("problem").isNull()).select("path", "raw")
    if schema is not None:
        records = records.withColumn("record", F.from_json("raw", schema))
    unparsable = parsed.where(F.col("problem").isNotNull()).select("path", "problem")
    oversize = inside.where(F.col("size") > max_bytes).select("path", F.lit("file exceeds the size limit").alias("problem"))
    broken = unparsable.unionByName(oversize)
    return records, as_findings(broken, "json-parse", F.col("path"), F.col("problem"), F.col("path"))


def relative_path(file_path: Column, root: str) -> Column:
    """Path below ``root`` of a file URI."""
    base = re.sub(r"^[a-z0-9]+:/*", "/", root).rstrip("/").lstrip("/")
    return F.regexp_replace(F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B"))), rf"^.*?{re.escape(base)}/", "")


def _in_directory(path: Column, names: Sequence[str]) -> Column:
    if not names:
        return F.lit(False)
    choice = "|".join(re.escape(n) for n in names)
    return path.rlike(rf"(?:^|/)(?:{choice})/")


def json_problem(raw: Column) -> Column:
    """Why a text is not one strict JSON value, else NULL."""
    return F.when(~F.is_valid_utf8(raw), "text is not valid UTF-8").when(
        F.try_parse_json(raw).isNull(), "text is not strict JSON"
    )


def parse_json_column(df: DataFrame, raw: str, schema: T.StructType | str, *, record: str = "record", ok: str = "parsed") -> DataFrame:
    """Adds a typed struct and whether the text parsed; a broken text gives a NULL struct."""
    good = json_problem(F.col(raw)).isNull() & F.col(raw).isNotNull()
    return df.withColumn(ok, good).withColumn(record, F.when(good, F.from_json(raw, schema)))
