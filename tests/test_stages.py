from __future__ import annotations

import os
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import stages
from ledgerloom.llm import shared


def _shuffles(spark) -> set[Path]:
    root = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir())
    return {p for top in root.split(",") for p in Path(top).glob("**/blockmgr-*/*/shuffle_*.data")}


@pytest.mark.parametrize("kept", [stages.cut, lambda df: shared.written(df, "rows")])
def test_kept_rows_leave_no_shuffle_files(spark, kept):
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    setting = spark.conf.get(stages._CLEANUP, None)
    before = _shuffles(spark)
    rows.select("k", "n").collect()
    assert _shuffles(spark) - before, "a plain run leaves its files, so that the next line can fail"
    before = _shuffles(spark)
    out = kept(rows)
    assert not _shuffles(spark) - before
    for _ in range(2):
        assert sorted(map(tuple, out.collect())) == [(k, 143 if k < 6 else 142) for k in range(7)]
    assert spark.conf.get(stages._CLEANUP, None) == setting


def test_the_callers_setting_holds_again_after_an_error(spark):
    setting = spark.conf.get(stages._CLEANUP, None)
    with pytest.raises(ValueError), stages.shuffles_removed(spark):
        raise ValueError
    assert spark.conf.get(stages._CLEANUP, None) == setting
