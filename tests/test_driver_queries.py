"""Every registered query gives its oracle's rows, and its plan has no unbounded join."""

from __future__ import annotations

import math
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as driver  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(round(value, 6)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    frame = driver.queries()[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    result = con.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    order = sorted(columns)
    expected = sorted(tuple(cell(row[columns.index(c)]) for c in order) for row in result.fetchall())
    actual = sorted(tuple(cell(row[c]) for c in order) for row in frame.collect())
    assert actual == expected


def test_every_query_has_an_oracle_but_the_file_listing():
    assert set(driver.QUERIES) - set(driver.ORACLES) == {"q_file_inventory"}


def test_entry_and_file_inventory(spark):
    assert driver.entry(spark).count() > 0
    rows = driver.queries()["q_file_inventory"](spark, SF).collect()
    assert {r.path for r in rows} == {f"{t}.parquet" for t in TABLES}
    import hashlib

    one = next(r for r in rows if r.path == "orders.parquet")
    data = Path(SF, "orders.parquet").read_bytes()
    assert (one.size, one.digest, one.role) == (len(data), "sha256:" + hashlib.sha256(data).hexdigest(), "fact")


def test_file_inventory_reads_large_files_in_pieces(spark, tmp_path):
    """A file of over WHOLE bytes with an extension is never one value; its digest is that of its very bytes, whatever it ends with and is named."""
    import gzip
    import hashlib
    import random

    from ledgerloom.sources import inventory

    big, rng = inventory.WHOLE + 7, random.Random(3)
    noise = rng.randbytes(3 * big)
    contents = {
        "a.bin": noise, "b.bin": noise[:big] + b"\n", "c.bin": noise[:big].replace(b"\n", b"x") + b"\r\n\n", "mark.csv": b"\xef\xbb\xbf" + noise[:big].rstrip(b"\n"),
        "mark2.csv": b"\xef\xbb\xbf" + noise[:big] + b"\n", "real.gz": gzip.compress(noise), "false.gz": noise[:big], "x.tgz": noise[1:big], "nested/p.zst": noise[2 : 2 * big], "x.0": noise[5:], "part-00000": noise[5:9999],
        "lines.txt": b"\n" * big, "small.txt": b"a\nb\n", "mark.txt": b"\xef\xbb\xbf", "at.bin": noise[: inventory.WHOLE], "sp ace+.bin": noise[7:], "v.parquet": b"\n" + noise,
    }
    for name, data in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    limits = {"spark.sql.sources.binaryFile.maxLength": str(inventory.WHOLE), "spark.sql.files.maxPartitionBytes": "300000"}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        rows = inventory.file_inventory(spark, str(tmp_path)).collect()
        some = inventory.file_inventory(spark, str(tmp_path), glob="*.gz").collect()
    finally:
        for key in limits:
            spark.conf.unset(key)
    assert {r.path: (r.size, r.digest) for r in rows} == {n: (len(d), f"sha256:{hashlib.sha256(d).hexdigest()}") for n, d in contents.items()}
    assert len(rows) == len(contents) and {r.path for r in some} == {"real.gz", "false.gz"}
