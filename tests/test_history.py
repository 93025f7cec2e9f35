"""Histories: the chunked look-back equals a brute-force pass, with hot keys and nulls."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.ordered import default_chunk, prefix_chunk, sampled_chunk, with_history
from ledgerloom.operators import history as H

STATES = {"collected": ["validated", "withdrawn"], "validated": ["sanitized", "withdrawn"], "sanitized": ["published"], "published": []}


def make_log(seed: int = 7, n: int = 1200):
    """One key holds more than half of the rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "c", "d"])
        rows.append((key, i, rng.choice([None, rng.randint(0, 50)]), rng.choice(["x", "y", None]), rng.random() < 0.01))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [1, 50, 100000])
def test_with_history_equals_brute_force(spark, size):
    rows = make_log()
    df = spark.createDataFrame(rows, "k string, pos long, v int, s string, flag boolean")
    out = with_history(
        df, ["k"], ["pos"], lag={"before": F.col("s")}, last_valid={"valid": F.col("v")}, seen={"seen": F.col("flag")}, position="n",
        chunk=F.floor(F.col("pos") / size),
    )
    expected = set()
    state: dict = {}
    for key, pos, v, s, flag in sorted(rows, key=lambda r: r[1]):
        before, valid, seen, n = state.get(key, (None, None, False, 0))
        expected.add((key, pos, before, valid, seen, n + 1))
        state[key] = (s, v if v is not None else valid, seen or flag, n + 1)
    got = {(r.k, r.pos, r.before, r.valid, r.seen, r.n) for r in out.collect()}
    assert got == expected and out.count() == len(rows)


def test_a_hot_key_is_spread_over_tasks(spark):
    df = spark.createDataFrame(make_log(), "k string, pos long, v int, s string, flag boolean")
    out = with_history(df, ["k"], ["pos"], lag={"before": F.col("s")}, chunk=F.floor(F.col("pos") / 20))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = out.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 4


def test_a_hot_key_whose_first_order_column_is_constant_is_spread(spark):
    rows = [("hot", 1, i << 14, "x" if i % 3 else "y") for i in range(400)]
    df = spark.createDataFrame(rows, "k string, first int, pos long, s string")
    out = with_history(df, ["k"], ["first", "pos"], lag={"before": F.col("s")}, position="n", chunk=prefix_chunk(df, ["first", "pos"]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(r.pos, r.before, r.n) for r in out.collect()} == {(p, rows[i - 1][3] if i else None, i + 1) for i, (_, _, p, _) in enumerate(rows)}


def test_default_chunk_needs_a_number_or_a_time(spark):
    df = spark.createDataFrame([("a", "x")], "k string, o string")
    with pytest.raises(ValueError):
        default_chunk(df, "o")
    assert with_history(df, ["k"], ["o"], position="n", chunk=None).collect()[0].n == 1
    assert with_history(df, ["k"], ["o"], position="n").collect()[0].n == 1


@pytest.mark.parametrize("first", [None, "same"])
def test_a_sampled_chunk_cuts_hot_keys_along_any_order(spark, first):
    """Of a constant or null first order column and a text; small keys stay whole; results equal a plain pass."""
    rng = random.Random(11)
    rows = [(rng.choice(["hot"] * 6 + [f"k{i}" for i in range(40)]), first, f"{i:05d}", rng.choice([None, "x", "y"]), rng.random() < 0.005) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, first string, pos string, s string, flag boolean")
    chunk = sampled_chunk(df, ["k"], ["first", "pos"], sample_rows=1000, pieces=20, least=1)
    chunks = {r.k: r.n for r in df.groupBy("k").agg(F.count_distinct(chunk).alias("n")).collect()}
    assert chunks["hot"] > 2 and all(n == 1 for k, n in chunks.items() if k != "hot")
    assert sampled_chunk(df.where("k <> 'hot'"), ["k"], ["first", "pos"], least=500) is None
    out = with_history(df, ["k"], ["first", "pos"], lag={"before": F.col("s")}, last_valid={"valid": F.col("s")}, seen={"seen": F.col("flag")}, position="n", chunk=chunk)
    expected, state = set(), {}
    for k, _, pos, s, flag in sorted(rows, key=lambda r: r[2]):
        before, valid, seen, n = state.get(k, (None, None, False, 0))
        expected.add((k, pos, before, valid, seen, n + 1))
        state[k] = (s, s if s is not None else valid, seen or flag, n + 1)
    assert {(r.k, r.pos, r.before, r.valid, r.seen, r.n) for r in out.collect()} == expected


def test_a_cut_history_is_read_and_exchanged_once(spark, tmp_path):
    spark.createDataFrame(make_log(), "k string, pos long, v int, s string, flag boolean").write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log")).select("k", "pos", "s")
    out = with_history(log, ["k"], ["pos"], lag={"before": F.col("s")}, chunk=F.floor(F.col("pos") / 50))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = out.groupBy().count()._jdf.queryExecution().executedPlan().toString()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1, plan


def test_transitions_boundaries_and_times(spark):
    log = spark.createDataFrame(
        [("e1", 1, "collected", 5), ("e1", 2, "validated", 5), ("e1", 3, "published", None), ("e1", 4, "lost", 6), ("e1", 5, "collected", 6),
         ("e2", 1, "validated", 1), ("e2", 2, "sanitized", 2)],
        "k string, pos int, state string, at int",
    )
    steps = H.invalid_transitions(log, ["k"], ["pos"], "state", STATES).collect()
    assert {(r.k, r.step, r.from_state, r.state) for r in steps} == {
        ("e1", 2, "validated", "published"), ("e1", 3, "published", "lost"), ("e1", 4, "lost", "collected"),
    }
    current = spark.createDataFrame([("e1", "lost"), ("e2", "sanitized")], "k string, state string")
    ends = H.history_boundaries(log, ["k"], ["pos"], "state", start="collected", current=current, current_state="state").collect()
    assert {(r.k, r.reason) for r in ends} == {("e1", "lifecycle-current"), ("e2", "lifecycle-start")}
    times = H.strictly_increasing(log, ["k"], ["pos"], "at").collect()
    assert {(r.k, r.pos, r.previous_ts) for r in times} == {("e1", 2, 5), ("e1", 5, 6)}


def test_chain_rules(spark):
    chain = spark.createDataFrame(
        [("c", 1, "d1", None, "active"), ("c", 2, "d2", "d1", "revoked"), ("c", 4, "d3", "d1", "active"), ("ok", 1, "o1", None, "active"), ("ok", 2, "o2", "o1", "expired")],
        "k string, rev long, digest string, previous string, state string",
    )
    assert [(r.k, r.rev, r.expected) for r in H.revision_gaps(chain, ["k"], ["rev"], "rev").collect()] == [("c", 4, 3)]
    links = H.broken_links(chain, ["k"], ["rev"], "digest", "previous")
    assert [(r.k, r.rev, r.expected) for r in links.collect()] == [("c", 4, "d2")]
    assert [(r.k, r.previous, r.successors) for r in H.forks(chain, ["k"], "previous").collect()] == [("c", "d1", 2)]
    back = H.state_rollback(chain, ["k"], ["rev"], F.col("state") == "revoked").collect()
    assert [(r.k, r.rev) for r in back] == [("c", 4)]
    latest = {r.k: r for r in H.latest_state(chain, ["k"], "rev", ["state"], links.select("k")).collect()}
    assert (latest["c"].valid, latest["c"].state, latest["ok"].state, latest["ok"].latest_revision) == (False, None, "expired", 2)


def test_input_order_does_not_matter(spark):
    rows = make_log(seed=3, n=200)
    schema = "k string, pos long, v int, s string, flag boolean"
    results = []
    for order in (rows, rows[::-1]):
        found = H.strictly_increasing(spark.createDataFrame(order, schema), ["k"], ["pos"], "v")
        results.append(sorted((r.k, r.pos, r.previous_ts) for r in found.collect()))
    assert results[0] == results[1] and results[0]
