"""Digests against hashlib, export steps, table comparison, and behaviour under one hot key."""

from __future__ import annotations

import base64
import hashlib
import json

from pyspark.sql import functions as F

from ledgerloom.functions.digest import normalize_mixed, normalize_set, row_digest
from ledgerloom.functions.joins import lookup_join
from ledgerloom.operators import contracts as C
from ledgerloom.operators import digests as D
from ledgerloom.operators import reconcile as K
from ledgerloom.operators import references as R
from ledgerloom.plans import export as E


def sha(domain: str, payload: str) -> str:
    return "sha256:" + hashlib.sha256(domain.encode() + b"\x00" + payload.encode()).hexdigest()


def test_row_digest_equals_hashlib(spark):
    df = spark.createDataFrame([("xé\"", 5, None, True)], "b string, a long, d string, c boolean")
    text = json.dumps({"a": 5, "b": "xé\"", "c": True, "d": None}, separators=(",", ":"), ensure_ascii=False)
    assert df.select(row_digest(["b", "a", "d", "c"], "dom/v1").alias("x")).collect()[0].x == sha("dom/v1", text)
    stored = df.withColumn("stored", F.lit(sha("dom/v1", text)))
    assert D.verify_digest(stored, "stored", "dom/v1").count() == 0
    assert D.verify_digest(stored.withColumn("a", F.lit(6)), "stored", "dom/v1").count() == 1


def test_key_ids_and_normal_forms(spark):
    raw = b"key bytes"
    good = ("sha256:" + hashlib.sha256(raw).hexdigest(), base64.b64encode(raw).decode())
    keys = spark.createDataFrame([good, ("sha256:00", good[1]), (good[0], "not base64!")], "id string, k string")
    assert D.verify_key_ids(keys, "id", "k").count() == 2
    sets = spark.createDataFrame([(["b", "a"],), (["a", "b"],)], "s array<string>")
    assert sets.select(row_digest({"s": normalize_set(F.col("s"))}, "d")).distinct().count() == 1
    mixed = spark.sql("SELECT transform(array('\"b\"', '10', 'true', '\"a\"', '9', 'false'), x -> parse_json(x)) AS v")
    assert mixed.select(F.transform(normalize_mixed(F.col("v")), lambda x: x.cast("string")).alias("v")).collect()[0].v == ["false", "true", "10", "9", "a", "b"]


def test_group_digests_ignore_row_order(spark):
    rows = [("g", i % 7, f"m{i % 5}") for i in range(40)] + [("h", 1, "m1")]
    schema = "g string, o int, m string"
    digests = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, schema).repartition(5)
        sets = {r.g: (r.members, r.digest) for r in D.set_digest(df, ["g"], F.col("m"), "set/v1").collect()}
        lists = {r.g: (r.members, r.digest) for r in D.list_digest(df, ["g"], ["o"], F.to_json(F.struct("m")), "list/v1", F.expr("o div 3")).collect()}
        digests.append((sets, lists))
    assert digests[0] == digests[1]
    sets, lists = digests[0]
    assert sets["g"][0] == 40 and lists["g"][0] == 40
    one = hashlib.sha256(b'[{"m":"m1"}]').hexdigest()
    assert lists["h"] == (1, sha("list/v1", f"[{one}]"))
    fewer = spark.createDataFrame(rows[1:], schema)
    assert {r.g: r.digest for r in D.set_digest(fewer, ["g"], F.col("m"), "set/v1").collect()}["g"] != sets["g"][1]


EVENT = ("2026-01-03T00:00:00Z", "sha-event")
HISTORY = "array<struct<state:string,recorded_at:string,review_digest:string>>"


def test_promotion_and_omissions(spark):
    base = [("collected", "2026-01-01T00:00:00Z", None), ("validated", "2026-01-02T00:00:00Z", "r")]
    ask = lambda rule: [("$.evidence_record.public_artifacts", rule, "h")]
    rows = [
        ("v", "validated", base, EVENT, ask("OMIT-PUBLIC-ARTIFACTS"), ["b", "a"]), ("s", "sanitized", [*base, ("sanitized", *EVENT)], EVENT, [], ["a"]),
        ("d", "sanitized", [*base, ("sanitized", EVENT[0], "other")], EVENT, ask("OTHER"), ["a"]), ("c", "collected", base[:1], EVENT, [], ["a"]),
        ("p", "published", base, EVENT, [], ["a"]),
    ]
    df = spark.createDataFrame(
        rows, f"id string, lifecycle string, history {HISTORY}, event struct<recorded_at:string,review_digest:string>,"
        "asked array<struct<path:string,rule_id:string,human_review_digest:string>>, public_artifacts array<string>",
    )
    done = {r.id: r for r in E.promote(df, lifecycle="lifecycle", history="history", event="event").collect()}
    assert {k: r.promotion_error for k, r in done.items()} == {
        "v": None, "s": None, "d": "lifecycle-preservation", "c": "lifecycle-not-validated", "p": "lifecycle-limit",
    }
    assert [h.state for h in done["v"].history] == ["collected", "validated", "sanitized"] and done["v"].lifecycle == "sanitized"
    assert len(done["s"].history) == 3 and done["d"].lifecycle == "sanitized" and done["p"].lifecycle == "published"
    left = {r.id: r for r in E.apply_omissions(df, requested="asked", fields={E.OMISSION_RULES[0]["path"]: "public_artifacts"}).collect()}
    assert (left["v"].public_artifacts, left["v"].omission_error, left["v"].omission_log[0].action) == ([], None, "omitted-by-profile")
    assert (left["d"].public_artifacts, left["d"].omission_error, left["d"].omission_log) == (["a"], "omission-rule", [])
    assert not hasattr(left["v"].omission_log[0], "value")


def test_expected_checks(spark):
    rows = [("export-candidate", "programmatic"), ("test-fixture", "staged-file"), ("other", "programmatic"), ("test-fixture", "other")]
    df = spark.createDataFrame(rows, "m string, i string").select(E.required_checks(F.col("m"), F.col("i")).alias("c"))
    sizes = [len(r.c) for r in df.collect()]
    assert sizes == [len(E.COMMON_CHECKS), len(E.COMMON_CHECKS) + 4, 0, 0]
    empty = spark.createDataFrame([([],)], "actual array<string>")
    assert C.check(empty, [C.reported_checks("actual", F.array().cast("array<string>"))], path=F.lit("p"), key=F.lit("k")).count() == 1


def test_comparison_reduces_copies_instead_of_pairing_them(spark):
    left = spark.createDataFrame([("hot", 1)] * 500 + [("a", 1), ("b", None)], "k string, v int")
    right = spark.createDataFrame([("hot", 1)] * 500 + [("a", 2), ("b", None), ("c", 1)], "k string, v int")
    got = {(r.k, r.reason, r.column, r.left_value, r.right_value) for r in K.reconcile(left, right, ["k"], ["v"]).collect()}
    assert got == {("hot", "duplicate-key", None, None, None), ("a", "mismatch", "v", "1", "2"), ("c", "missing-left", None, None, None)}
    surplus = {(r.k, r.v, r.side, r.surplus) for r in K.rederive_and_compare(left, right.where("k <> 'b'")).collect()}
    assert surplus == {("a", 1, "only-stored", 1), ("a", 2, "only-derived", 1), ("b", None, "only-stored", 1), ("c", 1, "only-derived", 1)}
    for frame in (K.reconcile(left, right, ["k"], ["v"]), K.rederive_and_compare(left, right)):
        assert "Join" not in frame._jdf.queryExecution().executedPlan().toString()


def test_references_skip_nulls_and_copies_of_targets(spark):
    records = spark.createDataFrame([("r", ["a", None, "x"], None), ("q", [], ["z"])], "id string, e array<string>, l array<string>")
    edges = R.explode_references(records, ["id"], {"e": "evidence", "l": "limit"})
    keys = spark.createDataFrame([("evidence", "a")] * 3 + [("limit", "x")], "dst_type string, dst_id string")
    assert {(r.id, r.field, r.dst_id) for r in R.missing_references(edges, keys).collect()} == {("r", "e", "x"), ("q", "l", "z")}


def test_a_hot_key_is_split_by_adaptive_execution(spark):
    """Two thirds of the rows share one id; the grouped side has its own shuffle, so the join can split it."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        key = F.when(F.col("id") % 3 < 2, F.lit(-1)).otherwise(F.col("id"))
        rows = spark.range(0, 60000, 1, 8).select(key.alias("k"), F.col("id").alias("pos"), F.sha2(F.col("id").cast("string"), 256).alias("path"))
        found = R.duplicate_ids(rows, ["k"], ["pos"], "path")
        assert found.count() == 39999
        result = found.groupBy(F.lit(1)).agg(F.count(F.lit(1)))
        result.collect()
        grouped = rows.groupBy("k").agg(F.max("pos").alias("top"))
        joined = lookup_join(rows, grouped, ["k"])
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_every_leaf_of_a_candidate_is_scanned_in_every_form(spark):
    path = "see /home/ops/run.log"
    rows = [
        (1, "plain", ["a"], '{"owner": 1}'), (2, path, ["a"], "{}"), (3, "plain", ["a", base64.b64encode(path.encode() * 3).decode()], "{}"),
        (4, "see%20%2Fhome%2Fops%2Frun.log", [], "{}"), (5, "plain", [], r'{"owner": [{"x": "see /home/ops/run.log"}]}'), (None, path, [], "{}"),
    ]
    frame = spark.createDataFrame(rows, "k long, note string, artifacts array<string>, raw string")
    scanned = E.scan_candidates(frame, "k", json=["raw"])
    assert scanned.columns == [*frame.columns, "sensitive_columns"]
    assert {r["k"]: r["sensitive_columns"] for r in scanned.collect()} == {1: [], 2: ["note"], 3: ["artifacts"], 4: ["note"], 5: ["raw"], None: ["note"]}


def test_each_named_check_of_an_export_fails_on_what_it_names(spark):
    from driver_queries import export_queries as Q

    candidates = Q._candidates(spark, "/root/testdata/sf0.001")
    rules = Q._staged_rules(E.text_columns(candidates, "o_orderkey"))
    good = Q._scanned(candidates).where(E.earliest_failure(rules).isNull()).limit(1).cache()
    faults = {
        "strict-input-parse": {"raw": F.lit('{"owner": 1')}, "closed-configuration": {"configuration": F.lit('{"priority": "x", "other": 1}')},
        "prohibited-field-scan": {"raw": F.lit('{"owner": {"a": [{"Pass\\u0077ord": 1}]}}')}, "path-boundary": {"public_artifacts": F.array(F.lit("a/../../b"))},
        "digest-bindings": {"bound_record": F.lit("sha256:" + "0" * 64)}, "export-profile-binding": {"profile_digest": F.lit("sha256:" + "0" * 64)},
        "exporter-implementation-manifest": {"manifest_digest": F.lit(None).cast("string")}, "review-status-parity": {"reviewed_status": F.lit("other")},
    }
    for check, changed in {"none": {}, **faults}.items():
        frame = good.withColumns(changed) if changed else good
        failed = frame.select(F.array(*[F.coalesce(F.size(r.messages) > 0 if r.messages is not None else r.bad, F.lit(False)) for r in rules])).first()[0]
        names = {c for r, bad in zip(rules, failed, strict=True) if bad for c in r.checks}
        assert (check in names) if changed else not names, (check, names)
