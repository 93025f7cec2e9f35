"""Row contracts, and whole corpora: a valid corpus has no finding, a changed one exactly its code."""

from __future__ import annotations

import copy
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import contracts as C
from ledgerloom.operators.findings import finding_positions, finding_summary, observed_summary, order_findings, union_findings
from ledgerloom.plans.corpus import RECORD_SCHEMA, contract_findings, reference_findings, validate_corpus
from ledgerloom.sources.sinks import write_findings, write_summary

DIGEST = "sha256:" + "a" * 64
SUBJECT = {"type": "process", "identifier": "thing", "version": "1", "digest": DIGEST}


def evidence(number: int, **changes) -> dict:
    record = {
        "schema_version": "0.1", "record_type": "evidence", "id": f"PM-EVIDENCE-{number:04d}", "type": "test", "status": "pass",
        "lifecycle": "validated",
        "lifecycle_history": [
            {"state": "collected", "recorded_at": "2026-01-01T00:00:01Z", "review_digest": None},
            {"state": "validated", "recorded_at": "2026-01-02T00:00:01Z", "review_digest": DIGEST},
        ],
        "subject": SUBJECT, "input_digests": [DIGEST], "output_digest": DIGEST, "producer": {"type": "local-runner", "identity": "me"},
        "tool": {"name": "t", "version": "1", "source": "s"}, "started_at": "2026-01-01T00:00:00Z", "completed_at": "2026-01-01T00:00:01Z",
        "execution": {"ran": True, "required": True, "reason": None}, "configuration": {}, "model_check": None, "summary": "done",
        "private_source_metadata": None, "public_artifacts": [], "limitations": [],
    }
    return {**record, **changes}


def claim(number: int, **changes) -> dict:
    record = {
        "schema_version": "0.1", "record_type": "claim", "id": f"PM-CLAIM-{number:04d}", "statement": "s", "subject": SUBJECT, "scope": "x",
        "status": "supported", "assumptions": ["PM-ASSUMPTION-0001"], "evidence": ["PM-EVIDENCE-0001"], "limitations": ["PM-LIMITATION-0001"],
        "valid_from": "2026-01-01T00:00:00Z", "valid_until": None, "status_reason": None, "supersedes": None, "owner": "o", "reviewers": [],
    }
    return {**record, **changes}


ASSUMPTION = {
    "schema_version": "0.1", "record_type": "assumption", "id": "PM-ASSUMPTION-0001", "statement": "s", "scope": "x", "status": "active",
    "rationale": "r", "owner": "o", "reviewed_at": "2026-01-01T00:00:00Z", "next_review_at": "2026-02-01T00:00:00Z", "sources": [],
}
LIMITATION = {
    "schema_version": "0.1", "record_type": "known-limitation", "id": "PM-LIMITATION-0001", "statement": "s", "affected_claims": ["PM-CLAIM-0001"],
    "severity": "low", "status": "open", "owner": "o", "identified_at": "2026-01-01T00:00:00Z", "reviewed_at": "2026-01-02T00:00:00Z",
    "next_review_at": None, "mitigation": None, "references": [],
}
NOTICE = {
    "schema_version": "0.1", "record_type": "assurance-notice", "id": "PM-NOTICE-0001", "notice_type": "correction", "affected_report": "r",
    "affected_claims": ["PM-CLAIM-0001"], "reason": "r", "impact": "i", "replacement": None, "issued_at": "2026-01-01T00:00:00Z", "approver": "a",
    "public_notice": "p",
}
NAMED = {"identifier": "i", "version": "1", "digest": DIGEST}
MANIFEST = {
    "schema_version": "0.1", "record_type": "evidence-manifest", "id": "PM-MANIFEST-0001", "release": {"identifier": "r", "version": "1", "channel": "fixture"},
    "subject": SUBJECT,
    "digests": {
        "source_revision": DIGEST, "build_artifact": None, "claim_set": DIGEST, "assumption_set": DIGEST, "evidence_set": DIGEST,
        "evidence_record_digests": [DIGEST], "evidence_output_digests": [DIGEST], "limitation_set": DIGEST,
    },
    "protocol": NAMED, "conformance": NAMED, "toolchain": [], "claims": ["PM-CLAIM-0001"], "assumptions": [], "evidence": ["PM-EVIDENCE-0001"],
    "limitations": [], "approvals": [], "publication": {"status": "candidate", "publicly_reproducible": False, "reason": "r", "signature": None},
    "generated_at": "2026-01-01T00:00:00Z", "supersedes": None,
}
MODEL = {
    "properties": ["p"],
    "state_space_bounds": {
        "parameters": [
            {"name": "n", "kind": "integer-range", "minimum": 0, "maximum": 3, "values": []},
            {"name": "m", "kind": "finite-set", "minimum": None, "maximum": None, "values": ["a", 1, True]},
        ],
        "constraints": [], "max_depth": 5, "max_states": 100,
    },
    "explored_state_space": {"generated_states": 50, "distinct_states": 20, "maximum_depth": 5, "complete_within_bounds": True},
}


def model(**paths) -> dict:
    value = copy.deepcopy(MODEL)
    for path, new in paths.items():
        node, *rest = path.split("__")
        target = value[node]
        for name in rest[:-1]:
            target = target[int(name) if name.isdigit() else name]
        target[rest[-1]] = new
    return evidence(2, type="model-check", model_check=value)


VALID = [evidence(1), evidence(2, type="model-check", model_check=MODEL), claim(1), ASSUMPTION, LIMITATION, NOTICE, MANIFEST]
LATE = "2026-03-01T00:00:00Z"
# name -> (records that replace the valid one of the same id, or are added; expected codes)
CHANGES = {
    "missing-member": ([{k: v for k, v in evidence(1).items() if k != "producer"}], {"schema"}),
    "unknown-member": ([evidence(1, extra=1)], {"schema"}),
    "unknown-nested-member": ([evidence(1, tool={"name": "t", "version": "1", "source": "s", "x": 1})], {"schema"}),
    "bad-status": ([evidence(1, status="green")], {"schema"}),
    "bad-id": ([{**NOTICE, "id": "NOTICE-1"}], {"schema"}),
    "pass-without-output": ([evidence(1, output_digest=None)], {"schema", "evidence-output-digest-set"}),
    "skip-that-ran": ([evidence(1, status="skip")], {"schema"}),
    "expired-without-reason": ([claim(1, status="expired")], {"schema"}),
    "supported-without-evidence": ([claim(1, evidence=[])], {"schema"}),
    "model-without-detail": ([evidence(2, type="model-check")], {"schema"}),
    "detail-without-model": ([evidence(2, model_check=MODEL)], {"schema"}),
    "conformance-without-suite": ([evidence(1, type="conformance")], {"schema"}),
    "collected-with-review": ([evidence(1, lifecycle="collected", lifecycle_history=[{"state": "collected", "recorded_at": LATE, "review_digest": DIGEST}])], {"schema"}),
    "time-order": ([evidence(1, completed_at="2025-12-31T23:59:59Z")], {"time-order"}),
    "offset-time-is-in-order": ([evidence(1, completed_at="2026-01-01T05:00:00+05:00")], set()),
    "claim-time-order": ([claim(1, valid_until="2025-01-01T00:00:00Z")], {"time-order"}),
    "unparsable-time": ([{**ASSUMPTION, "next_review_at": "2026-13-01T00:00:00Z"}], {"schema"}),
    "lifecycle-start": ([evidence(1, lifecycle_history=evidence(1)["lifecycle_history"][1:])], {"lifecycle-start"}),
    "lifecycle-current": ([evidence(1, lifecycle="collected")], {"lifecycle-current"}),
    "lifecycle-transition": (
        [evidence(1, lifecycle="published", lifecycle_history=[*evidence(1)["lifecycle_history"], {"state": "published", "recorded_at": LATE, "review_digest": DIGEST}])],
        {"lifecycle-transition"},
    ),
    "lifecycle-time": (
        [evidence(1, lifecycle_history=[{**h, "recorded_at": "2026-01-01T00:00:01Z"} for h in evidence(1)["lifecycle_history"]])], {"lifecycle-time-order"},
    ),
    "model-range": ([model(state_space_bounds__parameters__0__maximum=-1)], {"model-check-range"}),
    "model-names": ([model(state_space_bounds__parameters__1__name="n")], {"model-check-duplicate-parameter"}),
    "model-count": ([model(explored_state_space__distinct_states=51)], {"model-check-state-count"}),
    "model-bound": ([model(explored_state_space__generated_states=101)], {"model-check-state-bound"}),
    "model-depth": ([model(explored_state_space__maximum_depth=6)], {"model-check-depth"}),
    "published-without-approval": ([{**MANIFEST, "publication": {**MANIFEST["publication"], "status": "published"}}], {"publication-approval", "schema"}),
    "digest-count": ([{**MANIFEST, "digests": {**MANIFEST["digests"], "evidence_record_digests": []}}], {"evidence-record-digest-count"}),
    "digest-set": ([{**MANIFEST, "digests": {**MANIFEST["digests"], "evidence_output_digests": ["sha256:" + "b" * 64]}}], {"evidence-output-digest-set"}),
    "missing-reference": ([claim(1, limitations=["PM-LIMITATION-0999"])], {"missing-reference"}),
    "inactive-evidence": (
        [evidence(1, lifecycle="withdrawn", lifecycle_history=[*evidence(1)["lifecycle_history"], {"state": "withdrawn", "recorded_at": LATE, "review_digest": DIGEST}])],
        {"inactive-evidence-reference"},
    ),
    "unknown-type": ([{"record_type": "poem", "id": "x", "surprise": 1}], {"unknown-record-type"}),
}


REFERENCE_CODES = {"missing-reference", "inactive-evidence-reference", "evidence-output-digest-set", "duplicate-id"}


def frame(spark, rows):
    """Records of (path, record) pairs, typed as the corpus plan reads them."""
    raw = spark.createDataFrame([(p, json.dumps(r)) for p, r in rows], "path string, raw string")
    return raw.select("path", "raw", F.from_json("raw", RECORD_SCHEMA).alias("r")).select("path", "raw", "r.*")


def corpus(name: str) -> list[dict]:
    changed = CHANGES[name][0] if name else []
    records = {r["id"]: r for r in [*VALID, *changed]}
    if name == "bad-id":
        records.pop("PM-NOTICE-0001")
    return list(records.values())


def test_row_contracts_give_exactly_their_codes(spark):
    """All variants in one pass; the path names the variant."""
    rows = [(name, record) for name in ["", *CHANGES] for record in corpus(name)]
    got: dict = {}
    for r in contract_findings(frame(spark, rows)).collect():
        got.setdefault(r.path, set()).add(r.code)
    expected = {name: codes - REFERENCE_CODES for name, (_, codes) in CHANGES.items()}
    assert got == {name: codes for name, codes in expected.items() if codes}


@pytest.mark.parametrize("name", ["", *[n for n, (_, codes) in CHANGES.items() if codes & REFERENCE_CODES]])
def test_references_give_exactly_their_codes(spark, name):
    rows = [(f"{i}.json", record) for i, record in enumerate(corpus(name))]
    found = reference_findings(frame(spark, rows)).collect()
    assert {r.code for r in found} == (CHANGES[name][1] & REFERENCE_CODES if name else set()), found


def test_a_valid_corpus_of_files_has_no_finding(spark, tmp_path):
    for i, record in enumerate(corpus("")):
        folder = tmp_path / ("deep/er" if i % 2 else "")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"r{i}.json").write_text(json.dumps(record), encoding="utf-8")
    records, findings = validate_corpus(spark, str(tmp_path))
    assert records.count() == len(VALID) and findings.collect() == []


def test_file_faults_duplicates_and_sinks(spark, tmp_path):
    for name, text in {
        "a/one.json": json.dumps(claim(1)), "b/two.json": json.dumps(claim(1)), "bad.json": "{", "twice.json": '{"id": 1, "id": 2}', "list.json": "[1]",
        "tests/skipped.json": "{", "big.json": json.dumps({"id": "x" * 1_100_000}), "note.txt": "{",
    }.items():
        file = tmp_path / "in" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text, encoding="utf-8")
    records, findings = validate_corpus(spark, str(tmp_path / "in"))
    rows = findings.collect()
    assert {r.path for r in rows if r.code == "json-parse"} == {"bad.json", "twice.json", "big.json"}
    assert [r.path for r in rows if r.code == "record-shape"] == ["list.json"]
    duplicate = [(r.path, r.message) for r in rows if r.code == "duplicate-id"]
    assert duplicate == [("b/two.json", "duplicate id also present in a/one.json")]
    write_findings(findings, str(tmp_path / "out"))
    write_summary(findings, records, str(tmp_path / "summary"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    summary = spark.read.json(str(tmp_path / "summary")).collect()[0]
    assert (summary.records, summary.errors, summary.failed) == (2, len(rows), True)


def test_rules_are_one_projection_and_null_is_silent(spark):
    df = spark.createDataFrame([(1, None, "x", 1.5), (2, 5, None, float("nan")), (3, -1, "y", -0.0)], "id int, n int, s string, d double")
    rules = [*C.require("n"), C.in_range("n", 0, 3), C.one_of("s", ["x"]), C.finite("d"), C.implies(F.col("n") > 3, F.col("s") == "x", code="if", field="s", message="m")]
    found = C.check(df, rules, path=F.col("id"), key=F.col("id"))
    got = {(r.key, r.code, r.field) for r in found.collect()}
    assert got == {("1", "schema", "n"), ("2", "schema", "n"), ("2", "schema", "d"), ("2", "if", "s"), ("3", "schema", "n"), ("3", "schema", "s"), ("3", "schema", "d")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1 and "Exchange" not in plan


def test_findings_summary_and_order(spark):
    df = spark.createDataFrame([("warning", "w", "a"), ("error", "e", "z"), ("error", "e", "b")], "severity string, code string, path string")
    findings = union_findings(df.select("severity", "code", "path", F.lit("m").alias("message"), F.lit("k").alias("key")))
    assert [(r.severity, r.path) for r in order_findings(findings).collect()] == [("error", "b"), ("error", "z"), ("warning", "a")]
    row = finding_summary(findings).collect()[0]
    assert (row.errors, row.warnings, row.info, row.failed) == (2, 1, 0, True)
    assert finding_summary(findings.limit(0)).collect()[0].failed is False


def test_row_contracts_work_on_a_stream(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    found = C.check(stream, [C.in_range("id", 0, 1)], path=F.col("id"), key=F.col("id"))
    query = found.writeStream.format("memory").queryName("found").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert {r.key for r in spark.table("found").collect()} == {"2", "3"}


def test_positions_and_observed_summary(spark, tmp_path):
    rows = [(["error", "warning", "info"][i % 3], f"c{i % 7}", None if i % 11 == 0 else f"p{i % 50:02d}", "m", str(i)) for i in range(900)]
    df = spark.createDataFrame(rows, "severity string, code string, path string, message string, key string").repartition(5)
    placed = {r.key: r.position for r in finding_positions(df).collect()}
    order = sorted(rows, key=lambda r: (r[0] != "error", r[2] is not None, r[2] or "", r[1], r[3], r[4]))
    assert placed == {r[4]: i for i, r in enumerate(order, start=1)}
    assert finding_positions(df.limit(0)).count() == 0
    watched, seen = observed_summary(df)
    watched.write.parquet(str(tmp_path / "findings"))
    assert seen.get == finding_summary(df).first().asDict()


def test_a_product_beyond_a_bigint_is_out_of_range(spark, tmp_path):
    from driver_queries.contract_queries import q_contract_range

    rows = [(1, 1000, 1, 5.0, 0.1), (2, 1001, 2, 5.0, 0.1), (3, 1_200_000, 3, 5.0, 0.1), (4, None, 4, 5.0, 0.1)]
    kind = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_tax double"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = {(r.key, r.field) for r in q_contract_range(spark, str(tmp_path)).collect()}
    assert found == {("2/2", "big"), ("3/3", "big")}
