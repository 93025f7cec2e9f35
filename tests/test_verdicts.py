"""Roll-ups, judgments, trust and release classification on small hand-made cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import contracts as C
from ledgerloom.operators import rollup as A
from ledgerloom.plans import packages as P
from ledgerloom.plans import release as R


def test_claim_rollup_precedence(spark):
    evidence = {"p": "pass", "p2": "pass", "f": "fail", "s": "skip", "u": "unsupported", "t": "timeout", "e": "tool-error", "other": "pass"}
    claims = {
        "missing": ("supported", ["nope", "f"], []), "mismatch": ("supported", ["other"], []), "failed": ("supported", ["p", "f", "s"], []),
        "ended": ("withdrawn", ["p"], []), "skipped": ("supported", ["p", "s"], []), "error": ("supported-with-assumptions", ["e"], []),
        "no-assumption": ("supported-with-assumptions", ["p"], []), "assumed": ("supported-with-assumptions", ["p"], ["a"]),
        "assumed-missing": ("supported-with-assumptions", ["p"], ["b"]), "good": ("supported", ["p", "p2"], []), "empty": ("supported", [], []),
        "draft": ("draft", ["p"], []), "draft-failed": ("draft", ["f"], []), "assumed-without-evidence": ("supported-with-assumptions", [], ["a"]),
    }
    expected = {
        "missing": "invalid-reference", "mismatch": "invalid-reference", "failed": "not-supported", "ended": "not-supported",
        "skipped": "not-evaluated", "error": "not-evaluated", "no-assumption": "invalid-reference", "assumed": "supported-with-assumptions",
        "assumed-missing": "invalid-reference", "good": "supported", "empty": "not-evaluated", "draft": "not-evaluated",
        "draft-failed": "not-supported", "assumed-without-evidence": "supported-with-assumptions",
    }
    table = spark.createDataFrame(
        [(k, s, e, a, [], ("process", "x")) for k, (s, e, a) in claims.items()],
        "claim_id string, status string, evidence array<string>, assumptions array<string>, limitations array<string>, subject struct<type:string,id:string>",
    )
    targets = spark.createDataFrame(
        [("evidence", k, s, ("process", "y" if k == "other" else "x")) for k, s in evidence.items()] + [("assumption", "a", None, None), ("evidence", "b", "pass", ("process", "x"))],
        "kind string, ref_id string, status string, subject struct<type:string,id:string>",
    )
    result = A.claim_rollup(table, A.claim_references(table), targets)
    assert {r.claim_id: r.result for r in result.collect()} == expected
    counts = {r.value: r.n for r in A.vocabulary_counts(result, "result", A.CLAIM_RESULTS).collect()}
    assert list(counts) == list(A.CLAIM_RESULTS) and sum(counts.values()) == len(claims)


ROLES = {"ci": "required", "conformance": "required", "formal": "optional", "security": "optional", "review": "optional"}
TYPES = {"ci": "ci", "conformance": "test-runner", "formal": "formal-tool", "security": "security-tool", "review": "human-review"}
# package -> (statuses in role order, lineages in role order, judgment, warnings)
PACKAGES = {
    "success": (["pass", "pass", "skip", "unsupported", "skip"], "abcde", "satisfied-with-warnings", ["missing-spec-derived-evidence"]),
    "required-fail": (["pass", "fail", "skip", "unsupported", "skip"], "abcde", "blocked", ["insufficient-independent-lanes", "missing-spec-derived-evidence"]),
    "missing-tool": (
        ["unsupported", "pass", "skip", "unsupported", "skip"], "abcde", "blocked",
        ["all-evidence-derived-from-source", "insufficient-independent-lanes", "missing-spec-derived-evidence"],
    ),
    "same-lineage": (["pass", "pass", "skip", "unsupported", "skip"], "aacde", "blocked", ["missing-spec-derived-evidence", "same-generator-lineage"]),
}


def packages(spark):
    rows = [
        (name, role, TYPES[role], status, lineage)
        for name, (statuses, lineages, _, _) in PACKAGES.items() for role, status, lineage in zip(ROLES, statuses, lineages, strict=True)
    ]
    return spark.createDataFrame(rows, "package_id string, tool_id string, producer_type string, status string, implementation_digest string")


def test_packages_are_judged_as_recorded(spark):
    records = packages(spark)
    entries = P.lane_entries(records, F.col("package_id"))
    need = spark.createDataFrame(
        [(name, ["behavior", "runtime"], ["integration", "runtime-control"], 2) for name in PACKAGES],
        "claim_id string, required_lanes array<string>, required_kinds array<string>, min_sources int",
    )
    judged = {r.package_id: r.judgment for r in P.judge_packages(records, entries, need, ROLES).collect()}
    assert judged == {name: case[2] for name, case in PACKAGES.items()}
    lanes = A.lane_coverage(entries, need, ["behavior", "runtime"], ["integration", "runtime-control"])
    assert {r.claim_id: r.warning_codes for r in lanes.collect()} == {name: case[3] for name, case in PACKAGES.items()}
    gate = {r.package_id: (r.gate_state, r.n_pass, r.n_timeout) for r in A.gate_rollup(records, ["package_id"], "tool_id", "status", ROLES).collect()}
    assert gate["success"] == ("satisfied", 2, 0) and gate["required-fail"][0] == "blocked" and gate["same-lineage"][0] == "satisfied"
    partial = records.where("package_id = 'success' and tool_id <> 'ci'")
    assert A.gate_rollup(partial, ["package_id"], "tool_id", "status", ROLES).collect()[0].gate_state == "blocked"


def test_warning_policy_fails_closed(spark):
    claims = spark.createDataFrame(
        [("unknown", ["new-code", "bad"], [], [], "warning"), ("blocked", ["bad"], [], [], "warning"), ("missing", [], ["lane"], [], "blocked"),
         ("warned", ["seen"], [], [], "warning"), ("fine", [], [], [], "satisfied"), ("odd", [], [], [], "warning")],
        "p string, warning_codes array<string>, missing_lanes array<string>, missing_kinds array<string>, status string",
    )
    got = {r.p: r.native_state for r in A.warning_policy(claims, ["p"], ["bad"], ["seen"]).collect()}
    assert got == {"unknown": "error", "blocked": "blocked", "missing": "blocked", "warned": "warning", "fine": "satisfied", "odd": "error"}
    own = spark.createDataFrame([("fine", ["new-code"]), ("warned", ["bad"]), ("odd", []), ("alone", [])], "p string, warning_codes array<string>")
    got = {r.p: r.native_state for r in A.warning_policy(claims, ["p"], ["bad"], ["seen"], own).collect()}
    assert got == {"unknown": "error", "blocked": "blocked", "missing": "blocked", "warned": "blocked", "fine": "error", "odd": "error", "alone": "error"}
    codes = lambda *values: spark.createDataFrame([(v,) for v in values], "code string")
    assert A.policy_closed(codes("bad"), codes("seen"), codes("bad", "seen")).collect() == []
    assert {r.reason for r in A.policy_closed(codes("bad", "seen"), codes("seen", "x"), codes("bad", "seen", "y")).collect()} == {
        "overlap", "outside-universe", "uncovered",
    }


DAY = dt.datetime(2026, 8, 4)


def test_valid_at_includes_both_ends(spark):
    keys = spark.createDataFrame(
        [("k", "sign", "active", DAY, DAY + dt.timedelta(days=1)), ("r", "sign", "revoked", DAY, DAY)],
        "key string, usage string, status string, valid_from timestamp, valid_until timestamp",
    )
    hour = dt.timedelta(hours=1)
    facts = spark.createDataFrame(
        [(1, "k", DAY), (2, "k", DAY + 24 * hour), (3, "k", DAY + 25 * hour), (4, "k", DAY - hour), (5, "x", DAY), (6, "r", DAY), (7, "k", None)],
        "id int, key string, at timestamp",
    )
    got = {r.id: r.trust_reason for r in R.valid_at(facts, keys, "key", "at", "sign").collect()}
    assert got == {1: None, 2: None, 3: "key-validity", 4: "key-validity", 5: "key-unknown", 6: "key-status", 7: "key-validity"}
    assert {r.trust_reason for r in R.valid_at(facts.where("id = 1"), keys, "key", "at", "other").collect()} == {"key-usage"}


@pytest.mark.parametrize(
    ("change", "overall", "code"),
    [
        ({}, R.VERIFIED, 0), ({"key_status": "revoked", "release_state": "withdrawn"}, "revoked-key", 3), ({"key_status": "lost"}, "untrusted-key", 3),
        ({"valid_until": DAY - dt.timedelta(days=1)}, "expired-release", 4), ({"valid_from": DAY + dt.timedelta(days=1)}, "expired-release", 4),
        ({"release_state": "withdrawn"}, "withdrawn-release", 4), ({"release_state": "superseded"}, "superseded-release", 4),
        ({"release_state": "corrected"}, "corrected-release", 4), ({"release_state": "expired"}, "expired-release", 4),
        ({"release_state": "odd"}, "invalid-structure", 1), ({"n_invalid_reference": 1, "n_not_evaluated": 1}, "claims-not-supported", 5),
        ({"n_not_supported": 1}, "claims-not-supported", 5), ({"n_not_evaluated": 2}, "not-evaluated", 5), ({"key_status": None}, "untrusted-key", 3),
    ],
)
def test_release_ladder(spark, change, overall, code):
    row = {
        "key_status": "active", "valid_from": DAY, "valid_until": DAY, "release_state": "active", "n_not_supported": 0, "n_invalid_reference": 0,
        "n_not_evaluated": 0, **change,
    }
    schema = (
        "key_status string, valid_from timestamp, valid_until timestamp, release_state string, n_not_supported int, n_invalid_reference int, n_not_evaluated int"
    )
    result = R.classify_release(spark.createDataFrame([tuple(row.values())], schema), F.lit(DAY)).collect()[0]
    assert (result.overall, result.exit_class) == (overall, code)


def test_status_entries_and_results(spark):
    at = dt.datetime(2026, 8, 4)
    rows = [
        ("ok", "active", None, None, None, at), ("future", "active", None, None, None, at + dt.timedelta(days=1)), ("half", "superseded", "n", None, None, at),
        ("self", "corrected", "self", "b2", None, at), ("noted", "superseded", "n", "b2", "notice", at), ("quiet", "withdrawn", None, None, None, at),
        ("moved", "withdrawn", "n", None, "notice", at), ("odd", "expired", None, None, "notice", at), ("fine", "withdrawn", None, None, "notice", at),
    ]
    entries = spark.createDataFrame(
        [(k, "b1", *rest) for k, *rest in rows],
        "release_id string, bundle_digest string, state string, replacement_release_id string, replacement_bundle_digest string, notice_digest string, effective_at timestamp",
    )
    found = C.check(entries, R.release_entry_rules(F.lit(at)), path=F.col("release_id"), key=F.col("release_id")).collect()
    assert {(r.key, r.code) for r in found} == {
        ("future", "status-entry-future"), ("half", "replacement-binding"), ("self", "replacement-cycle"), ("noted", "release-status-fields"),
        ("quiet", "withdrawal-notice"), ("moved", "release-status-fields"), ("odd", "release-status-fields"),
    }
    keys = spark.createDataFrame([("a", "revoked", True, at), ("b", "revoked", False, at), ("c", "active", None, at)], "k string, status string, compromise_indicator boolean, effective_at timestamp")
    assert {r.key for r in C.check(keys, R.key_entry_rules(F.lit(at)), path=F.col("k"), key=F.col("k")).collect()} == {"b", "c"}
    classified = spark.createDataFrame([("x", "active", R.VERIFIED, 0), ("y", "active", R.VERIFIED, 0)], "rel string, release_state string, overall string, exit_class int")
    failures = spark.createDataFrame(
        [("y", "lifecycle", "invalid-structure", "late"), ("y", "trust", "untrusted-key", "early")], "rel string, stage string, status string, reason string"
    )
    result = {r.rel: r for r in R.verification_result(classified, failures, "rel").collect()}
    assert (result["y"].overall, result["y"].exit_class, result["y"].reason, result["y"].release_state) == ("untrusted-key", 3, "early", None)
    assert (result["y"].trust_valid, result["y"].lifecycle_valid, result["y"].structure_valid) == (False, False, True)
    assert (result["x"].overall, result["x"].reason, result["x"].release_state) == (R.VERIFIED, None, "active")
    copies = spark.createDataFrame([("a",), ("a",), ("b",)], "rel string")
    assert [(r.rel, r.entries) for r in R.entry_count(copies, ["rel"]).collect()] == [("a", 2)]


def test_releases_are_verified_end_to_end(spark):
    """One release per lifecycle state, and one per failing stage."""
    at = dt.datetime(2026, 8, 4)
    early = at - dt.timedelta(days=2)
    normal = ["active", "revoked", "withdrawn", "superseded", "corrected", "expired"]
    faults = ["missing-file", "extra-file", "unknown-key", "bad-signature", "bad-linkage", "gap", "link", "order", "rollback", "claims", "open-claims", "no-chain"]
    names = [*normal, *faults]
    releases = spark.createDataFrame(
        [(n, "b", "lost" if n == "unknown-key" else "k", n != "bad-signature", n != "bad-linkage", early, at) for n in names],
        "release_id string, bundle_digest string, key_id string, signature_valid boolean, linkage_valid boolean, valid_from timestamp, valid_until timestamp",
    )
    files = [(n, f"f{i}", "d", 1) for n in names for i in range(3)]
    schema = "release_id string, path string, digest string, size long"
    declared = spark.createDataFrame([f for f in files if f[:2] != ("extra-file", "f2")], schema)
    actual = spark.createDataFrame([f for f in files if f[:2] != ("missing-file", "f2")] + [(n, "listing", "d", 1) for n in names], schema)
    keys = spark.createDataFrame([("k", "release-signing", "active", early, at)], "key_id string, usage string, status string, valid_from timestamp, valid_until timestamp")

    def entry(name, revision, state="active", key="active", previous=None, days=0, number=None):
        replaced = state in ("superseded", "corrected")
        return (
            name, revision, number or revision, f"{name}{revision}", previous, early + dt.timedelta(hours=revision + days), key, key == "revoked", "b", state,
            "next" if replaced else None, "nb" if replaced else None, "notice" if state == "withdrawn" else None, early,
        )

    rows = [entry(n, 1) for n in names if n != "no-chain"]
    rows += [entry("revoked", 2, key="revoked", previous="revoked1")]
    rows += [entry(n, 2, state=n, previous=f"{n}1") for n in normal[2:]]
    rows += [entry("gap", 2, previous="gap1", number=3), entry("link", 2, previous="other"), entry("order", 2, previous="order1", days=-1)]
    rows += [entry("rollback", 2, state="withdrawn", previous="rollback1"), entry("rollback", 3, previous="rollback2")]
    chain = spark.createDataFrame(
        rows, "release_id string, position int, revision int, status_set_digest string, previous_digest string, generated_at timestamp, key_status string,"
        "compromise_indicator boolean, bundle_digest string, state string, replacement_release_id string, replacement_bundle_digest string, notice_digest string,"
        "effective_at timestamp",
    )
    claims = spark.createDataFrame(
        [(n, {"claims": "not-supported", "open-claims": "not-evaluated"}.get(n, "supported")) for n in names], "release_id string, result string"
    )
    got = {r.release_id: (r.overall, r.exit_class, r.reason) for r in R.verify_releases(releases, declared, actual, keys, chain, claims, F.lit(at), self_path="listing").collect()}
    assert got == {
        "active": (R.VERIFIED, 0, None), "revoked": ("revoked-key", 3, None), "withdrawn": ("withdrawn-release", 4, None),
        "superseded": ("superseded-release", 4, None), "corrected": ("corrected-release", 4, None), "expired": ("expired-release", 4, None),
        "missing-file": ("incomplete-bundle", 1, "path-missing"), "extra-file": ("incomplete-bundle", 1, "path-extra"),
        "unknown-key": ("untrusted-key", 3, "key-unknown"), "bad-signature": ("invalid-signature", 1, "release-signature-invalid"),
        "bad-linkage": ("invalid-report-linkage", 1, "static-report-linkage-invalid"), "gap": ("invalid-structure", 1, "status-chain-revision-sequence"),
        "link": ("invalid-structure", 1, "status-chain-revision-binding"), "order": ("invalid-structure", 1, "status-chain-revision-order"),
        "rollback": ("invalid-structure", 1, "status-chain-release-state-rollback"), "claims": ("claims-not-supported", 5, None),
        "open-claims": ("not-evaluated", 5, None), "no-chain": ("invalid-structure", 1, "status-chain-missing"),
    }
