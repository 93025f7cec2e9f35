"""Validation of a corpus of record files: six record types, one pass of contracts, then references."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.digest import DIGEST_PATTERN
from ledgerloom.functions.joins import lookup_join
from ledgerloom.functions.times import parse_time
from ledgerloom.operators import contracts as C
from ledgerloom.operators import references as R
from ledgerloom.operators.findings import as_findings, union_findings
from ledgerloom.operators.history import invalid_steps, unordered_times
from ledgerloom.operators.rollup import EVIDENCE_STATUSES
from ledgerloom.sources.records import MAX_RECORD_BYTES, read_records

# Record vocabularies, id patterns, member names and state transitions.
LIFECYCLE_TRANSITIONS = {
    "collected": ("validated", "withdrawn"),
    "validated": ("sanitized", "withdrawn"),
    "sanitized": ("published", "withdrawn"),
    "published": ("superseded", "withdrawn"),
    "superseded": (),
    "withdrawn": (),
}
ID_PATTERNS = {
    "claim": r"^PM-CLAIM-[0-9]{4,}\z",
    "assumption": r"^PM-ASSUMPTION-[0-9]{4,}\z",
    "evidence": r"^PM-EVIDENCE-[0-9]{4,}\z",
    "evidence-manifest": r"^PM-MANIFEST-[0-9]{4,}\z",
    "known-limitation": r"^PM-LIMITATION-[0-9]{4,}\z",
    "assurance-notice": r"^PM-NOTICE-[0-9]{4,}\z",
}
MEMBERS = {
    "claim": (
        "schema_version", "record_type", "id", "statement", "subject", "scope", "status", "assumptions", "evidence",
        "limitations", "valid_from", "valid_until", "status_reason", "supersedes", "owner", "reviewers",
    ),
    "assumption": (
        "schema_version", "record_type", "id", "statement", "scope", "status", "rationale", "owner", "reviewed_at",
        "next_review_at", "sources",
    ),
    "evidence": (
        "schema_version", "record_type", "id", "type", "status", "lifecycle", "lifecycle_history", "subject", "input_digests",
        "output_digest", "producer", "tool", "started_at", "completed_at", "execution", "configuration", "model_check",
        "summary", "private_source_metadata", "public_artifacts", "limitations",
    ),
    "evidence-manifest": (
        "schema_version", "record_type", "id", "release", "subject", "digests", "protocol", "conformance", "toolchain",
        "claims", "assumptions", "evidence", "limitations", "approvals", "publication", "generated_at", "supersedes",
    ),
    "known-limitation": (
        "schema_version", "record_type", "id", "statement", "affected_claims", "severity", "status", "owner", "identified_at",
        "reviewed_at", "next_review_at", "mitigation", "references",
    ),
    "assurance-notice": (
        "schema_version", "record_type", "id", "notice_type", "affected_report", "affected_claims", "reason", "impact",
        "replacement", "issued_at", "approver", "public_notice",
    ),
}
# Member -> (record types that have it, its own members).
NESTED_MEMBERS = {
    "subject": (("claim", "evidence", "evidence-manifest"), ("type", "identifier", "version", "digest")),
    "producer": (("evidence",), ("type", "identity")),
    "tool": (("evidence",), ("name", "version", "source")),
    "execution": (("evidence",), ("ran", "required", "reason")),
    "private_source_metadata": (("evidence",), ("revision_digest", "source_class", "reproducibility", "publication_review_digest")),
    "model_check": (("evidence",), ("properties", "state_space_bounds", "explored_state_space")),
    "release": (("evidence-manifest",), ("identifier", "version", "channel")),
    "protocol": (("evidence-manifest",), ("identifier", "version", "digest")),
    "conformance": (("evidence-manifest",), ("identifier", "version", "digest")),
    "publication": (("evidence-manifest",), ("status", "publicly_reproducible", "reason", "signature")),
    "digests": (("evidence-manifest",), (
            "source_revision", "build_artifact", "claim_set", "assumption_set", "evidence_set", "evidence_record_digests",
            "evidence_output_digests", "limitation_set",
        )),
}
CLAIM_STATUSES = ("draft", "supported", "supported-with-assumptions", "not-supported", "expired", "withdrawn")
EVIDENCE_TYPES = (
    "test", "conformance", "model-check", "proof-check", "security-scan", "provenance", "review", "sbom", "benchmark",
)
SUBJECT_TYPES = ("protocol", "source-revision", "build-artifact", "deployment-profile", "process")
PRODUCER_TYPES = ("github-actions", "local-runner", "external-lab", "human-review")
ASSUMPTION_STATUSES = ("active", "invalidated", "expired")
LIMITATION_STATUSES = ("open", "accepted", "mitigated", "superseded")
SEVERITIES = ("critical", "high", "medium", "low", "informational")
NOTICE_TYPES = ("correction", "withdrawal")
CHANNELS = ("fixture", "experimental", "pilot", "production")
APPROVAL_TYPES = ("provenance", "schema", "security", "privacy", "claims", "ip", "publication")
APPROVAL_STATUSES = ("approved", "rejected", "not-required")
PUBLICATION_STATUSES = ("candidate", "published", "withdrawn")
REFERENCES = {
    "claim": {"assumptions": "assumption", "evidence": "evidence", "limitations": "known-limitation"},
    "evidence-manifest": {
        "claims": "claim", "assumptions": "assumption", "evidence": "evidence", "limitations": "known-limitation",
    },
    "known-limitation": {"affected_claims": "claim"},
    "assurance-notice": {"affected_claims": "claim"},
}
ACTIVE_CLAIMS = ("supported", "supported-with-assumptions")
INACTIVE_LIFECYCLES = ("superseded", "withdrawn")

RECORD_SCHEMA = """
    schema_version string, record_type string, id string, statement string,
    subject struct<type:string,identifier:string,version:string,digest:string>,
    scope string, status string, assumptions array<string>, evidence array<string>, limitations array<string>,
    claims array<string>, affected_claims array<string>, valid_from string, valid_until string, status_reason string,
    supersedes string, owner string, reviewers array<string>, rationale string, reviewed_at string,
    next_review_at string, sources array<string>, type string, lifecycle string,
    lifecycle_history array<struct<state:string,recorded_at:string,review_digest:string>>,
    input_digests array<string>, output_digest string, producer struct<type:string,identity:string>,
    tool struct<name:string,version:string,source:string>, started_at string, completed_at string,
    execution struct<ran:boolean,required:boolean,reason:string>, configuration string,
    model_check struct<properties:array<string>,state_space_bounds:struct<parameters:array<struct<name:string,
      kind:string,minimum:bigint,maximum:bigint,values:array<string>>>,constraints:array<string>,max_depth:bigint,
      max_states:bigint>,explored_state_space:struct<generated_states:bigint,distinct_states:bigint,
      maximum_depth:bigint,complete_within_bounds:boolean>>,
    summary string, private_source_metadata string, public_artifacts array<string>,
    release struct<identifier:string,version:string,channel:string>,
    digests struct<evidence_record_digests:array<string>,evidence_output_digests:array<string>>,
    approvals array<struct<type:string,status:string,reviewer:string,reviewed_at:string>>,
    publication struct<status:string,publicly_reproducible:boolean,reason:string>, generated_at string,
    severity string, identified_at string, mitigation string, `references` array<string>, notice_type string,
    affected_report string, reason string, impact string, replacement string, issued_at string, approver string,
    public_notice string
"""


def _present(name: str) -> Column:
    return F.col(name).isNotNull()


def _texts(*names: str) -> list[C.Rule]:
    return [rule for n in names for rule in (*C.require(n), C.text_length(n, 1))]


def _time(name: str, nullable: bool = False) -> list[C.Rule]:
    return [*([] if nullable else C.require(name)), C.parses_as_time(name)]


def _ids(name: str, record_type: str) -> list[C.Rule]:
    pattern = ID_PATTERNS[record_type]
    return [
        *C.require(name), *C.array_shape(name, unique=True),
        C.all_elements(name, lambda v: v.rlike(pattern), code="schema"),
    ]


def _digests(name: str) -> list[C.Rule]:
    return [
        *C.require(name), *C.array_shape(name, unique=True),
        C.all_elements(name, lambda v: v.rlike(DIGEST_PATTERN), code="schema"),
    ]


def _digest(value: Column) -> Column:
    return value.rlike(DIGEST_PATTERN)


def _rule(name: str, bad: Column, message: str) -> C.Rule:
    return C.Rule("schema", name, bad, f"{name}: {message}")


def _common(record_type: str, extra: Sequence[str] = ()) -> list[C.Rule]:
    rules = [
        *C.closed_fields("raw", [*MEMBERS[record_type], *extra], exact=True),
        C.one_of("schema_version", ["0.1"]), C.matches("id", ID_PATTERNS[record_type]),
    ]
    for name, (types, members) in NESTED_MEMBERS.items():
        if record_type in types:
            inner = F.get_json_object("raw", f"$.{name}")
            rules += C.closed_fields(F.when(inner.startswith("{"), inner), list(members), exact=True)
    return rules


def _subject(digest_required: bool) -> list[C.Rule]:
    subject = F.col("subject")
    return [
        *C.require("subject"),
        C.one_of(subject["type"], SUBJECT_TYPES, field="subject.type"),
        C.text_length(subject["identifier"], 1, field="subject.identifier"),
        C.text_length(subject["version"], 1, field="subject.version"),
        C.matches(subject["digest"], DIGEST_PATTERN, field="subject.digest"),
        *([_rule("subject.digest", _present("subject") & subject["digest"].isNull(), "digest is required")] if digest_required else []),
    ]


def _claim() -> list[C.Rule]:
    status = F.col("status")
    return [
        *_common("claim"), *_texts("statement", "scope", "owner"), *_subject(False), *C.require("status"),
        C.one_of("status", CLAIM_STATUSES), *_ids("assumptions", "assumption"), *_ids("evidence", "evidence"),
        *_ids("limitations", "known-limitation"), *_time("valid_from"), *_time("valid_until", nullable=True),
        C.matches("supersedes", ID_PATTERNS["claim"]), *C.require("reviewers"), *C.array_shape("reviewers", unique=True),
        C.implies(status.isin(list(ACTIVE_CLAIMS)), F.size("evidence") > 0, code="schema", field="evidence", message="a supported claim needs evidence"),
        C.implies(status == "supported-with-assumptions", F.size("assumptions") > 0, code="schema", field="assumptions", message="an assumption is needed"),
        C.implies(status.isin("expired", "withdrawn"), F.char_length("status_reason") > 0, code="schema", field="status_reason", message="a reason is needed"),
        *C.ordered(parse_time(F.col("valid_from")), parse_time(F.col("valid_until")), fields=["valid_from", "valid_until"]),
    ]


def _assumption() -> list[C.Rule]:
    return [
        *_common("assumption"), *_texts("statement", "scope", "rationale", "owner"), *C.require("status"),
        C.one_of("status", ASSUMPTION_STATUSES), *_time("reviewed_at"), *_time("next_review_at"),
        *C.require("sources"), *C.array_shape("sources", unique=True),
        *C.ordered(parse_time(F.col("reviewed_at")), parse_time(F.col("next_review_at")), fields=["reviewed_at", "next_review_at"]),
    ]


def _evidence() -> list[C.Rule]:
    status, kind, execution = F.col("status"), F.col("type"), F.col("execution")
    history = F.col("lifecycle_history")
    bounds, explored = F.col("model_check.state_space_bounds"), F.col("model_check.explored_state_space")
    named = ("$.protocol.identifier", "$.protocol.version", "$.conformance_suite.identifier", "$.conformance_suite.version")
    configured = F.lit(True)
    for path in named:
        configured = configured & (F.char_length(F.get_json_object("configuration", path)) > 0)

    def entry_ok(entry: Column) -> Column:
        review = F.when(entry["state"] == "collected", entry["review_digest"].isNull()).otherwise(
            F.coalesce(_digest(entry["review_digest"]), F.lit(False))
        )
        return entry["state"].isin(list(LIFECYCLE_TRANSITIONS)) & parse_time(entry["recorded_at"]).isNotNull() & review

    def parameter_ok(p: Column) -> Column:
        ranged = (p["kind"] == "integer-range") & p["minimum"].isNotNull() & p["maximum"].isNotNull() & (F.size(p["values"]) == 0)
        listed = (p["kind"] == "finite-set") & p["minimum"].isNull() & p["maximum"].isNull() & (F.size(p["values"]) > 0)
        return F.coalesce(ranged | listed, F.lit(False)) & (F.char_length(p["name"]) > 0)

    is_model = kind == "model-check"
    return [
        *_common("evidence"), *C.require("type", "status", "lifecycle", "lifecycle_history", "producer", "tool", "execution"),
        C.one_of("type", EVIDENCE_TYPES), C.one_of("status", EVIDENCE_STATUSES), C.one_of("lifecycle", list(LIFECYCLE_TRANSITIONS)),
        *C.array_shape("lifecycle_history", at_least=1), C.all_elements("lifecycle_history", entry_ok, code="schema"),
        *_subject(True), *_digests("input_digests"), C.matches("output_digest", DIGEST_PATTERN),
        C.one_of(F.col("producer.type"), PRODUCER_TYPES, field="producer.type"),
        C.text_length(F.col("producer.identity"), 1, field="producer.identity"),
        *[C.text_length(F.col("tool")[n], 1, field=f"tool.{n}") for n in ("name", "version", "source")],
        *_time("started_at"), *_time("completed_at"), *_texts("summary"), *C.require("configuration", "public_artifacts", "limitations"),
        *C.array_shape("public_artifacts", unique=True), *C.array_shape("limitations", unique=True),
        _rule("execution", _present("execution") & (execution["ran"].isNull() | execution["required"].isNull()), "ran and required are booleans"),
        C.implies(status.isin("pass", "fail"), execution["ran"] & _digest(F.col("output_digest")), code="schema", field="output_digest", message="a verdict needs a run and an output digest"),
        C.implies(status.isin("skip", "unsupported"), ~execution["ran"] & (F.char_length(execution["reason"]) > 0), code="schema", field="execution", message="not run needs a reason"),
        C.implies(is_model, _present("model_check"), F.col("model_check").isNull(), code="schema", field="model_check", message="model check detail belongs to model checks only"),
        C.implies(kind == "conformance", configured, code="schema", field="configuration", message="conformance names its protocol and suite"),
        C.implies(_present("model_check"), bounds.isNotNull() & explored.isNotNull() & (F.size("model_check.properties") > 0), code="schema", field="model_check", message="bounds, properties and explored states are needed"),
        C.implies(bounds.isNotNull(), (F.size(bounds["parameters"]) > 0) & F.forall(bounds["parameters"], parameter_ok), code="schema", field="model_check.parameters", message="a parameter is malformed"),
        *C.ordered(parse_time(F.col("started_at")), parse_time(F.col("completed_at")), fields=["started_at", "completed_at"]),
        C.Rule("lifecycle-start", "lifecycle_history", F.get(history, F.lit(0))["state"] != "collected", "lifecycle_history must start with collected"),
        C.Rule("lifecycle-current", "lifecycle", F.try_element_at(history, F.lit(-1))["state"] != F.col("lifecycle"), "lifecycle must match the last lifecycle_history state"),
        C.Rule("lifecycle-time-order", "lifecycle_history", messages=unordered_times(history, parse_time)),
        C.Rule("lifecycle-transition", "lifecycle_history", messages=invalid_steps(history, LIFECYCLE_TRANSITIONS)),
        C.unique_names(bounds["parameters"], code="model-check-duplicate-parameter", field="parameters").when(is_model),
        C.parameter_ranges(bounds["parameters"], code="model-check-range", field="parameters").when(is_model),
        C.within(explored["distinct_states"], explored["generated_states"], code="model-check-state-count", field="distinct_states", bound_name="generated_states").when(is_model),
        C.within(explored["generated_states"], bounds["max_states"], code="model-check-state-bound", field="generated_states", bound_name="max_states").when(is_model),
        C.within(explored["maximum_depth"], bounds["max_depth"], code="model-check-depth", field="maximum_depth", bound_name="max_depth").when(is_model),
    ]


def _manifest(extra: Sequence[str]) -> list[C.Rule]:
    published = F.col("publication.status") == "published"

    def approved(item: Column) -> Column:
        return (item["type"] == "publication") & (item["status"] == "approved")

    def approval_ok(item: Column) -> Column:
        return (
            item["type"].isin(list(APPROVAL_TYPES)) & item["status"].isin(list(APPROVAL_STATUSES))
            & (F.char_length(item["reviewer"]) > 0) & parse_time(item["reviewed_at"]).isNotNull()
        )

    return [
        *_common("evidence-manifest", extra), *_subject(True), *C.require("release", "digests", "approvals", "publication"),
        *_ids("claims", "claim"), *_ids("assumptions", "assumption"), *_ids("evidence", "evidence"),
        *_ids("limitations", "known-limitation"), *_time("generated_at"), C.matches("supersedes", ID_PATTERNS["evidence-manifest"]),
        C.one_of(F.col("release.channel"), CHANNELS, field="release.channel"),
        C.one_of(F.col("publication.status"), PUBLICATION_STATUSES, field="publication.status"),
        C.all_elements("approvals", approval_ok, code="schema"),
        C.any_element("approvals", approved, when=published, code="schema"),
        C.any_element("approvals", approved, when=published, code="publication-approval"),
        C.Rule(
            "evidence-record-digest-count", "digests",
            F.col("evidence").isNotNull() & (F.size("digests.evidence_record_digests") >= 0)
            & (F.size("digests.evidence_record_digests") != F.size("evidence")),
            "evidence_record_digests must have one entry per referenced record",
        ),
    ]


def _limitation() -> list[C.Rule]:
    times = ["identified_at", "reviewed_at", "next_review_at"]
    return [
        *_common("known-limitation"), *_texts("statement", "owner"), *C.require("severity", "status", "references"),
        C.one_of("severity", SEVERITIES), C.one_of("status", LIMITATION_STATUSES), *_ids("affected_claims", "claim"),
        *_time("identified_at"), *_time("reviewed_at"), *_time("next_review_at", nullable=True),
        *C.array_shape("references", unique=True), *C.ordered(*[parse_time(F.col(t)) for t in times], fields=times),
    ]


def _notice() -> list[C.Rule]:
    return [
        *_common("assurance-notice"), *_texts("affected_report", "reason", "impact", "approver", "public_notice"),
        *C.require("notice_type"), C.one_of("notice_type", NOTICE_TYPES), *_ids("affected_claims", "claim"), *_time("issued_at"),
    ]


def record_contracts(manifest_members: Sequence[str] = ()) -> dict[str, list[C.Rule]]:
    """The contract of each record type, over the columns of ``RECORD_SCHEMA`` and ``raw``.

    ``manifest_members`` names further required members of a manifest, such as the block that
    identifies the tool framework in use.
    """
    return {
        "claim": _claim(), "assumption": _assumption(), "evidence": _evidence(), "evidence-manifest": _manifest(manifest_members),
        "known-limitation": _limitation(), "assurance-notice": _notice(),
    }


def contract_findings(records: DataFrame, manifest_members: Sequence[str] = ()) -> DataFrame:
    """Findings of every row contract over mixed records (columns of the record, ``raw`` and ``path``)."""
    return C.check_by_type(records, F.col("record_type"), record_contracts(manifest_members), path=F.col("path"), key=F.col("id"))


def reference_findings(records: DataFrame) -> DataFrame:
    """Findings between records: duplicate ids, broken and inactive references, output digest sets."""
    keys = records.where(F.col("id").isNotNull())
    copies = R.duplicate_ids(keys.select("id", "path", "record_type"), ["id"], ["path"], "path")
    duplicate = as_findings(
        copies, "duplicate-id", F.col("path"), F.concat(F.lit("duplicate id also present in "), F.col("first_path")), F.col("id")
    )
    edges = None
    for record_type, fields in REFERENCES.items():
        part = R.explode_references(
            records.where(F.col("record_type") == record_type), ["path", "id", "record_type", "status"], fields
        )
        edges = part if edges is None else edges.unionByName(part)
    targets = keys.select(F.col("record_type").alias("dst_type"), F.col("id").alias("dst_id"))
    absent = R.missing_references(edges, targets)
    missing = as_findings(
        absent, "missing-reference", F.col("path"),
        F.concat(F.col("field"), F.lit(" references unknown "), F.col("dst_type"), F.lit(" id "), F.col("dst_id")), F.col("id"),
    )
    # The first record of an id is the one that references resolve to.
    evidence = keys.where(F.col("record_type") == "evidence").groupBy(F.col("id").alias("dst_id")).agg(
        F.min_by(F.struct("lifecycle", "output_digest"), "path").alias("e")
    ).select("dst_id", "e.lifecycle", "e.output_digest")
    cited = edges.where((F.col("record_type") == "claim") & (F.col("field") == "evidence"))
    stale = R.inactive_references(
        cited, evidence, ["dst_id"], edge_status="status", active=ACTIVE_CLAIMS, lifecycle="lifecycle", inactive=INACTIVE_LIFECYCLES
    )
    inactive = as_findings(
        stale, "inactive-evidence-reference", F.col("path"),
        F.concat(F.lit("active claim references "), F.col("lifecycle"), F.lit(" evidence "), F.col("dst_id")), F.col("id"),
    )
    manifests = records.where(
        (F.col("record_type") == "evidence-manifest") & F.col("evidence").isNotNull()
        & F.col("digests.evidence_output_digests").isNotNull()
    )
    declared = manifests.select("path", "id", F.explode("digests.evidence_output_digests").alias("digest"))
    derived = (
        edges.where((F.col("record_type") == "evidence-manifest") & (F.col("field") == "evidence"))
        .join(manifests.select("path"), "path", "left_semi")
    )
    derived = lookup_join(derived, evidence, ["dst_id"]).select("path", "id", F.col("output_digest").alias("digest"))
    sets = as_findings(
        R.set_equality(declared, derived, ["path", "id"], "digest"), "evidence-output-digest-set", F.col("path"),
        "evidence_output_digests must equal referenced evidence output digests", F.col("id"),
    )
    return union_findings(duplicate, missing, inactive, sets)


def validate_corpus(
    spark: SparkSession, root: str, manifest_members: Sequence[str] = (), *, max_bytes: int = MAX_RECORD_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(records, findings) of a directory of record files; a file over ``max_bytes`` is a finding."""
    read, broken = read_records(spark, root, RECORD_SCHEMA, max_bytes=max_bytes)
    shaped = F.col("raw").rlike(r"^\s*\{")
    records = read.where(shaped).select("path", "raw", "record.*")
    shapeless = as_findings(read.where(~shaped), "record-shape", F.col("path"), "record must be a JSON object", F.col("path"))
    return records, union_findings(broken, shapeless, contract_findings(records, manifest_members), reference_findings(records))
