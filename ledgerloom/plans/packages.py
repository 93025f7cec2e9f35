"""Producer packages: derived evidence, tool and lane projections, and their judgments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import contracts as C
from ledgerloom.operators import rollup as A

# What each producer type yields.
EVIDENCE_TYPE = {
    "ci": "test", "test-runner": "conformance", "formal-tool": "proof-check", "security-tool": "security-scan",
    "human-review": "review",
}
LANE = {
    "ci": ("runtime", "runtime-control", "runtime-derived"),
    "test-runner": ("behavior", "integration", "source-derived"),
    "formal-tool": ("proof", "proof-check", "model-derived"),
    "security-tool": ("adversarial", "fuzz", "source-derived"),
    "human-review": ("spec", "schema", "manual"),
}
NOT_RUN = ("skip", "unsupported")
BLOCKING_WARNINGS = (
    "all-evidence-derived-from-source", "same-generator-lineage", "unresolved-critical-counterexample",
    "insufficient-independent-lanes", "context-pack-profile-mismatch", "unknown-claim-ref", "unlinked-counterexample",
    "unrecognized-evidence-claim", "assumption-validation-required", "untrusted-formal-summary",
)
VISIBLE_WARNINGS = ("missing-spec-derived-evidence",)
ABSENCE_BEHAVIOR = {
    "required": ("unsupported-blocked", "tool-error-blocked"), "optional": ("skip-visible", "unsupported-visible"),
}


def literal_map(values: Mapping[str, str], key: Column) -> Column:
    """Lookup in a literal map; NULL for an unknown key."""
    return F.try_element_at(F.create_map(*[F.lit(x) for item in values.items() for x in item]), key)


def bound_records(records: DataFrame, bindings: DataFrame, packages: DataFrame) -> DataFrame:
    """Records with their tool binding and package: one row per record.

    Keys are (package_id, tool_id) = (package_id, tool_role_id) and package_id; both sides are unique.
    """
    tools = bindings.select(
        "package_id", F.col("tool_role_id").alias("tool_id"), "identity", "version", "implementation_digest",
        "input_contract", "output_contract", "binding_digest",
    )
    owners = packages.select("package_id", "package_digest", "validated_at", "subject", "suite_digest")
    return records.join(tools, ["package_id", "tool_id"], "left").join(owners, "package_id", "left")


def derive_evidence(bound: DataFrame, requirements: Mapping[str, str]) -> DataFrame:
    """Evidence rows of bound producer records; the status is never changed."""
    ran = ~F.col("status").isin(list(NOT_RUN))
    history = F.array(
        F.struct(
            F.lit("collected").alias("state"), F.col("started_at").alias("recorded_at"), F.lit(None).cast("string").alias("review_digest")
        ),
        F.struct(
            F.lit("validated").alias("state"), F.col("validated_at").alias("recorded_at"), F.col("package_digest").alias("review_digest")
        ),
    )
    reviewed = F.col("producer_type") == "human-review"
    return bound.select(
        "package_id", F.col("evidence_id").alias("id"), literal_map(EVIDENCE_TYPE, F.col("producer_type")).alias("type"),
        "status", F.lit("validated").alias("lifecycle"), history.alias("lifecycle_history"), "subject",
        F.array("suite_digest", "case_digest", "input_digest", "implementation_digest_product", "artifact_digest").alias("input_digests"),
        "output_digest",
        F.struct(
            F.when(reviewed, "human-review").otherwise("local-runner").alias("type"), F.col("producer_id").alias("identity")
        ).alias("producer"),
        F.struct(F.col("identity").alias("name"), F.col("version"), F.col("implementation_digest").alias("source")).alias("tool"),
        "started_at", "completed_at",
        F.struct(
            ran.alias("ran"), (literal_map(requirements, F.col("tool_id")) == "required").alias("required"),
            F.when(~ran, F.get("limitations", F.lit(0))).alias("reason"),
        ).alias("execution"),
        "summary", "limitations",
    )


def producer_inventory(bound: DataFrame) -> DataFrame:
    """Who produced which record with which tool."""
    return bound.select(
        "package_id", "evidence_id", "producer_type", "producer_id", F.col("tool_id").alias("tool_role_id"),
        F.col("identity").alias("tool_identity"), F.col("version").alias("tool_version"), "implementation_digest",
        "binding_digest", "status",
    )


def lane_entries(bound: DataFrame, claim: Column) -> DataFrame:
    """Lane entries of bound records for a claim; the lineage is the tool's implementation."""
    lane = {k: v[0] for k, v in LANE.items()}
    kind = {k: v[1] for k, v in LANE.items()}
    source = {k: v[2] for k, v in LANE.items()}
    producer = F.col("producer_type")
    return bound.select(
        claim.alias("claim_id"), literal_map(lane, producer).alias("lane"), literal_map(kind, producer).alias("kind"),
        literal_map(source, producer).alias("source_kind"), "status",
        F.concat(F.lit("implementation/"), F.col("implementation_digest")).alias("lineage"),
    )


def record_rules() -> list[C.Rule]:
    """Row rules of bound producer records: identity, chronology and bindings."""
    return [
        C.one_of("producer_type", list(EVIDENCE_TYPE), code="producer-type"),
        C.one_of("status", A.EVIDENCE_STATUSES, code="producer-status"),
        *[
            C.Rule("tool-binding", a, ~F.col(a).eqNullSafe(F.col(b)), f"{a} is not the bound {b}")
            for a, b in (
                ("tool_identity", "identity"), ("tool_version", "version"), ("tool_implementation_digest", "implementation_digest"),
            )
        ],
        *C.ordered("started_at", "completed_at", code="record-time"),
        *C.ordered("completed_at", "created_at", code="package-time"),
        *C.ordered("completed_at", "validated_at", code="validation-time"),
    ]


def absence_rules() -> list[C.Rule]:
    """Tool policy rows: the absence behaviour must fit the requirement."""
    need = F.col("requirement")
    return [
        C.implies(
            need == name, F.col("absence_behavior").isin(list(allowed)), code="absence-behavior", field="absence_behavior",
            message=f"not permitted for a {name} tool",
        )
        for name, allowed in ABSENCE_BEHAVIOR.items()
    ]


def judge_packages(
    records: DataFrame, entries: DataFrame, lane_requirements: DataFrame, requirements: Mapping[str, str],
    *, blocking: Sequence[str] = BLOCKING_WARNINGS, visible: Sequence[str] = VISIBLE_WARNINGS,
) -> DataFrame:
    """Gate, native and combined judgment per package.

    ``entries`` and ``lane_requirements`` use the package id as claim id: one claim per package.
    """
    gate = A.gate_rollup(records, ["package_id"], "tool_id", "status", requirements)
    lanes, kinds = sorted({v[0] for v in LANE.values()}), sorted({v[1] for v in LANE.values()})
    covered = A.lane_coverage(entries, lane_requirements, lanes, kinds).withColumnRenamed("claim_id", "package_id")
    native = A.warning_policy(covered, ["package_id"], blocking, visible)
    return A.combine_judgments(gate, native, ["package_id"])
