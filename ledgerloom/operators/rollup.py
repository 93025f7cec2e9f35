"""Zero-filled counts and policy verdicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.reconcile import disjoint_cover

# Vocabularies, in report order.
EVIDENCE_STATUSES = ("pass", "fail", "skip", "unsupported", "timeout", "tool-error")
CLAIM_RESULTS = ("supported", "supported-with-assumptions", "not-supported", "not-evaluated", "invalid-reference")
CLAIM_ENDED = ("not-supported", "expired", "withdrawn")


def vocabulary_counts(df: DataFrame, column: str, vocabulary: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, value, n): rows per value of a closed vocabulary, zero-filled, one row per value.

    Values outside the vocabulary are not counted; a contract rule reports them.
    """
    counts = [F.count_if(F.col(column) == v).alias(f"__{i}") for i, v in enumerate(vocabulary)]
    grouped = df.groupBy(*by).agg(*counts)
    entries = F.array(*[F.struct(F.lit(v).alias("value"), F.col(f"__{i}").alias("n")) for i, v in enumerate(vocabulary)])
    return grouped.select(*by, F.explode(entries).alias("e")).select(*by, "e.value", "e.n")


def claim_references(claims: DataFrame) -> DataFrame:
    """(claim_id, kind, ref_id, subject) from claims that hold their references as arrays."""
    kinds = {"evidence": "evidence", "assumptions": "assumption", "limitations": "limitation"}

    def references(name: str, kind: str) -> Column:
        ids = F.coalesce(F.col(name), F.array().cast("array<string>"))
        return F.transform(ids, lambda item: F.struct(F.lit(kind).alias("kind"), item.alias("ref_id")))

    parts = [references(name, kind) for name, kind in kinds.items()]
    refs = claims.select("claim_id", "subject", F.explode(F.concat(*parts)).alias("e"))
    return refs.select("claim_id", "e.kind", "e.ref_id", "subject")


def claim_rollup(claims: DataFrame, references: DataFrame, targets: DataFrame) -> DataFrame:
    """One verdict per claim from its status and everything it refers to.

    ``claims``: (claim_id, status). ``references``: (claim_id, kind, ref_id, subject) where kind is
    ``evidence``, ``assumption`` or ``limitation`` and subject is the claim's own. ``targets``:
    (kind, ref_id, status, subject), one row per id; status and subject matter for evidence only.

    All three kinds resolve in one join, and references are counted per claim before the shuffle.
    First match wins: a broken reference or another subject; an ended claim or failed evidence;
    evidence that did not run to a verdict; assumptions declared (and needed); all evidence passed;
    anything else is not evaluated. Evidence lifecycle plays no part.
    """
    known = targets.select("kind", "ref_id", "status", F.col("subject").alias("target_subject"), F.lit(True).alias("found"))
    resolved = references.join(known, ["kind", "ref_id"], "left")
    is_evidence = F.col("kind") == "evidence"
    found = F.col("found").isNotNull()
    counts = resolved.groupBy("claim_id").agg(
        F.count_if(~found).alias("n_missing"),
        F.count_if(is_evidence & found & ~F.col("subject").eqNullSafe(F.col("target_subject"))).alias("n_mismatch"),
        F.count_if(F.col("kind") == "assumption").alias("n_assumptions"),
        F.count_if(is_evidence & found).alias("n_evidence"),
        *[F.count_if(is_evidence & (F.col("status") == s)).alias(_count_name(s)) for s in EVIDENCE_STATUSES],
    )
    names = ["n_missing", "n_mismatch", "n_assumptions", "n_evidence", *[_count_name(s) for s in EVIDENCE_STATUSES]]
    rows = claims.select("claim_id", F.col("status").alias("declared_status")).join(counts, "claim_id", "left")
    rows = rows.select("claim_id", "declared_status", *[F.coalesce(F.col(n), F.lit(0).cast("bigint")).alias(n) for n in names])

    def verdict(result: str, reason: str) -> Column:
        return F.struct(F.lit(result).alias("result"), F.lit(reason).alias("reason_code"))

    status = F.col("declared_status")
    not_run = F.col("n_skip") + F.col("n_unsupported") + F.col("n_timeout") + F.col("n_tool_error")
    ladder = (
        F.when((F.col("n_missing") > 0) | (F.col("n_mismatch") > 0), verdict("invalid-reference", "claim-reference-invalid"))
        .when(status.isin(list(CLAIM_ENDED)) | (F.col("n_fail") > 0), verdict("not-supported", "claim-or-evidence-not-supported"))
        .when(not_run > 0, verdict("not-evaluated", "required-evidence-not-evaluated"))
        .when(
            (status == "supported-with-assumptions") & (F.col("n_assumptions") == 0),
            verdict("invalid-reference", "required-assumption-missing"),
        )
        .when(
            status == "supported-with-assumptions", verdict("supported-with-assumptions", "evidence-pass-assumptions-visible")
        )
        .when(
            (status == "supported") & (F.col("n_evidence") > 0) & (F.col("n_pass") == F.col("n_evidence")),
            verdict("supported", "required-evidence-pass"),
        )
        .otherwise(verdict("not-evaluated", "claim-status-not-evaluable"))
    )
    judged = rows.withColumn("__v", ladder)
    return judged.select("claim_id", "declared_status", "__v.result", "__v.reason_code", *names)


def _count_name(status: str) -> str:
    return "n_" + status.replace("-", "_")


def gate_results(records: DataFrame, role: str, status: str, requirements: Mapping[str, str]) -> DataFrame:
    """Adds ``requirement`` and ``gate_state`` to each record; a role outside the policy is ``unknown-role``.

    The policy (role -> ``required`` or ``optional``) is a literal map inside the plan.
    """
    pairs = [F.lit(x) for item in requirements.items() for x in item]
    requirement = F.try_element_at(F.create_map(*pairs), F.col(role))
    state = (
        F.when(requirement.isNull(), "unknown-role").when(F.col(status) == "pass", "satisfied")
        .when(requirement == "required", "blocked").otherwise("visible-nonblocking")
    )
    return records.withColumn("requirement", requirement).withColumn("gate_state", state)


def gate_rollup(
    records: DataFrame, package: Sequence[str], role: str, status: str, requirements: Mapping[str, str]
) -> DataFrame:
    """One gate state per package with its zero-filled status counts.

    Satisfied only when every required role is reported and every report of it passed; with no
    required role that is vacuously true. An unknown role blocks.
    """
    results = gate_results(records, role, status, requirements)
    required = [r for r, need in requirements.items() if need == "required"]
    reported = [F.count_if(F.col(role) == r).alias(f"__r{i}") for i, r in enumerate(required)]
    grouped = results.groupBy(*package).agg(
        *[F.count_if(F.col(status) == s).alias(_count_name(s)) for s in EVIDENCE_STATUSES],
        F.count_if(F.col("gate_state").isin("blocked", "unknown-role")).alias("blocking"), *reported,
    )
    complete = F.lit(True)
    for i in range(len(required)):
        complete = complete & (F.col(f"__r{i}") > 0)
    state = F.when(complete & (F.col("blocking") == 0), "satisfied").otherwise("blocked")
    return grouped.withColumn("gate_state", state).drop(*[f"__r{i}" for i in range(len(required))])


def lane_coverage(entries: DataFrame, requirements: DataFrame, lanes: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """Observed, required and missing lanes and evidence kinds per claim, with warning codes.

    ``entries``: (claim_id, lane, kind, source_kind, status, lineage). ``requirements``: (claim_id,
    required_lanes, required_kinds, min_sources), one row per claim. An entry is observed when its
    status is ``pass``. ``lanes`` and ``kinds`` are the closed vocabularies, so the collected sets
    stay small whatever the number of entries.

    Warnings (the rule source is only partly visible, so these follow its recorded outcomes):
    ``same-generator-lineage`` when two or more observed entries share one lineage and no other
    exists; ``insufficient-independent-lanes`` below ``min_sources`` observed lanes;
    ``all-evidence-derived-from-source`` when every observed entry is source-derived;
    ``missing-spec-derived-evidence`` without an observed spec-derived entry.
    """
    observed = F.col("status") == "pass"

    def kept(column: str, vocabulary: Sequence[str]) -> Column:
        return F.when(observed & F.col(column).isin(list(vocabulary)), F.col(column))

    grouped = entries.groupBy("claim_id").agg(
        F.array_sort(F.collect_set(kept("lane", lanes))).alias("observed_lanes"),
        F.array_sort(F.collect_set(kept("kind", kinds))).alias("observed_kinds"),
        F.count_if(observed).alias("n_observed"),
        F.count_if(observed & (F.col("source_kind") == "source-derived")).alias("n_source"),
        F.count_if(observed & (F.col("source_kind") == "spec-derived")).alias("n_spec"),
        F.min(F.when(observed, F.col("lineage"))).alias("low"), F.max(F.when(observed, F.col("lineage"))).alias("high"),
    )
    empty = F.array().cast("array<string>")
    rows = requirements.join(grouped, "claim_id", "left").select(
        "claim_id", "required_lanes", "required_kinds", "min_sources", "low", "high",
        *[F.coalesce(F.col(c), empty).alias(c) for c in ("observed_lanes", "observed_kinds")],
        *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in ("n_observed", "n_source", "n_spec")],
    )
    missing_lanes = F.array_sort(F.array_except("required_lanes", "observed_lanes"))
    missing_kinds = F.array_sort(F.array_except("required_kinds", "observed_kinds"))
    warnings = F.array_compact(
        F.array(
            F.when((F.col("n_observed") > 0) & (F.col("n_observed") == F.col("n_source")), F.lit("all-evidence-derived-from-source")),
            F.when(F.size("observed_lanes") < F.col("min_sources"), F.lit("insufficient-independent-lanes")),
            F.when(F.col("n_spec") == 0, F.lit("missing-spec-derived-evidence")),
            F.when((F.col("n_observed") > 1) & (F.col("low") == F.col("high")), F.lit("same-generator-lineage")),
        )
    )
    blocked = (F.size(missing_lanes) > 0) | (F.size(missing_kinds) > 0)
    return rows.select(
        "claim_id", "observed_lanes", "observed_kinds", missing_lanes.alias("missing_lanes"),
        missing_kinds.alias("missing_kinds"), warnings.alias("warning_codes"),
        F.when(blocked, "blocked").when(F.size(warnings) > 0, "warning").otherwise("satisfied").alias("status"),
    )


def warning_policy(
    claims: DataFrame, package: Sequence[str], blocking: Sequence[str], visible: Sequence[str], package_codes: DataFrame | None = None
) -> DataFrame:
    """One native state per package from its own and its claims' warnings, against a closed code list.

    ``package_codes`` has the package columns and ``warning_codes``, what a package itself reports; a package without a
    claim is never ``satisfied``.

    ``claims`` has the package columns, ``warning_codes``, ``missing_lanes``, ``missing_kinds`` and
    ``status``. An unknown code is ``error`` before anything else; anything missing or a blocking
    code is ``blocked``; any other code is ``warning``; with no code, all claims satisfied is
    ``satisfied`` and anything else ``error``.
    """
    known = [*blocking, *visible]
    claims = claims.select(*package, "warning_codes", "missing_lanes", "missing_kinds", "status", F.lit(True).alias("__claim"))
    if package_codes is not None:
        none = F.array().cast("array<string>")
        claims = claims.unionByName(package_codes.select(
            *package, "warning_codes", none.alias("missing_lanes"), none.alias("missing_kinds"), F.lit(None).cast("string").alias("status"), F.lit(False).alias("__claim"),
        ))
    unknown = F.size(F.array_except("warning_codes", F.array(*[F.lit(c) for c in known]))) > 0
    flags = [F.bool_or(F.array_contains("warning_codes", c)).alias(f"__w{i}") for i, c in enumerate(known)]
    grouped = claims.groupBy(*package).agg(
        F.bool_or(unknown).alias("unknown"),
        F.bool_or((F.size("missing_lanes") > 0) | (F.size("missing_kinds") > 0)).alias("missing"),
        (F.bool_or("__claim") & F.bool_and(~F.col("__claim") | F.coalesce(F.col("status") == "satisfied", F.lit(False)))).alias("all_satisfied"), *flags,
    )
    codes = F.array_sort(F.array_compact(F.array(*[F.when(F.col(f"__w{i}"), F.lit(c)) for i, c in enumerate(known)])))
    blocks = F.lit(False)
    for i in range(len(blocking)):
        blocks = blocks | F.col(f"__w{i}")
    state = (
        F.when(F.col("unknown"), "error").when(F.col("missing") | blocks, "blocked").when(F.size(codes) > 0, "warning")
        .when(F.col("all_satisfied"), "satisfied").otherwise("error")
    )
    treatment = (
        F.when(state == "blocked", "blocking").when(state == "warning", "visible-nonblocking")
        .when(state == "satisfied", "not-applicable").otherwise("fail-closed")
    )
    return grouped.select(*package, state.alias("native_state"), codes.alias("warning_codes"), treatment.alias("policy_treatment"))


def policy_closed(blocking: DataFrame, visible: DataFrame, codes: DataFrame, code: str = "code") -> DataFrame:
    """(value, reason) where the two policy sets overlap or do not cover the code list."""
    members = blocking.select(F.lit("blocking").alias("s"), code).unionByName(visible.select(F.lit("visible").alias("s"), code))
    return disjoint_cover(members, "s", code, codes.select(F.col(code).alias(code)))


def combine_judgments(gate: DataFrame, native: DataFrame, package: Sequence[str]) -> DataFrame:
    """One automated judgment per package. Approval is a separate matter and never derived here.

    A package missing on either side is not evaluated unless the present side blocks.
    """
    both = gate.select(*package, "gate_state").join(native.select(*package, "native_state"), list(package), "full_outer")
    none = F.lit("not-evaluated")
    gate_state, native_state = F.coalesce("gate_state", none), F.coalesce("native_state", none)
    state = (
        F.when((gate_state == "blocked") | (native_state == "blocked"), "blocked")
        .when(gate_state != "satisfied", "not-evaluated")
        .when(native_state == "warning", "satisfied-with-warnings").when(native_state == "satisfied", "satisfied")
        .otherwise("not-evaluated")
    )
    return both.select(*package, gate_state.alias("gate_state"), native_state.alias("native_state"), state.alias("judgment"))
