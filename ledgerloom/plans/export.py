"""Export of candidates: review gates, promotion, omissions and the exported bundle.

A candidate is one row with nested columns: ``candidate_id``, ``artifact_status``, ``evidence`` (a
struct with status, lifecycle, lifecycle_history, public_artifacts, ...), ``source`` (original
status and lifecycle), ``reviews`` (a struct of four review structs), ``sensitivity`` (a struct of
booleans), ``event`` (recorded_at, review_digest), ``omissions`` and ``review_subject_digest``.
Every gate is a rule with a stage; all gates run in one projection and the earliest failing stage
of a candidate decides.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.digest import normalize_omissions, normalize_set, row_digest
from ledgerloom.functions.text import decodings, is_exempt, may_change_in_nfkc, may_hold_sensitive_line, nfkc_each, sensitive_class_of_form
from ledgerloom.operators import contracts as C
from ledgerloom.operators.leaves import holds_text, json_strings, leaf_array, member_names

# Modes, review slots and their scopes, roles, states, checks and omission rules.
CANDIDATE_MODE = "export-candidate"
FIXTURE_MODE = "test-fixture"
ARTIFACT_STATUS = {CANDIDATE_MODE: "export-candidate", FIXTURE_MODE: "test-only"}
REVIEWER_ROLE = {CANDIDATE_MODE: "authorized-human", FIXTURE_MODE: "synthetic-reviewer"}
PUBLICATION = {CANDIDATE_MODE: "candidate", FIXTURE_MODE: "test-only"}
FINAL_APPROVAL = {CANDIDATE_MODE: "required-not-provided", FIXTURE_MODE: "not-applicable-test-only"}
CANDIDATE_IDS = {
    CANDIDATE_MODE: r"^PM-EXPORT-CANDIDATE-[0-9A-F]{32}\z",
    FIXTURE_MODE: r"^PM-EXPORT-CANDIDATE-[A-Z0-9-]{4,64}\z",
}
REVIEW_SCOPES = {
    "privacy": "privacy", "security_boundary": "security-boundary", "ip": "ip", "vulnerability": "vulnerability",
}
REVIEW_STATUSES = ("approved", "not-applicable")
STRICT_REVIEWS = ("privacy", "security_boundary")
PROHIBITED_FIELDS = (
    "account_id", "address", "authorization", "bearer_token", "client_secret", "credential", "customer_id", "email",
    "hostname", "password", "patent_candidate", "personal_name", "phone", "private_key", "raw_vulnerability_detail",
    "secret", "tenant_id", "token", "unpublished_invention",
)
COMMON_CHECKS = (
    "allowlist", "candidate-schema", "closed-configuration", "digest-bindings", "evidence-schema", "export-profile-binding",
    "exporter-implementation-manifest", "lifecycle-limit", "prohibited-field-scan", "prohibited-value-scan",
    "review-gates", "review-status-parity", "review-subject-binding", "status-preservation", "trusted-execution-mode",
)
INTERFACE_CHECKS = {"programmatic": (), "staged-file": ("input-size", "path-boundary", "strict-input-parse")}
MODE_CHECKS = {CANDIDATE_MODE: (), FIXTURE_MODE: ("fixture-entry-binding",)}
OMISSION_RULES = (
    {
        "path": "$.evidence_record.public_artifacts", "rule_id": "OMIT-PUBLIC-ARTIFACTS",
        "category": "optional-public-reference", "action": "omitted-by-profile",
    },
)
# Stages, in the order in which an export fails.
STAGES = (
    "lifecycle", "candidate-id", "schema", "allowlist", "evidence", "bindings", "values", "reviews", "mode", "omissions",
    "promotion", "report",
)
STAGE = {name: i for i, name in enumerate(STAGES, start=1)}

_HISTORY = "array<struct<state:string,recorded_at:string,review_digest:string>>"


def required_checks(mode: Column, interface: Column) -> Column:
    """The sorted set of checks that a run in this mode over this interface must report."""
    return C.expected_checks(COMMON_CHECKS, INTERFACE_CHECKS, MODE_CHECKS, interface, mode)


def at_stage(stage: str, rules: Sequence[C.Rule], checks: Sequence[str] = ()) -> list[C.Rule]:
    """The rules, marked with their stage and with the checks that they carry out."""
    return [replace(rule, stage=STAGE[stage], checks=(*rule.checks, *checks)) for rule in rules]


def review_subject(columns: Sequence[str] | Mapping[str, Column]) -> Column:
    """The digest that reviews must bind: over all candidate material except the reviews themselves."""
    return row_digest(columns, "review-subject/v1")


def fixture_review_rules(mode: str, *, reviews: str = "reviews") -> list[C.Rule]:
    """Outside the fixture mode no review may come from the fixture mode's reviewer."""
    role = REVIEWER_ROLE[FIXTURE_MODE]
    return [] if mode == FIXTURE_MODE else [
        C.Rule("fixture-review", f"{reviews}.{slot}.reviewer_role", F.col(f"{reviews}.{slot}.reviewer_role").eqNullSafe(F.lit(role)), "review is a fixture")
        for slot in REVIEW_SCOPES
    ]


def review_rules(
    mode: str, *, reviews: str = "reviews", sensitivity: str = "sensitivity", flags: Sequence[str], subject: Column
) -> list[C.Rule]:
    """The review gate of one candidate row; ``subject`` is the digest the reviews must bind.

    Privacy and security reviews must be approved when the bundle is checked; the candidate gate
    itself accepts ``not-applicable`` in every slot, as :func:`strict_review_rules` tightens.
    """
    rules = []
    for slot, scope in REVIEW_SCOPES.items():
        review = F.col(f"{reviews}.{slot}")
        where = f"{reviews}.{slot}"
        rules += [
            C.Rule("review-required", f"{where}.status", ~F.coalesce(review["status"].isin(list(REVIEW_STATUSES)), F.lit(False)), "required human review is not approved"),
            C.Rule("review-role", f"{where}.reviewer_role", ~review["reviewer_role"].eqNullSafe(F.lit(REVIEWER_ROLE[mode])), "reviewer role does not match the mode"),
            C.Rule("review-scope", f"{where}.review_scope", ~review["review_scope"].eqNullSafe(F.lit(scope)), "review scope does not match its slot"),
            C.Rule("review-subject", f"{where}.reviewed_subject_digest", ~review["reviewed_subject_digest"].eqNullSafe(subject), "review does not bind the candidate subject"),
        ]
    ip, vulnerability = F.col(f"{reviews}.ip"), F.col(f"{reviews}.vulnerability")
    informed = F.coalesce(vulnerability["contains_vulnerability_information"], F.lit(True))
    remedied = (vulnerability["status"] == "approved") & vulnerability["remediation_approved"]
    sensitive = F.lit(False)
    for flag in flags:
        sensitive = sensitive | F.coalesce(F.col(f"{sensitivity}.{flag}"), F.lit(True))
    return [
        *rules,
        C.Rule("ip-gate", f"{reviews}.ip", F.coalesce(ip["unpublished_invention"] | ip["patent_candidate"], F.lit(True)), "unpublished or patent-candidate material"),
        C.Rule("vulnerability-gate", f"{reviews}.vulnerability.embargo_status", ~vulnerability["embargo_status"].eqNullSafe(F.lit("not-embargoed")), "embargoed material"),
        C.implies(informed, remedied, code="vulnerability-gate", field=f"{reviews}.vulnerability", message="vulnerability material lacks approved remediation"),
        C.Rule("sensitivity-gate", sensitivity, sensitive, "candidate declares sensitive content"),
    ]


def strict_review_rules(*, reviews: str = "reviews") -> list[C.Rule]:
    """Bundle rule: the privacy and security reviews must be approved outright."""
    return [
        C.Rule("review-status", f"{reviews}.{slot}.status", ~F.col(f"{reviews}.{slot}.status").eqNullSafe(F.lit("approved")), "review must be approved")
        for slot in STRICT_REVIEWS
    ]


def lifecycle_rules(lifecycle: Column, original: Column) -> list[C.Rule]:
    """Only validated or sanitized evidence may be exported; a null side is left to the schema."""
    both = lifecycle.isNotNull() & original.isNotNull()
    early = both & ((lifecycle == "collected") | (original == "collected"))
    allowed = lifecycle.isin("validated", "sanitized") & original.isin("validated", "sanitized")
    return [
        C.Rule("lifecycle-not-validated", "evidence.lifecycle", early, "evidence must be validated before export"),
        C.Rule("lifecycle-limit", "evidence.lifecycle", both & ~early & ~allowed, "lifecycle is not accepted"),
    ]


def promote(df: DataFrame, *, lifecycle: str, history: str, event: str) -> DataFrame:
    """The lifecycle step of an export, with ``promotion_error`` (NULL when it is allowed).

    Validated evidence gets the supplied event and becomes sanitized. Sanitized evidence must
    already end in that event. The status is not touched.
    """
    state, entries = F.col(lifecycle), F.col(history)
    step = F.struct(
        F.lit("sanitized").alias("state"), F.col(event)["recorded_at"].alias("recorded_at"),
        F.col(event)["review_digest"].alias("review_digest"),
    )
    last = F.try_element_at(entries, F.lit(-1))
    same = F.coalesce(
        (last["state"] == "sanitized") & last["review_digest"].eqNullSafe(step["review_digest"])
        & last["recorded_at"].eqNullSafe(step["recorded_at"]), F.lit(False),
    )
    error = (
        F.when(state == "validated", F.lit(None).cast("string")).when((state == "sanitized") & same, F.lit(None).cast("string"))
        .when(state == "sanitized", "lifecycle-preservation").when(state == "collected", "lifecycle-not-validated")
        .otherwise("lifecycle-limit")
    )
    promoted = F.when(state == "validated", F.array_append(entries, step).cast(_HISTORY)).otherwise(entries.cast(_HISTORY))
    return df.withColumn("promotion_error", error).withColumn(history, promoted).withColumn(
        lifecycle, F.when(F.col("promotion_error").isNull(), F.lit("sanitized")).otherwise(state)
    )


def apply_omissions(
    df: DataFrame, *, requested: str, fields: Mapping[str, str], rules: Sequence[Mapping[str, str]] = OMISSION_RULES
) -> DataFrame:
    """Blank the array columns that permitted omission requests name, and log them without values.

    ``requested`` is an array of (path, rule_id, human_review_digest); ``fields`` maps a path to the
    column it blanks. Adds ``omission_log`` and ``omission_error`` (a request no rule permits).
    """
    asked = F.col(requested)

    def matching(request: Column, rule: Mapping[str, str]) -> Column:
        return F.coalesce((request["path"] == rule["path"]) & (request["rule_id"] == rule["rule_id"]), F.lit(False))

    def permitted(request: Column) -> Column:
        ok = F.lit(False)
        for rule in rules:
            ok = ok | matching(request, rule)
        return ok

    def entry(request: Column) -> Column:
        def pick(name: str) -> Column:
            value = F.lit(None).cast("string")
            for rule in rules:
                value = F.when(matching(request, rule), rule[name]).otherwise(value)
            return value.alias(name)

        return F.struct(
            request["path"].alias("path"), request["rule_id"].alias("rule_id"), pick("category"), pick("action"),
            request["human_review_digest"].alias("human_review_digest"),
        )

    out = df.withColumn(
        "omission_error", F.when(F.exists(asked, lambda r: ~permitted(r)), F.lit("omission-rule"))
    ).withColumn("omission_log", normalize_omissions(F.transform(F.filter(asked, permitted), entry)))

    def named(path: str) -> Column:
        return F.exists(asked, lambda r: permitted(r) & (r["path"] == path))

    for path, column in fields.items():
        kind = df.schema[column].dataType.simpleString()
        out = out.withColumn(column, F.when(named(path), F.array().cast(kind)).otherwise(F.col(column)))
    return out


def text_columns(candidates: DataFrame, key: str) -> list[str]:
    """The columns of a candidate, but its key, that hold text at any depth."""
    return [f.name for f in candidates.schema.fields if f.name != key and holds_text(f.dataType)]


def _in_column(name: Column) -> Callable[[Column], Column]:
    return lambda value: F.struct(name.alias("column"), value.alias("value"))


def _is_sensitive(leaf: Column) -> Column:
    return sensitive_class_of_form(leaf["value"]).isNotNull()


def scan_candidates(candidates: DataFrame, key: str, *, json: Sequence[str] = (), output: str = "sensitive_columns") -> DataFrame:
    """Adds the columns in which some string leaf, in any decoded form, holds a sensitive value; an empty array if none does.

    Every column but ``key`` is walked, those of ``json`` as texts and as the strings that they hold at any depth. A row's different
    leaves are tried all at once; in rows where something may be found, and in other forms, one by one, inside the row, and reduced to
    the columns they are in: one pass over the candidates, without an exchange, a join or an action. Only leaves that NFKC
    can change are sent to Python.
    """
    pair = "array<struct<column:string,value:string>>"
    nothing = F.array().cast(pair)
    parts = []
    for name in text_columns(candidates, key):
        values = F.transform(leaf_array(F.col(f"`{name}`"), candidates.schema[name].dataType, F.lit("")), lambda leaf: leaf["value"])
        if name in json:
            values = F.concat(values, json_strings(F.col(f"`{name}`")))
        parts.append(F.transform(F.filter(values, lambda v: v.isNotNull()), _in_column(F.lit(name))).cast(pair))
    leaves = F.filter(F.array_distinct(F.concat(nothing, *parts)), lambda p: ~is_exempt(p["value"]))
    walked = candidates.withColumn("__leaves", leaves)
    walked = walked.withColumn("__changed", F.filter("__leaves", lambda p: may_change_in_nfkc(p["value"])))
    normal = nfkc_each(F.when(F.size("__changed") > 0, F.transform("__changed", lambda p: p["value"])))
    paired = F.zip_with("__changed", normal, lambda p, value: F.struct(p["column"].alias("column"), value.alias("value")))
    walked = walked.withColumn("__normal", F.filter(F.coalesce(paired, nothing), lambda p: p["value"].isNotNull()))
    decoded = F.flatten(F.transform("__leaves", lambda p: F.transform(decodings(p["value"]), _in_column(p["column"]))))
    walked = walked.withColumn("__forms", F.concat(decoded.cast(pair), "__normal"))
    joined = F.concat(F.lit("\n"), F.array_join(F.transform("__leaves", lambda p: p["value"]), "\n"))
    raw = F.when(may_hold_sensitive_line(joined), F.filter("__leaves", _is_sensitive)).otherwise(nothing)
    found = F.transform(F.concat(raw, F.filter("__forms", _is_sensitive)), lambda p: p["column"])
    return walked.select(*[F.col(f"`{c}`") for c in candidates.columns], F.array_sort(F.array_distinct(found)).alias(output))


def sensitive_rules(columns: Sequence[str], scanned: str = "sensitive_columns") -> list[C.Rule]:
    """No column holds a sensitive value, for rows of :func:`scan_candidates`: a rule for each of ``columns``, and one for any other column that was found."""
    other = F.size(F.array_except(F.col(scanned), F.array(*[F.lit(c) for c in columns]).cast("array<string>"))) > 0
    return [
        *[C.Rule("sensitive-value", c, F.coalesce(F.array_contains(scanned, c), F.lit(True)), "prohibited public value") for c in columns],
        C.Rule("sensitive-value", "$", F.coalesce(other, F.lit(True)), "prohibited public value"),
    ]


def path_rules(paths: str, *, code: str = "path-boundary") -> list[C.Rule]:
    """Every path of an array is relative and stays under its root: no scheme or drive, backslash, control character or ``..``."""
    leaves = r"^[/~]|^[A-Za-z][A-Za-z0-9+.-]*:|\\|[\x00-\x1F]|(^|/)\.\.(/|\z)|^\z"
    return [C.Rule(code, paths, F.col(paths).isNull() | F.coalesce(F.exists(paths, lambda p: F.coalesce(p.rlike(leaves), F.lit(True))), F.lit(True)), "path leaves the root")]


def strict_parse_rules(raw: str, *, code: str = "schema") -> list[C.Rule]:
    """Text that is not one JSON value, or has a member twice."""
    return [C.Rule(code, raw, F.try_parse_json(F.col(raw)).isNull(), f"{raw}: text is not strict JSON")]


def field_name_rules(raw: str, *, code: str = "allowlist") -> list[C.Rule]:
    """A prohibited member name at any depth of a JSON text that parses."""
    names = F.when(F.try_parse_json(F.col(raw)).isNotNull(), member_names(F.col(raw)))
    return [C.Rule(code, "$", F.coalesce(F.arrays_overlap(names, F.array(*[F.lit(n) for n in PROHIBITED_FIELDS])), F.lit(False)), "a prohibited field name is present")]


def digest_rules(recorded: str, recomputed: Column, *, code: str = "digest-binding") -> list[C.Rule]:
    """The recorded digest is the one computed anew."""
    return [C.Rule(code, recorded, ~F.col(recorded).eqNullSafe(recomputed), "digest is not the one computed anew")]


def earliest_failure(rules: Sequence[C.Rule]) -> Column:
    """(stage, code, field) of the first failing rule of a row, NULL if none fails; no shuffle."""
    failures = []
    for rule in rules:
        bad = F.coalesce(F.size(rule.messages) > 0 if rule.messages is not None else rule.bad, F.lit(False))
        failures.append(F.when(bad, F.struct(F.lit(rule.stage).alias("stage"), F.lit(rule.code).alias("code"), F.lit(rule.field).alias("field"))))
    return F.get(F.array_sort(F.array_compact(F.array(*failures))), F.lit(0))


def export_bundle(
    candidates: DataFrame, rules: Sequence[C.Rule], *, key: str, mode: str, interface: str, digest_columns: Sequence[str],
    artifacts: str = "public_artifacts", omissions: str = "omissions",
) -> DataFrame:
    """One row per candidate: ``failure`` (stage, code, field) or a bundle; one pass over the candidates.

    Columns used: ``status``, ``lifecycle``, ``lifecycle_history``, ``event``, ``original_status``,
    ``original_lifecycle``, ``reviews`` and the named ones. A candidate with a failing rule has its earliest failure and a
    NULL ``bundle``; every other one has a bundle with its sanitisation report, review provenance, publication state (never
    published) and digests. The report lists the checks that the given rules name, and those of the export's own
    rules; if they are not the ones that mode and interface require, every candidate fails.
    """
    asked = F.col(omissions)
    before = candidates.withColumn("candidate_digest", row_digest(
        {**{c: F.col(c).cast("string") for c in digest_columns}, artifacts: normalize_set(F.col(artifacts)),
         omissions: normalize_omissions(asked)}, "export-candidate/v1"))
    done = promote(before, lifecycle="lifecycle", history="lifecycle_history", event="event")
    done = apply_omissions(done, requested=omissions, fields={r["path"]: artifacts for r in OMISSION_RULES})
    own = [
        *at_stage("omissions", [C.Rule("omission-rule", omissions, F.col("omission_error").isNotNull(), "omission is not permitted")]),
        *at_stage("promotion", [C.Rule("promotion", "lifecycle", F.col("promotion_error").isNotNull(), F.col("promotion_error"))], ["lifecycle-limit"]),
        *at_stage("promotion", [C.Rule("status-preservation", "status", ~F.col("status").eqNullSafe(F.col("original_status")), "status changed")], ["status-preservation"]),
    ]
    staged = [*rules, *own]
    ran = F.array(*[F.lit(c) for c in sorted({c for rule in staged for c in rule.checks})])
    staged += at_stage("report", [C.reported_checks(ran, required_checks(F.lit(mode), F.lit(interface)))])
    judged = done.withColumn("failure", earliest_failure(staged))
    provenance = F.array(*[
        F.struct(
            F.lit(scope).alias("scope"),
            *[F.col(f"reviews.{slot}")[n].alias(n) for n in ("status", "reviewer_role", "review_digest", "reviewed_subject_digest")],
        )
        for slot, scope in REVIEW_SCOPES.items()
    ])
    exported = row_digest(
        {"id": F.col(key).cast("string"), "status": F.col("status"), "lifecycle": F.col("lifecycle"),
         "history": F.col("lifecycle_history"), "artifacts": normalize_set(F.col(artifacts))}, "exported-evidence/v1",
    )
    report = F.struct(
        F.lit("exported").alias("outcome"), ran.alias("checks_executed"),
        F.col("original_status").alias("input_status"), F.col("status").alias("output_status"),
        F.col("original_lifecycle").alias("input_lifecycle"), F.col("lifecycle").alias("output_lifecycle"),
    )
    parts = judged.select(
        key, "failure", "candidate_digest", exported.alias("evidence_digest"), report.alias("report"), F.col("omission_log").alias("omissions"),
        provenance.alias("review_provenance"),
    )
    sealed = row_digest(
        {"id": F.col(key).cast("string"), "candidate": F.col("candidate_digest"), "evidence": F.col("evidence_digest"),
         "report": F.col("report"), "omissions": F.col("omissions"), "reviews": F.col("review_provenance")}, "export-bundle/v1")
    bundle = F.struct(
        F.lit(ARTIFACT_STATUS[mode]).alias("artifact_status"), "candidate_digest", "evidence_digest", sealed.alias("bundle_digest"), "report", "omissions",
        "review_provenance", F.lit(FINAL_APPROVAL[mode]).alias("final_publication_approval"),
        F.struct(F.lit(PUBLICATION[mode]).alias("status"), F.lit(False).alias("automation_permitted")).alias("publication"),
    )
    return parts.select(key, "failure", F.when(F.col("failure").isNull(), bundle).alias("bundle"))
