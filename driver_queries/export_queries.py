"""Review gates, promotion, omissions, derived evidence and exported bundles."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.registry import query, scan_partitions, table
from ledgerloom.functions.digest import content_digest, row_digest
from ledgerloom.operators import contracts as C
from ledgerloom.operators.findings import first_failure
from ledgerloom.plans import export as E
from ledgerloom.plans import packages as P
from ledgerloom.sources.tables import read_for_scan

_FLAGS = ("contains_secret", "contains_customer_data")


def _review(scope: str, status: Column, role: Column, subject: Column, **extra: Column) -> Column:
    return F.struct(
        status.alias("status"), role.alias("reviewer_role"), F.lit(f"digest-{scope}").alias("review_digest"),
        F.lit(scope).alias("review_scope"), subject.alias("reviewed_subject_digest"), *[v.alias(k) for k, v in extra.items()],
    )


def _subject() -> Column:
    """The digest of a candidate's material, recomputed from the order itself."""
    return E.review_subject({"order": F.col("o_orderkey").cast("string"), "owner": F.col("o_custkey").cast("string")})


_SUBJECT_SQL = """'sha256:' || sha256('review-subject/v1' || chr(0) || '{"order":"' || o_orderkey || '","owner":"' || o_custkey || '"}')"""


def _record() -> Column:
    """The digest of the record that a candidate binds, recomputed from the order."""
    return row_digest({"order": F.col("o_orderkey").cast("string"), "owner": F.col("o_custkey").cast("string")}, "bound-record/v1")


#: The profile and the exporter's manifest in force, and the digests that candidates recorded of them.
_PROFILE = json.dumps({"allowed": ["owner"], "omissions": [r["rule_id"] for r in E.OMISSION_RULES], "prohibited": E.PROHIBITED_FIELDS}, sort_keys=True)
_MANIFEST = json.dumps({"checks": sorted((*E.COMMON_CHECKS, *E.INTERFACE_CHECKS["staged-file"])), "stages": E.STAGES}, sort_keys=True)
_PINNED = {
    "profile": "sha256:e686f550ccb4fd3cfd07b9543cebcea34ada510b80022b726736641dd56656b1",
    "manifest": "sha256:1ad277dab739f61eb19786494cb34adf4fb97d7c66fbe7ee2d290ea71deaff22",
}


def _candidates(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Orders as export candidates: every fault comes from a property of the order. With ``partitions``, dealt out for a scan of their texts."""
    status, priority, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    subject = _subject()
    human = F.lit("authorized-human")
    approved = F.lit("approved")
    reviews = F.struct(
        _review("privacy", F.when(price > 480000, "rejected").otherwise(approved), human, subject).alias("privacy"),
        _review("security-boundary", approved, F.when(price < 10000, "synthetic-reviewer").otherwise(human), subject).alias("security_boundary"),
        _review(
            "ip", F.lit("not-applicable"), human, F.when(price.between(10000, 20000), "other").otherwise(subject),
            unpublished_invention=price.between(20000, 25000), patent_candidate=F.lit(False),
        ).alias("ip"),
        _review(
            "vulnerability", F.when(price.between(30000, 60000), "not-applicable").otherwise(approved), human, subject,
            contains_vulnerability_information=price.between(25000, 35000), remediation_approved=F.lit(True),
            embargo_status=F.when(price.between(35000, 38000), "embargoed").otherwise("not-embargoed"),
        ).alias("vulnerability"),
    )
    lifecycle = (
        F.when(priority == "5-LOW", "published").when(status == "F", "validated").when(status == "O", "sanitized").otherwise("collected")
    )
    entry = "struct<state:string,recorded_at:string,review_digest:string>"
    event = F.struct(F.lit("2026-01-03T00:00:00Z").alias("recorded_at"), F.lit("event").alias("review_digest"))

    def step(state: str, at: Column, review: Column) -> Column:
        return F.struct(F.lit(state).alias("state"), at.alias("recorded_at"), review.alias("review_digest")).cast(entry)

    none = F.lit(None).cast("string")
    base = F.array(step("collected", F.lit("2026-01-01T00:00:00Z"), none), step("validated", F.lit("2026-01-02T00:00:00Z"), F.lit("first")))
    other = F.when(priority == "4-NOT SPECIFIED", "other").otherwise("event")
    history = F.when(status == "O", F.array_append(base, step("sanitized", F.lit("2026-01-03T00:00:00Z"), other))).otherwise(base)
    request = "array<struct<path:string,rule_id:string,human_review_digest:string>>"

    def asking(rule: str) -> Column:
        return F.array(
            F.struct(
                F.lit("$.evidence_record.public_artifacts").alias("path"), F.lit(rule).alias("rule_id"), F.lit("h").alias("human_review_digest")
            )
        ).cast(request)

    omissions = (
        F.when(priority == "1-URGENT", asking("OMIT-PUBLIC-ARTIFACTS")).when(priority == "2-HIGH", asking("OMIT-ANYTHING"))
        .otherwise(F.array().cast(request))
    )
    code = F.upper(F.hex(F.col("o_orderkey")))
    orders = read_for_scan(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"], "o_orderkey", partitions)
    return orders.select(
        F.concat(F.lit("PM-EXPORT-CANDIDATE-"), F.lpad(code, 32, "0")).alias("candidate_id"),
        F.when(price > 250000, "pass").otherwise("fail").alias("status"), F.when(price > 260000, "pass").otherwise("fail").alias("original_status"),
        lifecycle.alias("lifecycle"), lifecycle.alias("original_lifecycle"), history.alias("lifecycle_history"), event.alias("event"),
        reviews.alias("reviews"), F.struct(*[(price.between(60000, 61000 + 1000 * i)).alias(n) for i, n in enumerate(_FLAGS)]).alias("sensitivity"),
        F.array(F.when(price.between(119000, 120000) & (priority != "1-URGENT"), "../escape").otherwise(F.col("o_orderstatus")), "o_orderpriority").alias("public_artifacts"),
        omissions.alias("omissions"), "o_custkey", F.concat(F.lit('{"owner": '), F.col("o_custkey").cast("string"), F.lit("}")).alias("raw"),
        F.when(price.between(110000, 111000), "see /home/ops/run.log").otherwise(F.concat(F.lit("order of priority "), priority)).alias("note"),
        F.when(price.between(112000, 113000), F.lit(None)).otherwise(_record()).alias("bound_record"), "o_orderkey",
        F.concat(F.lit('{"priority": "'), priority, F.when(price.between(115000, 116000), '", "more": 1}').otherwise('"}')).alias("configuration"),
        F.when(price.between(121000, 122000), "unreviewed").when(price > 250000, "pass").otherwise("fail").alias("reviewed_status"),
        F.when(price.between(123000, 124000), "sha256:old").otherwise(_PINNED["profile"]).alias("profile_digest"),
        F.when(price.between(125000, 126000), "sha256:old").otherwise(_PINNED["manifest"]).alias("manifest_digest"), price.alias("price"),
    ).withColumn("raw", F.when(F.col("price").between(113001, 114000), F.lit('{"owner": ')).when(F.col("price").between(117000, 118000), F.concat(F.lit('{"owner": "'), F.repeat(F.lit("long "), 60), F.lit('"}')))
        .when(F.col("note").startswith("see"), F.col("raw")).when(F.col("o_custkey") % 97 == 0, F.lit('{"owner": 1, "email": "x"}')).otherwise(F.col("raw"))).drop("price")


def _review_rules() -> list[C.Rule]:
    return E.review_rules(E.CANDIDATE_MODE, flags=_FLAGS, subject=_subject())


_REVIEW_SQL = """
    SELECT o_orderkey, 'review-required' AS code, 'reviews.privacy.status' AS field FROM orders WHERE o_totalprice > 480000
    UNION ALL SELECT o_orderkey, 'review-role', 'reviews.security_boundary.reviewer_role' FROM orders WHERE o_totalprice < 10000
    UNION ALL SELECT o_orderkey, 'review-subject', 'reviews.ip.reviewed_subject_digest' FROM orders WHERE o_totalprice BETWEEN 10000 AND 20000
    UNION ALL SELECT o_orderkey, 'ip-gate', 'reviews.ip' FROM orders WHERE o_totalprice BETWEEN 20000 AND 25000
    UNION ALL SELECT o_orderkey, 'vulnerability-gate', 'reviews.vulnerability.embargo_status' FROM orders WHERE o_totalprice BETWEEN 35000 AND 38000
    UNION ALL SELECT o_orderkey, 'vulnerability-gate', 'reviews.vulnerability' FROM orders WHERE o_totalprice BETWEEN 30000 AND 35000
    UNION ALL SELECT o_orderkey, 'sensitivity-gate', 'sensitivity' FROM orders WHERE o_totalprice BETWEEN 60000 AND 62000
"""


@query(_REVIEW_SQL)
def q_review_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review gate of every candidate, each failing rule."""
    found = C.check(_candidates(spark, sf_dir), _review_rules(), path=F.col("o_orderkey"), key=F.col("o_orderkey"), keep=["o_orderkey"])
    return found.select("o_orderkey", "code", "field")


@query(
    """
    SELECT o_orderkey,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'lifecycle-limit' WHEN o_orderstatus = 'P' THEN 'lifecycle-not-validated'
           WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'lifecycle-preservation' END AS promotion_error,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'published' WHEN o_orderstatus = 'P' THEN 'collected' ELSE 'sanitized' END AS lifecycle,
      CASE WHEN o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_orderpriority <> '5-LOW') THEN 3 ELSE 2 END AS entries,
      CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'other'
           WHEN o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_orderpriority <> '5-LOW') THEN 'event' ELSE 'first' END AS last_review
    FROM orders
    """
)
def q_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lifecycle step of an export."""
    done = E.promote(_candidates(spark, sf_dir), lifecycle="lifecycle", history="lifecycle_history", event="event")
    last = F.try_element_at("lifecycle_history", F.lit(-1))["review_digest"]
    return done.select("o_orderkey", "promotion_error", "lifecycle", F.size("lifecycle_history").alias("entries"), last.alias("last_review"))


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN 'omission-rule' END AS omission_error,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 2 END AS artifacts,
           CASE WHEN o_orderpriority = '1-URGENT' THEN '[{"path":"$.evidence_record.public_artifacts","rule_id":"OMIT-PUBLIC-ARTIFACTS",'
             || '"category":"optional-public-reference","action":"omitted-by-profile","human_review_digest":"h"}]' ELSE '[]' END AS log
    FROM orders
    """
)
def q_omissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permitted omissions blank a field and are logged without its value."""
    done = E.apply_omissions(
        _candidates(spark, sf_dir), requested="omissions", fields={"$.evidence_record.public_artifacts": "public_artifacts"}
    )
    return done.select(
        "o_orderkey", "omission_error", F.size("public_artifacts").alias("artifacts"), F.to_json("omission_log").alias("log")
    )


_PRODUCERS = ("ci", "test-runner", "formal-tool", "security-tool", "human-review", "ci", "test-runner")
_REQUIREMENTS = {f"tool-{n}": "required" if n <= 2 else "optional" for n in range(1, 8)}
_LINE_STATUS = "CASE WHEN l_quantity > 46 THEN 'fail' WHEN l_discount < 0.01 THEN 'skip' WHEN l_tax > 0.07 THEN 'unsupported' ELSE 'pass' END"


def _bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as producer records, orders as packages with seven tool bindings each."""
    text = lambda prefix, *names: F.concat_ws("-", F.lit(prefix), *names)
    number = F.col("l_linenumber")
    producer = F.try_element_at(F.array(*[F.lit(p) for p in _PRODUCERS]), number)
    records = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("package_id"), F.concat(F.lit("tool-"), number.cast("string")).alias("tool_id"),
        text("e", "l_orderkey", "l_linenumber", "l_partkey").alias("evidence_id"), producer.alias("producer_type"), F.lit("producer").alias("producer_id"),
        F.expr(_LINE_STATUS).alias("status"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("started_at"),
        F.lit("2026-01-01T00:00:00Z").alias("completed_at"), text("case", "l_partkey").alias("case_digest"), text("in", "l_suppkey").alias("input_digest"),
        F.lit("impl").alias("implementation_digest_product"), F.lit("art").alias("artifact_digest"), text("out", "l_partkey").alias("output_digest"),
        F.lit("summary").alias("summary"), F.array(text("limit", "l_returnflag"), F.lit("mode")).alias("limitations"),
    )
    orders = table(spark, sf_dir, "orders")
    roles = F.explode(F.array(*[F.lit(r) for r in _REQUIREMENTS])).alias("tool_role_id")
    bindings = orders.select(F.col("o_orderkey").alias("package_id"), "o_orderpriority", roles).select(
        "package_id", "tool_role_id", text("id", "tool_role_id").alias("identity"), F.lit("1.0").alias("version"),
        text("impl", "tool_role_id", "o_orderpriority").alias("implementation_digest"), F.lit("in/1").alias("input_contract"),
        F.lit("out/1").alias("output_contract"), text("b", "package_id", "tool_role_id").alias("binding_digest"),
    )
    packages = orders.select(
        F.col("o_orderkey").alias("package_id"), text("p", "o_orderkey").alias("package_digest"), F.lit("2026-02-01T00:00:00Z").alias("validated_at"),
        text("s", "o_custkey").alias("subject"), F.lit("suite").alias("suite_digest"),
    )
    return P.bound_records(records, bindings, packages)


@query(
    f"""
    SELECT 'e-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id,
           ['test', 'conformance', 'proof-check', 'security-scan', 'review', 'test', 'conformance'][l_linenumber] AS type, s AS status,
           s NOT IN ('skip', 'unsupported') AS ran, l_linenumber <= 2 AS required, CASE WHEN s IN ('skip', 'unsupported') THEN 'limit-' || l_returnflag END AS reason,
           'suite,case-' || l_partkey || ',in-' || l_suppkey || ',impl,art' AS inputs,
           'collected ' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') || ' ; validated 2026-02-01T00:00:00Z p-' || l_orderkey AS history,
           CASE WHEN l_linenumber = 5 THEN 'human-review' ELSE 'local-runner' END AS producer, 'impl-tool-' || l_linenumber || '-' || o_orderpriority AS source,
           's-' || o_custkey AS subject
    FROM (SELECT *, {_LINE_STATUS} AS s FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
    """
)
def q_derive_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence rows derived from producer records, tool bindings and packages."""
    derived = P.derive_evidence(_bound(spark, sf_dir), _REQUIREMENTS)
    steps = F.transform("lifecycle_history", lambda h: F.concat_ws(" ", h["state"], h["recorded_at"], h["review_digest"]))
    return derived.select(
        "id", "type", "status", "execution.ran", "execution.required", "execution.reason", F.array_join("input_digests", ",").alias("inputs"),
        F.array_join(steps, " ; ").alias("history"), F.col("producer.type").alias("producer"), "tool.source", "subject",
    )


_PRODUCER_SQL = "['" + "', '".join(_PRODUCERS) + "'][l_linenumber]"


@query(
    f"""
    SELECT l_orderkey AS package_id, 'e-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS evidence_id, {_PRODUCER_SQL} AS producer_type,
           'producer' AS producer_id, 'tool-' || l_linenumber AS tool_role_id, 'id-tool-' || l_linenumber AS tool_identity, '1.0' AS tool_version,
           'impl-tool-' || l_linenumber || '-' || o_orderpriority AS implementation_digest, 'b-' || l_orderkey || '-tool-' || l_linenumber AS binding_digest,
           {_LINE_STATUS} AS status
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """
)
def q_producer_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who produced which record with which tool."""
    return P.producer_inventory(_bound(spark, sf_dir))


@query(
    f"""
    SELECT 'e-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS evidence_id, 'tool-binding' AS code, 'tool_version' AS field
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 7
    UNION ALL
    SELECT 'e-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey, 'package-time', 'created_at'
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 6
    """
)
def q_record_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer records against their tool binding and the package's times."""
    tool = F.col("tool_id")
    bound = _bound(spark, sf_dir).withColumns({
        "tool_identity": F.col("identity"), "tool_version": F.when(tool == "tool-7", "2.0").otherwise(F.col("version")),
        "tool_implementation_digest": F.col("implementation_digest"), "created_at": F.when(tool == "tool-6", "2025-01-01T00:00:00Z").otherwise("2026-01-15T00:00:00Z"),
    })
    found = C.check(bound, P.record_rules(), path=F.col("evidence_id"), key=F.col("evidence_id"), keep=["evidence_id"])
    return found.select("evidence_id", "code", "field")


_ALLOWED_SQL = " OR ".join(f"(need = '{k}' AND NOT list_contains({list(v)}, behaviour))" for k, v in P.ABSENCE_BEHAVIOR.items())
_BEHAVIOURS = sorted({b for v in P.ABSENCE_BEHAVIOR.values() for b in v})
_NEEDS = sorted(P.ABSENCE_BEHAVIOR)


@query(
    f"""
    SELECT o_orderkey, 'absence-behavior' AS code
    FROM (SELECT o_orderkey, {_NEEDS}[1 + o_orderkey % {len(_NEEDS)}] AS need, {_BEHAVIOURS}[1 + o_custkey % {len(_BEHAVIOURS)}] AS behaviour FROM orders)
    WHERE {_ALLOWED_SQL}
    """
)
def q_absence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a tool policy does in a tool's absence must fit how much the tool is needed."""
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (F.lit(1) + n % len(values)).cast("int"))
    policies = table(spark, sf_dir, "orders").select(
        "o_orderkey", pick(_NEEDS, F.col("o_orderkey")).alias("requirement"), pick(_BEHAVIOURS, F.col("o_custkey")).alias("absence_behavior")
    )
    return C.check(policies, P.absence_rules(), path=F.col("o_orderkey"), key=F.col("o_orderkey"), keep=["o_orderkey"]).select("o_orderkey", "code")


_LANE_SQL = " ".join(f"WHEN '{k}' THEN '{'|'.join(v)}'" for k, v in P.LANE.items())


@query(
    f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS claim_id, CASE {_PRODUCER_SQL} {_LANE_SQL} END AS entry, {_LINE_STATUS} AS status,
           'implementation/impl-tool-' || l_linenumber || '-' || o_orderpriority AS lineage
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """
)
def q_lane_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lane entries of the bound records."""
    entries = P.lane_entries(_bound(spark, sf_dir), F.col("package_id").cast("string"))
    return entries.select("claim_id", F.concat_ws("|", "lane", "kind", "source_kind").alias("entry"), "status", "lineage")


def _scanned(candidates: DataFrame) -> DataFrame:
    return E.scan_candidates(candidates, "o_orderkey", json=["raw", "configuration"])


def _staged_rules(columns: list[str]) -> list[C.Rule]:
    """Every stage of an export, each rule with the checks that it carries out. ``columns``: those that were scanned."""
    mode = F.lit(E.CANDIDATE_MODE)
    return [
        *E.at_stage("lifecycle", E.lifecycle_rules(F.col("lifecycle"), F.col("original_lifecycle")), ["lifecycle-limit"]),
        *E.at_stage("candidate-id", [C.matches_by("candidate_id", mode, E.CANDIDATE_IDS, code="candidate-id")], ["candidate-schema"]),
        *E.at_stage("schema", C.require("o_orderkey", "status", "lifecycle"), ["evidence-schema"]),
        *E.at_stage("schema", E.strict_parse_rules("raw"), ["strict-input-parse"]),
        *E.at_stage("schema", [*E.strict_parse_rules("configuration"), *C.closed_fields("configuration", ["priority"], exact=True)], ["closed-configuration"]),
        *E.at_stage("schema", [C.one_of("status", ["pass", "fail"])], ["evidence-schema"]),
        *E.at_stage("schema", [C.text_length("raw", 2, 200)], ["input-size"]),
        *E.at_stage("allowlist", C.closed_fields("raw", ["owner"], code="allowlist"), ["allowlist"]),
        *E.at_stage("allowlist", E.field_name_rules("raw"), ["prohibited-field-scan"]),
        *E.at_stage("evidence", C.array_shape("public_artifacts", at_most=8, code="evidence")),
        *E.at_stage("evidence", E.path_rules("public_artifacts"), ["path-boundary"]),
        *E.at_stage("bindings", E.digest_rules("bound_record", _record()), ["digest-bindings"]),
        *E.at_stage("bindings", E.digest_rules("profile_digest", content_digest(F.lit(_PROFILE))), ["export-profile-binding"]),
        *E.at_stage("bindings", E.digest_rules("manifest_digest", content_digest(F.lit(_MANIFEST))), ["exporter-implementation-manifest"]),
        *E.at_stage("values", E.sensitive_rules(columns), ["prohibited-value-scan"]),
        *E.at_stage("reviews", _review_rules(), ["review-gates", "review-subject-binding"]),
        *E.at_stage("reviews", [C.Rule("review-status-parity", "reviewed_status", ~F.col("reviewed_status").eqNullSafe(F.col("status")), "status is not the reviewed one")], ["review-status-parity"]),
        *E.at_stage("mode", [*E.fixture_review_rules(E.CANDIDATE_MODE), *E.strict_review_rules()], ["trusted-execution-mode"]),
    ]


_FAILURES_SQL = f"""
    SELECT o_orderkey, 1 AS stage, CASE WHEN o_orderpriority <> '5-LOW' THEN 'lifecycle-not-validated' ELSE 'lifecycle-limit' END AS code,
           'evidence.lifecycle' AS field FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'
    UNION ALL SELECT o_orderkey, 4, 'allowlist', '$' FROM orders WHERE o_custkey % 97 = 0 AND o_totalprice NOT BETWEEN 110000 AND 111000
    UNION ALL SELECT o_orderkey, 3, 'schema', 'raw' FROM orders WHERE o_totalprice BETWEEN 113001 AND 114000 OR o_totalprice BETWEEN 117000 AND 118000
    UNION ALL SELECT o_orderkey, 3, 'schema', '$' FROM orders WHERE o_totalprice BETWEEN 115000 AND 116000
    UNION ALL SELECT o_orderkey, 5, 'path-boundary', 'public_artifacts' FROM orders WHERE o_totalprice BETWEEN 119000 AND 120000 AND o_orderpriority <> '1-URGENT'
    UNION ALL SELECT o_orderkey, 6, 'digest-binding', 'profile_digest' FROM orders WHERE o_totalprice BETWEEN 123000 AND 124000
    UNION ALL SELECT o_orderkey, 6, 'digest-binding', 'manifest_digest' FROM orders WHERE o_totalprice BETWEEN 125000 AND 126000
    UNION ALL SELECT o_orderkey, 8, 'review-status-parity', 'reviewed_status' FROM orders WHERE o_totalprice BETWEEN 121000 AND 122000
    UNION ALL SELECT o_orderkey, 6, 'digest-binding', 'bound_record' FROM orders WHERE o_totalprice BETWEEN 112000 AND 113000
    UNION ALL SELECT o_orderkey, 7, 'sensitive-value', 'note' FROM orders WHERE o_totalprice BETWEEN 110000 AND 111000
    UNION ALL SELECT o_orderkey, 8, code, field FROM ({_REVIEW_SQL})
"""


@query(
    f"""
    SELECT o_orderkey, stage, code, field FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY stage, code, field) AS n FROM ({_FAILURES_SQL})) WHERE n = 1
    """
)
def q_first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the earliest failing stage of every candidate."""
    candidates = _candidates(spark, sf_dir, scan_partitions(spark))
    rules = _staged_rules(E.text_columns(candidates, "o_orderkey"))
    found = C.check(_scanned(candidates), rules, path=F.col("o_orderkey"), key=F.col("o_orderkey"), keep=["o_orderkey"])
    return first_failure(found, ["o_orderkey"], "stage", ["code", "field"])


_STEP_SQL = "'{{\"state\":\"{0}\",\"recorded_at\":\"{1}\",\"review_digest\":{2}}}'"
_HISTORY_SQL = "'[' || " + " || ',' || ".join((
    _STEP_SQL.format("collected", "2026-01-01T00:00:00Z", "null"), _STEP_SQL.format("validated", "2026-01-02T00:00:00Z", '"first"'),
    _STEP_SQL.format("sanitized", "2026-01-03T00:00:00Z", '"event"'),
)) + " || ']'"
_ASKED_SQL = """CASE WHEN o_orderpriority = '1-URGENT'
  THEN '[{"path":"$.evidence_record.public_artifacts","rule_id":"OMIT-PUBLIC-ARTIFACTS","human_review_digest":"h"}]' ELSE '[]' END"""
_LOG_SQL = """CASE WHEN o_orderpriority = '1-URGENT' THEN '[{"path":"$.evidence_record.public_artifacts","rule_id":"OMIT-PUBLIC-ARTIFACTS",'
  || '"category":"optional-public-reference","action":"omitted-by-profile","human_review_digest":"h"}]' ELSE '[]' END"""
_CHECKS_SQL = "[" + ",".join(f'"{c}"' for c in sorted((*E.COMMON_CHECKS, *E.INTERFACE_CHECKS["staged-file"]))) + "]"


def _digest_sql(domain: str, text: str) -> str:
    return f"'sha256:' || sha256('{domain}' || chr(0) || {text})"


@query(
    f"""
    WITH f AS (
      SELECT * FROM ({_FAILURES_SQL})
      UNION ALL SELECT o_orderkey, 10, 'omission-rule', 'omissions' FROM orders WHERE o_orderpriority = '2-HIGH'
      UNION ALL SELECT o_orderkey, 11, 'promotion', 'lifecycle' FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED'
      UNION ALL SELECT o_orderkey, 11, 'status-preservation', 'status' FROM orders WHERE o_totalprice > 250000 AND o_totalprice <= 260000),
    e AS (SELECT o_orderkey, stage, code, field FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY stage, code, field) AS n FROM f) WHERE n = 1),
    c AS (
      SELECT o_orderkey, e.stage, e.code, e.field, o_orderpriority = '1-URGENT' AS omitted, CASE WHEN o_totalprice > 250000 THEN 'pass' ELSE 'fail' END AS status,
             CASE WHEN o_orderstatus = 'F' THEN 'validated' ELSE 'sanitized' END AS lifecycle, {_SUBJECT_SQL} AS subject,
             CASE WHEN o_totalprice BETWEEN 30000 AND 60000 THEN 'not-applicable' ELSE 'approved' END AS vulnerability,
             {_ASKED_SQL} AS asked, {_LOG_SQL} AS log, '["' || o_orderpriority || '","' || o_orderstatus || '"]' AS artifacts, o_custkey,
             'PM-EXPORT-CANDIDATE-' || lpad(upper(to_hex(o_orderkey)), 32, '0') AS candidate_id
      FROM orders LEFT JOIN e USING (o_orderkey)),
    d AS (
      SELECT *, {_digest_sql('export-candidate/v1', """'{"candidate_id":"' || candidate_id || '","o_custkey":"' || o_custkey || '","omissions":' || asked
               || ',"public_artifacts":' || artifacts || ',"status":"' || status || '"}'""")} AS candidate_digest,
             {_digest_sql('exported-evidence/v1', f"""'{{"artifacts":' || CASE WHEN omitted THEN '[]' ELSE artifacts END || ',"history":' || {_HISTORY_SQL}
               || ',"id":"' || o_orderkey || '","lifecycle":"sanitized","status":"' || status || '"}}'""")} AS evidence_digest,
             '{{"outcome":"exported","checks_executed":{_CHECKS_SQL},"input_status":"' || status || '","output_status":"' || status || '","input_lifecycle":"'
               || lifecycle || '","output_lifecycle":"sanitized"}}' AS report,
             '[' || array_to_string(list_transform(['privacy', 'security-boundary', 'ip', 'vulnerability'], lambda s: '{{"scope":"' || s || '","status":"'
               || CASE s WHEN 'ip' THEN 'not-applicable' WHEN 'vulnerability' THEN vulnerability ELSE 'approved' END || '","reviewer_role":"authorized-human","review_digest":"digest-'
               || s || '","reviewed_subject_digest":"' || subject || '"}}'), ',') || ']' AS reviews
      FROM c)
    SELECT o_orderkey, stage, code, field, CASE WHEN stage IS NULL THEN 'candidate' END AS publication, CASE WHEN stage IS NULL THEN report END AS report,
           CASE WHEN stage IS NULL THEN candidate_digest END AS candidate_digest, CASE WHEN stage IS NULL THEN evidence_digest END AS evidence_digest,
           CASE WHEN stage IS NULL THEN {_digest_sql('export-bundle/v1', """'{"candidate":"' || candidate_digest || '","evidence":"' || evidence_digest || '","id":"' || o_orderkey
             || '","omissions":' || log || ',"report":' || report || ',"reviews":' || reviews || '}'""")} END AS bundle_digest
    FROM d
    """
)
def q_export_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bundle of every accepted candidate, with its digests and the checks that ran, or the failing stage."""
    candidates = _candidates(spark, sf_dir, scan_partitions(spark))
    exported = E.export_bundle(
        _scanned(candidates), _staged_rules(E.text_columns(candidates, "o_orderkey")), key="o_orderkey", mode=E.CANDIDATE_MODE, interface="staged-file",
        digest_columns=["candidate_id", "status", "o_custkey"],
    )
    return exported.select(
        "o_orderkey", "failure.stage", "failure.code", "failure.field", F.col("bundle.publication.status").alias("publication"), F.to_json("bundle.report").alias("report"),
        "bundle.candidate_digest", "bundle.evidence_digest", "bundle.bundle_digest",
    )


@query("SELECT o_orderkey, 12 AS stage, 'sanitization-checks' AS code FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM'")
def q_export_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that pass every rule are rejected all the same when a required check did not run."""
    rules = [rule for rule in _staged_rules([]) if rule.stage == E.STAGE["candidate-id"]]
    candidates = _candidates(spark, sf_dir).withColumn("original_status", F.col("status"))
    plain = candidates.where((F.col("lifecycle") == "validated") & (F.element_at("public_artifacts", 2) == "3-MEDIUM"))
    exported = E.export_bundle(plain, rules, key="o_orderkey", mode=E.CANDIDATE_MODE, interface="staged-file", digest_columns=["candidate_id"])
    return exported.select("o_orderkey", "failure.stage", "failure.code")
