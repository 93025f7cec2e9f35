"""Counts, verdicts and judgments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.registry import query, table
from ledgerloom.operators import rollup as A
from ledgerloom.plans import packages as P

ROLES = {f"line-{n}": "required" if n <= 2 else "optional" for n in range(1, 7)}
EVENT_TYPES = ("signup", "view", "click", "purchase", "error", "refund")


@query(
    " UNION ALL ".join(
        f"SELECT user_id, '{v}' AS value, count(*) FILTER (event_type = '{v}') AS n FROM events GROUP BY user_id" for v in EVENT_TYPES
    )
)
def q_vocabulary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: events per user and type, zero-filled over a closed vocabulary."""
    return A.vocabulary_counts(table(spark, sf_dir, "events"), "event_type", EVENT_TYPES, ["user_id"])


def _claims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders as claims, parts as evidence, customers as assumptions.

    An urgent order names its customer as an assumption. Parts of one brand do not exist as
    evidence; promotional parts belong to another subject.
    """
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    declared = (
        F.when(priority == "5-LOW", "expired").when(status == "F", "supported").when(status == "O", "supported-with-assumptions")
        .otherwise("draft")
    )
    orders = table(spark, sf_dir, "orders")
    claims = orders.select(F.col("o_orderkey").alias("claim_id"), declared.alias("status"))
    evidence = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("claim_id"), F.lit("evidence").alias("kind"), F.col("l_partkey").alias("ref_id"),
        F.lit("product").alias("subject"),
    )
    assumptions = orders.where(priority.isin("1-URGENT", "2-HIGH")).select(
        F.col("o_orderkey").alias("claim_id"), F.lit("assumption").alias("kind"), F.col("o_custkey").alias("ref_id"),
        F.lit("product").alias("subject"),
    )
    size = F.col("p_size")
    part_status = (
        F.when(size == 1, "fail").when(size == 2, "skip").when(size == 3, "unsupported").when(size == 4, "timeout")
        .when(size == 5, "tool-error").otherwise("pass")
    )
    parts = table(spark, sf_dir, "part").where(F.col("p_brand") != "Brand#13").select(
        F.lit("evidence").alias("kind"), F.col("p_partkey").alias("ref_id"), part_status.alias("status"),
        F.when((F.col("p_type") == "PROMO") & (size > 40), "promotion").otherwise("product").alias("subject"),
    )
    customers = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= -500).select(
        F.lit("assumption").alias("kind"), F.col("c_custkey").alias("ref_id"), F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("string").alias("subject"),
    )
    return claims, evidence.unionByName(assumptions), parts.unionByName(customers)


_CLAIMS_SQL = """
    WITH claims AS (
      SELECT o_orderkey AS claim_id, CASE WHEN o_orderpriority = '5-LOW' THEN 'expired' WHEN o_orderstatus = 'F' THEN 'supported'
             WHEN o_orderstatus = 'O' THEN 'supported-with-assumptions' ELSE 'draft' END AS declared_status FROM orders),
    ev AS (
      SELECT p_partkey, CASE p_size WHEN 1 THEN 'fail' WHEN 2 THEN 'skip' WHEN 3 THEN 'unsupported' WHEN 4 THEN 'timeout'
             WHEN 5 THEN 'tool-error' ELSE 'pass' END AS status, p_type = 'PROMO' AND p_size > 40 AS other
      FROM part WHERE p_brand <> 'Brand#13'),
    refs AS (
      SELECT l_orderkey AS claim_id, 'evidence' AS kind, ev.p_partkey IS NOT NULL AS found, ev.status, coalesce(other, false) AS other
      FROM lineitem LEFT JOIN ev ON l_partkey = p_partkey
      UNION ALL
      SELECT o_orderkey, 'assumption', c_custkey IS NOT NULL, NULL, false
      FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= -500) ON o_custkey = c_custkey
      WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
    n AS (
      SELECT claim_id, declared_status, count(*) FILTER (NOT found) AS n_missing, count(*) FILTER (other) AS n_mismatch,
             count(*) FILTER (kind = 'assumption') AS n_assumptions, count(*) FILTER (kind = 'evidence' AND found) AS n_evidence,
             count(*) FILTER (status = 'pass') AS n_pass, count(*) FILTER (status = 'fail') AS n_fail,
             count(*) FILTER (status = 'skip') AS n_skip, count(*) FILTER (status = 'unsupported') AS n_unsupported,
             count(*) FILTER (status = 'timeout') AS n_timeout, count(*) FILTER (status = 'tool-error') AS n_tool_error
      FROM claims LEFT JOIN refs USING (claim_id) GROUP BY claim_id, declared_status),
    v AS (
      SELECT *, CASE
        WHEN n_missing > 0 OR n_mismatch > 0 THEN 'invalid-reference|claim-reference-invalid'
        WHEN declared_status = 'expired' OR n_fail > 0 THEN 'not-supported|claim-or-evidence-not-supported'
        WHEN n_skip + n_unsupported + n_timeout + n_tool_error > 0 THEN 'not-evaluated|required-evidence-not-evaluated'
        WHEN declared_status = 'supported-with-assumptions' AND n_assumptions = 0 THEN 'invalid-reference|required-assumption-missing'
        WHEN declared_status = 'supported-with-assumptions' THEN 'supported-with-assumptions|evidence-pass-assumptions-visible'
        WHEN declared_status = 'supported' AND n_evidence > 0 AND n_pass = n_evidence THEN 'supported|required-evidence-pass'
        ELSE 'not-evaluated|claim-status-not-evaluable' END AS v FROM n)
"""


@query(_CLAIMS_SQL + "SELECT * EXCLUDE (v), split_part(v, '|', 1) AS result, split_part(v, '|', 2) AS reason_code FROM v")
def q_claim_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One verdict per claim."""
    return A.claim_rollup(*_claims(spark, sf_dir))


@query(
    _CLAIMS_SQL + " UNION ALL ".join(
        f"SELECT '{r}' AS value, count(*) FILTER (split_part(v, '|', 1) = '{r}') AS n FROM v" for r in A.CLAIM_RESULTS
    )
)
def q_claim_rollup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 over A6: verdict counts, zero-filled."""
    return A.vocabulary_counts(A.claim_rollup(*_claims(spark, sf_dir)), "result", A.CLAIM_RESULTS)


_STATUS_SQL = "CASE WHEN l_quantity > 46 THEN 'fail' WHEN l_discount < 0.01 THEN 'skip' WHEN l_tax > 0.07 THEN 'timeout' ELSE 'pass' END"
_GATE_SQL = f"""
    SELECT l_orderkey, count(*) FILTER (s = 'pass') AS n_pass, count(*) FILTER (s = 'fail') AS n_fail, count(*) FILTER (s = 'skip') AS n_skip,
           CAST(0 AS BIGINT) AS n_unsupported, count(*) FILTER (s = 'timeout') AS n_timeout, CAST(0 AS BIGINT) AS n_tool_error,
           count(*) FILTER (l_linenumber = 7 OR (l_linenumber <= 2 AND s <> 'pass')) AS blocking,
           CASE WHEN bool_or(l_linenumber = 1) AND bool_or(l_linenumber = 2)
                 AND count(*) FILTER (l_linenumber = 7 OR (l_linenumber <= 2 AND s <> 'pass')) = 0 THEN 'satisfied' ELSE 'blocked' END AS gate_state
    FROM (SELECT *, {_STATUS_SQL} AS s FROM lineitem) GROUP BY l_orderkey
"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (
        F.when(F.col("l_quantity") > 46, "fail").when(F.col("l_discount") < 0.01, "skip").when(F.col("l_tax") > 0.07, "timeout")
        .otherwise("pass")
    )
    role = F.concat(F.lit("line-"), F.col("l_linenumber").cast("string"))
    return table(spark, sf_dir, "lineitem").withColumn("status", status).withColumn("role", role)


@query(_GATE_SQL)
def q_gate_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One gate state per order; two required roles, four optional, one unknown."""
    return A.gate_rollup(_records(spark, sf_dir), ["l_orderkey"], "role", "status", ROLES)


@query(
    f"""
    SELECT 'line-' || l_linenumber AS role, CASE WHEN l_linenumber <= 2 THEN 'required' WHEN l_linenumber <= 6 THEN 'optional' END AS requirement,
           CASE WHEN l_linenumber = 7 THEN 'unknown-role' WHEN {_STATUS_SQL} = 'pass' THEN 'satisfied'
                WHEN l_linenumber <= 2 THEN 'blocked' ELSE 'visible-nonblocking' END AS gate_state, count(*) AS n
    FROM lineitem GROUP BY ALL
    """
)
def q_gate_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of every record under its role's requirement, counted."""
    results = A.gate_results(_records(spark, sf_dir), "role", "status", ROLES)
    return results.groupBy("role", "requirement", "gate_state").agg(F.count(F.lit(1)).alias("n"))


def _lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_line, flag = F.col("l_linestatus") == "O", F.col("l_returnflag")
    entries = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("claim_id"), F.when(open_line, "behavior").otherwise("runtime").alias("lane"),
        F.when(open_line, "integration").otherwise("runtime-control").alias("kind"),
        F.when(flag == "A", "spec-derived").when(open_line, "source-derived").otherwise("runtime-derived").alias("source_kind"),
        F.when(F.col("l_tax") < 0.06, "pass").otherwise("fail").alias("status"), F.col("l_suppkey").cast("string").alias("lineage"),
    )
    light = F.col("o_orderpriority") == "5-LOW"

    def required(*names: str):
        return F.when(light, F.array().cast("array<string>")).otherwise(F.array(*[F.lit(n) for n in names]))

    requirements = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("claim_id"), required("behavior", "runtime").alias("required_lanes"),
        required("integration", "runtime-control").alias("required_kinds"), F.when(light, 1).otherwise(2).alias("min_sources"),
    )
    return A.lane_coverage(entries, requirements, ["behavior", "runtime", "proof"], ["integration", "runtime-control", "proof-check"])


_LANES_SQL = """
    WITH o AS (
      SELECT o_orderkey AS claim_id, o_custkey, o_orderpriority, coalesce(b, 0) AS b, coalesce(r, 0) AS r, coalesce(n, 0) AS n,
             coalesce(src, 0) AS src, coalesce(spec, 0) AS spec, low, high
      FROM orders LEFT JOIN (
        SELECT l_orderkey, count(*) FILTER (l_linestatus = 'O') AS b, count(*) FILTER (l_linestatus = 'F') AS r, count(*) AS n,
               count(*) FILTER (l_linestatus = 'O' AND l_returnflag <> 'A') AS src, count(*) FILTER (l_returnflag = 'A') AS spec,
               min(l_suppkey) AS low, max(l_suppkey) AS high
        FROM lineitem WHERE l_tax < 0.06 GROUP BY l_orderkey) ON l_orderkey = o_orderkey),
    c AS (
      SELECT claim_id, o_custkey, o_orderpriority,
        list_filter([CASE WHEN b > 0 THEN 'behavior' END, CASE WHEN r > 0 THEN 'runtime' END], lambda x: x IS NOT NULL) AS observed_lanes,
        list_filter([CASE WHEN b > 0 THEN 'integration' END, CASE WHEN r > 0 THEN 'runtime-control' END], lambda x: x IS NOT NULL) AS observed_kinds,
        list_filter([CASE WHEN b = 0 AND o_orderpriority <> '5-LOW' THEN 'behavior' END, CASE WHEN r = 0 AND o_orderpriority <> '5-LOW' THEN 'runtime' END], lambda x: x IS NOT NULL) AS missing_lanes,
        list_filter([CASE WHEN b = 0 AND o_orderpriority <> '5-LOW' THEN 'integration' END, CASE WHEN r = 0 AND o_orderpriority <> '5-LOW' THEN 'runtime-control' END], lambda x: x IS NOT NULL) AS missing_kinds,
        list_filter([CASE WHEN n > 0 AND n = src THEN 'all-evidence-derived-from-source' END,
                     CASE WHEN (CASE WHEN b > 0 THEN 1 ELSE 0 END) + (CASE WHEN r > 0 THEN 1 ELSE 0 END) < (CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 2 END) THEN 'insufficient-independent-lanes' END,
                     CASE WHEN spec = 0 THEN 'missing-spec-derived-evidence' END,
                     CASE WHEN n > 1 AND low = high THEN 'same-generator-lineage' END], lambda x: x IS NOT NULL) AS warning_codes
      FROM o),
    lanes AS (
      SELECT *, CASE WHEN len(missing_lanes) + len(missing_kinds) > 0 THEN 'blocked' WHEN len(warning_codes) > 0 THEN 'warning' ELSE 'satisfied' END AS status FROM c)
"""


@query(
    _LANES_SQL + """
    SELECT claim_id, status, array_to_string(observed_lanes, ',') AS observed_lanes, array_to_string(observed_kinds, ',') AS observed_kinds,
           array_to_string(missing_lanes, ',') AS missing_lanes, array_to_string(missing_kinds, ',') AS missing_kinds,
           array_to_string(warning_codes, ',') AS warning_codes FROM lanes
    """
)
def q_lane_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lanes and evidence kinds per claim, with warnings."""
    lists = ("observed_lanes", "observed_kinds", "missing_lanes", "missing_kinds", "warning_codes")
    return _lanes(spark, sf_dir).select("claim_id", "status", *[F.array_join(c, ",").alias(c) for c in lists])


_WARNINGS_SQL = _LANES_SQL + """,
    k AS (
      SELECT o_custkey, o_orderpriority, bool_or(o_orderpriority = '2-HIGH' AND len(observed_lanes) = 0) OR o_custkey % 11 = 0 AS unknown, bool_or(len(missing_lanes) > 0) AS missing,
             bool_and(status = 'satisfied') AS fine, bool_or(list_contains(warning_codes, 'all-evidence-derived-from-source')) OR o_custkey % 11 = 1 AS a,
             bool_or(list_contains(warning_codes, 'insufficient-independent-lanes')) AS b,
             bool_or(list_contains(warning_codes, 'missing-spec-derived-evidence')) AS c,
             bool_or(list_contains(warning_codes, 'same-generator-lineage')) AS d
      FROM lanes GROUP BY o_custkey, o_orderpriority),
    native AS (
      SELECT o_custkey, o_orderpriority,
             CASE WHEN unknown THEN 'error' WHEN missing OR a OR b OR d THEN 'blocked' WHEN c THEN 'warning' WHEN fine THEN 'satisfied' ELSE 'error' END AS native_state,
             array_to_string(list_filter([CASE WHEN a THEN 'all-evidence-derived-from-source' END, CASE WHEN b THEN 'insufficient-independent-lanes' END,
                          CASE WHEN c THEN 'missing-spec-derived-evidence' END, CASE WHEN d THEN 'same-generator-lineage' END], lambda x: x IS NOT NULL), ',') AS warning_codes
      FROM k)
"""
_PACKAGE = ["o_custkey", "o_orderpriority"]


def _native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders of one priority are a package; orders without any observed lane and packages may name an unknown code."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("claim_id"), *_PACKAGE)
    claims = _lanes(spark, sf_dir).join(orders, "claim_id")
    stray = (F.col("o_orderpriority") == "2-HIGH") & (F.size("observed_lanes") == 0)
    codes = F.when(stray, F.array_append("warning_codes", F.lit("unreviewed-warning"))).otherwise(F.col("warning_codes"))
    own = F.when(F.col("o_custkey") % 11 == 0, F.array(F.lit("unreviewed-package"))).when(F.col("o_custkey") % 11 == 1, F.array(F.lit("all-evidence-derived-from-source")))
    packages = orders.select(*_PACKAGE).distinct().select(*_PACKAGE, F.coalesce(own, F.array().cast("array<string>")).alias("warning_codes"))
    return A.warning_policy(claims.withColumn("warning_codes", codes), _PACKAGE, P.BLOCKING_WARNINGS, P.VISIBLE_WARNINGS, packages)


@query(
    _WARNINGS_SQL + """
    SELECT o_custkey, o_orderpriority, native_state, warning_codes,
           CASE native_state WHEN 'blocked' THEN 'blocking' WHEN 'warning' THEN 'visible-nonblocking' WHEN 'satisfied' THEN 'not-applicable' ELSE 'fail-closed' END AS policy_treatment
    FROM native
    """
)
def q_warning_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One native state per package; an unknown warning code fails closed."""
    return _native(spark, sf_dir).withColumn("warning_codes", F.array_join("warning_codes", ","))


_PACKAGE_GATE_SQL = f"""
    SELECT o_custkey, o_orderpriority, CASE WHEN bool_or(l_linenumber = 1) AND bool_or(l_linenumber = 2)
             AND count(*) FILTER (l_linenumber = 7 OR (l_linenumber <= 2 AND {_STATUS_SQL} <> 'pass')) = 0 THEN 'satisfied' ELSE 'blocked' END AS gate_state
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, o_orderpriority
"""


@query(
    _WARNINGS_SQL + f"""
    SELECT n.o_custkey, n.o_orderpriority, coalesce(gate_state, 'not-evaluated') AS gate_state, native_state,
           CASE WHEN gate_state = 'blocked' OR native_state = 'blocked' THEN 'blocked' WHEN gate_state IS DISTINCT FROM 'satisfied' THEN 'not-evaluated'
                WHEN native_state = 'warning' THEN 'satisfied-with-warnings' WHEN native_state = 'satisfied' THEN 'satisfied' ELSE 'not-evaluated' END AS judgment
    FROM native n LEFT JOIN ({_PACKAGE_GATE_SQL}) g ON g.o_custkey = n.o_custkey AND g.o_orderpriority = n.o_orderpriority
    """
)
def q_combined_judgment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: gate and native state of each package, combined; a package without a record is not evaluated."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), *_PACKAGE)
    records = _records(spark, sf_dir).join(orders, "l_orderkey")
    return A.combine_judgments(A.gate_rollup(records, _PACKAGE, "role", "status", ROLES), _native(spark, sf_dir), _PACKAGE)
