"""Trust at a time, status rules and release classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.registry import query, table
from ledgerloom.operators import contracts as C
from ledgerloom.plans import release as R

_AT = "timestamp_ntz'1998-06-01 00:00:00'"


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, r IS NULL AS trusted, r AS trust_reason FROM (
      SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN o_orderkey IS NULL THEN 'key-unknown' WHEN o_orderpriority = '5-LOW' THEN 'key-usage'
             WHEN l_shipdate NOT BETWEEN o_orderdate AND o_orderdate + INTERVAL 90 DAY THEN 'key-validity' WHEN o_orderstatus = 'P' THEN 'key-status' END AS r
      FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 20000) ON l_orderkey = o_orderkey)
    """
)
def q_valid_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys valid for a use at a time, both ends of the interval included."""
    status = F.when(F.col("o_orderstatus") == "P", "revoked").otherwise("active")
    usage = F.when(F.col("o_orderpriority") == "5-LOW", "other").otherwise("signing")
    keys = table(spark, sf_dir, "orders").where("o_totalprice > 20000").select(
        F.col("o_orderkey").alias("l_orderkey"), usage.alias("usage"), status.alias("status"), F.col("o_orderdate").alias("valid_from"),
        F.expr("o_orderdate + interval 90 days").alias("valid_until"),
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    found = R.valid_at(lines, keys, "l_orderkey", "l_shipdate", "signing")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "trusted", "trust_reason")


@query(
    """
    WITH e AS (
      SELECT o_orderkey, o_orderdate, o_orderstatus AS s, o_totalprice AS p,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'active' WHEN '2-HIGH' THEN 'superseded' WHEN '3-MEDIUM' THEN 'withdrawn'
                  WHEN '5-LOW' THEN 'corrected' ELSE 'expired' END AS state FROM orders)
    SELECT o_orderkey, 'status-entry-future' AS code, 'effective_at' AS field FROM e WHERE o_orderdate > TIMESTAMP '1998-06-01'
    UNION ALL SELECT o_orderkey, 'replacement-binding', 'replacement_release_id' FROM e WHERE state IN ('superseded', 'corrected') AND s <> 'F'
    UNION ALL SELECT o_orderkey, 'replacement-cycle', 'replacement_release_id' FROM e WHERE state IN ('superseded', 'corrected') AND s = 'F' AND p > 400000
    UNION ALL SELECT o_orderkey, 'withdrawal-notice', 'notice_digest' FROM e WHERE state = 'withdrawn' AND s <> 'O'
    UNION ALL SELECT o_orderkey, 'release-status-fields', 'state' FROM e WHERE state IN ('active', 'expired') AND s IN ('F', 'O')
    UNION ALL SELECT o_orderkey, 'release-status-fields', 'notice_digest' FROM e WHERE state IN ('superseded', 'corrected') AND s = 'O'
    UNION ALL SELECT o_orderkey, 'release-status-fields', 'replacement_release_id' FROM e WHERE state = 'withdrawn' AND s = 'F'
    UNION ALL SELECT o_orderkey, 'revocation-policy', 'compromise_indicator' FROM e WHERE (state = 'withdrawn') <> (p > 250000)
    """
)
def q_status_entry_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State-dependent fields of status entries at an evaluation time."""
    states = {"1-URGENT": "active", "2-HIGH": "superseded", "3-MEDIUM": "withdrawn", "4-NOT SPECIFIED": "expired", "5-LOW": "corrected"}
    state = F.try_element_at(F.create_map(*[F.lit(x) for pair in states.items() for x in pair]), F.col("o_orderpriority"))
    status, own = F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
    entries = table(spark, sf_dir, "orders").select(
        "o_orderkey", own.alias("release_id"), F.lit("bundle").alias("bundle_digest"), state.alias("state"), F.col("o_orderdate").alias("effective_at"),
        F.when(status == "F", F.when(F.col("o_totalprice") > 400000, own).otherwise("next")).alias("replacement_release_id"),
        F.when(status == "F", F.lit("next-bundle")).alias("replacement_bundle_digest"), F.when(status == "O", F.lit("notice")).alias("notice_digest"),
        F.when(F.col("o_totalprice") > 250000, True).otherwise(False).alias("compromise_indicator"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", "revoked").otherwise("active").alias("status"),
    )
    rules = [*R.release_entry_rules(F.expr(_AT)), R.key_entry_rules(F.expr(_AT))[1]]
    found = C.check(entries, rules, path=F.col("o_orderkey"), key=F.col("o_orderkey"), keep=["o_orderkey"])
    return found.select("o_orderkey", "code", "field")


def _releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as releases: claims are their orders, the lifecycle follows the segment."""
    def count(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    priority, price = F.col("o_orderpriority"), F.col("o_totalprice")
    claims = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        count((priority == "1-URGENT") & (price > 450000), "n_not_supported"), count((priority == "2-HIGH") & (price > 470000), "n_invalid_reference"),
        count((priority == "5-LOW") & (price > 300000), "n_not_evaluated"), F.min("o_orderdate").alias("valid_from"),
        F.expr("max(o_orderdate) + interval 365 days").alias("valid_until"),
    )
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    key = F.when(balance < -500, "revoked").when(balance < 0, "retired").otherwise("active")
    state = (
        F.when(nation == 1, "withdrawn").when(nation == 2, "superseded").when(nation == 3, "corrected").when(nation == 4, "expired")
        .when(nation == 5, "lost").otherwise("active")
    )
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), key.alias("key_status"), state.alias("release_state"))
    return claims.join(customers, "o_custkey")


_RELEASES_SQL = """
    WITH c AS (
      SELECT o_custkey, count(*) FILTER (o_orderpriority = '1-URGENT' AND o_totalprice > 450000) AS n_not_supported,
             count(*) FILTER (o_orderpriority = '2-HIGH' AND o_totalprice > 470000) AS n_invalid_reference,
             count(*) FILTER (o_orderpriority = '5-LOW' AND o_totalprice > 300000) AS n_not_evaluated,
             min(o_orderdate) AS valid_from, max(o_orderdate) + INTERVAL 365 DAY AS valid_until FROM orders GROUP BY o_custkey),
    r AS (
      SELECT c.*, CASE WHEN c_acctbal < -500 THEN 'revoked' WHEN c_acctbal < 0 THEN 'retired' ELSE 'active' END AS key_status,
             CASE c_nationkey WHEN 1 THEN 'withdrawn' WHEN 2 THEN 'superseded' WHEN 3 THEN 'corrected' WHEN 4 THEN 'expired' WHEN 5 THEN 'lost' ELSE 'active' END AS release_state
      FROM c JOIN customer ON o_custkey = c_custkey),
    k AS (
      SELECT *, CASE WHEN key_status = 'revoked' THEN 'revoked-key' WHEN key_status <> 'active' THEN 'untrusted-key'
        WHEN TIMESTAMP '1998-06-01' < valid_from OR TIMESTAMP '1998-06-01' > valid_until THEN 'expired-release'
        WHEN release_state IN ('withdrawn', 'superseded', 'corrected', 'expired') THEN release_state || '-release'
        WHEN release_state <> 'active' THEN 'invalid-structure' WHEN n_not_supported + n_invalid_reference > 0 THEN 'claims-not-supported'
        WHEN n_not_evaluated > 0 THEN 'not-evaluated' ELSE 'verified-fixture-with-limitations' END AS overall FROM r),
    x AS (
      SELECT *, CASE WHEN overall IN ('revoked-key', 'untrusted-key') THEN 3 WHEN overall LIKE '%-release' THEN 4 WHEN overall = 'invalid-structure' THEN 1
        WHEN overall IN ('claims-not-supported', 'not-evaluated') THEN 5 ELSE 0 END AS exit_class FROM k)
"""


@query(_RELEASES_SQL + "SELECT o_custkey, overall, exit_class FROM x")
def q_classify_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: the overall result and exit class of every release."""
    return R.classify_release(_releases(spark, sf_dir), F.expr(_AT)).select("o_custkey", "overall", "exit_class")


@query(
    _RELEASES_SQL + """,
    f AS (
      SELECT o_custkey, 1 AS o, 'incomplete-bundle' AS status, 'output-file-missing' AS reason FROM orders WHERE o_totalprice > 495000
      UNION ALL SELECT o_custkey, 3, 'untrusted-key', 'release-key-validity' FROM orders WHERE o_totalprice < 5000
      UNION ALL SELECT o_custkey, 4, 'invalid-signature', 'release-signature-invalid' FROM orders WHERE o_totalprice BETWEEN 5000 AND 10000),
    g AS (SELECT o_custkey, bool_or(o = 1) AS a, bool_or(o = 3) AS b, bool_or(o = 4) AS c, arg_min(status, o) AS status, arg_min(reason, o) AS reason FROM f GROUP BY o_custkey)
    SELECT o_custkey, NOT coalesce(a, false) AS structure_valid, true AS digests_valid, NOT coalesce(b, false) AS trust_valid,
           NOT coalesce(c, false) AS signature_valid, true AS linkage_valid, true AS lifecycle_valid,
           CASE WHEN g.status IS NULL THEN release_state END AS release_state, CASE WHEN g.status IS NULL THEN n_not_supported END AS n_not_supported,
           coalesce(g.status, overall) AS overall,
           CASE WHEN g.status IN ('incomplete-bundle', 'invalid-signature') THEN 1 WHEN g.status = 'untrusted-key' THEN 3 ELSE exit_class END AS exit_class, g.reason
    FROM x LEFT JOIN g USING (o_custkey)
    """
)
def q_verification_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One result per release: stage booleans, and the classification or the first failure."""
    price = F.col("o_totalprice")
    orders = table(spark, sf_dir, "orders")
    kinds = {
        "structure": (price > 495000, "incomplete-bundle", "output-file-missing"), "trust": (price < 5000, "untrusted-key", "release-key-validity"),
        "signature": (price.between(5000, 10000), "invalid-signature", "release-signature-invalid"),
    }
    failing = F.array_compact(
        F.array(*[
            F.when(bad, F.struct(F.lit(stage).alias("stage"), F.lit(status).alias("status"), F.lit(reason).alias("reason")))
            for stage, (bad, status, reason) in kinds.items()
        ])
    )
    failures = orders.select("o_custkey", F.explode(failing).alias("f")).select("o_custkey", "f.stage", "f.status", "f.reason")
    classified = R.classify_release(_releases(spark, sf_dir), F.expr(_AT)).select(
        "o_custkey", "release_state", "n_not_supported", "overall", "exit_class"
    )
    return R.verification_result(classified, failures, "o_custkey")


@query(
    """
    WITH c AS (
      SELECT l_orderkey, bool_or(l_returnflag = 'A' AND l_quantity > 49) AS refused, bool_or(l_returnflag = 'N' AND l_quantity > 48) AS open FROM lineitem GROUP BY l_orderkey),
    f AS (
      SELECT *, CASE WHEN o_totalprice > 480000 THEN 'incomplete-bundle:path-missing' WHEN o_totalprice > 470000 THEN 'incomplete-bundle:digest-mismatch'
          WHEN o_custkey % 50 = 0 THEN 'untrusted-key:key-unknown' WHEN o_totalprice < 10000 THEN 'invalid-signature:release-signature-invalid'
          WHEN o_totalprice < 20000 THEN 'invalid-report-linkage:static-report-linkage-invalid' WHEN o_orderstatus = 'P' THEN 'invalid-structure:status-chain-missing'
          WHEN o_orderpriority = '1-URGENT' AND o_totalprice < 60000 THEN 'invalid-structure:release-status-binding'
          WHEN o_orderpriority = '3-MEDIUM' AND o_totalprice > 400000 THEN 'invalid-structure:status-chain-revision-binding' END AS failure
      FROM orders LEFT JOIN c ON l_orderkey = o_orderkey),
    k AS (
      SELECT *, CASE WHEN failure IS NOT NULL THEN split_part(failure, ':', 1) WHEN o_totalprice BETWEEN 300000 AND 310000 THEN 'revoked-key'
          WHEN TIMESTAMP '1998-06-01' < o_orderdate OR TIMESTAMP '1998-06-01' > o_orderdate + INTERVAL 1000 DAY THEN 'expired-release'
          WHEN o_orderpriority = '2-HIGH' THEN 'withdrawn-release' WHEN refused THEN 'claims-not-supported' WHEN open THEN 'not-evaluated'
          ELSE 'verified-fixture-with-limitations' END AS overall FROM f)
    SELECT CAST(o_orderkey AS VARCHAR) AS release_id, overall, CASE WHEN failure IS NOT NULL THEN split_part(failure, ':', 2) END AS reason,
           CASE WHEN overall IN ('revoked-key', 'untrusted-key') THEN 3 WHEN overall LIKE '%-release' THEN 4 WHEN overall IN ('claims-not-supported', 'not-evaluated') THEN 5
                WHEN overall LIKE 'verified%' THEN 0 ELSE 1 END AS exit_class
    FROM k
    """
)
def q_verify_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as releases, verified end to end: files, key, signature, linkage, status chain with one entry a revision, lifecycle and claims."""
    orders = table(spark, sf_dir, "orders").withColumn("release_id", F.col("o_orderkey").cast("string"))
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    releases = orders.select(
        "release_id", F.lit("b").alias("bundle_digest"), F.when(F.col("o_custkey") % 50 == 0, "lost").otherwise("k").alias("key_id"), (price >= 10000).alias("signature_valid"),
        (price >= 20000).alias("linkage_valid"), F.col("o_orderdate").cast("timestamp").alias("valid_from"), F.expr("o_orderdate + interval 1000 days").cast("timestamp").alias("valid_until"),
    )

    def files(changed: Column) -> DataFrame:
        pair = F.array(*[F.struct(F.lit(n).alias("path"), F.when(changed & (F.lit(n) == "main"), "other").otherwise("d").alias("digest")) for n in ("main", "notes")])
        return orders.select("release_id", price.alias("price"), F.explode(pair).alias("f")).select("release_id", "f.path", "f.digest", F.lit(1).cast("long").alias("size"), "price")

    declared = files(F.lit(False)).drop("price")
    actual = files(price.between(470000.001, 480000)).where((F.col("path") == "main") | (F.col("price") <= 480000)).drop("price")
    # Made from a column: a literal key moves into the join's condition and leaves it no key to join by.
    key = F.concat(F.lit("k"), F.substring(F.coalesce("r_name", F.lit("")), 1, 0))
    keys = table(spark, sf_dir, "region").where("r_regionkey = 0").select(
        key.alias("key_id"), F.lit("release-signing").alias("usage"), F.lit("active").alias("status"), F.expr("timestamp '1990-01-01'").alias("valid_from"), F.expr("timestamp '2030-01-01'").alias("valid_until")
    )

    def entry(revision: int, digest: str, previous: Column) -> Column:
        withdrawn = priority == "2-HIGH"
        none = F.lit(None).cast("string")
        revoked = price.between(300000, 310000)
        return F.struct(
            F.lit(revision).alias("position"), F.lit(revision).alias("revision"), F.concat(F.lit(digest), F.col("release_id")).alias("status_set_digest"), previous.alias("previous_digest"),
            F.expr(f"timestamp '1997-01-0{revision}'").alias("generated_at"), F.when(revoked, "revoked").otherwise("active").alias("key_status"), revoked.alias("compromise_indicator"),
            F.lit("b").alias("bundle_digest"), F.when(withdrawn, "withdrawn").otherwise("active").alias("state"), none.alias("replacement_release_id"),
            none.alias("replacement_bundle_digest"), F.when(withdrawn, "notice").alias("notice_digest"), F.expr("timestamp '1990-01-01'").alias("effective_at"),
        )

    none = F.lit(None).cast("string")
    second = F.when(price > 400000, "other").otherwise(F.concat(F.lit("one-"), F.col("release_id")))
    entries = F.array_compact(F.array(
        F.when(F.col("o_orderstatus") != "P", entry(1, "one-", none)), F.when((F.col("o_orderstatus") != "P") & (priority == "1-URGENT") & (price < 60000), entry(1, "two-", none)),
        F.when((F.col("o_orderstatus") != "P") & (priority == "3-MEDIUM"), entry(2, "next-", second)),
    ))
    chain = orders.select("release_id", F.explode(entries).alias("e")).select("release_id", "e.*")
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    result = F.when((flag == "A") & (quantity > 49), "not-supported").when((flag == "N") & (quantity > 48), "not-evaluated").otherwise("supported")
    claims = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("release_id"), result.alias("result"))
    return R.verify_releases(releases, declared, actual, keys, chain, claims, F.expr(_AT)).select("release_id", "overall", "reason", "exit_class")
