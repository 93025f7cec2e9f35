"""References between tables, and tables that should agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.registry import query, table
from ledgerloom.operators import reconcile as K
from ledgerloom.operators import references as R

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")


@query(
    """
    SELECT 'line' AS dst_type, o_orderkey AS dst_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL
    SELECT 'label', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """
)
def q_missing_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of two target types, resolved together."""
    edges = table(spark, sf_dir, "orders").select(F.lit("line").alias("dst_type"), F.col("o_orderkey").alias("dst_id")).unionByName(
        table(spark, sf_dir, "documents").select(F.lit("label").alias("dst_type"), F.col("doc_id").alias("dst_id"))
    )
    keys = table(spark, sf_dir, "lineitem").select(F.lit("line").alias("dst_type"), F.col("l_orderkey").alias("dst_id")).unionByName(
        table(spark, sf_dir, "labels").select(F.lit("label").alias("dst_type"), F.col("doc_id").alias("dst_id"))
    )
    return R.missing_references(edges, keys)


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN p_size <= 2 THEN 'superseded' ELSE 'withdrawn' END AS lifecycle
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    WHERE o_orderstatus IN ('F', 'O') AND (p_size <= 2 OR p_size >= 49)
    """
)
def q_inactive_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of active orders that cite a superseded or withdrawn part."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    edges = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(orders, "l_orderkey")
    lifecycle = F.when(F.col("p_size") <= 2, "superseded").when(F.col("p_size") >= 49, "withdrawn").otherwise("published")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), lifecycle.alias("lifecycle"))
    found = R.inactive_references(
        edges, parts, ["l_partkey"], edge_status="o_orderstatus", active=["F", "O"], lifecycle="lifecycle",
        inactive=["superseded", "withdrawn"],
    )
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "lifecycle")


@query(
    """
    SELECT s_suppkey, count(*) AS mismatches
    FROM events JOIN customer ON user_id = c_custkey JOIN supplier ON s_suppkey = user_id
    WHERE (CASE WHEN event_type = 'error' THEN NULL ELSE c_nationkey END) IS DISTINCT FROM s_nationkey
    GROUP BY s_suppkey
    """
)
def q_same_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects as structs, compared null-safe along resolved references."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    nation = F.when(F.col("event_type") != "error", F.col("c_nationkey"))
    edges = table(spark, sf_dir, "events").join(customers, "user_id").select(
        F.col("user_id").alias("s_suppkey"), F.struct(F.lit("nation").alias("type"), nation.alias("id")).alias("subject")
    )
    targets = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.struct(F.lit("nation").alias("type"), F.col("s_nationkey").alias("id")).alias("target")
    )
    found = R.same_subject(edges, targets, ["s_suppkey"], "subject", "target")
    return found.groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("mismatches"))


@query(
    """
    SELECT l_orderkey, l_linenumber, path, first_path FROM (
      SELECT l_orderkey, l_linenumber, l_partkey || '/' || l_suppkey AS path,
             first_value(l_partkey || '/' || l_suppkey) OVER w AS first_path, row_number() OVER w AS n
      FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey))
    WHERE n > 1
    """
)
def q_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every later copy of a line id, with the path of the first."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", F.concat_ws("/", "l_partkey", "l_suppkey").alias("path")
    )
    found = R.duplicate_ids(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"], "path")
    return found.select("l_orderkey", "l_linenumber", "path", "first_path")


@query(
    """
    SELECT 'order_line' AS key_name, l_orderkey || '-' || l_linenumber AS value, count(*) AS copies
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    UNION ALL
    SELECT 'order_part', l_orderkey || '-' || l_partkey, count(*) FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1
    """
)
def q_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: two keys checked independently in one scan."""
    keys = {
        "order_line": F.concat_ws("-", "l_orderkey", "l_linenumber"), "order_part": F.concat_ws("-", "l_orderkey", "l_partkey"),
    }
    return R.unique_key(table(spark, sf_dir, "lineitem"), keys)


@query(
    """
    WITH c AS (SELECT o_custkey, count(*) FILTER (o_orderpriority = '1-URGENT') AS a, count(*) FILTER (o_orderpriority = '2-HIGH') AS b,
                      count(*) FILTER (o_orderpriority = '3-MEDIUM') AS c, count(*) FILTER (o_orderpriority = '5-LOW') AS d,
                      count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')) AS e
               FROM orders GROUP BY o_custkey)
    SELECT o_custkey, '1-URGENT' AS value, a AS occurrences FROM c WHERE a <> 1
    UNION ALL SELECT o_custkey, '2-HIGH', b FROM c WHERE b <> 1
    UNION ALL SELECT o_custkey, '3-MEDIUM', c FROM c WHERE c <> 1
    UNION ALL SELECT o_custkey, '5-LOW', d FROM c WHERE d <> 1
    UNION ALL SELECT o_custkey, '(other)', e FROM c WHERE e > 0
    """
)
def q_each_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: required values that do not occur exactly once in a group."""
    return R.each_once(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", PRIORITIES)


@query(
    """
    SELECT o_orderkey, declared, actual FROM (
      SELECT o_orderkey, CAST(floor(o_totalprice / 50000) AS BIGINT) AS declared, coalesce(n, 0) AS actual
      FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)
    WHERE declared <> actual
    """
)
def q_declared_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: a declared number of lines against the lines there are."""
    declared = table(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 50000).alias("n"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.declared_count(declared, lines, ["o_orderkey"], "n")


@query(
    """
    WITH d AS (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem WHERE l_linestatus = 'O'),
         e AS (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem WHERE l_linestatus = 'F'),
         x AS (SELECT coalesce(d.l_orderkey, e.l_orderkey) AS l_orderkey, d.l_orderkey IS NOT NULL AS a, e.l_orderkey IS NOT NULL AS b
               FROM d FULL JOIN e ON d.l_orderkey = e.l_orderkey AND d.l_returnflag = e.l_returnflag)
    SELECT l_orderkey, count(*) FILTER (a) AS only_declared, count(*) FILTER (b) AS only_derived
    FROM x WHERE a <> b GROUP BY l_orderkey
    """
)
def q_set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: two sets per order, whatever their order and copies."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    status = F.col("l_linestatus")
    return R.set_equality(lines.where(status == "O"), lines.where(status == "F"), ["l_orderkey"], "l_returnflag")


@query(
    """
    WITH r AS (SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
                      nullif(o_orderpriority, '5-LOW') AS o_orderpriority
               FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED')
    SELECT o_orderkey, 'missing-right' AS reason, NULL AS "column", NULL AS left_value, NULL AS right_value
    FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
    UNION ALL
    SELECT o_orderkey, 'mismatch', 'o_orderstatus', o.o_orderstatus, r.o_orderstatus
    FROM orders o JOIN r USING (o_orderkey) WHERE o.o_orderstatus IS DISTINCT FROM r.o_orderstatus
    UNION ALL
    SELECT o_orderkey, 'mismatch', 'o_orderpriority', o.o_orderpriority, r.o_orderpriority
    FROM orders o JOIN r USING (o_orderkey) WHERE o.o_orderpriority IS DISTINCT FROM r.o_orderpriority
    """
)
def q_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field by field parity with a changed copy, nulls comparing equal."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    status = F.when(F.col("o_totalprice") > 400000, "X").otherwise(F.col("o_orderstatus"))
    copy = orders.where(F.col("o_orderpriority") != "4-NOT SPECIFIED").select(
        "o_orderkey", status.alias("o_orderstatus"), F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_orderpriority")
    )
    return K.reconcile(orders, copy, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


@query(
    """
    WITH d AS (SELECT l_orderkey, 'records/' || l_linenumber AS path, l_returnflag || l_partkey AS digest, CAST(l_quantity AS BIGINT) AS size
               FROM lineitem WHERE l_quantity > 3),
         a AS (SELECT l_orderkey, 'records/' || l_linenumber AS path,
                      CASE WHEN l_tax > 0.07 THEN 'X' ELSE l_returnflag || l_partkey END AS digest,
                      CAST(l_quantity AS BIGINT) + CASE WHEN l_discount < 0.01 THEN 1 ELSE 0 END AS size
               FROM lineitem WHERE l_discount < 0.09),
         k AS (SELECT l_orderkey, path, count(*) FILTER (d) AS nd, count(*) FILTER (NOT d) AS na, max(digest) FILTER (d) AS dd,
                      max(digest) FILTER (NOT d) AS ad, max(size) FILTER (d) AS ds, max(size) FILTER (NOT d) AS "as"
               FROM (SELECT *, true AS d FROM d UNION ALL SELECT *, false FROM a) GROUP BY l_orderkey, path)
    SELECT l_orderkey, path, 'self-listed' AS reason FROM k WHERE path = 'records/7' AND nd > 0
    UNION ALL SELECT l_orderkey, path, 'path-duplicate' FROM k WHERE nd > 1 OR na > 1
    UNION ALL SELECT l_orderkey, path, 'path-missing' FROM k WHERE nd > 0 AND na = 0
    UNION ALL SELECT l_orderkey, path, 'path-extra' FROM k WHERE nd = 0 AND path <> 'records/7'
    UNION ALL SELECT l_orderkey, path, 'digest-mismatch' FROM k WHERE nd = 1 AND na = 1 AND dd IS DISTINCT FROM ad
    UNION ALL SELECT l_orderkey, path, 'size-mismatch' FROM k WHERE nd = 1 AND na = 1 AND ds IS DISTINCT FROM "as"
    UNION ALL SELECT l_orderkey, path, 'file-too-large' FROM k WHERE "as" > 45
    UNION ALL SELECT l_orderkey, NULL, 'too-many-files' FROM a GROUP BY l_orderkey HAVING count(*) > 6
    """
)
def q_path_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared against actual files of every bundle, with count and size limits."""
    lines = table(spark, sf_dir, "lineitem")
    path = F.concat(F.lit("records/"), F.col("l_linenumber").cast("string")).alias("path")
    digest = F.concat(F.col("l_returnflag"), F.col("l_partkey").cast("string"))
    size = F.col("l_quantity").cast("bigint")
    declared = lines.where(F.col("l_quantity") > 3).select("l_orderkey", path, digest.alias("digest"), size.alias("size"))
    actual = lines.where(F.col("l_discount") < 0.09).select(
        "l_orderkey", path, F.when(F.col("l_tax") > 0.07, "X").otherwise(digest).alias("digest"),
        (size + F.when(F.col("l_discount") < 0.01, 1).otherwise(0)).alias("size"),
    )
    return K.path_closure(declared, actual, ["l_orderkey"], self_path="records/7", max_files=6, max_bytes=45)


@query(
    """
    WITH c AS (SELECT doc_id, quality FROM labels UNION ALL SELECT doc_id, quality FROM labels WHERE toxic = 1),
         n AS (SELECT doc_id, count(*) AS n, max(quality) AS quality FROM c GROUP BY doc_id)
    SELECT d.doc_id, CASE WHEN n.n IS NULL THEN 'no-match' WHEN n.n > 1 THEN 'ambiguous' ELSE 'attribute-mismatch' END AS reason
    FROM documents d LEFT JOIN n USING (doc_id)
    WHERE n.n IS NULL OR n.n > 1 OR (CASE WHEN lang = 'en' THEN 1 ELSE 0 END) <> n.quality
    """
)
def q_match_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document must match exactly one label, with the quality it expects."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    catalog = labels.unionByName(labels.where(F.col("toxic") == 1))
    documents = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") == "en", 1).otherwise(0).alias("expected"))
    return K.match_exactly_one(documents, catalog, ["doc_id"], {"expected": "quality"}).select("doc_id", "reason")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def q_deny_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers on a deny list."""
    deny = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return K.deny_listed(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), deny, ["o_custkey"])


@query(
    """
    WITH m AS (SELECT n_name AS role, CASE WHEN s_acctbal < 2000 THEN 'low' WHEN s_acctbal < 4000 THEN 'fair' WHEN s_acctbal < 6000 THEN 'good' ELSE 'high' END AS status,
                      s_acctbal >= 5000 AND s_acctbal < 6000 AS other
               FROM supplier JOIN nation ON s_nationkey = n_nationkey),
         w AS (SELECT n_name AS role, unnest(['low', 'fair', 'good']) AS status FROM nation),
         k AS (SELECT coalesce(w.role, m.role) AS role, coalesce(w.status, m.status) AS status, bool_or(w.role IS NOT NULL) AS wanted,
                      count(m.role) AS n, count(*) FILTER (other) AS altered
               FROM w FULL JOIN m ON w.role = m.role AND w.status = m.status GROUP BY 1, 2)
    SELECT role, status, CASE WHEN NOT wanted THEN 'unknown-pair' WHEN n = 0 THEN 'unmapped' WHEN n > 1 THEN 'mapped-twice' ELSE 'not-identity' END AS reason
    FROM k WHERE NOT wanted OR n <> 1 OR altered > 0
    """
)
def q_mapping_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation maps every balance band exactly once, to itself."""
    roles = table(spark, sf_dir, "nation").select(F.col("n_name").alias("role"), F.col("n_nationkey").alias("s_nationkey"))
    balance = F.col("s_acctbal")
    band = F.when(balance < 2000, "low").when(balance < 4000, "fair").when(balance < 6000, "good").otherwise("high")
    suppliers = table(spark, sf_dir, "supplier").join(roles, "s_nationkey")
    mapping = suppliers.select("role", band.alias("raw"), F.when(balance.between(5000, 5999.995), "other").otherwise(band).alias("normalized"))
    return K.mapping_complete(roles, "role", ["low", "fair", "good"], mapping, "raw", "normalized")


@query(
    """
    WITH l AS (SELECT conv_id, turn, role FROM conversations),
         r AS (SELECT conv_id, turn, CASE WHEN length(text) > 700 THEN 'tool' ELSE role END AS role FROM conversations WHERE turn < 5)
    SELECT coalesce(l.conv_id, r.conv_id) AS conv_id, coalesce(l.turn, r.turn) AS turn,
           CASE WHEN r.turn IS NULL THEN 'missing-right' WHEN l.turn IS NULL THEN 'missing-left' ELSE 'mismatch' END AS reason,
           CASE WHEN l.turn IS NOT NULL AND r.turn IS NOT NULL THEN l.role END AS left_value,
           CASE WHEN l.turn IS NOT NULL AND r.turn IS NOT NULL THEN r.role END AS right_value
    FROM l FULL JOIN r ON l.conv_id = r.conv_id AND l.turn = r.turn
    WHERE l.role IS DISTINCT FROM r.role
    """
)
def q_sequence_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ordered lists, position by position."""
    turns = table(spark, sf_dir, "conversations")
    role = F.when(F.char_length("text") > 700, "tool").otherwise(F.col("role"))
    other = turns.where(F.col("turn") < 5).select("conv_id", "turn", role.alias("role"))
    return K.sequence_parity(turns.select("conv_id", "turn", "role"), other, ["conv_id"], "turn", "role")


@query(
    """
    WITH a AS (SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 2 GROUP BY ALL),
         b AS (SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS n FROM lineitem WHERE l_tax < 0.08 GROUP BY ALL),
         x AS (SELECT l_orderkey, l_linenumber, l_returnflag, coalesce(a.n, 0) - coalesce(b.n, 0) AS w
               FROM a FULL JOIN b USING (l_orderkey, l_linenumber, l_returnflag))
    SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN w > 0 THEN 'only-stored' ELSE 'only-derived' END AS side, abs(w) AS surplus
    FROM x WHERE w <> 0
    """
)
def q_rederive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored against derived rows, both ways, copies included."""
    lines = table(spark, sf_dir, "lineitem")
    columns = ["l_orderkey", "l_linenumber", "l_returnflag"]
    return K.rederive_and_compare(lines.where("l_quantity > 2").select(*columns), lines.where("l_tax < 0.08").select(*columns))


@query(
    """
    WITH m AS (SELECT 'good' AS s, doc_id AS value FROM labels WHERE quality = 1 UNION ALL SELECT 'poor', doc_id FROM labels WHERE quality = 0
               UNION ALL SELECT 'toxic', doc_id FROM labels WHERE toxic = 1),
         k AS (SELECT value, min(s) AS low, max(s) AS high, bool_or(u) AS u
               FROM (SELECT value, s, false AS u FROM m UNION ALL SELECT page_id, NULL, true FROM pages) GROUP BY value)
    SELECT value, CASE WHEN NOT u THEN 'outside-universe' WHEN low IS NULL THEN 'uncovered' ELSE 'overlap' END AS reason
    FROM k WHERE NOT u OR low IS NULL OR low <> high
    """
)
def q_disjoint_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named sets of ids that should be disjoint and cover the page ids."""
    sets = F.array_compact(
        F.array(
            F.when(F.col("quality") == 1, F.lit("good")), F.when(F.col("quality") == 0, F.lit("poor")), F.when(F.col("toxic") == 1, F.lit("toxic"))
        )
    )
    members = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("value"), F.explode(sets).alias("s"))
    universe = table(spark, sf_dir, "pages").select(F.col("page_id").alias("value"))
    return K.disjoint_cover(members, "s", "value", universe)


@query(
    """
    WITH a AS (SELECT l_orderkey AS case_id, CASE WHEN bool_or(l_returnflag = 'R') THEN 'blocked' ELSE 'satisfied' END AS status,
                      CASE WHEN bool_or(l_returnflag = 'R') THEN 5 ELSE 0 END AS exit_class
               FROM lineitem GROUP BY l_orderkey),
         e AS (SELECT o_orderkey AS case_id, CASE WHEN o_orderstatus = 'P' THEN 'satisfied' ELSE 'blocked' END AS status,
                      CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 5 END AS exit_class FROM orders)
    SELECT case_id, 'missing-right' AS reason, NULL AS "column", NULL AS left_value, NULL AS right_value
    FROM e WHERE case_id NOT IN (SELECT case_id FROM a)
    UNION ALL SELECT case_id, 'mismatch', 'status', e.status, a.status FROM e JOIN a USING (case_id) WHERE e.status <> a.status
    UNION ALL SELECT case_id, 'mismatch', 'exit_class', CAST(e.exit_class AS VARCHAR), CAST(a.exit_class AS VARCHAR)
              FROM e JOIN a USING (case_id) WHERE e.exit_class <> a.exit_class
    """
)
def q_outcome_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: expected against actual outcome of every case."""
    returned = F.bool_or(F.col("l_returnflag") == "R")
    actual = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("case_id")).agg(
        F.when(returned, "blocked").otherwise("satisfied").alias("status"), F.when(returned, 5).otherwise(0).alias("exit_class")
    )
    expected = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("case_id"), F.when(F.col("o_orderstatus") == "P", "satisfied").otherwise("blocked").alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(5).alias("exit_class"),
    )
    return K.outcome_regression(expected, actual, ["case_id"], ["status", "exit_class"])
