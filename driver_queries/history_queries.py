"""Histories and revision chains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.registry import query, table
from ledgerloom.functions.ordered import with_history
from ledgerloom.operators import history as H

TRANSITIONS = {
    "signup": ("view", "click"), "view": ("click", "view", "purchase"), "click": ("view", "purchase"), "purchase": ("view",),
}
_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey"]


@query(
    """
    WITH h AS (SELECT event_id, user_id, event_type, lag(event_type) OVER w AS from_state, row_number() OVER w - 1 AS step
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_id, user_id, from_state, event_type, step FROM h
    WHERE from_state IS NOT NULL AND from_state || '>' || event_type NOT IN
      ('signup>view', 'signup>click', 'view>click', 'view>view', 'view>purchase', 'click>view', 'click>purchase', 'purchase>view')
    """
)
def q_invalid_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of a user's events that the transition table does not allow."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    found = H.invalid_transitions(events, ["user_id"], ["ts", "event_id"], "event_type", TRANSITIONS)
    return found.select("event_id", "user_id", "from_state", "event_type", "step")


@query(
    """
    WITH b AS (SELECT user_id, arg_min(event_type, event_id) AS first_state, arg_max(event_type, event_id) AS last_state
               FROM events GROUP BY user_id)
    SELECT user_id, first_state, last_state, 'lifecycle-start' AS reason FROM b WHERE first_state <> 'signup'
    UNION ALL
    SELECT user_id, first_state, last_state, 'lifecycle-current' FROM b JOIN customer ON user_id = c_custkey
    WHERE last_state <> CASE WHEN c_acctbal < 3000 THEN 'purchase' ELSE 'view' END
    """
)
def q_history_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories must start in the start state and end in the current one."""
    state = F.when(F.col("c_acctbal") < 3000, "purchase").otherwise("view")
    current = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), state.alias("state"))
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return H.history_boundaries(events, ["user_id"], ["ts", "event_id"], "event_type", start="signup", current=current, current_state="state")


@query(
    """
    WITH h AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag <> 'N' THEN l_shipdate END AS shipped_at, l_suppkey FROM lineitem),
         p AS (SELECT *, last_value(shipped_at IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey
                                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM h)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(shipped_at AS DATE)::VARCHAR AS shipped, CAST(previous AS DATE)::VARCHAR AS previous
    FROM p WHERE shipped_at <= previous
    """
)
def q_strictly_increasing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times that are not after the last earlier time; a null time neither fails nor resets."""
    at = F.when(F.col("l_returnflag") != "N", F.col("l_shipdate"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *_LINE_ORDER, at.alias("at"))
    found = H.strictly_increasing(lines, ["l_orderkey"], _LINE_ORDER, "at")
    return found.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.date_format("at", "yyyy-MM-dd").alias("shipped"),
        F.date_format("previous_ts", "yyyy-MM-dd").alias("previous"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, expected FROM (
      SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey) AS expected
      FROM lineitem)
    WHERE l_linenumber <> expected
    """
)
def q_revision_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisions must be their stored position; the order is by time."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")
    found = H.revision_gaps(lines, ["l_orderkey"], ["l_shipdate", "l_partkey", "l_suppkey"], "l_linenumber")
    return found.select("l_orderkey", "l_linenumber", "expected")


def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), 256)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *_LINE_ORDER, "l_discount", digest.alias("digest"))
    linked = with_history(lines, ["l_orderkey"], _LINE_ORDER, lag={"before": F.col("digest")})
    previous = F.when(F.col("l_discount") >= 0.01, F.col("before"))
    return linked.select("l_orderkey", *_LINE_ORDER, "digest", previous.alias("previous"))


@query(
    """
    WITH h AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount,
                      lag(sha256(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey))
                        OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS expected FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, expected FROM h WHERE expected IS NOT NULL AND l_discount < 0.01
    """
)
def q_broken_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that do not name the digest of the entry before; some links are dropped."""
    found = H.broken_links(_chain(spark, sf_dir), ["l_orderkey"], _LINE_ORDER, "digest", "previous")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "expected")


@query(
    """
    SELECT o_custkey, o_orderpriority AS previous, count(*) AS successors FROM orders
    WHERE o_orderpriority <> '4-NOT SPECIFIED' GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1
    """
)
def q_forks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predecessors that more than one entry follows."""
    previous = F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')").alias("previous")
    return H.forks(table(spark, sf_dir, "orders").select("o_custkey", previous), ["o_custkey"], "previous")


@query(
    """
    WITH f AS (SELECT user_id, min((ts, event_id)) AS since FROM events WHERE event_type = 'error' GROUP BY user_id)
    SELECT event_id, user_id, event_type FROM events JOIN f USING (user_id) WHERE (ts, event_id) > since AND event_type <> 'error'
    """
)
def q_state_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that leave a sticky state again."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    found = H.state_rollback(events, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")
    return found.select("event_id", "user_id", "event_type")


@query(
    """
    WITH c AS (SELECT o_custkey, max(o_orderkey) AS latest_revision, count(*) AS entries, arg_max(o_orderstatus, o_orderkey) AS status
               FROM orders GROUP BY o_custkey),
         b AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000 GROUP BY o_custkey)
    SELECT o_custkey, latest_revision, entries, coalesce(n, 0) AS findings,
           coalesce(n, 0) = 0 AND c_acctbal >= 0 AS valid, CASE WHEN coalesce(n, 0) = 0 AND c_acctbal >= 0 THEN status END AS o_orderstatus
    FROM c LEFT JOIN b USING (o_custkey) JOIN customer ON c_custkey = o_custkey
    """
)
def q_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last revision's state, when the whole chain is valid and its own pointers agree."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    findings = orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000)).select("o_custkey")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    counted = orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("latest_revision"), F.count(F.lit(1)).alias("n"))
    pointers = counted.join(customers, "o_custkey").select(
        "o_custkey", "latest_revision", F.when(F.col("c_acctbal") < 0, F.col("n") + 1).otherwise(F.col("n")).alias("entries")
    )
    return H.latest_state(orders, ["o_custkey"], "o_orderkey", ["o_orderstatus"], findings, pointers)
