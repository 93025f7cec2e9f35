"""Digests of rows and groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.registry import query, table
from ledgerloom.functions.digest import content_digest, normalize_mixed, normalize_omissions, normalize_set, row_digest
from ledgerloom.operators import digests as D

_ROW_SQL = """'{{"o_custkey":' || o_custkey || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d') || '","o_orderkey":' || o_orderkey
   || ',"o_orderpriority":' || coalesce('"' || {priority} || '"', 'null') || ',"o_orderstatus":"' || {status} || '"}}'"""
_MEMBER_SQL = "l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_returnflag || '|' || strftime(l_shipdate, '%Y-%m-%d')"


@query("SELECT doc_id, sha256(array_to_string(list_sort(string_split(text, ' ')), ' ')) AS digest FROM documents")
def q_normalize_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of whole texts as a sorted set, then digested."""
    words = normalize_set(F.split("text", " "))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.array_join(words, " "), 256).alias("digest"))


def _order_columns() -> dict:
    return {
        "o_orderkey": F.col("o_orderkey"), "o_custkey": F.col("o_custkey"), "o_orderstatus": F.col("o_orderstatus"),
        "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderpriority": F.expr("nullif(o_orderpriority, '5-LOW')"),
    }


@query(
    "SELECT o_orderkey, 'sha256:' || sha256('order/v1' || chr(0) || "
    + _ROW_SQL.format(priority="nullif(o_orderpriority, '5-LOW')", status="o_orderstatus") + ") AS digest FROM orders"
)
def q_row_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain-separated digest of the canonical row, nulls kept."""
    return table(spark, sf_dir, "orders").select("o_orderkey", row_digest(_order_columns(), "order/v1").alias("digest"))


@query(
    "SELECT o_orderkey, 'sha256:' || sha256('order/v1' || chr(0) || "
    + _ROW_SQL.format(priority="nullif(o_orderpriority, '5-LOW')", status="o_orderstatus")
    + ") AS expected FROM orders WHERE o_totalprice > 450000"
)
def q_verify_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored digests that are not the recomputed ones; large orders were digested with another status."""
    columns = _order_columns()
    altered = {**columns, "o_orderstatus": F.when(F.col("o_totalprice") > 450000, "X").otherwise(F.col("o_orderstatus"))}
    orders = table(spark, sf_dir, "orders").withColumn("stored", row_digest(altered, "order/v1"))
    return D.verify_digest(orders, "stored", "order/v1", columns).select("o_orderkey", "expected")


_LIMBS_SQL = ", ".join(f"sum(CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT)::DECIMAL(38, 0)) AS s{i}" for i in range(8))
_LIMBS_TEXT_SQL = " || ':' || ".join(f"s{i}" for i in range(8))


@query(
    f"""
    WITH h AS (SELECT l_suppkey, sha256({_MEMBER_SQL}) AS h FROM lineitem),
         s AS (SELECT l_suppkey, count(*) AS members, {_LIMBS_SQL} FROM h GROUP BY l_suppkey)
    SELECT l_suppkey, members, 'sha256:' || sha256('line-set/v1' || chr(0) || members || ':' || {_LIMBS_TEXT_SQL}) AS digest FROM s
    """
)
def q_set_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: one order-free fingerprint per supplier's lines."""
    member = F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", F.date_format("l_shipdate", "yyyy-MM-dd"))
    return D.set_digest(table(spark, sf_dir, "lineitem"), ["l_suppkey"], member, "line-set/v1")


#: A third of all lines are one group.
_GROUP_SQL = "CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE 's' || l_suppkey END"


@query(
    f"""
    WITH m AS (SELECT {_GROUP_SQL} AS g, l_orderkey, l_linenumber, l_orderkey // 512 AS c, '{{"part":' || l_partkey || ',"supplier":' || l_suppkey || '}}' AS m FROM lineitem),
         k AS (SELECT g, c, count(*) AS n, sha256('[' || string_agg(m, ',' ORDER BY l_orderkey, l_linenumber, m) || ']') AS d FROM m GROUP BY g, c)
    SELECT g, CAST(sum(n) AS BIGINT) AS members, 'sha256:' || sha256('bundle/v1' || chr(0) || '[' || string_agg(d, ',' ORDER BY c) || ']') AS digest FROM k GROUP BY g
    """
)
def q_list_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: the ordered list of groups of any size, one of which holds a third of all lines."""
    member = F.to_json(F.struct(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier")))
    group = F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")))
    lines = table(spark, sf_dir, "lineitem").withColumn("g", group)
    return D.list_digest(lines, ["g"], ["l_orderkey", "l_linenumber"], member, "bundle/v1", F.expr("l_orderkey div 512"))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 11 = 0")
def q_verify_key_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys whose id is not the digest of their bytes, or whose bytes do not decode."""
    name = F.encode("c_name", "UTF-8")
    key_id = F.when(F.col("c_custkey") % 7 == 0, F.lit("sha256:00")).otherwise(content_digest(name))
    encoded = F.when(F.col("c_custkey") % 11 == 0, F.lit("not base64!")).otherwise(F.base64(name))
    keys = table(spark, sf_dir, "customer").select("c_custkey", key_id.alias("key_id"), encoded.alias("encoded"))
    return D.verify_key_ids(keys, "key_id", "encoded").select("c_custkey")


@query(
    """
    SELECT o_orderkey, 'false,true,' || array_to_string(list_sort([CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR)]), ',') || ','
           || array_to_string(list_sort([o_orderpriority, o_orderstatus]), ',') AS ordered FROM orders
    """
)
def q_normalize_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A set of mixed scalars in order of kind and text."""
    text = F.to_json(F.array(F.col("o_orderstatus"), F.col("o_orderpriority")))
    raw = F.concat(F.lit("[true,"), F.col("o_orderkey").cast("string"), F.lit(",false,"), F.col("o_custkey").cast("string"), F.lit(","), F.substr(text, F.lit(2)))
    values = table(spark, sf_dir, "orders").select("o_orderkey", F.variant_get(F.parse_json(raw), "$", "array<variant>").alias("v"))
    return values.select("o_orderkey", F.array_join(F.transform(normalize_mixed(F.col("v")), lambda x: x.cast("string")), ",").alias("ordered"))


@query(
    """
    SELECT o_orderkey, array_to_string(list_sort(['$.' || o_orderpriority || ' b', '$.' || o_orderpriority || ' a', '$.' || o_orderstatus || ' c']), ',') AS ordered
    FROM orders
    """
)
def q_normalize_omissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Omissions in order of path and rule."""
    omission = lambda column, rule: F.struct(F.concat(F.lit("$."), F.col(column)).alias("path"), F.lit(rule).alias("rule_id"), F.lit("h").alias("human_review_digest"))
    asked = F.array(omission("o_orderpriority", "b"), omission("o_orderstatus", "c"), omission("o_orderpriority", "a"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", normalize_omissions(asked).alias("o"))
    return orders.select("o_orderkey", F.array_join(F.transform("o", lambda x: F.concat_ws(" ", x["path"], x["rule_id"])), ",").alias("ordered"))
