"""Row contracts, leaves and JSON members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.registry import query, table
from ledgerloom.operators import contracts as C
from ledgerloom.operators import leaves as L
from ledgerloom.operators.findings import finding_counts, finding_positions, finding_summary, order_findings
from ledgerloom.plans import export as E
from ledgerloom.sources.inventory import file_inventory
from ledgerloom.sources.records import parse_json_column


def _check(df: DataFrame, rules: list[C.Rule], key: Column) -> DataFrame:
    return C.check(df, rules, path=key, key=key).select("key", "code", "field", "message")


def _line_key() -> Column:
    return F.concat_ws("/", "l_orderkey", "l_linenumber")


@query(
    """
    SELECT event_id, event_type NOT IN ('error', 'signup') AS parsed,
           CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k
    FROM events
    """
)
def q_parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text in a column; a cut-off text and a repeated member do not parse."""
    kind, props = F.col("event_type"), F.col("props")
    raw = (
        F.when(kind == "error", F.substring(props, F.lit(1), F.char_length(props) - 1))
        .when(kind == "signup", F.concat(F.lit('{"k": 0, '), F.substr(props, F.lit(2))))
        .otherwise(props)
    )
    events = table(spark, sf_dir, "events").withColumn("raw", raw)
    return parse_json_column(events, "raw", "k bigint").select("event_id", "parsed", F.col("record.k").alias("k"))


@query()
def q_file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table files themselves, with size, digest and role."""
    return file_inventory(spark, sf_dir, prefix_roles={"line": "fact", "orders": "fact"}, suffix_roles={".parquet": "table"})


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS key, 'schema' AS code, 'priority' AS field,
           'priority: required member is absent' AS message
    FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), 'schema', '$', 'note: required member is absent'
    FROM orders WHERE o_orderstatus = 'P'
    """
)
def q_contract_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An absent column value, and an absent member of a JSON text (a null member is present)."""
    raw = F.when(F.col("o_orderstatus") == "P", F.lit('{"id": 1}')).otherwise(F.lit('{"id": 1, "note": null}'))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')").alias("priority"), raw.alias("raw")
    )
    rules = [*C.require("o_orderkey", "priority"), C.require_members("raw", ["id", "note"])]
    return _check(orders, rules, F.col("o_orderkey"))


@query(
    """
    SELECT CAST(event_id AS VARCHAR) AS key, 'schema' AS code, '$' AS field,
           CASE WHEN event_type = 'purchase' THEN 'debug: unknown member' ELSE 'k: required member is absent' END AS message
    FROM events WHERE event_type IN ('purchase', 'view')
    """
)
def q_closed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members outside the closed set, and missing ones."""
    kind, props = F.col("event_type"), F.col("props")
    raw = (
        F.when(kind == "purchase", F.concat(F.lit('{"debug": 1, '), F.substr(props, F.lit(2))))
        .when(kind == "view", F.lit("{}")).otherwise(props)
    )
    events = table(spark, sf_dir, "events").withColumn("raw", raw)
    return _check(events, C.closed_fields("raw", ["k"], exact=True), F.col("event_id"))


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS key, 'schema' AS code, 'o_orderpriority' AS field,
           'o_orderpriority: value is not in the vocabulary' AS message
    FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
    """
)
def q_contract_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values outside a closed vocabulary."""
    rules = [C.one_of("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]), C.one_of("o_orderstatus", ["F", "O", "P"])]
    return _check(table(spark, sf_dir, "orders"), rules, F.col("o_orderkey"))


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS key, 'schema' AS code, 'p_brand' AS field,
           'p_brand: text does not match its mode' AS message
    FROM part
    WHERE NOT ((p_type = 'ECONOMY' AND regexp_full_match(p_brand, 'Brand#[0-9]'))
            OR (p_type = 'STANDARD' AND regexp_full_match(p_brand, 'Brand#1[0-9]'))
            OR (p_type = 'PROMO' AND regexp_full_match(p_brand, 'Brand#[0-9]{2}')))
    UNION ALL
    SELECT CAST(p_partkey AS VARCHAR), 'schema', 'p_name', 'p_name: text does not match the pattern'
    FROM part WHERE NOT regexp_full_match(p_name, '[a-z]+ (ring|widget)')
    """
)
def q_contract_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pattern, and a pattern chosen by another column; an unknown mode is invalid."""
    modes = {"ECONOMY": r"^Brand#[0-9]\z", "STANDARD": r"^Brand#1[0-9]\z", "PROMO": r"^Brand#[0-9]{2}\z"}
    rules = [C.matches_by("p_brand", "p_type", modes), C.matches("p_name", r"^[a-z]+ (?:ring|widget)\z")]
    return _check(table(spark, sf_dir, "part"), rules, F.col("p_partkey"))


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS key, 'schema' AS code, 'stamp' AS field, 'stamp: text is not a date-time' AS message
    FROM orders WHERE o_orderstatus = 'P'
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), 'schema', 'stamp', 'stamp: text is not a canonical UTC time'
    FROM orders WHERE o_orderstatus IN ('O', 'P')
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), 'schema', 'amount', 'amount: text is not of type int'
    FROM orders WHERE o_orderpriority = '5-LOW'
    """
)
def q_parse_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: unparsable times, times not in canonical form, and text that is not a number."""
    status, stamp = F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(status == "F", F.concat(stamp, F.lit("Z"))).when(status == "O", F.concat(stamp, F.lit("+00:00")))
        .otherwise(F.regexp_replace(stamp, "-[0-9]{2}T", "-32T"))
    )
    amount = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("12x")).otherwise(F.col("o_custkey").cast("string"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("stamp"), amount.alias("amount"))
    rules = [C.parses_as_time("stamp"), C.parses_as_time("stamp", canonical=True), C.parses_as("amount", "int")]
    return _check(orders, rules, F.col("o_orderkey"))


@query(
    """
    WITH w AS (SELECT doc_id, string_split(text, ' ') AS words FROM documents)
    SELECT CAST(doc_id AS VARCHAR) AS key, 'schema' AS code, 'words' AS field, 'words: fewer than 60 items' AS message
    FROM w WHERE len(words) < 60
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), 'schema', 'words', 'words: more than 900 items' FROM w WHERE len(words) > 900
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), 'schema', 'words', 'words: items are not unique' FROM w WHERE list_unique(words) < len(words)
    """
)
def q_array_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item counts and uniqueness of the words of whole texts."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("words"))
    return _check(documents, C.array_shape("words", at_least=60, at_most=900, unique=True), F.col("doc_id"))


@query(
    """
    SELECT l_orderkey || '/' || l_linenumber AS key, 'schema' AS code, 'l_quantity' AS field,
           'l_quantity: value is out of range' AS message
    FROM lineitem WHERE l_quantity < 2 OR l_quantity > 48
    UNION ALL
    SELECT l_orderkey || '/' || l_linenumber, 'schema', 'l_tax', 'l_tax: number is not finite'
    FROM lineitem WHERE CAST(l_tax AS VARCHAR) = '-0.0'
    UNION ALL
    SELECT l_orderkey || '/' || l_linenumber, 'schema', 'big', 'big: value is out of range'
    FROM lineitem WHERE l_partkey * 9007199254740 > 9007199254740991
    UNION ALL
    SELECT l_orderkey || '/' || l_linenumber, 'schema', 'flags', 'flags: value is out of range'
    FROM lineitem WHERE l_linenumber > 6
    """
)
def q_contract_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric bounds, finite and not negative zero, safe integers and text length."""
    # A decimal: the product of a key above 1,024,000 does not fit a bigint, and is out of range all the same.
    lines = table(spark, sf_dir, "lineitem").withColumn("big", F.col("l_partkey").cast("decimal(20,0)") * F.lit(9007199254740))
    lines = lines.withColumn("flags", F.repeat(F.lit("x"), F.col("l_linenumber")))
    rules = [C.in_range("l_quantity", 2, 48), C.finite("l_tax"), C.safe_integer("big"), C.text_length("flags", 1, 6)]
    return _check(lines, rules, _line_key())


@query(
    """
    SELECT l_orderkey || '/' || l_linenumber AS key, 'conditional' AS code, 'l_returnflag' AS field,
           'open lines are not returned' AS message
    FROM lineitem
    WHERE (l_linestatus = 'O' AND l_returnflag <> 'N') OR (l_linestatus <> 'O' AND l_returnflag = 'N')
    """
)
def q_contract_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conditional rule with both branches."""
    flag = F.col("l_returnflag")
    rule = C.implies(
        F.col("l_linestatus") == "O", flag == "N", flag.isin("A", "R"), code="conditional", field="l_returnflag",
        message="open lines are not returned",
    )
    return _check(table(spark, sf_dir, "lineitem"), [rule], _line_key())


@query(
    """
    SELECT l_orderkey || '/' || l_linenumber AS key, 'time-order' AS code, 'l_shipdate' AS field,
           'l_shipdate must not be before o_orderdate' AS message
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag <> 'N' AND l_shipdate < o_orderdate
    """
)
def q_time_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chronology between an order and its lines; a null date silences its pair."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")).alias("l_shipdate")
    )
    return _check(lines.join(orders, "l_orderkey"), C.ordered("o_orderdate", "l_shipdate"), _line_key())


@query(
    """
    SELECT l_orderkey || '/' || l_linenumber AS key, 'state-bound' AS code, 'l_discount' AS field,
           'l_discount must not exceed l_tax' AS message
    FROM lineitem WHERE l_discount > l_tax
    UNION ALL
    SELECT l_orderkey || '/' || l_linenumber, 'parameter-range', 'parameters', 'parameter ' || l_returnflag || ': maximum is below minimum'
    FROM lineitem WHERE CAST(l_quantity AS BIGINT) < l_linenumber
    UNION ALL
    SELECT l_orderkey || '/' || l_linenumber, 'duplicate-parameter', 'parameters', 'parameters: names must be unique'
    FROM lineitem WHERE l_returnflag = 'A'
    """
)
def q_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: a counter above its bound, nested ranges upside down, and repeated nested names."""

    def parameter(name: Column, kind: str, low: Column, high: Column) -> Column:
        return F.struct(
            name.alias("name"), F.lit(kind).alias("kind"), low.cast("bigint").alias("minimum"), high.cast("bigint").alias("maximum")
        )

    parameters = F.array(
        parameter(F.col("l_returnflag"), "integer-range", F.col("l_linenumber"), F.col("l_quantity")),
        parameter(F.lit("A"), "finite-set", F.lit(1), F.lit(0)),
    )
    lines = table(spark, sf_dir, "lineitem").withColumn("parameters", parameters)
    rules = [C.within("l_discount", "l_tax", code="state-bound"), C.parameter_ranges("parameters"), C.unique_names("parameters")]
    return _check(lines, rules, _line_key())


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS key, 'publication-approval' AS code, 'approvals' AS field,
           'approvals: no element qualifies' AS message
    FROM orders WHERE o_orderstatus = 'F' AND NOT (o_totalprice > 250000 OR o_orderpriority = '1-URGENT')
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), 'approval-status', 'approvals', 'approvals: an element does not qualify'
    FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
    """
)
def q_any_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At least one approval of the right kind, and every approval well formed."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    approvals = F.array(
        F.struct(F.lit("publication").alias("type"), F.when(F.col("o_totalprice") > 250000, "approved").otherwise("pending").alias("status")),
        F.struct(F.when(urgent, "publication").otherwise("review").alias("type"), F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "lost").otherwise("approved").alias("status")),
    )
    orders = table(spark, sf_dir, "orders").withColumn("approvals", approvals)
    rules = [
        C.any_element("approvals", lambda a: (a["type"] == "publication") & (a["status"] == "approved"), when=F.col("o_orderstatus") == "F", code="publication-approval"),
        C.all_elements("approvals", lambda a: a["status"].isin("approved", "pending"), code="approval-status"),
    ]
    return _check(orders, rules, F.col("o_orderkey"))


@query(
    """
    SELECT CAST(event_id AS VARCHAR) AS key, 'unknown-record-type' AS code, 'record_type' AS field,
           'unsupported record_type: ' || event_type AS message
    FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')
    UNION ALL
    SELECT CAST(event_id AS VARCHAR), 'schema', 'value', 'value: value is out of range'
    FROM events WHERE (event_type = 'click' AND value > 100) OR (event_type = 'purchase' AND value < 5)
    """
)
def q_unknown_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed records under one contract per type; an unknown type skips every other rule."""
    contracts = {"click": [C.in_range("value", None, 100)], "view": [], "purchase": [C.in_range("value", 5, None)]}
    found = C.check_by_type(
        table(spark, sf_dir, "events"), F.col("event_type"), contracts, path=F.col("event_id"), key=F.col("event_id")
    )
    return found.select("key", "code", "field", "message")


_DEEP_NAMES = ("l1", "l2", "l3", "l4", "l5", "l6", "l7", "l8")
_DEEP_PATH = ".".join(("$", *_DEEP_NAMES, "Password"))


def _nested_props(kind: Column, props: Column) -> Column:
    deep = "".join(f'{{"{name}": ' for name in _DEEP_NAMES)[1:] + '{"Password": "deep"}' + "}" * (len(_DEEP_NAMES) - 1)
    nested = F.concat(
        F.lit('{"who": {"Token": "t", "tags": ["a", {"b": "'), kind, F.lit('"}], "n": 1}, ' + deep + ", "), F.substr(props, F.lit(2))
    )
    return F.when(kind.isin("purchase", "click"), nested).otherwise(props)


def _nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a nested JSON text. Every 1,000th holds a string of 9,000 characters, escapes among them, and one in 1,000 is malformed brackets."""
    nested = _nested_props(F.col("event_type"), F.col("props"))
    padded = F.concat(F.lit('{"pad": "'), F.repeat(F.lit('\\n\\"ab'), 1500), F.lit('", '), F.substr(nested, F.lit(2)))
    broken = F.repeat(F.lit("["), 3000)
    raw = F.when(F.col("event_id") % 1000 == 7, padded).when((F.col("event_id") % 1000 == 8) & (F.col("event_type") == "view"), broken).otherwise(nested)
    return table(spark, sf_dir, "events").withColumn("raw", raw)


@query(
    f"""
    SELECT event_id, '$.who.Token' AS path, 'token' AS name FROM events WHERE event_type IN ('purchase', 'click')
    UNION ALL
    SELECT event_id, '$.who.tags[1].b', 'b' FROM events WHERE event_type IN ('purchase', 'click')
    UNION ALL
    SELECT event_id, '{_DEEP_PATH}', 'password' FROM events WHERE event_type IN ('purchase', 'click')
    """
)
def q_forbidden_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member names on a deny list, at any depth of a JSON text."""
    nodes = L.json_nodes(_nested_events(spark, sf_dir), ["event_id"], "raw")
    return L.forbidden_members(nodes, ["event_id"], [*E.PROHIBITED_FIELDS, "b"])


@query(
    """
    SELECT event_id, unnest(['token', 'b', 'password']) AS name FROM events WHERE event_type IN ('purchase', 'click')
    """
)
def q_forbidden_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same names without their paths, from the text's strings alone."""
    return L.forbidden_names(_nested_events(spark, sf_dir), ["event_id"], "raw", [*E.PROHIBITED_FIELDS, "b"])


_LEAVES_SQL = f"""
    SELECT event_id, '$.who.Token' AS path, 't' AS value FROM events WHERE event_type IN ('purchase', 'click')
    UNION ALL
    SELECT event_id, '$.who.tags[0]', 'a' FROM events WHERE event_type IN ('purchase', 'click')
    UNION ALL
    SELECT event_id, '$.who.tags[1].b', event_type FROM events WHERE event_type IN ('purchase', 'click')
    UNION ALL
    SELECT event_id, '{_DEEP_PATH}', 'deep' FROM events WHERE event_type IN ('purchase', 'click')
    UNION ALL
    SELECT event_id, '$.pad', repeat(chr(10) || '"ab', 1500) FROM events WHERE event_id % 1000 = 7
    """


@query(_LEAVES_SQL)
def q_json_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String leaves of a free-form JSON text."""
    return L.json_leaves(_nested_events(spark, sf_dir), ["event_id"], "raw")


@query(_LEAVES_SQL)
def q_variant_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String leaves of a VARIANT column."""
    return L.json_leaves(_nested_events(spark, sf_dir).select("event_id", F.try_parse_json("raw").alias("v")), ["event_id"], "v")


@query(
    """
    SELECT o_orderkey, '$.record.status' AS path, o_orderstatus AS value FROM orders
    UNION ALL SELECT o_orderkey, '$.record.detail.priority', o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'
    UNION ALL SELECT o_orderkey, '$.record.detail.tags[0].name', o_orderstatus FROM orders
    UNION ALL SELECT o_orderkey, '$.record.detail.tags[1].name', o_orderpriority FROM orders
    """
)
def q_flatten_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String leaves of a nested, typed record."""
    tags = F.array(*[F.struct(F.col(c).alias("name"), F.lit(1).alias("n")) for c in ("o_orderstatus", "o_orderpriority")])
    detail = F.struct(F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"), tags.alias("tags"))
    record = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("owner"), detail.alias("detail"))
    return L.flatten_leaves(table(spark, sf_dir, "orders").select("o_orderkey", record.alias("record")), ["o_orderkey"])


_COMMON_SQL = ", ".join(f"'{c}'" for c in E.COMMON_CHECKS)
_FILE_SQL = ", ".join(f"'{c}'" for c in E.INTERFACE_CHECKS["staged-file"])


@query(
    f"""
    WITH c AS (
      SELECT o_orderkey,
             CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '4-NOT SPECIFIED' THEN CAST([] AS VARCHAR[])
                  ELSE list_sort(list_concat([{_COMMON_SQL}],
                         list_concat(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST([] AS VARCHAR[]) ELSE [{_FILE_SQL}] END,
                                     CASE WHEN o_orderstatus = 'O' THEN ['fixture-entry-binding'] ELSE CAST([] AS VARCHAR[]) END)))
             END AS checks
      FROM orders)
    SELECT o_orderkey, array_to_string(checks, ',') AS checks, len(checks) <> {len(E.COMMON_CHECKS)} AS wrong FROM c
    """
)
def q_expected_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: the checks a run context must report, against a reported list."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    mode = F.when(status == "F", E.CANDIDATE_MODE).when(status == "O", E.FIXTURE_MODE).otherwise("other")
    interface = F.when(priority == "1-URGENT", "programmatic").when(priority == "4-NOT SPECIFIED", "unknown").otherwise("staged-file")
    expected = E.required_checks(mode, interface)
    reported = F.array(*[F.lit(c) for c in sorted(E.COMMON_CHECKS)])
    orders = table(spark, sf_dir, "orders").select("o_orderkey", expected.alias("expected"), reported.alias("reported"))
    wrong = C.reported_checks("reported", F.col("expected")).bad
    return orders.select("o_orderkey", F.array_join("expected", ",").alias("checks"), wrong.alias("wrong"))


def _line_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        C.in_range("l_quantity", 2, 48, code="quantity"),
        C.Rule("discount", "l_discount", F.col("l_discount") > 0.09, "high discount", severity="warning"),
        C.Rule("flag", "l_returnflag", F.col("l_returnflag") == "R", "returned", severity="notice"),
    ]
    key = F.col("l_orderkey")
    return C.check(table(spark, sf_dir, "lineitem"), rules, path=_line_key(), key=key)


_LINE_FINDINGS_SQL = """
    SELECT 'error' AS severity, 'quantity' AS code, l_orderkey || '/' || l_linenumber AS path,
           'l_quantity: value is out of range' AS message, CAST(l_orderkey AS VARCHAR) AS key
    FROM lineitem WHERE l_quantity < 2 OR l_quantity > 48
    UNION ALL
    SELECT 'warning', 'discount', l_orderkey || '/' || l_linenumber, 'high discount', CAST(l_orderkey AS VARCHAR)
    FROM lineitem WHERE l_discount > 0.09
    UNION ALL
    SELECT 'notice', 'flag', l_orderkey || '/' || l_linenumber, 'returned', CAST(l_orderkey AS VARCHAR)
    FROM lineitem WHERE l_returnflag = 'R'
"""


@query(
    f"""
    SELECT count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings,
           count(*) FILTER (severity = 'info') AS info, count(*) AS findings, count(*) FILTER (severity = 'error') > 0 AS failed
    FROM ({_LINE_FINDINGS_SQL})
    """
)
def q_finding_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity counts, zero-filled, and whether the run fails."""
    return finding_summary(_line_findings(spark, sf_dir))


@query(f"SELECT severity, code, count(*) AS findings FROM ({_LINE_FINDINGS_SQL}) GROUP BY severity, code")
def q_finding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings per severity and code."""
    return finding_counts(_line_findings(spark, sf_dir))


@query(f"SELECT * FROM ({_LINE_FINDINGS_SQL}) ORDER BY severity <> 'error', path, code, message")
def q_order_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: findings in report order."""
    return order_findings(_line_findings(spark, sf_dir).select("severity", "code", "path", "message", "key"))


@query(
    f"""
    SELECT path, code, row_number() OVER (ORDER BY severity <> 'error', path NULLS FIRST, code NULLS FIRST, message NULLS FIRST, key NULLS FIRST) AS position
    FROM ({_LINE_FINDINGS_SQL})
    """
)
def q_finding_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: every finding's place in the report, over all findings."""
    return finding_positions(_line_findings(spark, sf_dir)).select("path", "code", "position")
