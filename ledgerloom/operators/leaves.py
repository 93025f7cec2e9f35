"""String leaves of nested data, each with its path."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LEAVES = "array<struct<path:string,value:string>>"


def _none(kind: str = _LEAVES) -> Column:
    return F.array().cast(kind)


def leaf_array(value: Column, data_type: T.DataType, path: Column, depth: int | None = None) -> Column:
    """Array of (path, value) for every string leaf of a typed value, in one expression.

    A VARIANT is walked ``depth`` levels deep, as deep as the values nest; without a depth it is an error, not an empty result.
    """
    if isinstance(data_type, T.VariantType):
        if depth is None:
            raise ValueError("a VARIANT value needs the depth of its nesting (see json_depth)")
        levels = [F.array(F.struct(path.alias("path"), F.lit(None).cast("string").alias("name"), value.alias("v")))]
        for _ in range(depth):
            levels.append(F.flatten(F.transform(levels[-1], _children)))
        texts = F.filter(F.concat(*levels), lambda n: F.schema_of_variant(n["v"]) == "STRING")
        return F.coalesce(F.transform(texts, lambda n: F.struct(n["path"].alias("path"), n["v"].cast("string").alias("value"))), _none())
    if isinstance(data_type, T.StringType):
        leaf = F.struct(path.alias("path"), value.alias("value"))
        return F.when(value.isNotNull(), F.array(leaf)).otherwise(_none())
    if isinstance(data_type, T.StructType):
        parts = [
            leaf_array(value[f.name], f.dataType, F.concat(path, F.lit(f".{f.name}")), depth)
            for f in data_type.fields if holds_text(f.dataType)
        ]
        return F.concat(*parts) if parts else _none()
    if isinstance(data_type, T.ArrayType) and holds_text(data_type.elementType):
        nested = F.transform(
            value,
            lambda item, i: leaf_array(item, data_type.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), depth),
        )
        return F.coalesce(F.flatten(nested), _none())
    if isinstance(data_type, T.MapType) and holds_text(data_type.valueType):
        nested = F.transform(
            F.map_entries(value),
            lambda e: leaf_array(e["value"], data_type.valueType, F.concat(path, F.lit("."), e["key"]), depth),
        )
        return F.coalesce(F.flatten(nested), _none())
    return _none()


def holds_text(data_type: T.DataType) -> bool:
    """Whether a value of the type can have a string leaf."""
    if isinstance(data_type, T.StructType):
        return any(holds_text(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return holds_text(data_type.elementType)
    if isinstance(data_type, T.MapType):
        return holds_text(data_type.valueType)
    return isinstance(data_type, (T.StringType, T.VariantType))


def flatten_leaves(df: DataFrame, id_columns: Sequence[str], columns: Sequence[str] | None = None, depth: int | None = None) -> DataFrame:
    """(id, path, value) of every string leaf of the other columns, whatever their nesting.

    ``depth`` is how deep VARIANT values nest; only they need it.
    """
    names = list(columns) if columns else [c for c in df.columns if c not in id_columns]
    parts = [
        leaf_array(F.col(n), df.schema[n].dataType, F.lit(f"$.{n}"), depth) for n in names if holds_text(df.schema[n].dataType)
    ]
    leaves = df.select(*id_columns, F.explode(F.concat(*parts)).alias("__leaf"))
    return leaves.select(*id_columns, F.col("__leaf.path").alias("path"), F.col("__leaf.value").alias("value"))


def _children(node: Column) -> Column:
    """Members and items directly under a node struct (path, name, v)."""
    members = F.transform(
        F.map_entries(F.try_variant_get(node["v"], "$", "map<string,variant>")),
        lambda e: F.struct(
            F.concat(node["path"], F.lit("."), e["key"]).alias("path"), e["key"].alias("name"), e["value"].alias("v")
        ),
    )
    items = F.transform(
        F.try_variant_get(node["v"], "$", "array<variant>"),
        lambda item, i: F.struct(
            F.concat(node["path"], F.lit("["), i.cast("string"), F.lit("]")).alias("path"),
            F.lit(None).cast("string").alias("name"), item.alias("v"),
        ),
    )
    return F.coalesce(members, items, F.array().cast(_NODES))


_NODES = "array<struct<path:string,name:string,v:variant>>"


#: One JSON string. Possessive, so that Java's matcher keeps no stack: strings of any length are cut out.
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'

#: Levels that are opened by expressions; containers that are still closed after them, which few rows have, are walked by themselves.
LEVELS = 10


def json_depth(raw: Column) -> Column:
    """How deep the objects and arrays of a JSON text nest; 0 for a scalar. Brackets inside strings do not count."""
    brackets = F.regexp_replace(F.regexp_replace(raw, STRING, ""), r"[^\[\]{}]++", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc: Column, c: Column) -> Column:
        now = acc["now"] + F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    return F.coalesce(F.aggregate(F.split(brackets, ""), start, step, lambda acc: acc["most"]), F.lit(0))


def _is_variant(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.VariantType)


def deepest(df: DataFrame, raw: str) -> int:
    """The greatest ``json_depth`` of a column's rows that parse: one aggregate over it. Only deep texts are parsed for it.

    Texts that do not parse are never opened, so a malformed one of very many brackets counts for nothing.
    """
    text = F.col(raw).cast("string")
    depth = json_depth(text)
    parses = F.lit(True) if _is_variant(df, raw) else F.try_parse_json(text).isNotNull()
    counted = F.get(F.transform(F.array(depth), lambda d: F.when((d <= LEVELS) | parses, d)), F.lit(0))
    return df.agg(F.max(counted)).first()[0] or 0


def _opened(rows: DataFrame, id_columns: Sequence[str], depth: int) -> DataFrame:
    """(id, n, last) of all nodes within ``depth`` levels of the nodes in ``__l0``; ``last``: of the deepest of these levels."""
    for level in range(1, depth + 1):
        opened = F.flatten(F.transform(F.col(f"__l{level - 1}"), _children))
        rows = rows.select("*", opened.alias(f"__l{level}"))

    def tagged(level: int) -> Column:
        return F.transform(F.col(f"__l{level}"), lambda n: F.struct(n.alias("n"), F.lit(level == depth).alias("last")))

    nodes = rows.select(*id_columns, F.explode(F.concat(*map(tagged, range(1, depth + 1)))).alias("e"))
    kind = F.schema_of_variant(F.col("e.n.v"))
    label = (
        F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.when(F.col("e.last"), "container").otherwise("inner"))
        .when(kind == "STRING", "string").otherwise("scalar")
    )
    text = F.when(label != "inner", F.col("e.n.v").cast("string"))
    return nodes.select(*id_columns, F.col("e.n.path").alias("path"), F.col("e.n.name").alias("name"), label.alias("kind"), text.alias("value"))


class _Number(str):
    """A number as it is written."""


def _walk(path: str, text: str) -> Iterator[tuple[str, str | None, str, str | None]]:
    """(path, name, kind, JSON text or string) of every node inside a container; a stack instead of recursion."""
    stack: list[tuple[str, str | None, object]] = [(path, None, json.loads(text, parse_int=_Number, parse_float=_Number))]
    while stack:
        path, name, node = stack.pop()
        if isinstance(node, dict):
            below = [(f"{path}.{k}", k, v) for k, v in node.items()]
        elif isinstance(node, list):
            below = [(f"{path}[{i}]", None, v) for i, v in enumerate(node)]
        else:
            continue
        for at, name, value in below:
            if isinstance(value, (dict, list)):
                yield at, name, "inner", None
            elif isinstance(value, str) and not isinstance(value, _Number):
                yield at, name, "string", value
            else:
                yield at, name, "scalar", str(value) if isinstance(value, _Number) else json.dumps(value)
        stack += below


def _walked(containers: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    """(id, path, name, kind, value) of everything inside closed containers (id, path, value)."""
    ids = T.StructType([containers.schema[c] for c in id_columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (path, text) in enumerate(zip(batch.column("path").to_pylist(), batch.column("value").to_pylist(), strict=True)):
                nodes = list(_walk(path, text))
                at = pa.array([row] * len(nodes), pa.int64())
                columns = [batch.column(c).take(at) for c in id_columns] + [pa.array([n[k] for n in nodes], pa.string()) for k in range(4)]
                yield pa.RecordBatch.from_arrays(columns, names=[*id_columns, "path", "name", "kind", "value"])

    schema = T.StructType([*ids.fields, *[T.StructField(n, T.StringType()) for n in ("path", "name", "kind", "value")]])
    found = containers.mapInArrow(run, schema)
    # Scalars are written as the expressions above write them, but numbers with an exponent, which become decimals.
    scalar = F.try_parse_json("value").cast("string")
    return found.withColumn("value", F.when(F.col("kind") == "scalar", scalar).otherwise(F.col("value")))


def json_nodes(df: DataFrame, id_columns: Sequence[str], raw: str, depth: int | None = None) -> DataFrame:
    """(id, path, name, kind, value) of every member and item of a free-form JSON text or VARIANT column.

    ``kind`` is ``string``, ``scalar``, ``inner`` (an opened object or array, whose value is NULL) or ``container``: one still
    closed at ``depth`` levels, kept as a node with its JSON text as value, so that no text is lost. Without a depth
    everything is opened: one scan and one generator for up to ``LEVELS`` levels, and where rows that parse nest deeper
    the closed containers of these rows alone are walked, so the plan does not grow with the deepest row.
    ``name`` is the member name, NULL for an array item. Rows that do not parse give no node.
    """
    ids = list(id_columns)
    value = F.col(raw) if _is_variant(df, raw) else F.try_parse_json(F.col(raw))
    root = F.struct(F.lit("$").alias("path"), F.lit(None).cast("string").alias("name"), value.alias("v"))
    most = max(1, deepest(df, raw) if depth is None else depth)
    opened = lambda rows, levels: _opened(rows.select(*ids, F.array(root).alias("__l0")), ids, levels)
    if depth is not None or most <= LEVELS:
        return opened(df, most)
    shallow = opened(df, LEVELS).withColumns({
        "kind": F.when(F.col("kind") == "container", "inner").otherwise(F.col("kind")), "value": F.when(F.col("kind") != "container", F.col("value")),
    })
    deep = df.where(json_depth(F.col(raw).cast("string")) > LEVELS)
    return shallow.unionByName(_walked(opened(deep, LEVELS).where("kind = 'container'").select(*ids, "path", "value"), ids))


def json_strings(raw: Column) -> Column:
    """The string values (not the names) of a JSON text at any depth, as one array; no walk, no level, no shuffle."""
    tokens = F.regexp_extract_all(raw, F.lit(STRING + r"(?:\s*+:)?+"), F.lit(0))
    values = F.filter(tokens, lambda s: ~s.endswith(":"))
    read = F.from_json(F.concat(F.lit("["), F.array_join(values, ","), F.lit("]")), "array<string>")
    return F.coalesce(read, F.array().cast("array<string>"))


def json_leaves(df: DataFrame, id_columns: Sequence[str], raw: str, depth: int | None = None) -> DataFrame:
    """(id, path, value) of the string leaves of a free-form JSON text or VARIANT column."""
    nodes = json_nodes(df, id_columns, raw, depth)
    return nodes.where(F.col("kind").isin("string", "container")).select(*id_columns, "path", "value")


def forbidden_members(nodes: DataFrame, id_columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(id, path, name) of members, at any depth, whose lower-cased name is on the deny list."""
    return nodes.where(F.lower("name").isin(list(names))).select(*id_columns, "path", F.lower("name").alias("name"))


def member_names(raw: Column) -> Column:
    """The member names of a JSON text at any depth, in lower case and without repeats, as one array.

    Every string is cut out with the colon that may follow it; those with one are names. Escapes inside a name are read.
    """
    strings = F.regexp_extract_all(raw, F.lit(STRING + r"(?:\s*+:)?+"), F.lit(0))
    quoted = F.transform(F.filter(strings, lambda s: s.endswith(":")), lambda s: F.regexp_replace(s, r"\s*+:\z", ""))
    plain = F.transform(quoted, lambda s: F.when(s.contains("\\"), F.get(F.from_json(F.concat(F.lit("["), s, F.lit("]")), "array<string>"), F.lit(0))).otherwise(F.btrim(s, F.lit('"'))))
    return F.array_distinct(F.transform(plain, lambda n: F.lower(n)))


def forbidden_names(df: DataFrame, id_columns: Sequence[str], raw: str, names: Sequence[str]) -> DataFrame:
    """(id, name) of members on the deny list at any depth of a JSON text, without a walk and without paths."""
    found = F.filter(member_names(F.col(raw)), lambda n: n.isin(list(names)))
    valid = F.when(F.try_parse_json(F.col(raw)).isNotNull(), found)
    return df.select(*id_columns, F.explode(valid).alias("name"))


def forbidden_columns(df: DataFrame, id_columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(id, path, name) of typed columns or struct fields on the deny list that hold a value."""
    found: list[Column] = []

    def walk(value: Column, data_type: T.DataType, path: str, name: str | None) -> None:
        if name is not None and name.lower() in set(names):
            entry = F.struct(F.lit(path).alias("path"), F.lit(name.lower()).alias("name"))
            found.append(F.when(value.isNotNull(), entry))
        if isinstance(data_type, T.StructType):
            for f in data_type.fields:
                walk(value[f.name], f.dataType, f"{path}.{f.name}", f.name)
        elif isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StructType):
            for f in data_type.elementType.fields:
                inner = F.array_compact(value[f.name])
                walk(F.when(F.size(inner) > 0, inner), T.ArrayType(f.dataType), f"{path}[].{f.name}", f.name)

    for field in df.schema.fields:
        if field.name not in id_columns:
            walk(F.col(field.name), field.dataType, f"$.{field.name}", field.name)
    if not found:
        return df.limit(0).select(*id_columns, F.lit("").alias("path"), F.lit("").alias("name"))
    hits = df.select(*id_columns, F.explode(F.array_compact(F.array(*found))).alias("__hit"))
    return hits.select(*id_columns, "__hit.path", "__hit.name")
