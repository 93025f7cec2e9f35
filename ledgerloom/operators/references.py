"""Referential checks between record tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.joins import lookup_join


def explode_references(records: DataFrame, id_columns: Sequence[str], fields: Mapping[str, str]) -> DataFrame:
    """(id columns, field, dst_type, dst_id): one row per id held in the reference arrays.

    ``fields`` maps an array column to the record type it points at. Null arrays and null items
    give no row.
    """

    def references(name: str, target: str) -> Column:
        ids = F.coalesce(F.array_compact(F.col(name)), F.array().cast("array<string>"))
        return F.transform(
            ids, lambda item: F.struct(F.lit(name).alias("field"), F.lit(target).alias("dst_type"), item.alias("dst_id"))
        )

    per_field = [references(name, target) for name, target in fields.items()]
    edges = records.select(*id_columns, F.explode(F.concat(*per_field)).alias("e"))
    return edges.select(*id_columns, "e.field", "e.dst_type", "e.dst_id")


def missing_references(
    edges: DataFrame, keys: DataFrame, on: Sequence[str] = ("dst_type", "dst_id"), unique_keys: bool = False
) -> DataFrame:
    """Edges whose target does not exist."""
    targets = keys.select(*on)
    if unique_keys:
        return edges.join(targets, list(on), "left_anti")
    return lookup_join(edges, targets.distinct(), on, "left_anti")


def inactive_references(
    edges: DataFrame, targets: DataFrame, on: Sequence[str], *, edge_status: str, active: Sequence[str],
    lifecycle: str, inactive: Sequence[str],
) -> DataFrame:
    """Edges of active sources that point at a target in an inactive lifecycle state.

    Missing targets are left to :func:`missing_references`. Target ids are unique.
    """
    live = edges.where(F.col(edge_status).isin(list(active)))
    dead = targets.where(F.col(lifecycle).isin(list(inactive))).select(*on, lifecycle)
    return lookup_join(live, dead, on, "inner")


def same_subject(edges: DataFrame, targets: DataFrame, on: Sequence[str], source: str, target: str) -> DataFrame:
    """Edges whose resolved target has another subject; structs compare field by field, null-safe."""
    joined = edges.join(targets.select(*on, target), list(on), "inner")
    return joined.where(~F.col(source).eqNullSafe(F.col(target)))


def duplicate_ids(df: DataFrame, key: Sequence[str], order: Sequence[str], path: str) -> DataFrame:
    """Every later copy of an id, with the path of the first record that holds it.

    ``order`` is a total order inside a key. Rows with a null key column are skipped. The first
    record comes from a pre-aggregated minimum, so a key with very many copies is not gathered.
    """
    at = F.struct(*[F.col(name) for name in order])
    rows = df.dropna(subset=list(key)).withColumn("__at", at)
    firsts = rows.groupBy(*key).agg(
        F.min(F.struct(F.col("__at"), F.col(path).alias("path"))).alias("__first"), F.count(F.lit(1)).alias("copies")
    ).where(F.col("copies") > 1)
    later = lookup_join(rows, firsts, key, "inner").where(F.col("__at") > F.col("__first")["__at"])
    return later.withColumn("first_path", F.col("__first.path")).drop("__at", "__first", "copies")


def unique_key(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """(key_name, value, copies) of values that occur more than once, each key on its own.

    All keys share one scan and one shuffle.
    """
    entries = F.array(*[F.struct(F.lit(n).alias("key_name"), c.cast("string").alias("value")) for n, c in keys.items()])
    values = df.select(F.explode(entries).alias("e")).select("e.key_name", "e.value").where(F.col("value").isNotNull())
    return values.groupBy("key_name", "value").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def each_once(df: DataFrame, group: Sequence[str], column: str, required: Sequence[str]) -> DataFrame:
    """(group, value, occurrences) of required values that do not occur exactly once in a group.

    Values outside the required set are one row per group, under the value ``(other)``.
    """
    counts = [F.count_if(F.col(column) == v).alias(f"__{i}") for i, v in enumerate(required)]
    other = F.count_if(~F.coalesce(F.col(column).isin(list(required)), F.lit(False))).alias("__other")
    grouped = df.groupBy(*group).agg(*counts, other)
    entries = [F.struct(F.lit(v).alias("value"), F.col(f"__{i}").alias("occurrences")) for i, v in enumerate(required)]
    entries.append(F.struct(F.lit("(other)").alias("value"), F.col("__other").alias("occurrences")))
    wrong = F.filter(
        F.array(*entries),
        lambda e: F.when(e["value"] == "(other)", e["occurrences"] > 0).otherwise(e["occurrences"] != 1),
    )
    return grouped.select(*group, F.explode(wrong).alias("e")).select(*group, "e.value", "e.occurrences")


def declared_count(declared: DataFrame, references: DataFrame, key: Sequence[str], count: str) -> DataFrame:
    """(key, declared, actual) where the declared number of references is not the actual one.

    Unresolved references count too. Both sides are stacked and summed, so no key is gathered.
    """
    left = declared.select(*key, F.col(count).cast("bigint").alias("declared"), F.lit(0).cast("bigint").alias("one"))
    right = references.select(*key, F.lit(None).cast("bigint").alias("declared"), F.lit(1).cast("bigint").alias("one"))
    totals = left.unionByName(right).groupBy(*key).agg(F.max("declared").alias("declared"), F.sum("one").alias("actual"))
    return totals.where(~F.col("declared").eqNullSafe(F.col("actual")))


def set_equality(declared: DataFrame, derived: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """(key, only_declared, only_derived) where two sets of non-null values differ.

    Order and duplicates do not matter. Values are reduced per (key, value) before the per-key count.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        flags = [F.lit(name == n).alias(n) for n in ("declared", "derived")]
        return df.where(F.col(value).isNotNull()).select(*key, value, *flags)

    both = side(declared, "declared").unionByName(side(derived, "derived"))
    values = both.groupBy(*key, value).agg(F.max("declared").alias("declared"), F.max("derived").alias("derived"))
    differing = values.where(F.col("declared") != F.col("derived"))
    return differing.groupBy(*key).agg(
        F.count_if("declared").alias("only_declared"), F.count_if("derived").alias("only_derived")
    )
