"""Comparison of tables that should say the same thing.

Two sides are compared by stacking them and reducing per key, not by a join: partial sums run
before the shuffle, a key with many copies is reduced instead of paired, and copies are reported.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.joins import lookup_join

# The limits of one bundle.
MAX_BUNDLE_FILES = 128
MAX_FILE_BYTES = 8 * 1024 * 1024


def _stack(left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per key: copies on each side (n_left, n_right) and the values (l, r)."""

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        values = F.struct(*[F.col(c).alias(c) for c in cols]) if cols else F.struct(F.lit(1).alias("one"))
        return df.select(
            *keys, F.lit(1 if is_left else 0).cast("bigint").alias("n_left"),
            F.lit(0 if is_left else 1).cast("bigint").alias("n_right"), values.alias("v"),
        )

    stacked = side(left, True).unionByName(side(right, False))
    return stacked.groupBy(*keys).agg(
        F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"),
        F.max(F.when(F.col("n_left") == 1, F.col("v"))).alias("l"),
        F.max(F.when(F.col("n_right") == 1, F.col("v"))).alias("r"),
    )


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(keys, reason, column, left_value, right_value) for every disagreement of two tables.

    Nulls compare equal. A key missing on a side, or held more than once on a side, is one row with
    a null column.
    """
    both = _stack(left, right, keys, cols)
    none = F.lit(None).cast("string")

    def entry(reason: str, column: Column = none, lv: Column = none, rv: Column = none) -> Column:
        return F.struct(
            F.lit(reason).alias("reason"), column.alias("column"), lv.cast("string").alias("left_value"),
            rv.cast("string").alias("right_value"),
        )

    differing = F.array_compact(
        F.array(*[
            F.when(~F.col("l")[c].eqNullSafe(F.col("r")[c]), entry("mismatch", F.lit(c), F.col("l")[c], F.col("r")[c]))
            for c in cols
        ])
    )
    verdict = (
        F.when((F.col("n_left") > 1) | (F.col("n_right") > 1), F.array(entry("duplicate-key")))
        .when(F.col("n_right") == 0, F.array(entry("missing-right")))
        .when(F.col("n_left") == 0, F.array(entry("missing-left")))
        .otherwise(differing)
    )
    found = both.select(*keys, F.explode(verdict).alias("e"))
    return found.select(*keys, "e.reason", "e.column", "e.left_value", "e.right_value")


def path_closure(
    declared: DataFrame, actual: DataFrame, bundle: Sequence[str], *, self_path: str | None = None,
    max_files: int = MAX_BUNDLE_FILES, max_bytes: int = MAX_FILE_BYTES,
) -> DataFrame:
    """(bundle, path, reason) wherever declared and actual files are not the same exact set.

    Both sides hold (bundle, path, digest, size). ``self_path`` is the listing itself: present, but
    never listed. Count and size limits are checked on the actual files.
    """
    keys = [*bundle, "path"]

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            *keys, F.lit(prefix == "d").alias("is_declared"), F.col("digest"), F.col("size").cast("bigint").alias("size")
        )

    stacked = side(declared, "d").unionByName(side(actual, "a"))
    listed = F.col("is_declared")
    both = stacked.groupBy(*keys).agg(
        F.count_if(listed).alias("n_declared"), F.count_if(~listed).alias("n_actual"),
        F.max(F.when(listed, F.col("digest"))).alias("declared_digest"), F.max(F.when(~listed, F.col("digest"))).alias("actual_digest"),
        F.max(F.when(listed, F.col("size"))).alias("declared_size"), F.max(F.when(~listed, F.col("size"))).alias("actual_size"),
    )
    is_self = F.col("path") == self_path if self_path is not None else F.lit(False)
    once = (F.col("n_declared") == 1) & (F.col("n_actual") == 1)
    reasons = F.array_compact(
        F.array(
            F.when(is_self & (F.col("n_declared") > 0), F.lit("self-listed")),
            F.when((F.col("n_declared") > 1) | (F.col("n_actual") > 1), F.lit("path-duplicate")),
            F.when((F.col("n_declared") > 0) & (F.col("n_actual") == 0), F.lit("path-missing")),
            F.when((F.col("n_declared") == 0) & ~is_self, F.lit("path-extra")),
            F.when(once & ~F.col("declared_digest").eqNullSafe(F.col("actual_digest")), F.lit("digest-mismatch")),
            F.when(once & ~F.col("declared_size").eqNullSafe(F.col("actual_size")), F.lit("size-mismatch")),
            F.when(F.col("actual_size") > max_bytes, F.lit("file-too-large")),
        )
    )
    per_path = both.select(*keys, F.explode(reasons).alias("reason"))
    counted = actual.groupBy(*bundle).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_files)
    per_bundle = counted.select(*bundle, F.lit(None).cast("string").alias("path"), F.lit("too-many-files").alias("reason"))
    return per_path.unionByName(per_bundle)


def match_exactly_one(df: DataFrame, catalog: DataFrame, on: Sequence[str], also_equal: Mapping[str, str]) -> DataFrame:
    """Rows with a ``reason`` where they do not match exactly one catalog entry.

    ``also_equal`` maps a row column to the catalog column it must equal (null-safe) on the match.
    """
    attributes = F.struct(F.lit(1).alias("one"), *[F.col(c).alias(f"c_{c}") for c in also_equal.values()])
    entries = catalog.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"), F.max(attributes).alias("__entry"))
    joined = lookup_join(df, entries, on, "left")
    differs = F.lit(False)
    for column, other in also_equal.items():
        differs = differs | ~F.col(column).eqNullSafe(F.col("__entry")[f"c_{other}"])
    reason = (
        F.when(F.col("__n").isNull(), "no-match").when(F.col("__n") > 1, "ambiguous").when(differs, "attribute-mismatch")
    )
    return joined.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("__n", "__entry")


def deny_listed(df: DataFrame, deny: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows that do match an entry of a deny list."""
    return lookup_join(df, deny.select(*on).distinct(), on, "left_semi")


def mapping_complete(
    roles: DataFrame, role: str, statuses: Sequence[str], mapping: DataFrame, raw: str, normalized: str
) -> DataFrame:
    """(role, status, reason) wherever roles x statuses do not map exactly once, to themselves.

    The statuses are a literal vocabulary, so the expected pairs come from a generator.
    """
    wanted = roles.select(F.col(role).alias("role"), F.explode(F.array(*[F.lit(s) for s in statuses])).alias("status"))
    none = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    left = wanted.select("role", "status", one.alias("wanted"), none.alias("mapped"), none.alias("altered"))
    right = mapping.select(
        F.col(role).alias("role"), F.col(raw).alias("status"), none.alias("wanted"), one.alias("mapped"),
        (~F.col(normalized).eqNullSafe(F.col(raw))).cast("bigint").alias("altered"),
    )
    totals = left.unionByName(right).groupBy("role", "status").agg(
        F.max("wanted").alias("wanted"), F.sum("mapped").alias("mapped"), F.sum("altered").alias("altered")
    )
    reason = (
        F.when(F.col("wanted") == 0, "unknown-pair").when(F.col("mapped") == 0, "unmapped")
        .when(F.col("mapped") > 1, "mapped-twice").when(F.col("altered") > 0, "not-identity")
    )
    return totals.select("role", "status", reason.alias("reason")).where(F.col("reason").isNotNull())


def sequence_parity(left: DataFrame, right: DataFrame, sequence: Sequence[str], position: str, item: str) -> DataFrame:
    """(sequence, position, reason, left_value, right_value) where two ordered lists differ."""
    found = reconcile(left, right, [*sequence, position], [item])
    return found.select(*sequence, position, "reason", "left_value", "right_value")


def rederive_and_compare(stored: DataFrame, derived: DataFrame) -> DataFrame:
    """Rows that are not equally often in both tables, with the side and the surplus.

    One reduction answers both directions, duplicates included.
    """
    columns = stored.columns
    left = stored.select(*columns, F.lit(1).cast("bigint").alias("__w"))
    right = derived.select(*columns, F.lit(-1).cast("bigint").alias("__w"))
    surplus = left.unionByName(right).groupBy(*columns).agg(F.sum("__w").alias("__w")).where(F.col("__w") != 0)
    side = F.when(F.col("__w") > 0, "only-stored").otherwise("only-derived")
    return surplus.select(*columns, side.alias("side"), F.abs("__w").alias("surplus"))


def disjoint_cover(members: DataFrame, set_name: str, value: str, universe: DataFrame) -> DataFrame:
    """(value, reason): in two sets, in no set, or outside the universe."""
    left = members.select(F.col(value).alias("value"), F.col(set_name).alias("s"), F.lit(False).alias("in_universe"))
    right = universe.select(F.col(value).alias("value"), F.lit(None).cast("string").alias("s"), F.lit(True).alias("in_universe"))
    seen = left.unionByName(right).groupBy("value").agg(
        F.min("s").alias("low"), F.max("s").alias("high"), F.max("in_universe").alias("in_universe")
    )
    reason = (
        F.when(~F.col("in_universe"), "outside-universe").when(F.col("low").isNull(), "uncovered")
        .when(F.col("low") != F.col("high"), "overlap")
    )
    return seen.select("value", reason.alias("reason")).where(F.col("reason").isNotNull())


def outcome_regression(expected: DataFrame, actual: DataFrame, case: Sequence[str], outcome: Sequence[str]) -> DataFrame:
    """Case table: every case is covered once and its actual outcome equals the expected one."""
    return reconcile(expected, actual, case, outcome)
