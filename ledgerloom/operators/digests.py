"""Digest checks and digests of whole groups of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.digest import content_digest, domain_digest, row_digest


def verify_digest(
    df: DataFrame, stored: str, domain: str, columns: Sequence[str] | Mapping[str, Column] | None = None
) -> DataFrame:
    """Rows whose stored digest is not the one recomputed over all other columns; adds ``expected``."""
    names = columns if columns is not None else [c for c in df.columns if c != stored]
    rows = df.withColumn("expected", row_digest(names, domain))
    return rows.where(~F.col(stored).eqNullSafe(F.col("expected")))


def verify_key_ids(keys: DataFrame, key_id: str, encoded: str) -> DataFrame:
    """Keys whose id is not the digest of their decoded bytes; undecodable bytes fail."""
    decoded = F.try_to_binary(F.col(encoded), F.lit("base64"))
    return keys.where(~F.coalesce(F.col(key_id).eqNullSafe(content_digest(decoded)), F.lit(False)))


def set_digest(df: DataFrame, by: Sequence[str], member: Column, domain: str) -> DataFrame:
    """(by, members, digest): an order-free fingerprint per group, whatever the group size.

    It covers the member count and the sums of the eight 32-bit limbs of each member's SHA-256, all of its bits, so copies
    count and members never have to be brought together. A sum can be forged by whoever chooses
    the members: against that use :func:`list_digest`, which digests the ordered members themselves.
    """
    hexed = df.select(*by, F.sha2(member, 256).alias("__h"))
    limbs = hexed.select(*by, *[F.conv(F.substring("__h", 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"__l{i}") for i in range(8)])
    # Each limb is summed as two 16-bit parts: plain integer sums, safe for 2^47 members of a group.
    parts = [F.sum(F.shiftright(F.col(f"__l{i}"), 16 * j).bitwiseAND(0xFFFF)).alias(f"__s{i}_{j}") for i in range(8) for j in range(2)]
    grouped = limbs.groupBy(*by).agg(F.count("__l0").alias("members"), *parts)

    def limb_sum(i: int) -> Column:
        low, high = (F.col(f"__s{i}_{j}").cast("decimal(19,0)") for j in range(2))
        return (high * F.lit(1 << 16).cast("decimal(6,0)") + low).cast("decimal(38,0)").cast("string")

    text = F.concat_ws(":", F.col("members").cast("string"), *[limb_sum(i) for i in range(8)])
    return grouped.select(*by, "members", domain_digest(domain, text).alias("digest"))


def list_digest(df: DataFrame, by: Sequence[str], order: Sequence[str], member: Column, domain: str, chunk: Column) -> DataFrame:
    """(by, members, digest): digest of each group's members in order, for groups of any size.

    ``chunk`` never decreases along ``order`` and is part of the digest's definition: members of one chunk, in order (equal
    places by member), are a JSON list that is digested, and the group's digest is that of the list of its chunks'
    digests. A group is gathered chunk by chunk, so a chunk, not a group, has to fit into a task.
    """
    rows = df.select(*by, chunk.alias("__chunk"), F.struct(*order, member.alias("__m")).alias("__e"))
    entries = F.array_join(F.transform(F.array_sort(F.collect_list("__e")), lambda e: e["__m"]), ",")
    chunks = rows.groupBy(*by, "__chunk").agg(F.count("*").alias("__n"), F.sha2(F.concat(F.lit("["), entries, F.lit("]")), 256).alias("__d"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__chunk", "__d"))), lambda c: c["__d"]), ",")
    grouped = chunks.groupBy(*by).agg(F.sum("__n").alias("members"), listed.alias("__l"))
    return grouped.select(*by, "members", domain_digest(domain, F.concat(F.lit("["), F.col("__l"), F.lit("]"))).alias("digest"))
