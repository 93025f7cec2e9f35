"""Digest columns: domain-separated SHA-256 over a stated canonical row text.

The canonical row is the JSON text of a struct whose fields are ordered by name, with nulls kept.
Use string, integer, boolean and date-time columns only: doubles have no stable text form.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape of a digest.
DIGEST_PATTERN = r"^sha256:[0-9a-f]{64}\z"


def content_digest(content: Column) -> Column:
    """``sha256:`` digest of bytes or UTF-8 text."""
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def domain_digest(domain: str, payload: Column) -> Column:
    """Digest of ``domain``, one zero byte, then the payload text."""
    prefix = F.unhex(F.lit(domain.encode("ascii").hex() + "00"))
    return content_digest(F.concat(prefix, F.encode(payload, "UTF-8")))


def canonical_row(columns: Sequence[str] | Mapping[str, Column]) -> Column:
    """JSON text of the columns, ordered by name, nulls kept."""
    named = columns if isinstance(columns, Mapping) else {name: F.col(name) for name in columns}
    ordered = [named[name].alias(name) for name in sorted(named)]
    return F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})


def row_digest(columns: Sequence[str] | Mapping[str, Column], domain: str) -> Column:
    """Digest of one row under a domain."""
    return domain_digest(domain, canonical_row(columns))


def normalize_set(values: Column) -> Column:
    """Sort a set-like array so that member order cannot reach a digest."""
    return F.array_sort(values)


def normalize_omissions(omissions: Column) -> Column:
    """Order omission structs by (path, rule_id)."""

    def compare(left: Column, right: Column) -> Column:
        a = F.struct(left["path"], left["rule_id"])
        b = F.struct(right["path"], right["rule_id"])
        return F.when(a < b, -1).when(a > b, 1).otherwise(0)

    return F.array_sort(omissions, compare)


def normalize_mixed(values: Column) -> Column:
    """Order an array of VARIANT scalars by (kind, text): booleans, then integers, then strings."""

    def sort_key(value: Column) -> Column:
        kind = F.schema_of_variant(value)
        rank = F.when(kind == "BOOLEAN", 0).when(kind == "BIGINT", 1).otherwise(2)
        return F.struct(rank, value.cast("string"))

    def compare(left: Column, right: Column) -> Column:
        a, b = sort_key(left), sort_key(right)
        return F.when(a < b, -1).when(a > b, 1).otherwise(0)

    return F.array_sort(values, compare)
