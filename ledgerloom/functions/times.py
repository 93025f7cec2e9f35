"""Timestamps held as RFC 3339 text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted time text, and the one canonical spelling of a UTC instant.
_RFC3339 = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:\d{2})?)?\z"
)
_DATE = r"^\d{4}-\d{2}-\d{2}\z"
_HAS_ZONE = r"(?:Z|:\d{2}(?:\.\d+)?[+-]\d{2}:\d{2})\z"
_CANONICAL_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.(?!000000)\d{6})?Z\z"


def parse_time(text: Column) -> Column:
    """Instant of an RFC 3339 text; text without an offset is UTC; NULL when unparsable.

    The result does not depend on the session time zone.
    """
    with_zone = (
        F.when(text.rlike(_DATE), F.concat(text, F.lit("T00:00:00Z"))).when(text.rlike(_HAS_ZONE), text)
        .otherwise(F.concat(text, F.lit("Z")))
    )
    return F.when(text.rlike(_RFC3339), F.try_to_timestamp(with_zone))


def is_canonical_utc(text: Column) -> Column:
    """True when the text parses and is already the canonical UTC spelling of its instant."""
    return text.rlike(_CANONICAL_UTC) & parse_time(text).isNotNull()
