"""The operators of ``ledgerloom`` on the driver's tables, each with its SQL oracle.

A rule that no row of the clean tables breaks would prove nothing, so some queries derive a changed
copy of a table from its own columns first; the oracle derives the same copy.
"""

from driver_queries import (  # noqa: F401
    contract_queries, digest_queries, export_queries, history_queries, reference_queries, release_queries, rollup_queries,
    text_queries,
)
from driver_queries.registry import ORACLES, QUERIES  # noqa: F401
