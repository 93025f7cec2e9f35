"""Checks over append-only histories and revision chains.

A history is a log table with one row per entry: key columns, order columns (a total order inside a
key) and the entry's values. ``chunk`` is explained in :mod:`ledgerloom.functions.ordered`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.joins import lookup_join
from ledgerloom.functions.ordered import AUTO, with_history


def _step_allowed(source: Column, target: Column, transitions: Mapping[str, Iterable[str]]) -> Column:
    pairs = [f"{a}>{b}" for a, targets in transitions.items() for b in sorted(targets)]
    return F.concat(source, F.lit(">"), target).isin(pairs)


def invalid_transitions(
    log: DataFrame, key: Sequence[str], order: Sequence[str], state: str,
    transitions: Mapping[str, Iterable[str]], chunk: Column | str | None = AUTO,
) -> DataFrame:
    """Entries reached by a step that is not in the transition table.

    Adds ``step`` (0-based index of the entry) and ``from_state``. A source state the table does not
    know is invalid; a step with a null state on either side is skipped.
    """
    rows = with_history(log, key, order, lag={"from_state": F.col(state)}, position="__n", chunk=chunk)
    allowed = _step_allowed(F.col("from_state"), F.col(state), transitions)
    return rows.where(~allowed).withColumn("step", F.col("__n") - 1).drop("__n")


def invalid_steps(history: Column, transitions: Mapping[str, Iterable[str]]) -> Column:
    """Messages for the wrong steps of a history held as an array inside one record; no shuffle."""
    steps = F.transform(
        F.slice(history, 1, F.greatest(F.size(history) - 1, F.lit(0))),
        lambda entry, i: F.struct((i + 1).alias("step"), entry["state"].alias("a"), F.get(history, i + 1)["state"].alias("b")),
    )
    wrong = F.filter(steps, lambda s: ~_step_allowed(s["a"], s["b"], transitions))
    return F.transform(
        wrong,
        lambda s: F.concat(F.lit("invalid transition at index "), s["step"].cast("string"), F.lit(": "), s["a"], F.lit(" -> "), s["b"]),
    )


def unordered_times(history: Column, parse) -> Column:
    """Messages for entries of an in-record history that do not come after the last parsable time."""
    start = F.struct(
        F.lit(0).alias("i"), F.lit(None).cast("timestamp").alias("at"), F.array().cast("array<string>").alias("bad")
    )

    def step(acc: Column, entry: Column) -> Column:
        at = parse(entry["recorded_at"])
        note = F.concat(F.lit("entry "), acc["i"].cast("string"), F.lit(": recorded_at must increase"))
        bad = F.when(F.coalesce(at <= acc["at"], F.lit(False)), F.array_append(acc["bad"], note)).otherwise(acc["bad"])
        return F.struct((acc["i"] + 1).alias("i"), F.coalesce(at, acc["at"]).alias("at"), bad.alias("bad"))

    return F.aggregate(history, start, step, lambda acc: acc["bad"])


def history_boundaries(
    log: DataFrame, key: Sequence[str], order: Sequence[str], state: str, *, start: str, current: DataFrame | None = None,
    current_state: str | None = None,
) -> DataFrame:
    """(key, first_state, last_state, reason) where a history starts or ends in the wrong state.

    ``current`` holds (key, ``current_state``), one row per key. Without it only starts are checked.
    """
    at = F.struct(*[F.col(name) for name in order])
    ends = log.groupBy(*key).agg(F.min_by(state, at).alias("first_state"), F.max_by(state, at).alias("last_state"))
    reasons = [F.when(~F.col("first_state").eqNullSafe(F.lit(start)), F.lit("lifecycle-start"))]
    if current is not None:
        ends = ends.join(current.select(*key, F.col(current_state).alias("__current")), list(key), "inner")
        reasons.append(F.when(~F.col("last_state").eqNullSafe(F.col("__current")), F.lit("lifecycle-current")))
    found = ends.select(*key, "first_state", "last_state", F.explode(F.array_compact(F.array(*reasons))).alias("reason"))
    return found


def strictly_increasing(
    log: DataFrame, key: Sequence[str], order: Sequence[str], ts: str, chunk: Column | str | None = AUTO
) -> DataFrame:
    """Entries whose time is not after the last earlier non-null time, with that time.

    Equal times are findings; a null time neither fails nor resets.
    """
    rows = with_history(log, key, order, last_valid={"previous_ts": F.col(ts)}, chunk=chunk)
    return rows.where(F.col(ts) <= F.col("previous_ts"))


def revision_gaps(
    chain: DataFrame, key: Sequence[str], order: Sequence[str], revision: str, chunk: Column | str | None = AUTO
) -> DataFrame:
    """Entries whose revision is not their stored position 1, 2, ..., N; adds ``expected``."""
    rows = with_history(chain, key, order, position="expected", chunk=chunk)
    return rows.where(~F.col(revision).eqNullSafe(F.col("expected")))


def broken_links(
    chain: DataFrame, key: Sequence[str], order: Sequence[str], digest: str, previous: str,
    chunk: Column | str | None = AUTO,
) -> DataFrame:
    """Entries whose previous digest is not the digest of the entry before; adds ``expected``.

    The first entry must name no predecessor.
    """
    rows = with_history(chain, key, order, lag={"expected": F.col(digest)}, chunk=chunk)
    return rows.where(~F.col(previous).eqNullSafe(F.col("expected")))


def forks(chain: DataFrame, key: Sequence[str], previous: str) -> DataFrame:
    """(key, previous digest, successors) of digests that more than one entry follows."""
    named = chain.where(F.col(previous).isNotNull())
    grouped = named.groupBy(*key, previous).agg(F.count(F.lit(1)).alias("successors"))
    return grouped.where(F.col("successors") > 1)


def state_rollback(chain: DataFrame, key: Sequence[str], order: Sequence[str], sticky: Column) -> DataFrame:
    """Entries after the first sticky one that are not sticky themselves.

    The first sticky entry is a pre-aggregated minimum per key, joined back to the log.
    """
    at = F.struct(*[F.col(name) for name in order])
    rows = chain.withColumn("__at", at).withColumn("__sticky", F.coalesce(sticky, F.lit(False)))
    first = rows.where("__sticky").groupBy(*key).agg(F.min("__at").alias("__since"))
    after = lookup_join(rows, first, key, "inner")
    return after.where((F.col("__at") > F.col("__since")) & ~F.col("__sticky")).drop("__at", "__since", "__sticky")


def latest_state(
    chain: DataFrame, key: Sequence[str], revision: str, columns: Sequence[str], findings: DataFrame | None = None,
    pointers: DataFrame | None = None,
) -> DataFrame:
    """(key, latest_revision, entries, columns, valid, findings) of each chain's last revision.

    ``findings`` holds one row per broken rule with the key columns; the latest state counts only
    when the whole chain has none, otherwise the columns are null. ``pointers`` holds what the chain
    says about itself (key, latest_revision, entries) and must agree.
    """
    last = chain.groupBy(*key).agg(
        F.max(F.struct(F.col(revision), *[F.col(c) for c in columns])).alias("__last"), F.count(F.lit(1)).alias("entries")
    )
    out = last.select(
        *key, F.col("__last")[revision].alias("latest_revision"), "entries", *[F.col("__last")[c].alias(c) for c in columns]
    )
    broken = F.lit(0).cast("bigint")
    if findings is not None:
        counts = findings.groupBy(*key).agg(F.count(F.lit(1)).alias("__broken"))
        out = out.join(counts, list(key), "left")
        broken = F.coalesce(F.col("__broken"), broken)
    agrees = F.lit(True)
    if pointers is not None:
        named = pointers.select(*key, F.col("latest_revision").alias("__lr"), F.col("entries").alias("__en"))
        out = out.join(named, list(key), "left")
        agrees = F.col("__lr").eqNullSafe(F.col("latest_revision")) & F.col("__en").eqNullSafe(F.col("entries"))
    valid = (broken == 0) & agrees
    return out.select(
        *key, "latest_revision", "entries", *[F.when(valid, F.col(c)).alias(c) for c in columns],
        valid.alias("valid"), broken.alias("findings"),
    )
