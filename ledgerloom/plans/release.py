"""Trust at a point in time, status rules, and the classification of releases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.ordered import with_history
from ledgerloom.operators import contracts as C
from ledgerloom.operators import history as H
from ledgerloom.operators.findings import first_failure
from ledgerloom.operators.reconcile import path_closure
from ledgerloom.operators.rollup import CLAIM_RESULTS

# States, overall results and their exit classes.
REPLACED = ("superseded", "corrected")
ENDED = ("withdrawn", "superseded", "corrected", "expired")
PLAIN = ("active", "expired")
VERIFIED = "verified-fixture-with-limitations"
EXIT_CLASS = {
    VERIFIED: 0, "invalid-structure": 1, "incomplete-bundle": 1, "invalid-signature": 1, "invalid-report-linkage": 1,
    "unsupported-algorithm": 2, "revoked-key": 3, "untrusted-key": 3, "expired-release": 4, "withdrawn-release": 4,
    "superseded-release": 4, "corrected-release": 4, "claims-not-supported": 5, "not-evaluated": 5,
}
# Verification stages, in the order in which a verification fails.
STAGES = ("structure", "digests", "trust", "signature", "linkage", "lifecycle")


def valid_at(
    facts: DataFrame, keys: DataFrame, key: str, at: str, usage: str | Column, *, valid_from: str = "valid_from",
    valid_until: str = "valid_until",
) -> DataFrame:
    """Adds ``trusted`` and ``trust_reason`` to facts that name a key and a time.

    ``keys``: (key, usage, status, valid_from, valid_until), one row per key. Both ends of the
    interval count. An unknown key is untrusted. The key is the join column and the interval is
    tested on the joined row, so this is a hash-partitioned join whose hot keys can be split.
    """
    wanted = F.lit(usage) if isinstance(usage, str) else usage
    known = keys.select(
        F.col(key), F.col("usage").alias("__usage"), F.col("status").alias("__status"), F.col(valid_from).alias("__from"),
        F.col(valid_until).alias("__until"),
    )
    joined = facts.join(known, key, "left")
    reason = (
        F.when(F.col("__usage").isNull(), "key-unknown").when(F.col("__usage") != wanted, "key-usage")
        .when(~F.coalesce(F.col(at).between(F.col("__from"), F.col("__until")), F.lit(False)), "key-validity")
        .when(~F.col("__status").eqNullSafe(F.lit("active")), "key-status")
    )
    return joined.withColumn("trust_reason", reason).withColumn("trusted", F.col("trust_reason").isNull()).drop(
        "__usage", "__status", "__from", "__until"
    )


def release_entry_rules(at: Column, release: str = "release_id", bundle: str = "bundle_digest") -> list[C.Rule]:
    """State-dependent fields of one release status entry, at an evaluation time."""
    state = F.col("state")
    other, other_bundle, notice = F.col("replacement_release_id"), F.col("replacement_bundle_digest"), F.col("notice_digest")
    replaced = state.isin(list(REPLACED))
    either = other.isNotNull() | other_bundle.isNotNull()

    def rule(code: str, field: str, bad: Column, message: str) -> C.Rule:
        return C.Rule(code, field, F.coalesce(bad, F.lit(False)), message)

    return [
        rule("status-entry-future", "effective_at", F.col("effective_at") > at, "entry is not yet effective"),
        rule("replacement-binding", "replacement_release_id", replaced & (other.isNull() | other_bundle.isNull()), "a replacement needs both ids"),
        rule("replacement-cycle", "replacement_release_id", replaced & ((other == F.col(release)) | (other_bundle == F.col(bundle))), "a release cannot replace itself"),
        rule("withdrawal-notice", "notice_digest", (state == "withdrawn") & notice.isNull(), "a withdrawal needs a notice"),
        rule("release-status-fields", "state", state.isin(list(PLAIN)) & (either | notice.isNotNull()), "state permits no replacement or notice"),
        rule("release-status-fields", "notice_digest", replaced & notice.isNotNull(), "a replacement carries no notice"),
        rule("release-status-fields", "replacement_release_id", (state == "withdrawn") & either, "a withdrawal carries no replacement"),
    ]


def key_entry_rules(at: Column) -> list[C.Rule]:
    """A key is revoked exactly when it is marked compromised; entries are not in the future."""
    agrees = (F.col("status") == "revoked").eqNullSafe(F.col("compromise_indicator"))
    return [
        C.Rule("status-entry-future", "effective_at", F.col("effective_at") > at, "entry is not yet effective"),
        C.Rule("revocation-policy", "compromise_indicator", ~agrees, "revocation and compromise must agree"),
    ]


def entry_count(entries: DataFrame, release: Sequence[str]) -> DataFrame:
    """(release, entries) of releases that do not have exactly one status entry."""
    return entries.groupBy(*release).agg(F.count(F.lit(1)).alias("entries")).where(F.col("entries") != 1)


def classify_release(releases: DataFrame, at: Column) -> DataFrame:
    """Adds ``overall`` and ``exit_class``; first match wins.

    Columns used: ``key_status``, ``valid_from``, ``valid_until``, ``release_state`` and the claim
    counts ``n_not_supported``, ``n_invalid_reference`` and ``n_not_evaluated``. A state nobody knows
    is a structural error, never a pass.
    """
    key, state = F.col("key_status"), F.col("release_state")
    overall = (
        F.when(key == "revoked", "revoked-key").when(~key.eqNullSafe(F.lit("active")), "untrusted-key")
        .when((at < F.col("valid_from")) | (at > F.col("valid_until")), "expired-release")
        .when(state.isin(list(ENDED)), F.concat(state, F.lit("-release")))
        .when(~state.eqNullSafe(F.lit("active")), "invalid-structure")
        .when((F.col("n_not_supported") > 0) | (F.col("n_invalid_reference") > 0), "claims-not-supported")
        .when(F.col("n_not_evaluated") > 0, "not-evaluated").otherwise(VERIFIED)
    )
    rows = releases.withColumn("overall", overall)
    return rows.withColumn("exit_class", exit_class(F.col("overall")))


def exit_class(overall: Column) -> Column:
    """Exit class of an overall result; an unknown result is a structural error."""
    pairs = [F.lit(x) for item in EXIT_CLASS.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), overall), F.lit(1))


def verification_result(classified: DataFrame, failures: DataFrame, release: str) -> DataFrame:
    """One result row per release: stage booleans, and either the classification or the first failure.

    ``failures``: (release, stage, status, reason), any number per release, where stage is one of
    ``STAGES``. Failures are reduced per release before they meet the releases. When a release failed,
    only the earliest stage's status and reason are reported, and its lifecycle result is withheld.
    """
    order = F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("stage")).cast("int")
    staged = failures.withColumn("__order", order)
    first = first_failure(staged, [release], "__order", ["status", "reason"])
    broken = staged.groupBy(release).agg(*[F.bool_or(F.col("stage") == s).alias(f"__{s}") for s in STAGES])
    joined = classified.join(first, release, "left").join(broken, release, "left")
    failed = F.col("__order").isNotNull()
    stages = [(~F.coalesce(F.col(f"__{s}"), F.lit(False))).alias(f"{s}_valid") for s in STAGES]
    kept = [c for c in classified.columns if c not in ("overall", "exit_class", release)]
    return joined.select(
        release, *stages, *[F.when(~failed, F.col(c)).alias(c) for c in kept],
        F.when(failed, F.col("status")).otherwise(F.col("overall")).alias("overall"),
        F.when(failed, exit_class(F.col("status"))).otherwise(F.col("exit_class")).alias("exit_class"),
        F.when(failed, F.col("reason")).alias("reason"),
    )


def chain_failures(chain: DataFrame, at: Column, release: str = "release_id") -> DataFrame:
    """(release, stage, status, reason) for every broken rule of the releases' status chains.

    ``chain``: one row per release and revision (a second one is ``release-status-binding``) with ``position`` (stored order), ``revision``,
    ``status_set_digest``, ``previous_digest``, ``generated_at``, ``key_status``,
    ``compromise_indicator`` and the columns of :func:`release_entry_rules`.
    """
    key, order = [release], ["position", "status_set_digest"]
    # All look-backs share one pass along the chain.
    revoked, ended = F.col("key_status") == "revoked", F.col("state") != "active"
    linked = with_history(
        chain, key, order, lag={"__before": F.col("status_set_digest"), "__same": F.col("position")}, last_valid={"__last": F.col("generated_at")},
        seen={"__revoked": revoked, "__ended": ended}, position="__place",
    )
    steps = F.array_compact(F.array(
        F.when(F.col("position") == F.col("__same"), "release-status-binding"),
        F.when(~F.col("revision").eqNullSafe(F.col("__place")), "status-chain-revision-sequence"),
        F.when(~F.col("previous_digest").eqNullSafe(F.col("__before")), "status-chain-revision-binding"),
        F.when(F.col("generated_at") <= F.col("__last"), "status-chain-revision-order"),
        F.when(F.col("__revoked") & ~F.coalesce(revoked, F.lit(False)), "status-chain-key-state-rollback"),
        F.when(F.col("__ended") & (F.col("state") == "active"), "status-chain-release-state-rollback"),
    ))
    stepped = linked.select(release, F.explode(steps).alias("reason"))
    entries = chain.withColumn("status", F.col("key_status"))
    rules = [*release_entry_rules(at, release), *key_entry_rules(at)]
    found = C.check(entries, rules, path=F.col(release), key=F.col(release), keep=key).select(release, F.col("code").alias("reason"))
    found = found.unionByName(stepped)
    return found.select(release, F.lit("lifecycle").alias("stage"), F.lit("invalid-structure").alias("status"), "reason")


def verify_releases(
    releases: DataFrame, declared: DataFrame, actual: DataFrame, keys: DataFrame, chain: DataFrame, claims: DataFrame, at: Column,
    *, self_path: str | None = None,
) -> DataFrame:
    """One verification result per release at an evaluation time.

    ``releases``: (release_id, bundle_digest, key_id, signature_valid, linkage_valid, valid_from,
    valid_until). ``declared`` and ``actual``: (release_id, path, digest, size). ``keys``: (key_id,
    usage, status, valid_from, valid_until). ``chain``: see :func:`chain_failures`. ``claims``:
    (release_id, result), one row per claim. Whether a signature is valid is an input.
    """
    release = ["release_id"]
    closure = path_closure(declared, actual, release, self_path=self_path)
    incomplete = F.col("reason").isin("path-missing", "path-extra", "digest-mismatch", "size-mismatch")
    failures = closure.select(
        "release_id", F.lit("structure").alias("stage"), F.when(incomplete, "incomplete-bundle").otherwise("invalid-structure").alias("status"), "reason"
    )
    trusted = valid_at(releases.withColumn("__at", at), keys, "key_id", "__at", "release-signing")
    gates = F.array_compact(F.array(
        F.when(F.col("trust_reason").isNotNull(), _failure("trust", "untrusted-key", F.col("trust_reason"))),
        F.when(~F.coalesce("signature_valid", F.lit(False)), _failure("signature", "invalid-signature", F.lit("release-signature-invalid"))),
        F.when(~F.coalesce("linkage_valid", F.lit(False)), _failure("linkage", "invalid-report-linkage", F.lit("static-report-linkage-invalid"))),
    ))
    failures = failures.unionByName(trusted.select("release_id", F.explode(gates).alias("f")).select("release_id", "f.stage", "f.status", "f.reason"))
    broken = chain_failures(chain, at)
    latest = H.latest_state(chain, release, "revision", ["key_status", "state"], broken)
    counted = claims.groupBy(*release).agg(
        *[F.count_if(F.col("result") == r).alias("n_" + r.replace("-", "_")) for r in CLAIM_RESULTS]
    )
    counts = ["n_" + r.replace("-", "_") for r in CLAIM_RESULTS]
    joined = releases.join(latest, release, "left").join(counted, release, "left").select(
        "release_id", "valid_from", "valid_until", "key_status", F.col("state").alias("release_state"), "latest_revision",
        *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in counts],
    )
    absent = joined.where(F.col("latest_revision").isNull()).select(
        "release_id", F.lit("lifecycle").alias("stage"), F.lit("invalid-structure").alias("status"), F.lit("status-chain-missing").alias("reason")
    )
    return verification_result(classify_release(joined, at), failures.unionByName(broken).unionByName(absent), "release_id")


def _failure(stage: str, status: str, reason: Column) -> Column:
    return F.struct(F.lit(stage).alias("stage"), F.lit(status).alias("status"), reason.alias("reason"))
