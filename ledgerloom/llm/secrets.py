"""Secret scans: candidates by pattern, then judged by how many repositories and owners of the whole corpus hold the same value."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.joins import lookup_join
from ledgerloom.llm.shared import written

#: Fixed patterns of the base kinds, in the order of the kinds. Letters of ``assign`` are in either case, of ASCII only.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

#: What the method adds: other runs of characters that keys are written in.
GENERIC = r"[A-Za-z0-9+/_-]+"

KINDS = ("assign", "access", "hex", "generic")

#: Least characters: of the value of ``assign``, of a whole match of the other kinds.
LEAST = {"assign": 8, "access": 16, "hex": 32, "generic": 20}

#: Different characters of a value that looks live; words that mark one as an example.
DIFFERENT = 8
EXAMPLE_WORDS = ("example", "changeme", "placeholder", "dummy", "sample", "your", "xxxx", "1234", "abcd")

#: A value of this many owners or repositories is a widely copied example; one of fewer owners is specific to them.
WIDE_OWNERS, WIDE_REPOSITORIES = 4, 64

_ASSIGN = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
# Short runs are skipped by the expression; what is left is the same, for runs do not depend on where others end.
_PLAIN = [(1, re.compile(r"AKIA[A-Z0-9]{12,}")), (2, re.compile(r"[0-9a-f]{32,}"))]
_GENERIC = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")


def looks_live(value: str) -> bool:
    """Whether a value holds a letter and a digit, enough different characters, and no word that marks an example."""
    if len(set(value)) < DIFFERENT or not re.search("[0-9]", value) or not re.search("[A-Za-z]", value):
        return False
    lower = value.lower()
    return not any(w in lower for w in EXAMPLE_WORDS)


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, value) by start and kind, in code points. Generic ones overlap no base one and mix cases and digits."""
    found = [(m.start(), m.end(), 0, m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for kind, pattern in _PLAIN:
        found += [(m.start(), m.end(), kind, m[0]) for m in pattern.finditer(text)]
    found.sort()
    base = list(found)
    for m in _GENERIC.finditer(text):
        if re.search("[0-9]", m[0]) and re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0]) and looks_live(m[0]) and not any(a < m.end() and m.start() < b for a, b, _, _ in base):
            found.append((m.start(), m.end(), 3, m[0]))
    found.sort()
    return found


def _value_hash(value: str) -> bytes:
    return hashlib.blake2b(value.encode(), digest_size=16).digest()


_SPAN = "struct<start:bigint,end:bigint,kind:int,hash:binary,live:boolean>"
_SPAN_ARROW = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("hash", pa.binary()), ("live", pa.bool_())])


def _scanned(docs: DataFrame, keep: list[str], owner: str, repository: str, text: str) -> DataFrame:
    """``row, owner, repository, print, spans``: every row of ``docs`` with its candidates. Values leave a task as hashes only."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{owner}`").cast("string").alias("owner"), F.col(f"`{repository}`").cast("string").alias("repository"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("body"),
    )
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, prints = [], []
            for repo, own, body in zip(batch.column("repository").to_pylist(), batch.column("owner").to_pylist(), batch.column("body").to_pylist(), strict=True):
                found = candidates(body)
                spans.append([{"start": a, "end": b, "kind": k, "hash": _value_hash(v), "live": looks_live(v)} for a, b, k, v in found])
                # Rows of equal print have equal candidates.
                prints.append(hashlib.blake2b(repr((repo, own, found)).encode(), digest_size=16).digest() if found else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("owner"), batch.column("repository"), pa.array(prints, pa.binary()), pa.array(spans, pa.list_(_SPAN_ARROW))],
                names=["row", "owner", "repository", "print", "spans"],
            )

    return rows.mapInArrow(run, f"row {kind}, owner string, repository string, print binary, spans array<{_SPAN}>")


def ownership(spans: DataFrame) -> DataFrame:
    """``hash, owners, repositories``: in how many different owners and repositories each value is (``hash, owner, repository``).

    Null owners are one owner. Summed in three steps with partial sums before each exchange, so a value that
    a third of all documents hold is counted in as many tasks as there are.
    """
    # One owner's repositories are counted apart; then owners.
    once = spans.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    per_owner = once.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return per_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def scan_secrets(docs: DataFrame, keep: list[str], *, owner: str = "source", repository: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs``: ``row`` (its columns ``keep``) and ``spans``, an array of ``start, end, kind, verdict, owners, repositories``.

    Offsets are code points of the whole text, ends exclusive; null and empty texts have no spans; repeated rows each
    have theirs. ``verdict``: ``example`` if the value is held by WIDE_OWNERS owners or WIDE_REPOSITORIES repositories or does not look live,
    else ``live``. All base candidates are returned; a generic one only if it is live. Kinds are indices of KINDS.
    """
    scanned = written(_scanned(docs, keep, owner, repository, text), "secret_candidates")
    found = scanned.where("print is not null")
    hashes = found.select("owner", "repository", F.explode("spans.hash").alias("hash"))
    # One row of each print: copies of a row have the same spans.
    spans = found.groupBy("print").agg(F.any_value("spans").alias("spans")).select("print", F.explode("spans").alias("span")).select("print", "span", F.col("span.hash").alias("hash"))
    wide = (F.col("owners") >= WIDE_OWNERS) | (F.col("repositories") >= WIDE_REPOSITORIES)
    verdict = F.when(F.col("span.live") & ~wide, F.lit("live")).otherwise(F.lit("example"))
    judged = lookup_join(spans, ownership(hashes), ["hash"]).select("print", "span", verdict.alias("verdict"), "owners", "repositories").where("span.kind < 3 or verdict = 'live'")
    per_print = judged.groupBy("print").agg(
        F.array_sort(F.collect_list(F.struct("span.start", "span.kind", "span.end", "verdict", "owners", "repositories"))).alias("judged")
    )
    return lookup_join(scanned.select("row", "print"), per_print, ["print"], "left").select(
        "row", F.coalesce("judged", F.array().cast(per_print.schema["judged"].dataType)).alias("spans")
    )


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of spans in order, comma-joined."""
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")
