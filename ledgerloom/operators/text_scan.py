"""Scans of text columns for content that must not leave a private side."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import patterns as P
from ledgerloom.functions import text as X
from ledgerloom.operators.findings import as_findings


def decode_forms(df: DataFrame, text: str, base64_characters: tuple[int, int] = X.BASE64_CHARACTERS) -> DataFrame:
    """Adds ``forms``: the raw, NFKC, percent-decoded and base64-decoded forms without repeats.

    Only texts of a length in ``base64_characters`` are tried as base64.
    """
    prepared = df.withColumn("__nfkc", X.nfkc_changed(F.col(text)))
    return prepared.withColumn("forms", X.decoded_forms(F.col(text), F.col("__nfkc"), base64_characters)).drop("__nfkc")


def classify_sensitive(
    df: DataFrame, text: str, *, output: str = "sensitive_class", private_names: Sequence[str] = (),
    base64_characters: tuple[int, int] = X.BASE64_CHARACTERS,
) -> DataFrame:
    """Adds the first sensitive class of a value over its decoded forms, NULL when there is none.

    All classes are tried on the raw form before any other form. The other forms are classified
    only on the rare rows where they differ from the raw one. Whole texts are scanned.
    """
    raw = F.col(text)
    prepared = df.withColumn("__nfkc", X.nfkc_changed(raw))
    others = F.slice(X.decoded_forms(raw, F.col("__nfkc"), base64_characters), 2, 3)
    prepared = prepared.withColumn("__others", F.when(X.may_have_other_forms(raw, F.col("__nfkc"), base64_characters), others))
    first = X.sensitive_class_of_form(raw, private_names)
    classes = F.filter(
        F.transform("__others", lambda form: X.sensitive_class_of_form(form, private_names)), lambda c: c.isNotNull()
    )
    later = F.when(F.size("__others") > 0, F.get(classes, F.lit(0)))
    found = F.when(~X.is_exempt(raw), F.coalesce(first, later))
    # Through a generator, so that a filter on the class stays above it and the text is scanned once.
    return prepared.select(*df.columns, F.explode(F.array(found)).alias(output))


def nonpublic_hosts(df: DataFrame, id_columns: Sequence[str], text: str) -> DataFrame:
    """(id, host): the distinct non-public hosts named in each text, in lower case, without final dots.

    A name whose first label is all hexadecimal digits is cut as an address, as the class scan cuts it: ``db.internal`` is
    not seen, and ``foo.lan`` is seen as ``oo.lan``.
    """
    hosts = df.select(*id_columns, F.explode(X.host_tokens(F.col(text))).alias("host"))
    return hosts.where(X.is_nonpublic_host(F.col("host")))


def scan_strings(
    leaves: DataFrame, id_columns: Sequence[str], *, path: str = "path", value: str = "value", private_names: Sequence[str] = ()
) -> DataFrame:
    """Findings for leaves that hold a sensitive value: path and class, never the value."""
    classified = classify_sensitive(leaves, value, private_names=private_names).where(F.col("sensitive_class").isNotNull())
    message = F.concat(F.lit("prohibited public value class: "), F.col("sensitive_class"))
    key = F.concat_ws("/", *[F.col(c).cast("string") for c in id_columns])
    return as_findings(classified, "sensitive-value", F.col(path), message, key)


def private_text_flags(text: Column, expressions: Mapping[str, str] = P.PRIVATE_TEXT) -> dict[str, Column]:
    """One boolean per pattern of the narrower scan; a literal test runs first where one is known."""
    flags = {}
    for name, expression in expressions.items():
        flags[name] = X.guarded(text, P.PRIVATE_TEXT_NEEDS.get(name, ()), expression)
    return flags


def private_text_hits(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """Texts hit per pattern, and in total, per group; one pass over the text."""
    flags = private_text_flags(F.col(text))
    marked = df.select(*by, *[flag.alias(name) for name, flag in flags.items()])
    any_hit = F.lit(False)
    for name in flags:
        any_hit = any_hit | F.col(name)
    counts = [F.count_if(F.col(name)).alias(name) for name in flags]
    return marked.groupBy(*by).agg(F.count(F.lit(1)).alias("texts"), *counts, F.count_if(any_hit).alias("any_hit"))


def prohibited_claim(text: Column, subject: str, verbs: str = P.PROHIBITED_VERBS) -> Column:
    """The subject and a proving word within 80 characters on one line, in either order."""
    name = rf"{P.B}{re.escape(subject)}{P.B}"
    word = rf"(?<!{P.W}){verbs}(?!{P.W})"
    either = rf"{P.I}(?:{name}[^\n]{{0,80}}{word}|{word}[^\n]{{0,80}}{name})"
    return F.lower(text).contains(subject.lower()) & text.rlike(either)


def prohibited_claims(df: DataFrame, text: str, subject: str, verbs: str = P.PROHIBITED_VERBS) -> DataFrame:
    """Rows whose text makes a prohibited claim about the subject."""
    return df.where(prohibited_claim(F.col(text), subject, verbs))
