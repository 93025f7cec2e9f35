"""Line-first cleaning in DataFrame functions only: drop failing lines, then reject documents that lose too much."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import whole_row

GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"

#: Phrases of page furniture and licences.
BOILERPLATE = (
    "all rights reserved", "licensed under", "terms of service", "terms of use", "privacy policy", "cookie policy", "accept cookies",
    "enable javascript", "subscribe to", "sign up", "log in to", "click here", "share this", "powered by",
)


@dataclass(frozen=True)
class Rules:
    """Limits per line and per document, shares in percent; a line without a word passes."""

    symbols: int = 10
    separators: int = 20
    exclamations: int = 25
    stutter: int = 30
    least_words: int = 20
    repeats: int = 30
    window: int = 8
    kept_words: int = 50


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def line_failures(line: Column, words: Column, rules: Rules) -> Column:
    """Names of the rules that a line with words breaks, as an array. ``words`` is a column, not an expression to repeat."""
    n = F.size(words)
    marks = F.length(line) - F.length(F.regexp_replace(line, SYMBOLS, ""))
    bars = F.regexp_count(line, F.lit("[|›»•]"))
    shouts = F.regexp_count(line, F.lit("!"))
    stutter = F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1))))
    tests = [
        ("punctuation", ~line.rlike("[.!?…。！？]")),
        ("symbols", 100 * marks > rules.symbols * F.length(line)),
        ("navigation", 100 * bars > rules.separators * n),
        ("shouting", (shouts > 1) & (100 * shouts > rules.exclamations * n)),
        ("stutter", 100 * stutter > rules.stutter * n),
        ("boilerplate", F.lower(line).rlike("|".join(BOILERPLATE))),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests]))


def window_places(windows: Column) -> Column:
    """(hash, start) of all windows in order of hash, for a text in which a window occurs twice; else null."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed)


def repeated_starts(placed: Column) -> Column:
    """Starts of windows that occur twice or more, in order. ``placed`` is a column, not an expression to repeat."""
    twice = F.filter(placed, lambda x, i: ((i > 0) & (x["h"] == F.get(placed, i - 1)["h"])) | F.coalesce(x["h"] == F.get(placed, i + 1)["h"], F.lit(False)))
    return F.array_sort(F.transform(twice, lambda x: x["i"]))


def covered_by(starts: Column, width: int) -> Column:
    """Words inside at least one of the windows that begin at ``starts``."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("at"))
    return F.coalesce(F.aggregate(
        starts, zero,
        lambda acc, s: F.struct((acc["n"] + width - F.greatest(F.lit(0), acc["at"] - s)).alias("n"), (s + width).alias("at")),
        lambda acc: acc["n"],
    ), F.lit(0))


def measure(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, rules: Rules | None = None) -> DataFrame:
    """The measures and the verdict of each whole text.

    Returns ``row`` (the columns ``keep`` of ``docs``, all by default), ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``n_lines`` (lines with a word), ``n_failed_lines``,
    ``n_kept_words``, ``cleaned`` (the lines that pass) and ``kept``. ``kept`` is false if the base fails or if under
    ``kept_words`` percent of the words are left. Null text is an empty text: no words, rejected. One scan, no shuffle.
    """
    rules = rules or Rules()
    row = docs.select(*[F.col(f"`{c}`") for c in keep or docs.columns])
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    base = docs.select(whole_row(row), body.alias("body"))
    base = base.select("row", "body", words_of(F.col("body")).alias("words"), F.split("body", "\n").alias("lines"))
    base = base.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    hashes = F.col("hashes")
    whole = F.greatest(F.size("hashes") - (rules.window - 1), F.lit(0))
    windows = F.transform(F.slice("hashes", F.lit(1), whole), lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, rules.window)]))
    # A line's words become values here: an expression inside a lambda would be evaluated again for every element.
    lines = F.transform("lines", lambda x: F.struct(x.alias("line"), words_of(x).alias("words")))
    base = base.select("row", "body", "words", windows.alias("windows"), lines.alias("lines"))
    base = base.select("row", "body", "words", window_places(F.col("windows")).alias("placed"), "lines")
    judged = F.transform("lines", lambda x: F.struct(
        x["line"].alias("line"), F.size(x["words"]).alias("n"),
        F.when(F.size(x["words"]) > 0, F.size(line_failures(x["line"], x["words"], rules))).otherwise(F.lit(0)).alias("failures"),
    ))
    full = F.transform(F.filter("lines", lambda x: F.size(x["words"]) > 0), lambda x: x["line"])
    base = base.select(
        "row", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("body") - F.length(F.regexp_replace("body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        full.alias("full"), repeated_starts(F.col("placed")).alias("starts"), judged.alias("judged"),
    )
    good = F.filter("judged", lambda x: x["failures"] == 0)
    base = base.select(
        "*", good.alias("good"), covered_by(F.col("starts"), rules.window).cast("long").alias("n_repeat_words"),
        F.size("full").cast("long").alias("n_lines"), (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
    ).select(
        "*", (F.size("judged") - F.size("good")).cast("long").alias("n_failed_lines"),
        F.aggregate("good", F.lit(0), lambda acc, x: acc + x["n"]).cast("long").alias("n_kept_words"),
        F.array_join(F.transform("good", lambda x: x["line"]), "\n").alias("cleaned"),
        ((F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.repeats * F.col("n_words"))).alias("base_failed"),
    )
    kept = ~F.col("base_failed") & (100 * F.col("n_kept_words") >= rules.kept_words * F.col("n_words"))
    return base.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines", "n_failed_lines", "n_kept_words", "cleaned", kept.alias("kept"),
    )


def clean(docs: DataFrame, *, text: str = "text", rules: Rules | None = None) -> DataFrame:
    """``docs`` without rejected documents, each text without its failing lines."""
    judged = measure(docs, text=text, rules=rules)
    left = F.struct(*[F.col("cleaned").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
    # Not a filter: pushed down, the verdict's expressions would be evaluated inside one another's lambdas.
    return judged.select(F.explode(F.when(F.col("kept"), F.array(left))).alias("doc")).select("doc.*")
