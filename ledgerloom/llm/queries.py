"""The numbered queries over the driver's tables; each derives its digest from the full output of its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import conversation_repair as op11
from ledgerloom.llm import decontaminate as op3
from ledgerloom.llm import jaccard as op6
from ledgerloom.llm import language as op10
from ledgerloom.llm import language_model as op9
from ledgerloom.llm import line_dedup as op8
from ledgerloom.llm import packing as op4
from ledgerloom.llm import quality_model as op2
from ledgerloom.llm import quality_rules as op7
from ledgerloom.llm import secrets as op13
from ledgerloom.llm import spelling as op12
from ledgerloom.llm import token_counts as op5
from ledgerloom.llm import toxicity as op1

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(n: int) -> Column:
    """crc32(doc_id as text) mod n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    lexicon = op1.fit(docs, labels(spark, sf_dir), remainder(4) != 2)
    scored = op1.score_toxicity(docs, lexicon, keep=["doc_id"]).select("row.doc_id", "score", F.col("hits").cast("long").alias("n_hits"))
    return scored.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_hits")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = op2.fit(docs, labels(spark, sf_dir), remainder(5) != 0)
    scored = op2.score_quality(docs, model, keep=["doc_id"]).select("row.doc_id", "score")
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op3.find_passages(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"], width=10)
    names = F.array_distinct(F.transform("spans", lambda s: s["item_id"]))
    hit = op3.covered_words(F.col("spans"))
    return found.select(
        "row.doc_id", "n_words", hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        op3.items_digest(names).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.pack_documents(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = op5.count_tokens(documents(spark, sf_dir), keep=["doc_id"])
    return counted.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.jaccard_groups(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = op7.measure(documents(spark, sf_dir), keep=["doc_id"])
    return measured.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_failed_lines", "n_kept_words",
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, and the numbers of those that repeat an earlier line of the corpus, equal ones and near ones."""
    rows, repeats = op8.find_repeats(documents(spark, sf_dir))
    per_doc = repeats.groupBy("id").agg(
        F.array_sort(F.collect_list(F.when(F.col("exact"), F.col("line")))).alias("equal_lines"), F.array_sort(F.collect_list(F.when(~F.col("exact"), F.col("line")))).alias("near_lines"),
    )
    none = F.array().cast("array<bigint>")
    return rows.join(per_doc, "id", "left").select(
        F.col("id").alias("doc_id"), F.col("lines").alias("n_lines"), F.coalesce("equal_lines", none).alias("equal_lines"), F.coalesce("near_lines", none).alias("near_lines"),
    )


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = op9.score_texts(documents(spark, sf_dir), remainder(5) != 1).withColumnRenamed("id", "doc_id")
    return scored.withColumn("held_out", remainder(5) == 1)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = op10.fit(docs, remainder(3) != 1)
    named = op10.identify(docs, model, keep=["doc_id"]).select("row.doc_id", "lang_pred", "score")
    return named.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with planted faults, and how often each row is there."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", as_text("conv_id"), as_text("turn")).cast("binary")) % 20
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(as_text("text"), "[.!?]", "")).otherwise(as_text("text"))
    faulty = rows.select("conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(as_text("role")).alias("role"), text.alias("text"), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"))
    return faulty, F.col("times")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, times = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return op11.summaries(op11.repair(rows, copies=times)).withColumnRenamed("conv", "conv_id")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = op12.letter_runs(documents(spark, sf_dir), F.col("doc_id"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run")).cast("int")
    word = F.when(h % 97 == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    return op12.variant_groups(op12.vocabulary(runs.select(word.alias("word"))))


def op13_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op13.scan_secrets(documents(spark, sf_dir), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] < 3)
    number = lambda test: F.size(F.filter("spans", test)).cast("long")
    return found.select(
        "row.doc_id", number(lambda s: s["kind"] == 0).alias("n_assign"), number(lambda s: s["kind"] == 1).alias("n_access"), number(lambda s: s["kind"] == 2).alias("n_hex"),
        F.sha2(op13.span_list(base).cast("binary"), 256).alias("base_sha256"), op13.span_list(F.col("spans")).alias("spans"),
        number(lambda s: s["verdict"] == "live").alias("n_live"), number(lambda s: s["verdict"] == "example").alias("n_example"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_toxicity, op2_quality_classifier, op3_benchmark_decontamination, op4_best_fit_packing, op5_token_counts, op6_ngram_jaccard_join, op7_quality_rules, op8_line_dedup, op9_lm_scoring, op10_language_id, op11_conversation_repair, op12_spelling_variants, op13_secret_scans)
}
