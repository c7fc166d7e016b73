"""The operators over the stored test tables, a query each; digests of what the operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewatch.llm import (
    alignment,
    byte_bpe,
    decontaminate,
    line_dedup,
    ordinal,
    passages,
    pii,
    quality_rules,
    simhash,
    spelling,
    token_files,
    topk_search,
    url_filter,
)

RULES = [
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.grouped(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = quality_rules.rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return ruled.select("doc_id", *[F.col(f"_measures.{name}").alias(name) for name in counts], F.col("_kept").alias("kept"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = byte_bpe.encoded(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded by both labels: toxic or poor documents are the lower grades."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    ratings = labels.where("quality is not null and toxic is not null").select("doc_id", grade.alias("grade"))
    return ordinal.graded(documents, ratings).select("doc_id", "expected_grade", "p_at_least_1", "p_at_least_2", "kept")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the rules: keys (host and path) that some page of the corpus was reached at through a campaign link are listed."""
    url = F.col("url")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    pages = pages.select("page_id", "url", url_filter.host_of(url).alias("host"), url_filter.path_of(url).alias("path"))
    keys = pages.select(F.concat("host", "path").alias("key"), "url")
    listed = url_filter.cascade(keys.where(url.rlike("[?&]utm_")), keys)
    rule = url_filter.fitting(RULES, F.col("host"), F.col("path"))
    pages, is_listed = listed.holds(pages, F.concat("host", "path"))
    verdict = F.when(is_listed, F.lit("block")).otherwise(F.lit("allow"))
    return pages.select(
        "page_id",
        "host",
        "path",
        rule.getField("rule").alias("rule"),
        F.coalesce(rule.getField("verdict"), verdict).alias("verdict"),
    )


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = passages.without_repeats(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded as the library does unless told otherwise: the vocabulary's added tokens are recognised in texts."""
    path = token_files.new_path(spark)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    documents = table(spark, sf_dir, "documents")
    token_files.write(documents, vocabulary, public_tokenizers.PATTERN, path, encode_special_tokens=False)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    judged = line_dedup.with_lines_judged(pages)
    return judged.select(
        "doc_id",
        "source",
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        (F.coalesce(F.size("_lines"), F.lit(0)) - F.coalesce(F.size("_left"), F.lit(0))).cast("long").alias("n_dropped"),
        F.array_join("_left", "\n").alias("text"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.cross_counts(table(spark, sf_dir, "documents"), a, b)


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {name: build for name, build in globals().items() if name.startswith("op") and callable(build)}
