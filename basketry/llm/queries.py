"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm import audit, chunks, classify, decontamination, html, infill, jaccard, langid, packing, quality, secrets, suffixes, urls
from basketry.llm.tables import documents
from basketry.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

# A document with a lower score is predicted to be of low quality.
LEAST_SCORE = 0.3


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(prepare(spark), sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(secrets.count("secret_spans", k).alias(f"n_{k}") for k in secrets.KINDS[:3]),
        F.sha2(secrets.written("secret_spans", base_only=True), 256).alias("base_sha256"),
        secrets.written("secret_spans").alias("spans"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(prepare(spark), sf_dir)
    model = langid.train(docs.where(~langid.held_out()))
    return langid.predict(docs, model, ["doc_id", langid.held_out().alias("held_out")])


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard.link(documents(prepare(spark), sf_dir))
    return linked.select("doc_id", "n_shingles", "component_id")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.leaks(documents(prepare(spark), sf_dir), benchmark)
    return found.drop("row_key")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeats(documents(prepare(spark), sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract(pages(prepare(spark), sf_dir))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunks.repeated(documents(prepare(spark), sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        "n_chunks",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages(prepare(spark), sf_dir)
    return urls.filter_urls(rows, urls.listed_pages(rows))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(prepare(spark), sf_dir))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "removed_words",
        "kept",
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(prepare(spark), sf_dir)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack_documents(docs, vocabulary, payload="ids_crc32")
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(prepare(spark), sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = classify.train(docs, labels, ~classify.held_out(F.col("doc_id")))
    return classify.score(docs, model).select(
        "row.doc_id",
        classify.held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return audit.audit(audit.survivors(documents(prepare(spark), sf_dir), labels))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.fill_in_middle(documents(prepare(spark), sf_dir).select("doc_id", "text"))
    return made.select(
        "row.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(), 256).alias("restored_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_secret_scans": op1_secret_scans,
        "op2_language_id": op2_language_id,
        "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
        "op4_benchmark_decontamination": op4_benchmark_decontamination,
        "op5_suffix_array_dedup": op5_suffix_array_dedup,
        "op6_html_extraction": op6_html_extraction,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_url_filters": op8_url_filters,
        "op9_quality_rules": op9_quality_rules,
        "op10_packing": op10_packing,
        "op11_quality_classifier": op11_quality_classifier,
        "op12_filter_audit": op12_filter_audit,
        "op13_fill_in_middle": op13_fill_in_middle,
    }
