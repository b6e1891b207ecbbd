from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import quality


def hosts(spark, line, with_line, without, words=40):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(words)) for _ in range(with_line + without)]
    rows = [(i, t + f"\n{line}\n" * (i < with_line), "en", "host", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_a_line_of_very_many_texts_goes_whatever_its_share(spark):
    docs = hosts(spark, "Sign up here", 30, 770)
    assert all("Sign up" not in r["text"] for r in quality.keep_good(docs, most_docs=25).collect())


def test_pipeline_rejects_documents_left_with_few_words(spark):
    docs = hosts(spark, "one two three four five six seven eight", 25, 20, words=18)
    longer = hosts(spark, "", 0, 45)
    kept = corpus_pipeline.quality_rules(spark, docs.union(longer.withColumn("doc_id", F.col("doc_id") + 100)), "")
    assert {r["doc_id"] for r in kept.collect()} == set(range(100, 145))


@pytest.mark.parametrize("texts", [30, 500, 100_000])
def test_lines_are_judged_alike_on_small_and_large_hosts(spark, texts):
    row = F.col("id")
    own = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(25)), lambda k: F.concat(F.lit("w"), F.hash(row, k))), " ")
    common = F.when(row % 5 < 2, "\nAll rights reserved by 2024 us\n").otherwise("")  # 40 %
    rare = F.when(row % 50 == 1, "\nA line that a few share\n").otherwise("")  # 2 %, and under 1,000 texts or 5
    hollow = F.when(row % 10 == 0, "Only a few words here").otherwise(own)  # 10 % keep 6 words
    text = F.concat(hollow, F.lit(" "), F.translate(row.cast("string"), "0123456789", "abcdefghij"), common, F.when(row < 45_000, rare).otherwise(""))
    docs = spark.range(texts).select(
        F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("h").alias("source"), F.lit(0).alias("n_chars")
    )
    judged = quality.judge(docs, min_words=6)
    found = judged.groupBy((F.col("doc_id") % 10).alias("d")).agg(
        F.min("removed_words"), F.max("removed_words"), F.min(F.col("kept").cast("int")), F.max(F.col("kept").cast("int"))
    )
    got = {r[0]: tuple(r)[1:] for r in found.collect()}
    want = {d: (6, 6, 1, 1) if d % 5 < 2 else (0, 0, 1, 1) for d in range(10)}
    assert got == want | {0: (6, 6, 0, 0)}


def test_pipeline_and_query_have_one_rule():
    import inspect

    own = {k: v.default for k, v in inspect.signature(quality.judge).parameters.items()}
    assert own | quality.PIPELINE_LIMITS == own
