"""Word vectors and pooling against loops, the classifier on held-out documents."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from odd import no_docs, odd_docs
from pyspark.sql import functions as F

from basketry.llm import classify, queries
from basketry.llm.blocks import Block

TABLES = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int"


def words_of(text):
    """Runs of signs and of other letters, as the module's buckets tell them apart."""
    signs = "".join(chr(c) for c in range(128) if not chr(c).isalnum() and chr(c) not in " \t\n\x0b\x0c\r")
    out = []
    for run in re.findall(f"[{re.escape(signs)}]+|[^{re.escape(signs)} \t\n\x0b\x0c\r]+", text):
        capitals = len(re.findall("[A-Z]", run))
        case = 3 if run[0] in signs else 2 if capitals > 1 and 2 * capitals > len(run.encode()) else min(capitals, 1)
        out.append((case, run.translate({c: c + 32 for c in range(65, 91)})))
    return out


def texts(n=40):
    rng = random.Random(3)
    names = ["the", "The", "THE", "aé", "$$$", "b!!", "x-y", "12", "|", "ABc", "Abcd"]
    return [rng.choice([" ", "\n", "  "]).join(rng.choices(names, k=rng.choice([0, 1, 2, 30]))) for _ in range(n)]


def test_words_are_told_apart_by_case_and_kind():
    rows = texts()
    buckets, bounds = classify.block_words(Block.of(rows))
    named: dict = {}
    for i, text in enumerate(rows):
        own = buckets[bounds[i] : bounds[i + 1]]
        want = words_of(text)
        assert len(own) == len(want)
        for b, w in zip(own.tolist(), want):
            assert named.setdefault(w, b) == b and b // (classify.BUCKETS // 4) == w[0]


def test_vectors_and_pooling_against_loops(spark):
    rows = texts()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    places, signs = classify.index_vectors()
    sums, seen, total = {}, {}, np.zeros(classify.DIMENSIONS)
    lists = []
    for text in rows:
        b, _ = classify.block_words(Block.of([text]))
        lists.append(b.tolist())
        for i, word in enumerate(lists[-1]):
            seen[word] = seen.get(word, 0) + 1
            v = sums.setdefault(word, np.zeros(classify.DIMENSIONS))
            for j in range(max(0, i - classify.REACH), min(len(b), i + classify.REACH + 1)):
                if j != i:
                    np.add.at(v, places[lists[-1][j]], signs)
    total = sum(sums.values()) / sum(seen.values())
    vectors = classify.word_vectors(docs)
    for word, v in sums.items():
        centred = v / seen[word] - total
        assert np.allclose(vectors[word], centred / np.linalg.norm(centred), atol=1e-5)
    assert not vectors[[b for b in range(classify.BUCKETS) if b not in sums]].any()
    pooled = classify.pool(Block.of(rows), vectors)
    for i, own in enumerate(lists):
        if not own:
            assert not pooled[i].any()
            continue
        v = vectors[own].astype(float)
        steps = np.abs(np.diff(v, axis=0)).mean(axis=0) if len(own) > 1 else np.zeros(classify.DIMENSIONS)
        want = np.concatenate([v.mean(axis=0), v.std(axis=0), steps, [np.log1p(len(own))]])
        assert np.allclose(pooled[i], want, atol=2e-3)


def test_held_out_documents_are_told_apart(spark):
    found = queries.op11_quality_classifier(spark, TABLES).toPandas()
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").toPandas()
    held = found[found.held_out].merge(labels, on="doc_id")
    assert len(held) > 50
    good = held.quality == 1
    assert (held.predicted[good] == 1).mean() >= 0.98
    assert (held.predicted[~good] == 0).mean() >= 0.85
    assert found.score.between(0, 1).all() and len(found) == 1000
    assert (found.predicted == (found.score >= 0.3)).all()


def test_labels_of_held_out_documents_teach_nothing(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    held = classify.held_out(F.col("doc_id"))
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (classify.train(docs, x, ~held) for x in (labels, turned))
    assert all((a == b).all() for a, b in zip(one.layers, two.layers)) and one.temperature == two.temperature


def test_same_model_in_any_partitioning_and_within_the_bound(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    models = [classify.train(d, labels, F.lit(True), 50) for d in (docs, docs.repartition(7), docs.union(docs.limit(0)))]
    assert all((models[0].vectors == m.vectors).all() for m in models)
    assert all((a == b).all() for m in models for a, b in zip(models[0].layers, m.layers))


def test_temperature_calibrates():
    rng = np.random.default_rng(5)
    logits = rng.normal(0, 2, 20000)
    y = (rng.random(20000) < 1 / (1 + np.exp(-logits))).astype(float)
    assert classify._temperature(3 * logits, y) == pytest.approx(3, rel=0.1)
    assert classify._temperature(logits / 2, y) == pytest.approx(0.5, rel=0.1)


def test_odd_rows_labels_and_tables(spark):
    docs = odd_docs(spark).withColumn("score", F.lit("own"))
    for rows in ([], [(4, 1), (4, 0), (6, 0), (None, 1), (7, 5), (2, None)], [(4, 1)]):
        model = classify.train(docs, spark.createDataFrame(rows, LABELS), F.lit(True))
        got = classify.score(docs, model).collect()
        assert len(got) == docs.count() and all(r["row"]["score"] == "own" for r in got)
        assert all(0 <= r["score"] <= 1 for r in got)
        assert len({r["score"] for r in got if r["row"]["doc_id"] == 4}) == 1
        if not rows:
            assert {r["score"] for r in got} == {0.5}
    empty = classify.train(no_docs(spark), spark.createDataFrame([(1, 1)], LABELS), F.lit(True))
    assert classify.score(no_docs(spark), empty).collect() == []
