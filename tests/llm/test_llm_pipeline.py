from __future__ import annotations

import random

import brute
import public_tokenizers
from test_llm_operators import corpus

import corpus_pipeline
from basketry.llm import packing, quality, queries


def test_all_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
    assert set(queries.queries()) | {"pipeline"} <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "packing"


def test_pipeline_against_its_plain_version(spark, tmp_path):
    rng = random.Random(11)
    texts = corpus(12, 70, low=25)
    item = " ".join(rng.sample([w for t in texts for w in t.split()], 30))
    for i in range(0, 70, 9):
        texts[i] += f"\n{item}\n"
    for i in range(0, 70, 7):
        texts[i] += f' api_key = "{rng.getrandbits(160):040x}" end'
    texts += [None, "", "too short"]
    rows = [(i, t, "en", "host", len(t or "")) for i, t in enumerate(texts)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    judged = brute.quality([(r[3], r[1]) for r in rows], quality.MAX_SHARE, quality.MIN_DOCS)
    docs = [(r[0], text) for r, (kept, text) in zip(rows, judged) if kept]
    roots, _ = brute.groups([t for _, t in docs], 5, 80)
    docs = [d for k, d in enumerate(docs) if roots[k] == k]
    n = len(brute.leak_words(item))
    docs = [d for d in docs if brute.covered(d[1], item) < 0.6 * n]
    tokenizer = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json")).tokenizer
    expected = {i: len(tokenizer.encode(brute.masked(t), add_special_tokens=False).ids) + 1 for i, t in docs}

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in got} == expected
    assert sum(r["length"] for r in got) == sum(expected.values())
    assert 10 < len(expected) < 60


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.schema.simpleString() == docs.schema.simpleString(), name
