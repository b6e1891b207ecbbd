from __future__ import annotations

import random

import brute
from test_llm_operators import frame

import corpus_pipeline
from basketry.llm import secrets


def test_pipeline_masks_secrets_of_a_single_case(spark):
    rng = random.Random(4)
    alphabets = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz0123456789"]
    tokens = ["".join(rng.choices(a, k=40)) for a in alphabets for _ in range(20)]
    plain = ["internationalization of counterrevolutionaries", "a-page-about-2024/and-other-things-to-read", "A1" * 15]
    docs = frame(spark, [f"key {t} end" for t in tokens] + plain)
    got = [r["text"] for r in corpus_pipeline.secret_scans(spark, docs, "").orderBy("doc_id").collect()]
    assert all(t not in text and "[SECRET]" in text for t, text in zip(tokens, got))
    assert got[len(tokens) :] == plain


def test_scan_lists_secrets_of_a_single_case(spark):
    tokens = [
        "JBSWY3DPEHPK3PXPJBSWY3DPEHPK3PXP",
        "9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B2B0B822CD15D6C15B0F00A08",
        "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b",
        "k3jx0q9w8zv7m2pt5rh4yd6b1nc0gs9l",
    ]
    texts = [f"see {t} there" for t in tokens]
    spans = [[(s["kind_no"], s["start"]) for s in r["secret_spans"]] for r in secrets.scan(frame(spark, texts)).orderBy("doc_id").collect()]
    assert all((3, 4) in own for own in spans)
    assert [[(s["start"], s["kind_no"], s["stop"]) for s in r["secret_spans"]] for r in secrets.scan(frame(spark, texts)).orderBy("doc_id").collect()] == [
        brute.secret_spans(t) for t in texts
    ]
