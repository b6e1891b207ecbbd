"""Fill-in-middle against plain regular expressions, and the wavelet matrix against counting."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from odd import no_docs, odd_docs
from pyspark.sql import functions as F

from basketry.llm import infill, queries
from basketry.llm.blocks import Block
from basketry.llm.wavelet import WaveletMatrix

TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
MARKS = ("<P>", "<S>", "<M>")


def plain_version(doc_id, text, seed=42, fill=50, suffix_first=80):
    text = text or ""
    units = TOKEN.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= fill:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < suffix_first:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts(n=400):
    rng = random.Random(11)
    out = []
    for _ in range(n):
        signs = rng.choice(["ab ", "aé🙂 \n\t", " \x0b\x0c\r", "<P>SM ab", "x\x85   y"])
        out.append("".join(rng.choices(signs, k=rng.choice([0, 1, 2, 3, 7, 60, 500]))))
    return [*out, "<P>", "a <M> b", "<p> <s", " ", "a", "a ", " a", None]


def test_ranks_and_places_of_symbols():
    rng = np.random.default_rng(2)
    for n in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 8, n).astype(np.uint8)
        matrix = WaveletMatrix(symbols, 3)
        places = np.arange(n + 1)
        for s in range(8):
            want = np.concatenate([[0], np.cumsum(symbols == s)])
            assert (matrix.rank(s, places) == want).all()
            at = np.flatnonzero(symbols == s)
            assert (matrix.select(s, np.arange(1, len(at) + 1)) == at).all()


def test_tokens_and_their_ends():
    rows = texts()
    cuts = infill.Cuts(Block.of(rows))
    for i, text in enumerate(rows):
        units = TOKEN.findall(text or "")
        assert cuts.tokens[i] == len(units)
    for k in (0, 1, 2, 5, 1000):
        ends = cuts.ends(np.full(len(rows), k))
        starts = cuts.block.offsets[:-1]
        for i, text in enumerate(rows):
            head = "".join(TOKEN.findall(text or "")[:k])
            assert ends[i] - starts[i] == len(head.encode())
        assert cuts.chars(starts, ends).tolist() == [len("".join(TOKEN.findall(t or "")[:k])) for t in rows]


def test_against_plain_version(spark):
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = infill.fill_in_middle(docs).withColumn("back", infill.restored()).collect()
    columns = ("n", "form", "prefix_chars", "middle_chars", "output")
    key = repr
    assert sorted(((r["row"]["doc_id"], *(r[c] for c in columns)) for r in got), key=key) == sorted(
        ((i, *plain_version(i, t)) for i, t in rows), key=key
    )
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    back = sorted((r["row"]["doc_id"] or -1, r["back"]) for r in got)
    assert back == sorted((i or -1, t or "") for i, t in rows)


def test_shares_are_parameters(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"))
    forms = infill.fill_in_middle(docs, seed=7, fill_percent=100, suffix_first_percent=0).select("form").distinct()
    assert [r[0] for r in forms.collect()] == ["psm"]
    found = infill.fill_in_middle(docs, seed=7).collect()
    assert all((r["form"], r["output"]) == plain_version(r["row"]["doc_id"], "a b c d", 7)[1::3] for r in found)


def test_odd_rows_and_empty_table(spark):
    docs = odd_docs(spark).withColumns({"n": F.lit(1), "form": F.lit("own"), "output": F.lit("own")})
    got = infill.fill_in_middle(docs).withColumn("back", infill.restored()).collect()
    assert len(got) == docs.count() and all(r["row"]["form"] == r["row"]["output"] == "own" for r in got)
    want = sorted(r["text"] or "" for r in docs.select("text").collect())
    assert sorted(r["back"] for r in got) == want
    assert infill.fill_in_middle(no_docs(spark)).collect() == []


def test_query_restores_every_text(spark):
    found = queries.op13_fill_in_middle(spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {r["doc_id"]: plain_version(r["doc_id"], r["text"]) for r in rows}
    assert {r["doc_id"]: tuple(r)[1:6] for r in found} == {i: (*w[:4], sha(w[4])) for i, w in want.items()}
    assert {r["doc_id"]: r["restored_sha256"] for r in found} == {r["doc_id"]: sha(r["text"] or "") for r in rows}
