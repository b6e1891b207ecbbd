"""Words, lines and texts that agree in every polynomial modulo 2^64, but are different."""

from __future__ import annotations

import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketry.llm import blocks, chunks, decontamination, jaccard, packing, quality
from basketry.llm.blocks import Block

LENGTHS = (1024, 2048, 4096)
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def pair(n, one="a", two="b"):
    """The first ``n`` letters of the Thue-Morse word, and its complement."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return [one if b else two for b in bits], [two if b else one for b in bits]


def words(n):
    return tuple("".join(x) for x in pair(n))


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("n", LENGTHS)
def test_hashes_differ(n):
    block = Block.of(words(n))
    one, two = blocks.span_hashes(block.data, block.offsets[:-1], block.offsets[1:])
    back = blocks.span_hashes(block.data[::-1], block.offsets[:-1], block.offsets[1:])
    assert one != two and back[0] != back[1]
    numbers = np.concatenate([np.array([5 if c == "a" else 9 for c in w], np.uint64) for w in words(n)])
    one, two = blocks.sequence_hashes(numbers, np.array([0, n]), np.array([n, 2 * n]))
    assert one != two


def test_equal_long_spans_have_equal_hashes():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, 5000).astype(np.uint8).tobytes()
    block = Block.of([text, b"xyz" + text, text[:128], text[:129]])
    starts = np.array([0, 5003, block.offsets[2], block.offsets[3]])
    hashes = blocks.span_hashes(block.data, starts, block.offsets[1:])
    assert hashes[0] == hashes[1] and len(set(hashes.tolist())) == 3


def test_jaccard_does_not_link_them(spark):
    texts = [w for n in LENGTHS for w in words(n)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.link(frame(spark, texts)).collect()}
    assert got == {i: i for i in range(len(texts))}


def test_packing_gives_each_its_own_ids(spark):
    texts = [w for n in LENGTHS for w in words(n)] + [" ".join(words(1024))]
    plain = Tokenizer.from_file(VOCABULARY)
    pieces = packing.pack_documents(frame(spark, texts), VOCABULARY, payload="ids_crc32").toPandas()
    for i, text in enumerate(texts):
        ids = [*plain.encode(text, add_special_tokens=False).ids, 0]
        own = pieces[pieces.doc_id == i].sort_values("start")
        assert own.length.sum() == len(ids)
        for start, length, crc in zip(own.start, own.length, own.ids_crc32):
            assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())


def test_quality_counts_no_copies(spark):
    one, two = words(2048)
    lines = ["\n".join(words(n)) for n in LENGTHS] + [" ".join([one] * 8 + [two] * 8), "\n".join(map(" ".join, pair(2048)))]
    got = {r["doc_id"]: (r["n_dup_lines"], r["n_repeat_words"]) for r in quality.judge(_sourced(spark, lines)).collect()}
    assert [got[i] for i in range(4)] == [(0, 0)] * 4
    assert got[4][0] == 0


def _sourced(spark, texts):
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_decontamination_finds_no_leak(spark):
    one, two = words(4096)
    item = " ".join([one] * 3 + ["some", "other", "words"] + [one] * 3)
    docs = frame(spark, [item.replace(one, two), item])
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [r["doc_id"] for r in decontamination.leaks(docs, benchmark).collect()] == [1]


def test_chunks_are_told_apart(spark):
    texts = list(words(4096))
    found = chunks.repeated(frame(spark, texts)).collect()
    assert {r["doc_id"]: r["n_bytes"] for r in found} == {0: 4096, 1: 4096}


def test_brute_versions_agree_on_long_words(spark):
    texts = [w for n in LENGTHS for w in words(n)] + [words(1024)[0]]
    roots, sizes = brute.groups(texts, 4, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(frame(spark, texts)).collect()}
    assert got == {i: (sizes[i], roots[i]) for i in range(len(texts))}
