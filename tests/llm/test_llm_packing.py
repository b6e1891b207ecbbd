from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from basketry.llm import packing
from basketry.llm.blocks import Block

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(VOCABULARY)


def whole(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_give_the_ids_of_whole_texts(encoder):
    rng = random.Random(1)
    parts = [*"ab 's'tre'll \n\t1٣é中<|>!.,'", "'re", "'s", "'ve", "don't ", "<|endoftext|>", "\r\n", "  ", "🙂", "\x1c", "\x85"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(400)]
    ids, cuts = encoder.encode(Block.of(texts))
    for i, text in enumerate(texts):
        assert ids[cuts[i] : cuts[i + 1]].tolist() == whole(encoder, text), text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=4))
def test_any_text(texts):
    encoder = packing.encoder(VOCABULARY)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, cuts = encoder.encode(Block.of(texts))
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [whole(encoder, t) for t in texts]


def test_a_full_memory_starts_afresh(encoder, monkeypatch):
    monkeypatch.setattr(packing, "MOST_REMEMBERED", 3)
    for text in ("one two three four five", "five six seven", "one two"):
        ids, _ = encoder.encode(Block.of([text]))
        assert ids.tolist() == whole(encoder, text)


def test_every_id_is_in_one_piece_and_sequences_have_no_gaps(spark, encoder):
    rng = random.Random(2)
    texts = ["word " * rng.randint(0, 900) for _ in range(200)] + [None, "", "x " * 5000, "same", "same"]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = packing.pack_documents(docs, VOCABULARY).collect()
    total = sum(len(whole(encoder, t or "")) + 1 for t in texts)
    assert sum(r["length"] for r in rows) == total
    assert all(len(r["ids"]) == r["length"] <= 1024 for r in rows)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by_sequence) <= 1.03 * total / 1024 + 2
    sums = packing.pack_documents(docs, VOCABULARY, payload="ids_crc32").collect()
    expected = sorted(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)
    assert sorted(r["ids_crc32"] for r in sums) == expected


@pytest.mark.parametrize("seed", range(4))
def test_shortest_pack_first_uses_each_piece_once(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 63): rng.randint(1, 40) for _ in range(30)}
    packs = packing.shortest_pack_first(histogram, 64)
    used = {}
    for n, pattern in packs:
        assert sum(pattern) <= 64 and n > 0
        for length in pattern:
            used[length] = used.get(length, 0) + n
    assert used == histogram
    least = sum(k * n for k, n in histogram.items()) / 64
    assert sum(n for n, _ in packs) <= 1.1 * least + 1


def test_numbers_of_a_frequent_length_come_from_many_parts(spark):
    rows = [(i, 7 if i % 4 else i % 5) for i in range(3000)] + [(1, 7)] * 5
    pieces = spark.createDataFrame(rows, "doc_id long, length long")
    sizes = collections.Counter(n for _, n in rows)
    for each in (1, 50, 10**6):
        found = packing._numbered(pieces, "length", ["doc_id"], sizes, rows_a_salt=each).collect()
        ranks = collections.defaultdict(list)
        for r in found:
            ranks[r["length"]].append(r["rank"])
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in sizes.items()}
