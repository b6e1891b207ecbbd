from __future__ import annotations

import random

import public_tokenizers
from tokenizers import Tokenizer

from basketry.llm import packing
from basketry.llm.blocks import Block


def test_added_tokens_are_one_id():
    path = public_tokenizers.path("byte_bpe_50k.json")
    fresh, rng = Tokenizer.from_file(path), random.Random(7)
    parts = ["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "word", "é", "'s", "!", "1"]
    texts = ["x <|endoftext|> y", "<|endof", "text|>", "<|endoftext|>", ""]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(400)]
    ids, cuts = packing.Encoder(path).encode(Block.of(texts))
    for i, text in enumerate(texts):
        assert ids[cuts[i] : cuts[i + 1]].tolist() == fresh.encode(text, add_special_tokens=False).ids, text
    assert (ids == 50256).sum() >= 200
