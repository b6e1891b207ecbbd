from __future__ import annotations

import random

from test_llm_operators import corpus, frame

from basketry.llm import chunks
from basketry.llm.blocks import Block


def test_every_repeated_passage_of_51_words_is_caught(spark):
    rng = random.Random(5)
    names = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(3000)]
    some = lambda n: " ".join(rng.choices(names, k=n))
    passages = [some(51) for _ in range(600)]
    texts = [f"{some(rng.randint(20, 90))} {p} {some(rng.randint(20, 90))}" for p in passages * 2]
    found = {r["doc_id"]: r["spans"] for r in chunks.repeated(frame(spark, texts)).collect()}
    covered = [sum(s["stop"] - s["start"] for s in found[i]) for i in range(600, 1200)]
    assert all(covered) and not any(found[i] for i in range(600))
    assert sum(covered) > 0.75 * sum(map(len, passages))


def test_chunk_cuts_do_not_depend_on_other_texts():
    texts = [t * 3 for t in corpus(21, 30, low=20)]
    together = chunks.chunk_ends(Block.of(texts))
    for i, text in enumerate(texts):
        before = sum(len(t.encode()) for t in texts[:i])
        alone = chunks.chunk_ends(Block.of([text]))[1]
        assert (together[1][together[0] == i] - before).tolist() == alone.tolist()
