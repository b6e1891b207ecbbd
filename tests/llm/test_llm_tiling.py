"""Decontamination where places are many or phrases common to all."""

from __future__ import annotations

import random
import time

import brute
import numpy as np
from test_llm_operators import frame

from basketry.llm import decontamination


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_one_repeated_word_makes_no_pairs(spark):
    shared = [(np.arange(14_996), np.arange(196))]
    begun = time.monotonic()
    found = decontamination.runs(shared)
    assert len(found) == 14_996 + 196 - 1  # one run a diagonal
    assert decontamination.tiles(found, 5) == [(0, 0, 200)]
    assert time.monotonic() - begun < 1
    docs, items = frame(spark, ["so " * 15_000]), bench(spark, [(1, "so " * 200)])
    rows = decontamination.matches(docs, items).collect()
    assert [(len(s["places"]), len(s["item_places"])) for s in rows[0]["shared"]] == [(14_996, 196)]
    assert [r["covered"] for r in decontamination.leaks(docs, items).collect()] == [200]


def test_small_steps_find_the_same_runs(monkeypatch):
    rng = np.random.default_rng(4)
    doc, item = rng.integers(0, 3, 300), rng.integers(0, 3, 40)
    shared = [(np.flatnonzero(doc == v), np.flatnonzero(item == v)) for v in range(3)]
    whole = decontamination.runs(shared)
    monkeypatch.setattr(decontamination, "PAIRS_AT_ONCE", 7)
    assert decontamination.runs(shared).tolist() == whole.tolist()
    assert whole[:, 2].sum() == (doc[:, None] == item).sum()  # every pair lies in one run


def test_leaks_against_brute_force(spark):
    rng = random.Random(12)
    phrase = "a phrase that all of them share".split()
    some = lambda n: rng.choices("abcdefghijklmnopqrstuvwxyz", k=n)
    items = [some(rng.randint(3, 40)) + (phrase if k % 2 else []) for k in range(12)]
    texts = []
    for k in range(80):
        words = some(20) + phrase
        for item in rng.sample(items, 2):
            cut, share = rng.randrange(len(item)), rng.random()
            turned = item[cut:] + item[:cut]
            words += turned[: max(1, int(len(item) * share))] + some(3)
        texts.append(" ".join(words))
    rows = decontamination.leaks(frame(spark, texts), bench(spark, [(k, " ".join(i)) for k, i in enumerate(items)])).collect()
    expected = {
        (d, k): n
        for d, text in enumerate(texts)
        for k, item in enumerate(items)
        if (n := brute.covered(text, " ".join(item))) >= 0.6 * len(item)
    }
    assert len(expected) > 40
    assert {(r["doc_id"], r["item_id"]): r["covered"] for r in rows} == expected


def test_a_phrase_common_to_all_brings_nobody_together(spark):
    rng = random.Random(13)
    phrase = "these six words stand in everything"
    some = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    texts = [f"{some(30)} {phrase}" for _ in range(60)]
    items = [(k, f"{phrase} {some(30)}") for k in range(60)]
    texts[7] = f"{some(4)} {items[3][1]}"
    found = decontamination.matches(frame(spark, texts), bench(spark, items)).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(7, 3)]


def test_items_of_one_id_are_judged_apart(spark):
    rows = [(1, "one two three four five six"), (1, "red blue green white black grey")]
    docs = frame(spark, ["one two three four five six", "one two three red blue green"])
    assert [(r["doc_id"], r["covered"]) for r in decontamination.leaks(docs, bench(spark, rows)).collect()] == [(0, 6)]
