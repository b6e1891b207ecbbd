"""What a Python worker takes beside its JVM: workers stay, and so does the memory of their largest block."""

from __future__ import annotations

import ctypes
import gc
import os
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from basketry.llm import blocks, packing, quality
from basketry.llm.blocks import Block, text_blocks


def batch() -> pa.RecordBatch:
    """As many rows as Spark hands over at a time, a megabyte in all, with null, empty and equal texts."""
    rng = random.Random(5)
    texts = ["\n".join(" ".join(str(rng.randrange(9999)) for _ in range(20)) for _ in range(21)) for _ in range(497)]
    n = 500
    columns = {"uid": range(n), "doc_id": range(n), "source": ["s"] * n, "row_key": range(n)}
    columns |= {"text": [*texts, None, "", texts[0]], "bad_lines": [[1, 2]] * n, "row": [{"doc_id": 1}] * n}
    return pa.RecordBatch.from_pydict({k: list(v) for k, v in columns.items()})


@pytest.mark.parametrize("work", [quality._measure, quality._strip])
def test_a_block_takes_little_memory(work, monkeypatch):
    rows = batch()
    monkeypatch.setattr(blocks, "_powers", {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)})
    tracemalloc.start()
    try:
        assert sum(made.num_rows for made in work([rows])) == rows.num_rows
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 30e6, peak


def test_powers_grow_with_the_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "_powers", {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)})
    for n in (1, 2, blocks.SMALL_BYTES, blocks.SMALL_BYTES + 1, 4 * blocks.BLOCK_BYTES + 1):
        found = blocks._power("base", blocks._BASE, n)
        assert len(found) == n and found[-1] == np.uint64(pow(blocks._BASE, n - 1, 2**64))
    assert len(blocks._powers["base"]) <= 4 * blocks.BLOCK_BYTES


def test_results_do_not_depend_on_the_size_of_a_block():
    rows = batch()
    found = []
    for size in (1000, blocks.SMALL_BYTES, blocks.BLOCK_BYTES):
        cut = list(text_blocks(rows, "text", size))
        assert [low for low, _, _ in cut] == [0, *(high for _, high, _ in cut[:-1])] and cut[-1][1] == rows.num_rows
        counted = [quality._count_block(block) for _, _, block in cut]
        found.append({k: np.concatenate([x[k] for x in counted]).tolist() for k in counted[0] if k != "line_cuts"})
        sets = [s.tolist() for _, _, block in cut for s in blocks.shingle_sets(block, 5)]
        found[-1]["sets"] = sets
    assert found[0] == found[1] == found[2]


def test_words_are_encoded_in_the_tasks_own_thread(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "")
    monkeypatch.delenv("TOKENIZERS_PARALLELISM")
    monkeypatch.setattr(packing, "_encoders", {})
    ids, cuts = packing.encoder(path).encode(Block.of(["one two", None, "two"]))
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    assert len(ids) == cuts[-1] and cuts[1] == cuts[2]


def resident() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="the C library keeps freed memory")
def test_a_task_gives_back_what_it_has_freed():
    held, rest = [], []

    @blocks.tidy
    def work(batches):
        for b in batches:
            held.extend(bytes(20_000) for _ in range(4_000))  # 80 MB under a small piece that stays
            rest.append(bytes(20_000))
            yield b
        held.clear()

    gc.collect()
    blocks.give_back()
    before = resident()
    tasks = work([batch()])
    next(tasks)
    assert resident() - before > 60e6
    assert list(tasks) == []
    assert resident() - before < 30e6
