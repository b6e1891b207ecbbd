from __future__ import annotations

import random

from pyspark.sql import functions as F
from test_llm_operators import frame

from basketry.llm import jaccard


def test_a_link_between_tiles_is_found_where_no_tile_has_any(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 1)
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(24)]
    tiles = frame(spark, texts).select("doc_id", F.expr("pmod(xxhash64(monotonically_increasing_id()), 2)").alias("t"))
    tile = {r["doc_id"]: r["t"] for r in tiles.collect()}
    a, b = 0, next(k for k in sorted(tile) if tile[k] != tile[0])
    texts[b] = f"{texts[a]} more"
    got = {r["doc_id"]: r["component_id"] for r in jaccard.link(frame(spark, texts)).collect()}
    assert got == {i: a if i == b else i for i in range(24)}
