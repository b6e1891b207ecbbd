"""A blocked Bloom filter of fixed size, built by Spark and probed in numpy.

A key picks one block of eight 64-bit words and sets one bit in each, so a probe touches one
cache line. The size is a parameter and does not grow with the keys: more keys than it is made
for let more rows pass, which an exact join after it takes out again.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

BLOCKS = 1 << 14  # 1 MB
# One odd multiplier below 2**31 for each word of a block.
SALTS = (0x47B6137B, 0x44974D91, 0x2EB8CD25, 0x22A82B6F, 0x705495C7, 0x2DF1424B, 0x1EFC4947, 0x5C6BFB31)


def build(keys: DataFrame, key: str, blocks: int = BLOCKS) -> np.ndarray:
    """Words of the filter over a long column; one partial OR per task, at most 8 * blocks rows out."""
    low = f"({key} & 4294967295L)"
    word = F.expr(f"cast(shiftrightunsigned({key}, 32) % {blocks}L * 8 as int)")

    def mask(salt: int) -> Column:
        return F.expr(f"shiftleft(1L, cast(shiftright({low} * {salt}L & 4294967295L, 26) as int))")

    bits = F.array(
        *(F.struct((word + j).alias("word"), mask(salt).alias("mask")) for j, salt in enumerate(SALTS))
    )
    rows = keys.where(F.col(key).isNotNull()).select(F.explode(bits).alias("bit"))
    merged = rows.groupBy("bit.word").agg(F.bit_or("bit.mask").alias("mask")).toArrow()
    words = np.zeros(blocks * 8, np.uint64)
    words[merged["word"].to_numpy()] = merged["mask"].to_numpy().view(np.uint64)
    return words


def probe(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the int64 keys may be in the filter."""
    keys = keys.view(np.uint64)
    low = keys & np.uint64(0xFFFFFFFF)
    word = (keys >> np.uint64(32)) % np.uint64(len(words) // 8) * np.uint64(8)
    found = np.ones(len(keys), bool)
    for j, salt in enumerate(SALTS):
        bit = (low * np.uint64(salt) & np.uint64(0xFFFFFFFF)) >> np.uint64(26)
        found &= (words[(word + np.uint64(j)).astype(np.int64)] >> bit & np.uint64(1)).astype(bool)
    return found


def may_contain(spark, words: np.ndarray, key: Column) -> Column:
    """Condition on a long column; a null key is in no filter."""
    shared = spark.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def possible(keys: pd.Series) -> pd.Series:
        return pd.Series(probe(shared.value, keys.to_numpy(np.int64, copy=True)))

    return possible(F.coalesce(key, F.lit(0))) & key.isNotNull()
