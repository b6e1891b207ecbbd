"""Order-related helpers that need neither a global sort nor a one-task window."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

_DIGIT_BITS = 16


# A Mersenne prime: products of two remainders stay below 2^122, well inside 38 digits.
SAMPLE_PRIME = 2**61 - 1


def sample_factors(seed: int) -> list[int]:
    """The four numbers that a seed gives the sample's hash."""
    return [random.Random(f"{seed}:{k}").randrange(1 << 60, SAMPLE_PRIME) for k in range(4)]


def key_hash(product_id: Column, date: Column, seed: int) -> Column:
    """Repeatable pseudo-random key of a (product, date) row, the same in any SQL engine.

    Two rounds modulo a prime near 2^61 with factors that depend on the seed: a sum of products,
    then a square. Remainders are taken before multiplying, so ids of 19 digits do not overflow. Computed in
    numpy on Arrow batches, as remainders of 38-digit decimals take some 20 microseconds a row.
    """

    def hashed(ids: pa.Array, days: pa.Array) -> pa.Array:
        found, missing = hash_arrays(ids, days, seed)
        return pa.array(found, pa.int64(), mask=missing)

    return F.arrow_udf(hashed, "long")(*key_columns(product_id, date))


def key_columns(product_id: Column, date: Column) -> tuple[Column, Column]:
    """A key as ``hash_arrays`` takes it."""
    return product_id.cast("long"), F.unix_date(date).cast("long")


def hash_arrays(ids: pa.Array, days: pa.Array, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each key and where a part of it is missing."""
    missing = (ids.is_null().to_numpy(False)) | (days.is_null().to_numpy(False))
    own, day = (x.fill_null(0).to_numpy(False) for x in (ids, days))
    a, b, c, d = (np.uint64(x) for x in sample_factors(seed))
    own = (own % SAMPLE_PRIME).astype(np.uint64)
    day = (day + 1_000_000).astype(np.uint64)
    first = _rest(_times(own, a) + _times(day, b) + c)
    return _times(_times(first, first), d).astype(np.int64), missing


_PRIME = np.uint64(SAMPLE_PRIME)
_LOW_30, _LOW_31 = np.uint64(2**30 - 1), np.uint64(2**31 - 1)
_1, _30, _31, _61 = (np.uint64(x) for x in (1, 30, 31, 61))


def _rest(x: np.ndarray) -> np.ndarray:
    """Remainder by the prime of any 64 bits: 2^61 counts as one."""
    x = (x & _PRIME) + (x >> _61)
    return np.where(x >= _PRIME, x - _PRIME, x)


def _times(x: np.ndarray, y: np.ndarray | np.uint64) -> np.ndarray:
    """Product of remainders by the prime, in halves of 30 and 31 bits so that no sum passes 64 bits."""
    x_high, x_low, y_high, y_low = x >> _31, x & _LOW_31, y >> _31, y & _LOW_31
    middle = x_high * y_low + x_low * y_high
    high = ((x_high * y_high) << _1) + (middle >> _30)
    return _rest(high + ((middle & _LOW_30) << _31) + x_low * y_low)


def nth_smallest(
    df: DataFrame,
    group: str,
    value: str,
    ranks: dict,
    low: int | None = None,
    high: int | None = None,
) -> dict:
    """The ``rank``-th smallest (from 0) long ``value`` inside each listed group.

    ``ranks`` maps a group key to its wanted ranks; the result maps a group key to
    ``{rank: value}``, with ``None`` for a rank beyond the group. A histogram over 16 bits of
    the value finds the bucket of each rank and the next pass looks inside that bucket only.
    Each pass is one partially aggregated count of at most 65,536 rows per wanted rank, so
    neither a sort nor a whole group ever reaches one task. ``low`` and ``high`` bound the
    values and save the passes over leading bits that are all zero.
    """
    bits = 64
    if low is not None and high is not None and low >= 0:
        bits = max(1, -(-high.bit_length() // _DIGIT_BITS)) * _DIGIT_BITS
    start = bits - _DIGIT_BITS
    # one search state per wanted rank: leading bits known so far, rank left inside them
    state = {(g, r): (None, r) for g, wanted in ranks.items() for r in wanted}
    for shift in range(start, -1, -_DIGIT_BITS):
        match = F.lit(False)
        for g, known in {(g, p) for (g, _), (p, _) in state.items()}:
            inside = F.col(group) == F.lit(g)
            if known is not None:
                inside &= F.shiftright(F.col(value), shift + _DIGIT_BITS) == F.lit(known)
            match |= inside
        histogram = (
            df.where(match)
            .groupBy(F.col(group).alias("g"), F.shiftright(F.col(value), shift).alias("p"))
            .agg(F.count("*").alias("n"))
            .collect()
        )
        buckets: dict = {}
        for row in sorted(histogram, key=lambda r: r["p"]):
            known = None if shift == start else row["p"] >> _DIGIT_BITS
            buckets.setdefault((row["g"], known), []).append((row["p"], row["n"]))
        for key, (known, left) in list(state.items()):
            for p, n in buckets.get((key[0], known), []):
                if left < n:
                    state[key] = (p, left)
                    break
                left -= n
            else:
                del state[key]
    settled = {key: p for key, (p, _) in state.items()}
    return {g: {r: settled.get((g, r)) for r in wanted} for g, wanted in ranks.items()}
