"""Texts as flat numpy arrays: bytes, words, shingles and their hashes, several documents at a time.

Tasks get Arrow batches, cut them into blocks of about ``BLOCK_BYTES`` and work on the bytes
of a whole block at once. A text longer than that is a block of its own; nothing is cut off.
Work on words takes some sixty times the bytes of a block, so operators that cost nothing fixed a
block take ``SMALL_BYTES``.
Hashes are 64 bits wide. Their constants are drawn from a fixed seed, so every task of every
run gives equal words equal hashes. Short spans have polynomials modulo 2^64, all of a block at once;
some different texts of a thousand characters and more agree in every such polynomial, so spans
of over ``LONG`` elements have a digest instead.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
SMALL_BYTES = 1 << 18
BATCH_ROWS = 500
LONG = 128

_draw = np.random.Generator(np.random.PCG64(20240229))
_BYTE_CODES = _draw.integers(1, 2**64 - 1, 256, dtype=np.uint64)
_POSITION_CODES = _draw.integers(1, 2**64 - 1, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# ASCII signs as well as white space; bytes of other scripts are parts of words.
SIGNS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)}


def _power(kind: str, factor: int, n: int) -> np.ndarray:
    """factor ** 0 … factor ** (n - 1) modulo 2**64, kept between calls."""
    if len(_powers[kind]) < n:
        once = n > 4 * BLOCK_BYTES  # one very long text: not worth keeping
        steps = np.full(n if once else max(1 << (n - 1).bit_length(), SMALL_BYTES), factor, np.uint64)
        steps[0] = 1
        grown = np.cumprod(steps, dtype=np.uint64)
        if once:
            return grown
        _powers[kind] = grown
    return _powers[kind][:n]


def small_batches(spark) -> None:
    """Let Spark hand Python at most BATCH_ROWS rows at a time, so that long texts fit in memory."""
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def give_back() -> None:
    """Return freed memory to the system, as far as Arrow and the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    except (OSError, TypeError):
        trim = None
    if trim:
        trim(0)


def tidy(work: Callable) -> Callable:
    """``work`` on the batches of a task, after which the worker gives back what it has freed.

    Spark keeps more workers than an executor has cores, and what idle ones hold adds to its memory.
    """

    @functools.wraps(work)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return tidied


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block:
    """Some texts end to end: ``data`` holds their UTF-8 bytes, ``offsets`` where each begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    @classmethod
    def of(cls, texts: list) -> Block:
        raw = [(t or "").encode() if not isinstance(t, bytes) else t for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)])
        return cls(np.frombuffer(b"".join(raw), np.uint8), offsets.astype(np.int64))

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def prefix_sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of ``values`` before each byte, one more than there are bytes."""
        return np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text have the flag."""
        sums = self.prefix_sums(flags)
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


def text_blocks(batch: pa.RecordBatch, column: str, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Block]]:
    """(first row, row after the last, block of about ``size`` bytes) of a batch; null counts as empty."""
    values = batch.column(batch.schema.get_field_index(column))
    values = pc.fill_null(values.cast(pa.large_binary()), b"")
    n = len(values)
    if not n:
        return
    _, where, raw = values.buffers()
    offsets = np.frombuffer(where, np.int64)[values.offset : values.offset + n + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(n, max(high, low + 1))
        own = offsets[low : high + 1]
        yield low, high, Block(data[own[0] : own[-1]], own - own[0])
        low = high


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each span; equal bytes have equal hashes wherever they stand."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * _power("base", _BASE, max(n, 1))[:n], out=sums[1:])
    inverse = _power("inverse", _BASE_INVERSE, n + 1)
    return _long_digested(mix((sums[ends] - sums[starts]) * inverse[starts]), data, starts, ends)


def _long_digested(hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``hashes`` with those of long spans replaced by digests of the spans."""
    long = np.flatnonzero(ends - starts > LONG)
    if len(long):
        data = np.ascontiguousarray(data)
        spans = zip(starts[long].tolist(), ends[long].tolist())
        digests = b"".join(hashlib.blake2b(data[a:b], digest_size=8).digest() for a, b in spans)
        hashes[long] = np.frombuffer(digests, np.uint64)
    return hashes


def sequence_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the run of hashes [start, end) for each pair; equal runs have equal hashes."""
    n = len(hashes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * _power("base", _BASE, max(n, 1))[:n], out=sums[1:])
    inverse = _power("inverse", _BASE_INVERSE, n + 1)
    own = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return _long_digested(own, hashes, starts, ends)


class Words:
    """The words of a block: maximal runs of bytes other than ``gaps``, by default ASCII white space."""

    def __init__(self, block: Block, lower: bool = True, gaps: np.ndarray = SPACE):
        data = LOWER[block.data] if lower else block.data
        word = ~gaps[data]
        first = np.zeros(len(data) + 1, bool)
        first[block.offsets] = True
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1] | first[1:-1]
        ends[:-1] &= ~word[1:] | first[1:-1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.hashes = span_hashes(data, self.starts, self.ends)
        # words of text i: bounds[i] … bounds[i + 1]
        self.bounds = np.searchsorted(self.starts, block.offsets)
        self.counts = np.diff(self.bounds)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every k words in a row inside one text."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total += self.hashes[j : j + n] * _POSITION_CODES[j]
        inside = np.ones(n, bool)
        for end in self.bounds[1:-1]:
            inside[max(0, end - k + 1) : end] = False
        at = np.flatnonzero(inside)
        return at, mix(total[at] + np.uint64(k))

    def whole(self, i: int) -> np.uint64:
        """Hash of all words of text ``i`` in order, for texts shorter than a shingle."""
        own = self.hashes[self.bounds[i] : self.bounds[i + 1]]
        codes = _POSITION_CODES[: len(own)]
        return mix(np.array([(own * codes).sum(dtype=np.uint64) + np.uint64(len(own))]))[0]


def shingle_sets(block: Block, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct k-word shingles of each text, as hashes.

    A text of fewer than ``k`` words has its whole sequence as the one shingle; a text
    without words has none.
    """
    words = Words(block)
    at, hashes = words.windows(k)
    cuts = np.searchsorted(at, words.bounds)
    for i in range(len(block)):
        if words.counts[i] >= k:
            yield np.unique(hashes[cuts[i] : cuts[i + 1]])
        elif words.counts[i]:
            yield np.array([words.whole(i)], np.uint64)
        else:
            yield np.zeros(0, np.uint64)
