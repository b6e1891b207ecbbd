"""Fill-in-middle: a text is cut at two token borders and its parts put into another order.

A token is white space with the word after it, or the white space at the end. Every byte gets
one of four classes (rest of a character, character of a word, white space, white space right
after a word), and the classes of a block of texts a wavelet matrix. Its ranks combine into what is needed:
tokens of a text are the white spaces after a word plus one, code points are the bytes that are no
rest of a character, and the place where a token ends is found by bisection on ranks.

The draws come from a digest of seed and document id, so a row has the same result in any partitioning.

* null text counts as empty; an empty text has no token and stays plain.
* null id: the digest is taken of the seed alone.
* A text that holds one of the marks stays plain, so that the parts can always be told apart.
* Repeated rows have equal results; an empty table has none. Columns of the input other than the text come
  back in the struct ``row`` and so clash with no name. Texts are cut at any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from basketry.llm.blocks import SPACE, Block, small_batches, text_blocks
from basketry.llm.wavelet import WaveletMatrix

SEED = 42
FILL_PERCENT = 50
SUFFIX_FIRST_PERCENT = 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"

_REST, _WORD, _GAP, _BORDER = range(4)
_DRAWS = 4


def byte_classes(block: Block) -> np.ndarray:
    """Class of every byte; a gap that begins its text, or goes on, is no border."""
    data = block.data
    space = SPACE[data]
    classes = np.where((data & 0xC0) == 0x80, np.uint8(_REST), np.uint8(_WORD))
    classes[space] = _GAP
    border = space.copy()
    border[1:] &= ~space[:-1]
    border[block.offsets[:-1][block.lengths > 0]] = False
    classes[border] = _BORDER
    return classes


class Cuts:
    """Token counts of the texts of a block, and the places of their token ends."""

    def __init__(self, block: Block):
        self.block = block
        self.matrix = WaveletMatrix(byte_classes(block), 2)
        self.borders = self.matrix.rank(_BORDER, block.offsets)
        self.tokens = np.where(block.lengths > 0, np.diff(self.borders) + 1, 0)

    def ends(self, units: np.ndarray) -> np.ndarray:
        """For each text the place in the block after its first ``units`` tokens."""
        places = np.where(units >= self.tokens, self.block.offsets[1:], self.block.offsets[:-1])
        inside = np.flatnonzero((units > 0) & (units < self.tokens))
        places[inside] = self.matrix.select(_BORDER, self.borders[:-1][inside] + units[inside])
        return places

    def chars(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Code points between two places."""
        rest = self.matrix.rank(_REST, ends) - self.matrix.rank(_REST, starts)
        return ends - starts - rest


def _rearranged(block: Block, draws: np.ndarray, fill: int, suffix_first: int):
    cuts = Cuts(block)
    n = cuts.tokens
    first, second = draws[0] % (n + 1), draws[1] % (n + 1)
    starts, stops = block.offsets[:-1], block.offsets[1:]
    one, two = cuts.ends(np.minimum(first, second)), cuts.ends(np.maximum(first, second))
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    raw = block.data.tobytes()
    forms, outputs = [], []
    for i in range(len(block)):
        text = raw[starts[i] : stops[i]]
        if not text or draws[2][i] % 100 >= fill or any(m in text for m in marks):
            forms.append(PLAIN)
            outputs.append(text)
            continue
        p, m, s = raw[starts[i] : one[i]], raw[one[i] : two[i]], raw[two[i] : stops[i]]
        if draws[3][i] % 100 < suffix_first:
            forms.append(SUFFIX_FIRST)
            outputs.append(marks[1] + s + marks[0] + p + marks[2] + m)
        else:
            forms.append(PREFIX_FIRST)
            outputs.append(marks[0] + p + marks[1] + s + marks[2] + m)
    plain = np.array([f == PLAIN for f in forms], bool)
    counts = [pa.array(x, pa.int64(), mask=plain) for x in (cuts.chars(starts, one), cuts.chars(one, two))]
    return [pa.array(n, pa.int64()), pa.array(forms), *counts, pa.array(outputs, pa.binary()).view(pa.string())]


def fill_in_middle(
    docs: DataFrame,
    seed: int = SEED,
    fill_percent: int = FILL_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """``row`` (all columns but the text), ``n`` tokens, ``form``, ``prefix_chars``, ``middle_chars``, ``output``."""
    small_batches(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"draw{k}") for k in range(_DRAWS)]
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("row"), *draws, F.col("text").cast("string").alias("text"))
    schema = rows.select("row").schema
    for name, kind in (("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string")):
        schema = schema.add(name, kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = np.array([batch.column(1 + k).to_numpy() for k in range(_DRAWS)])
            for low, high, block in text_blocks(batch, "text"):
                own = batch.column(0).slice(low, high - low)
                made = _rearranged(block, drawn[:, low:high], fill_percent, suffix_first_percent)
                yield pa.RecordBatch.from_arrays([own, *made], schema.names)

    return rows.mapInArrow(work, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text from an output and its form."""

    def part(mark: str, after: str | None) -> Column:
        head = F.substring_index(output, after, 1) if after else F.col(output)
        return F.substring_index(head, mark, -1)

    prefix_first = F.concat(part(PREFIX, SUFFIX), part(MIDDLE, None), part(SUFFIX, MIDDLE))
    suffix_first = F.concat(part(PREFIX, MIDDLE), part(MIDDLE, None), part(SUFFIX, PREFIX))
    return (
        F.when(F.col(form) == PREFIX_FIRST, prefix_first)
        .when(F.col(form) == SUFFIX_FIRST, suffix_first)
        .otherwise(F.col(output))
    )
