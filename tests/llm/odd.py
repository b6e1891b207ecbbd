"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, extra columns."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "uid string, row string, row_key string, spans string, n int, bad_lines string, secret_spans string, copy_no int"
)
WORDS = "the quick brown fox jumps over one lazy dog while seven wizards box with five dozen liquor jugs at dawn".split()


def odd_rows() -> list[tuple]:
    rest = ("own", "own", "own", "own", 7, "own", "own", 3)
    long_text = " ".join(f"{WORDS[i % 19]}{i}" for i in range(300_000))
    plain = " ".join(WORDS) + " and more of it."
    rows = [
        (None, None, None, None, None),
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", None, "b", 4),
        (4, plain, "en", "a", len(plain)),
        (4, plain, "en", "a", len(plain)),
        (5, plain, "en", None, len(plain)),
        (None, plain, "en", "b", len(plain)),
        (6, long_text, "de", "b", len(long_text)),
        (7, "été 🙂 naïve", "fr", "", 11),
    ]
    return [(*r, *rest) for r in rows]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def own_columns_kept(before, after) -> bool:
    """Same columns, and the extra ones hold what they held."""
    extra = [c for c in before.columns[5:]]
    held = {tuple(r) for r in before.select(*extra).collect()}
    return after.columns == before.columns and all(tuple(r) in held for r in after.select(*extra).collect())
