"""Secret scans with DataFrame functions alone: fixed patterns plus sliding-window entropy.

Three patterns give the base spans. The method then looks at candidates, that is runs of
characters of keys and digests with at least ``window`` of them. A window slides over each
candidate; counts per character are carried along, so a step updates two counts and the sum of
``n * log2(n)`` (as whole millionths, so that results do not depend on the order of additions).
A window is a hit if it has a digit and its Shannon entropy reaches the bound of its character class:
``hex`` (hexadecimal in one case), ``single`` (capitals and digits alone, or small letters and
digits alone) or ``mixed`` (capitals and small letters). Hits that touch are one span of kind
``entropy``. Candidates on the allow list add none.

Null texts count as empty and have no spans. Every row gets one result; other columns are left
alone. Texts are scanned whole, and no row is moved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from basketry.llm.tables import with_text


def either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# The fixed patterns of the base spans, in the order in which kinds are listed.
KEYWORDS = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
HEX_BITS, MIXED_BITS = 3.0, 3.7
SINGLE_CASE_BITS = 3.3  # random base32 and base36 windows have 3.34 and 3.38 at least, 99 times of 100
# Candidates that are no secrets: without a digit, numbers and dates, UUIDs, one repeated character.
ALLOWED = (
    "[^0-9]*",
    "[0-9+/_=-]*",
    "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
)
MASK = "[SECRET]"

_CHUNK = 1000


def spread_terms(window: int = WINDOW) -> list[int]:
    """n * log2(n) for n = 0 … window, in millionths."""
    return [0] + [round(n * math.log2(n) * 1_000_000) for n in range(1, window + 1)]


def spread_bound(bits: float, window: int = WINDOW) -> int:
    """Largest sum of ``spread_terms`` at which a window still has ``bits`` of entropy."""
    return math.floor(window * (math.log2(window) - bits) * 1_000_000)


def allow_pattern(allowed=ALLOWED) -> str:
    return "^(?:" + "|".join(f"(?:{p})" for p in allowed) + ")$"


def _pieces(text: Column, pattern: str, value_group: int, least: int) -> Column:
    """Per match: characters since the match before, its own length, whether its value is long enough."""
    gaps, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    found = F.arrays_zip(gaps.alias("gap"), matches.alias("own"), values.alias("value"))
    pieces = F.transform(
        F.filter(found, lambda x: x["own"].isNotNull()),
        lambda x: F.struct(
            F.length(x["gap"]).alias("gap"),
            F.length(x["own"]).alias("n"),
            (F.length(x["value"]) >= least).alias("good"),
            x["own"].alias("own"),
        ),
    )
    kind = "array<struct<gap:int,n:int,good:boolean,own:string>>"
    return F.when(text.rlike(pattern), pieces).otherwise(F.array().cast(kind))


def _placed(pieces: str) -> Column:
    """Matches with their places. Places add up along the text, in chunks, so that no long array
    is copied once per match."""
    kind = "array<struct<start:int,stop:int,good:boolean,own:string>>"

    def step(state: Column, p: Column) -> Column:
        start = state["at"] + p["gap"]
        stop = start + p["n"]
        own = F.struct(start.alias("start"), stop.alias("stop"), p["good"].alias("good"), p["own"].alias("own"))
        return F.struct(stop.alias("at"), F.concat(state["out"], F.array(own)).alias("out"))

    def chunk(state: Column, c: Column) -> Column:
        return F.aggregate(
            F.slice(F.col(pieces), c * _CHUNK + 1, F.lit(_CHUNK)),
            F.struct(state["at"].alias("at"), F.array().cast(kind).alias("out")),
            step,
            lambda s: F.struct(s["at"].alias("at"), F.concat(state["out"], F.array(s["out"])).alias("out")),
        )

    chunks = F.sequence(F.lit(0), F.floor(F.size(pieces) / _CHUNK).cast("int"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    placed = F.aggregate(chunks, zero, chunk, lambda s: F.flatten(s["out"]))
    return F.when(F.size(pieces) > 0, placed).otherwise(F.array().cast(kind))


def _entropy_spans(
    candidate: Column, window: int, hex_bits: float, mixed_bits: float, single_case_bits: float
) -> Column:
    """Spans of a candidate, from its start, whose windows are hits."""
    terms = F.array(*map(F.lit, spread_terms(window)))
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    codes = F.filter(codes, lambda k: k >= 0)  # splitting may leave an empty string
    pair = "array<struct<a:int,b:int>>"

    def between(k: Column, low: int, high: int) -> Column:
        return ((k >= low) & (k <= high)).cast("int")

    def is_hex(k: Column) -> Column:
        return ((k >= 26) & (k <= 31) | (k >= 52) & (k <= 61)).cast("int")

    def is_upper_hex(k: Column) -> Column:
        return ((k >= 0) & (k <= 5) | (k >= 52) & (k <= 61)).cast("int")

    # carried along the window: how many characters are of each group
    groups = {
        "capitals": lambda k: between(k, 0, 25),
        "smalls": lambda k: between(k, 26, 51),
        "digits": lambda k: between(k, 52, 61),
        "hexes": is_hex,
        "upper_hexes": is_upper_hex,
    }

    def step(s: Column, k: Column) -> Column:
        full = F.size(s["recent"]) == window
        out = F.when(full, s["recent"][0]).otherwise(F.lit(-1))
        fell = F.when(full, s["counts"][out]).otherwise(F.lit(0))
        less = F.when(full, terms[fell] - terms[fell - 1]).otherwise(F.lit(0))
        had = s["counts"][k] - (out == k).cast("int")
        more = terms[had + 1] - terms[had]
        counts = F.transform(s["counts"], lambda n, i: n + (i == k).cast("int") - (i == out).cast("int"))
        recent = F.concat(F.when(full, F.slice(s["recent"], 2, window)).otherwise(s["recent"]), F.array(k))

        def carried(name: str, member) -> Column:
            return s[name] + member(k) - F.when(full, member(out)).otherwise(F.lit(0))

        return F.struct(
            counts.alias("counts"),
            recent.alias("recent"),
            (s["spread"] + more - less).alias("spread"),
            *(carried(name, member).alias(name) for name, member in groups.items()),
            (s["at"] + 1).alias("at"),
            s["a"].alias("a"),
            s["b"].alias("b"),
            s["out"].alias("out"),
        )

    def settle(s: Column) -> Column:
        def reaches(bits: float) -> Column:
            return s["spread"] <= spread_bound(bits, window)

        hexes = ((s["hexes"] == window) | (s["upper_hexes"] == window)) & reaches(hex_bits)
        single = ((s["capitals"] + s["digits"] == window) | (s["smalls"] + s["digits"] == window)) & reaches(single_case_bits)
        mixed = (s["capitals"] > 0) & (s["smalls"] > 0) & reaches(mixed_bits)
        hit = (F.size(s["recent"]) == window) & (s["digits"] > 0) & (hexes | single | mixed)
        apart = hit & (s["at"] - window > s["b"])
        closes = apart & (s["b"] > 0)
        span = F.struct(s["a"].alias("a"), s["b"].alias("b"))
        return F.struct(
            *(s[c].alias(c) for c in ("counts", "recent", "spread", *groups, "at")),
            F.when(apart | (hit & (s["b"] == 0)), s["at"] - window).otherwise(s["a"]).alias("a"),
            F.when(hit, s["at"]).otherwise(s["b"]).alias("b"),
            F.when(closes, F.concat(s["out"], F.array(span))).otherwise(s["out"]).alias("out"),
        )

    zero = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.array().cast("array<int>").alias("recent"),
        *(F.lit(0).alias(c) for c in ("spread", *groups, "at", "a", "b")),
        F.array().cast(pair).alias("out"),
    )

    def merge(s: Column, k: Column) -> Column:
        # one element array: the stepped state is worked out once and read many times
        return F.transform(F.array(step(s, k)), settle)[0]

    def finish(s: Column) -> Column:
        last = F.array(F.struct(s["a"].alias("a"), s["b"].alias("b")))
        return F.when(s["b"] > 0, F.concat(s["out"], last)).otherwise(s["out"])

    return F.aggregate(codes, zero, merge, finish)


def scan(
    docs: DataFrame,
    allowed=ALLOWED,
    window: int = WINDOW,
    hex_bits: float = HEX_BITS,
    mixed_bits: float = MIXED_BITS,
    single_case_bits: float = SINGLE_CASE_BITS,
) -> DataFrame:
    """``docs`` with ``secret_spans``: array of (start, kind_no, stop), sorted; the kind is ``KINDS[kind_no]``.

    A column of that name is replaced.
    """
    found = _scanned(docs, allowed, window, hex_bits, mixed_bits, single_case_bits)
    return found.select(*(F.col(f"row.`{c}`") for c in docs.columns if c != "secret_spans"), "secret_spans")


def _scanned(
    docs: DataFrame, allowed, window: int, hex_bits: float, mixed_bits: float, single_case_bits: float
) -> DataFrame:
    """Every row as one struct ``row``, and its ``secret_spans``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    candidate = f"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{window},}}"
    pieces = docs.select(
        F.struct("*").alias("row"),
        _pieces(text, ASSIGN, 2, ASSIGN_LEAST).alias("_assign"),
        _pieces(text, ACCESS, 0, 0).alias("_access"),
        _pieces(text, HEX, 0, 0).alias("_hex"),
        _pieces(text, candidate, 0, 0).alias("_runs"),
    )
    placed = pieces.select(
        "row", *(_placed(c).alias(c) for c in ("_assign", "_access", "_hex", "_runs"))
    )

    def numbered(column: str, kind_no: int) -> Column:
        good = F.filter(F.col(column), lambda x: x["good"])
        return F.transform(
            good,
            lambda x: F.struct(x["start"].alias("start"), F.lit(kind_no).alias("kind_no"), x["stop"].alias("stop")),
        )

    suspects = F.filter("_runs", lambda x: ~x["own"].rlike(allow_pattern(allowed)))
    entropy = F.flatten(
        F.transform(
            suspects,
            lambda x: F.transform(
                _entropy_spans(x["own"], window, hex_bits, mixed_bits, single_case_bits),
                lambda s: F.struct(
                    (x["start"] + s["a"]).alias("start"),
                    F.lit(3).alias("kind_no"),
                    (x["start"] + s["b"]).alias("stop"),
                ),
            ),
        )
    )
    spans = F.concat(numbered("_assign", 0), numbered("_access", 1), numbered("_hex", 2), entropy)
    return placed.select("row", F.array_sort(spans).alias("secret_spans"))


def count(spans: str, kind: str) -> Column:
    no = KINDS.index(kind)
    return F.size(F.filter(F.col(spans), lambda s: s["kind_no"] == no)).cast("long")


def written(spans: str, base_only: bool = False) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    chosen = F.filter(F.col(spans), lambda s: s["kind_no"] < 3) if base_only else F.col(spans)
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(chosen, lambda s: F.concat_ws(":", kinds[s["kind_no"]], s["start"], s["stop"])), ","
    )


def mask(
    docs: DataFrame,
    allowed=ALLOWED,
    window: int = WINDOW,
    hex_bits: float = HEX_BITS,
    mixed_bits: float = MIXED_BITS,
    single_case_bits: float = SINGLE_CASE_BITS,
) -> DataFrame:
    """``docs`` with every span, overlaps counting as one, replaced by ``[SECRET]``."""
    found = _scanned(docs, allowed, window, hex_bits, mixed_bits, single_case_bits)
    text = F.col("row.text")

    def cut(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        before = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["stop"]).alias("at"),
            F.when(fresh, F.concat(state["out"], F.array(before, F.lit(MASK)))).otherwise(state["out"]).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    parts = F.aggregate(
        "secret_spans",
        zero,
        cut,
        lambda s: F.concat(
            s["out"], F.array(F.substring(text, s["at"] + 1, F.length(text)))
        ),
    )
    masked = F.when(F.size("secret_spans") > 0, F.array_join(parts, "")).otherwise(text)
    return with_text(found.select("row", masked.alias("text")), docs)
