"""The operators once more, as plain Python over a list of documents."""

from __future__ import annotations

import collections
import math
import re

SPACES = " \t\n\v\f\r"


def words(text):
    return [w for w in re.split(f"[{SPACES}]+", text or "") if w]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    w = words(lowered(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def groups(texts, k, percent):
    """Component number of each text: index of its first member."""
    sets = [shingles(t, k) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


def base_counts(text):
    text = text or ""
    w = words(text)
    grams = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + j for i in range(len(w) - 7) for j in range(8) if grams[tuple(w[i : i + 8])] > 1}
    lines = [x for x in text.split("\n") if words(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def plain_line(line):
    return " ".join(words(re.sub("[0-9]", "0", lowered(line))))


def quality(docs, max_share, min_docs, min_left=0.3, min_words=20, most_docs=1000, least_left=20):
    """(kept, text without boilerplate lines) of each (source, text)."""
    per_line, per_host = collections.defaultdict(set), collections.defaultdict(set)
    for source, text in docs:
        per_host[source or ""].add(text or "")
        for line in (text or "").split("\n"):
            if words(line):
                per_line[source or "", plain_line(line)].add(text or "")
    out = []
    for source, text in docs:
        n = base_counts(text)
        failed = n["n_words"] < min_words or 100 * n["n_repeat_words"] > 30 * n["n_words"]

        def bad(line):
            found = len(per_line.get((source or "", plain_line(line)), ()))
            many = found > len(per_host[source or ""]) * max_share or found > most_docs
            return bool(words(line)) and found > min_docs and many

        lines = (text or "").split("\n")
        kept = [x for x in lines if not bad(x)]
        left = sum(len(words(x)) for x in kept)
        depleted = left < n["n_words"] and (left < n["n_words"] * min_left or left < least_left)
        out.append((not failed and not depleted, strip_lines(text, bad)))
    return out


def strip_lines(text, bad):
    if text is None:
        return None
    return "".join(x for x in re.findall(r"[^\n]*\n|[^\n]+$", text) if not bad(x.rstrip("\n")))


ASSIGN = re.compile(
    r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def secret_spans(text, window=20, hex_bits=3.0, mixed_bits=3.7, single_bits=3.3):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    uuid = "[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
        run = m[0]
        if len(run) < window or re.fullmatch(f"[^0-9]*|[0-9+/_=-]*|{uuid}", run):
            continue
        spans = []
        for i in range(len(run) - window + 1):
            part = run[i : i + window]
            counts = collections.Counter(part)
            bits = -sum(n / window * math.log2(n / window) for n in counts.values())
            is_hex = re.fullmatch("[0-9a-f]*|[0-9A-F]*", part) and bits >= hex_bits
            single = re.fullmatch("[0-9a-z]*|[0-9A-Z]*", part) and bits >= single_bits
            mixed = re.search("[A-Z]", part) and re.search("[a-z]", part) and bits >= mixed_bits
            if re.search("[0-9]", part) and (is_hex or single or mixed):
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + window
                else:
                    spans.append([i, i + window])
        found += [(m.start() + a, 3, m.start() + b) for a, b in spans]
    return sorted(found)


def masked(text):
    out, done = [], 0
    for a, _, b in secret_spans(text):
        if a >= done:
            out += [text[done:a], "[SECRET]"]
        done = max(done, b)
    return text if text is None else "".join(out) + text[done:]


def leak_words(text):
    return re.findall("(?:[a-z0-9]|[^\x00-\x7f])+", lowered(text))


def covered(doc, item, seed=5):
    """Words of ``item`` that greedy tiles cover."""
    d, t = leak_words(doc), leak_words(item)
    seed = min(seed, len(t))
    if not t:
        return 0
    marked_d, marked_t, total = set(), set(), 0
    while True:
        best = None
        for j in range(len(t)):
            for i in range(len(d)):
                n = 0
                while (
                    i + n < len(d)
                    and j + n < len(t)
                    and d[i + n] == t[j + n]
                    and i + n not in marked_d
                    and j + n not in marked_t
                ):
                    n += 1
                if n >= seed and (best is None or n > best[0]):
                    best = (n, j, i)
        if best is None:
            return total
        n, j, i = best
        marked_d.update(range(i, i + n))
        marked_t.update(range(j, j + n))
        total += n


def repeated_bytes(texts, width=200):
    """(removed bytes, spans, kept bytes) of each text."""
    raw = [(t or "").encode() for t in texts]
    counts = collections.Counter(r[i : i + width] for r in raw for i in range(len(r) - width + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - width + 1):
            if counts[r[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((sum(gone), spans, bytes(c for c, g in zip(r, gone) if not g)))
    return out


def main_blocks(blocks, stop_words):
    """Texts of the (text, linked characters, inside an article, in a skipped region) that are content."""

    def letters(text):
        return re.findall(r"[^\W\d_]+", text.lower())

    def share(texts):
        found = [w for t in texts for w in letters(t)]
        return sum(w in stop_words for w in found) / len(found) if found else 0

    open_blocks = [b for b in blocks if not b[3]]
    unlinked = [b for b in open_blocks if b[1] <= len(b[0]) / 3]
    listed = share([b[0] for b in unlinked if len(b[0]) >= 70]) >= 0.1

    def label(text, links, trusted):
        if links > len(text) / 3:
            return False
        if len(text) < 70:
            return None
        low = 0.3 if len(text) < 200 else 0.15
        if trusted or not listed or share([text]) >= low:
            return True
        return None if share([text]) >= 0.15 else False

    outside = sum(len(b[0]) for b in open_blocks if not b[2] and label(b[0], b[1], False))
    article = any(b[2] for b in open_blocks) and outside <= 2 * sum(len(b[0]) for b in unlinked if b[2])
    region = [b for b in open_blocks if b[2] or not article]
    all_labels = [label(b[0], b[1], b[2]) for b in blocks]
    marks = {k: all_labels[k] for k, b in enumerate(blocks) if not b[3] and (b[2] or not article) and all_labels[k] is not None}
    if not marks:
        return [b[0] for b in region]
    out = []
    for k, b in enumerate(blocks):
        if not b[3] and (b[2] or not article):
            nearest = min(abs(k - d) for d in marks)
            if any(good for d, good in marks.items() if abs(k - d) == nearest):
                out.append(b[0])
    return out
