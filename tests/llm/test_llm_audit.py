"""The audit against filters that are really applied, order by order."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
from odd import no_docs, odd_docs

from basketry.llm import audit
from basketry.llm.blocks import Block

LABELS = "doc_id long, quality int, toxic int"


def fails(rows):
    """The failed filters of each (doc_id, text, lang) row."""
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        w = re.findall("[^\x20\x09-\x0d]+", text)
        out.append(
            {
                "A": len(w) < 200,
                "B": 100 * len(set(w)) < 50 * len(w),
                "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                "D": bool(re.search(r"[#$%&*|]", text)),
                "E": doc_id is not None and doc_id > least[text],
            }
        )
    return out


def plain_version(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    flags = fails(rows)
    out = {}
    for part in {lang or "" for _, _, lang in rows}:
        own = [k for k, r in enumerate(rows) if (r[2] or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [k for k in left if flags[k][f]]
                stay = [k for k in left if not flags[k][f]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    f,
                    len(stay),
                    len(gone),
                    sum(flags[k][f] for k in own) - len(gone),
                    sum(flags[k][f] and sum(flags[k].values()) == 1 for k in own),
                    sum(rows[k][0] in good for k in gone),
                    sum(rows[k][0] in toxic for k in gone),
                ]
                left = stay
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(total[f])
    return out


def corpus(seed, n=300):
    rng = random.Random(seed)
    few, many = [f"w{i}" for i in range(40)], [f"w{i}" for i in range(5000)]
    rows = []
    for i in range(n):
        w = rng.choices(rng.choice([few, many]), k=rng.choice([0, 3, 190, 205, 400]))
        if rng.random() < 0.3:
            w = [x.upper() for x in w]
        if rng.random() < 0.2:
            w.append(rng.choice("#$%&*|"))
        text = rng.choice([" ", "\n", "\x0b"]).join(w)
        if rows and rng.random() < 0.3:
            text = rng.choice(rows)[1]
        rows.append((rng.choice([i, i, i, None, 5]), rng.choice([text, text, text, None]), rng.choice(["en", "de", None, ""])))
    labels = [(rng.choice([rng.randrange(n), None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(n)]
    return rows, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_against_filters_applied_in_order(spark, seed):
    rows, labels = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = audit.audit(audit.survivors(docs, spark.createDataFrame(labels, LABELS))).collect()
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got} == plain_version(rows, labels)
    assert len(got) == 120 * 5 * len({r[2] or "" for r in rows})


def test_popcounts_of_words_with_multiplicities():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 3, 4, 100, 1000):
        words = rng.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)
        times = rng.integers(0, 10**6, n)
        want = [int((((words >> np.uint32(p)) & np.uint32(1)).astype(np.int64) * times).sum()) for p in range(32)]
        assert audit.positional_popcounts(words, times).tolist() == want


def test_survival_words():
    table = audit.survival_words()
    assert table[0] == 2**32 - 1 and table[31] == 1
    assert all(bool(table[f] >> s & 1) == (f & s == 0) for f in range(32) for s in range(32))


def test_flags_at_their_limits():
    one = " ".join(["a"] * 100 + [f"x{i}" for i in range(99)])
    texts = [one, one + " y", "a b a b", "a b a c", "A" + "a" * 32, "A" + "a" * 33, "é" * 32 + "A", "é" * 33 + "A", "a|b", ""]
    docs = [(i, t, None) for i, t in enumerate(texts)]
    want = [sum(1 << k for k, f in enumerate("ABCD") if x[f]) for x in fails(docs)]
    assert audit.text_fails(Block.of(texts)).tolist() == want


def test_one_text_in_a_third_of_all_rows(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'copy', concat('t', id)) AS text", "'en' AS lang")
    counts = audit.survivors(docs, spark.createDataFrame([(0, 1, 0), (3, 1, 1)], LABELS)).collect()
    assert len(counts) == 1
    assert counts[0]["everything"][0] == 3000 and counts[0]["everything"][16] == 2001
    assert counts[0]["good"][16] == 1 and counts[0]["toxic"][0] == 1 and counts[0]["toxic"][16] == 0


def test_odd_rows_and_empty_table(spark):
    labels = spark.createDataFrame([(4, 1, 1), (4, 0, None), (None, 1, 1)], LABELS)
    docs = odd_docs(spark)
    got = audit.audit(audit.survivors(docs, labels)).collect()
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    want = plain_version(rows, [tuple(r) for r in labels.collect()])
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got} == want
    assert audit.audit(audit.survivors(no_docs(spark), labels)).collect() == []
    assert len(audit.audit(audit.survivors(docs, labels.limit(0))).collect()) == len(got)
