"""The operators against their plain versions in ``brute``."""

from __future__ import annotations

import hashlib
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import bloom, chunks, components, decontamination, html, jaccard, langid, quality, secrets, suffixes, urls
from basketry.llm.blocks import Block, Words

SMALL = "/root/testdata/sf0.001"


def corpus(seed, n=60, vocabulary=400, low=1, high=120):
    """Texts with exact and near copies, shared passages and lines."""
    rng = random.Random(seed)
    names = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(vocabulary)]
    passage = " ".join(rng.choices(names, k=55))
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.5:
            w = rng.choice(texts).split(" ")
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = rng.choice(names).upper()
            texts.append(" ".join(w))
        else:
            w = rng.choices(names, k=rng.randint(low, high))
            for k in range(9, len(w), 10):
                w[k] += "\n"
            if kind > 0.85:
                w.insert(len(w) // 2, passage)
            texts.append(" ".join(w))
    return texts


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_words_are_runs_of_other_than_ascii_space():
    texts = ["a\x0bb \x1cc\x85d\n", "", "é", "  x"]
    words = Words(Block.of(texts))
    assert words.counts.tolist() == [len(brute.words(t)) for t in texts]
    again = Words(Block.of(["x", "é"]))
    assert again.hashes[0] == words.hashes[-1] and again.hashes[1] == words.hashes[-2]


@pytest.mark.parametrize("tile", [2048, 4])
def test_jaccard_components(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    texts = corpus(1, 90) + ["", None, "one", "ONE", "one two", "one  two"]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(frame(spark, texts)).collect()}
    roots, sizes = brute.groups(texts, 4, 85)
    assert got == {i: (sizes[i], roots[i]) for i in range(len(texts))}


def test_one_document_of_each_group_stays(spark):
    texts = corpus(2, 50)
    kept = {r["doc_id"] for r in jaccard.one_of_each(frame(spark, texts), 5, 80).collect()}
    assert kept == set(brute.groups(texts, 5, 80)[0])


def test_tree_finds_every_pair_that_bitmaps_allow():
    rng = np.random.default_rng(3)
    n = rng.integers(5, 60, 70)
    bits = np.stack([np.frombuffer(jaccard.bitmap(rng.integers(0, 2**63, k).astype(np.uint64)), np.uint64) for k in n])
    bits[40:] = bits[:30] | bits[30:60]
    component = np.arange(70)
    a, b, _ = jaccard.linked_leaves(bits, n, component, 50)
    level = jaccard._Level(bits, n, n, n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64), component)
    x, y = np.triu_indices(70, 1)
    good, _ = level.possible(x, y, 50)
    assert {frozenset(p) for p in zip(a.tolist(), b.tolist())} == {
        frozenset(p) for p in zip(x[good].tolist(), y[good].tolist())
    }
    assert len(a)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    got = {r["node"]: r["component"] for r in found.collect()}
    want = {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert got == want
    more = components.merged(found, spark.createDataFrame([(40, 129), (500, 501), (3, 4)], "a long, b long"))
    got = {r["node"]: r["component"] for r in more.collect()}
    assert got == {**dict.fromkeys(want, 0), 500: 500, 501: 500}
    again = components.merged(more, spark.createDataFrame([(1, 2)], "a long, b long"))
    assert {r["node"]: r["component"] for r in again.collect()} == got


@pytest.mark.parametrize("most", [4096, 1])
def test_repeated_bytes(spark, monkeypatch, most):
    monkeypatch.setattr(suffixes, "MOST", most)
    texts = corpus(4, 60) + ["ab" * 300, "ab" * 150 + "x" * 500, "x" * 199, "é" * 150, "é" * 100, None, ""]
    got = suffixes.repeats(frame(spark, texts)).orderBy("doc_id").collect()
    for row, (removed, spans, kept) in zip(got, brute.repeated_bytes(texts), strict=True):
        assert sum(s["stop"] - s["start"] for s in row["spans"]) == removed
        assert len(row["spans"]) == spans
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_chunks_resist_shifts_and_keep_the_first(spark):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz     "
    passage = "".join(rng.choices(letters, k=1500))
    own = ["".join(rng.choices(letters, k=700)) for _ in range(4)]
    texts = [own[0] + passage + own[1], own[2][:333] + passage + own[3], own[1][5:40] + passage[200:], own[2][400:]]
    found = {r["doc_id"]: r["spans"] for r in chunks.repeated(frame(spark, texts)).collect()}
    size = {i: sum(s["stop"] - s["start"] for s in spans) for i, spans in found.items()}
    assert size[0] == 0 and size[3] == 0
    assert 1500 - 1100 < size[1] <= 1500 and size[2] > 700
    kept = {r["doc_id"]: r["text"] for r in chunks.deduplicate(frame(spark, texts)).collect()}
    assert kept[0] == texts[0]
    for i, spans in found.items():
        raw = texts[i].encode()
        assert all(raw[s["start"] : s["stop"]].decode() in passage for s in spans)
        assert len(kept[i]) == len(raw) - size[i]


def test_chunk_cuts_follow_content():
    rng = np.random.default_rng(6)
    data = rng.integers(97, 123, 5000).astype(np.uint8).tobytes()
    _, ends = chunks.chunk_ends(Block.of([data, b"0123456789" * 3 + data]))
    split = int(np.searchsorted(ends, 5000)) + 1
    first, second = set(ends[:split].tolist()), {e - 5030 for e in ends[split:].tolist()}
    assert len(first & second) > 0.8 * len(first)


def test_tiles_against_brute_force():
    rng = random.Random(7)
    for _ in range(40):
        item = rng.choices("abcdefg", k=rng.randint(5, 18))
        doc = rng.choices("abcdefg", k=10) + item[8:] + ["z"] + item[:8] + rng.choices("abcdefg", k=10)
        seeds = [{tuple(w[i : i + 5]): [] for i in range(len(w) - 4)} for w in (doc, item)]
        for w, own in zip((doc, item), seeds):
            for i in range(len(w) - 4):
                own[tuple(w[i : i + 5])].append(i)
        shared = [(np.array(seeds[0][s]), np.array(seeds[1][s])) for s in seeds[0].keys() & seeds[1].keys()]
        found = decontamination.tiles(decontamination.runs(shared), 5)
        assert sum(t[2] for t in found) == brute.covered(" ".join(doc), " ".join(item))


def test_leaks_are_found_reordered_and_clean_documents_are_not(spark):
    item = "Alpha beta gamma delta epsilon zeta. Eta theta iota kappa lambda mu! Nu xi omicron pi rho sigma?"
    first, second, third = item.split(". ")[0], item.split(". ")[1].split("! ")[0], item.split("! ")[1]
    texts = [
        f"some words, {item} and others",
        f"{third} -- between -- {first.upper()}; then: {second}",
        f"only this: {first}",
        "nothing of it at all, only other words here",
        "short one",
    ]
    bench = spark.createDataFrame([(1, item), (2, "Short one!"), (3, "absent")], "item_id long, text string")
    rows = decontamination.leaks(frame(spark, texts), bench).collect()
    assert {(r["doc_id"], r["item_id"]): r["covered"] for r in rows} == {(0, 1): 18, (1, 1): 18, (4, 2): 2}
    assert {r["doc_id"] for r in decontamination.without_leaks(frame(spark, texts), bench).collect()} == {2, 3}


def test_secrets(spark):
    rng = random.Random(8)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = [None, "", "token=abc", "token=token:abcdefgh", "API_KEY = 'aé", "ſecret=abcdefgh", "pass passwd:=abcdefg"]
    texts += ["AKIA" + "A" * 15, "AKIA" + "AKIA" * 4, "x" + "0" * 30, "123e4567-e89b-12d3-a456-426614174000"]
    for _ in range(60):
        parts = [
            rng.choice(["é ", "token: ", "Password=", "apikey =\"", " ", "secret", "\n", "=", "-"])
            + "".join(rng.choices(rng.choice([alphabet, "0123456789abcdef", "aB1", "ab"]), k=rng.randint(0, 70)))
            for _ in range(rng.randint(1, 6))
        ]
        texts.append("".join(parts))
    # more matches than one chunk of places
    texts.append(" ".join(f"token={i:06d}" for i in range(2500)))
    rows = secrets.scan(frame(spark, texts)).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        got = [(s["start"], s["kind_no"], s["stop"]) for s in row["secret_spans"]]
        assert got == brute.secret_spans(text), text
    hidden = secrets.mask(frame(spark, texts)).orderBy("doc_id").collect()
    assert [r["text"] for r in hidden] == [brute.masked(t) for t in texts]


def test_secret_scan_is_native(spark):
    plan = secrets.mask(frame(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Exchange"))


def test_quality_counts_and_verdicts(spark):
    texts = corpus(9, 60, low=15)
    rng = random.Random(9)
    sources = [rng.choice(["a", "b", "", None]) for _ in texts]
    texts = [t + "\nPage 12 of 99\n" if rng.random() < 0.5 else t for t in texts] + ["w \n w\nw \n\n", None, "a|b <c>"]
    sources += ["a", None, "b"]
    rows = list(zip(range(len(texts)), texts, sources))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    limits = {"max_share": 0.2, "min_docs": 3}
    judged = quality.judge(docs, **limits).orderBy("doc_id").collect()
    expected = brute.quality(list(zip(sources, texts)), **limits)
    for row, text, (kept, _) in zip(judged, texts, expected, strict=True):
        counts = brute.base_counts(text)
        assert {c: row[c] for c in counts} == counts
        assert row["kept"] == kept
    assert any(r["removed_words"] for r in judged)
    good = {r["doc_id"]: r["text"] for r in quality.keep_good(docs, **limits).collect()}
    assert good == {i: text for i, (kept, text) in enumerate(expected) if kept}


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    model = langid.train(docs.where(~langid.held_out()))
    assert model.languages == ["de", "en", "es", "fr"]
    scored = langid.predict(docs, model, ["lang", langid.held_out().alias("held_out")])
    right = scored.where("held_out AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] >= 0.97
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_language_scores_against_plain_bayes(spark):
    rows = [(1, "aab ab", "x"), (2, "bba bb", "y"), (3, "aaa", "x"), (4, None, "x"), (5, "zz", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    names, posterior = model.score(Block.of(["ab", "BB", "12 !", "a1b"]))
    assert model.languages == ["x", "y"] and names[1] == "y" and names[2] == "und" and posterior[2] == 0
    totals = model.prior.copy()
    for _, buckets in langid.block_grams(Block.of(["ab"])):
        totals += model.weights[:, buckets].sum(axis=1)
    share = np.exp(totals - totals.max())
    assert posterior[0] == pytest.approx(share.max() / share.sum())
    assert names[0] == model.languages[int(totals.argmax())]


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    words = bloom.build(keys, "key", 1 << 10)
    inside = np.array([r[0] for r in keys.collect()], np.int64)
    assert bloom.probe(words, inside).all()
    outside = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20000)
    assert bloom.probe(words, outside).mean() < 0.1
    # the filter may say yes too often, the verdict does not
    pages = spark.createDataFrame([(i, f"http://h{i}.example/x") for i in range(300)], "page_id long, url string")
    listed = pages.where("page_id % 3 = 0").selectExpr("concat(url, '/?utm_source=a#b') AS url")
    judged = urls.filter_urls(pages, listed, rules=(), blocks=1).collect()
    assert {r["page_id"] for r in judged if r["verdict"] == "block"} == set(range(0, 300, 3))


def test_longest_rule_wins(spark):
    cases = {
        "http://a.example.org/en/12": ("example.org/en/1", "block"),
        "http://EXAMPLE.ORG/en/2": ("org/", "allow"),
        "https://x.com/de/1?u=/fr/": ("com/de/", "block"),
        "https://x.com/it/1": (None, "allow"),
        "https://notexample.org/es/": ("org/", "allow"),
        "x.com/de/1": (None, "allow"),
        "ftp://org": (None, "allow"),
    }
    pages = spark.createDataFrame(list(cases.items() and [(u,) for u in cases]), "url string")
    judged = urls.filter_urls(pages, pages.limit(0), keep=["url"]).collect()
    assert {r["url"]: (r["rule"], r["verdict"]) for r in judged} == cases


ARTICLE = "<p>The first of all the words that are here, and there is more of them to be had for you.</p><p>Short.</p>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("<p>a &amp; b&nbsp;c", "a & b c"),
        ("<h1>T</h1><p>x<br>y <b>z</b></p>", "T\nx y z"),
        (f"<nav><a href=/>Home</a></nav><article>{ARTICLE}</article><footer>Foot</footer>", None),
        (f"<header>Site</header><div class='cookie-notice'>We use</div><main>{ARTICLE}</main><aside>x</aside>", None),
        (f"<article>{ARTICLE}<ul class=related><li><a href=/x>Other</a></li></ul></article>", None),
        (f"<article>{ARTICLE}</article><section id=comments><article><p>So true.</p></article></section>", None),
        (f"<body>{ARTICLE}<div id='sidebar'><p>Short</p></div><form>q</form><script>var t='</p>';</script>", None),
        (f"<article>{ARTICLE}<script>var t='<p>x", None),
        (f"<article>{ARTICLE}</artic", None),
    ],
)
def test_main_text(page, text):
    wanted = text if text is not None else html.main_text(ARTICLE)
    assert html.main_text(page) == wanted
    assert html.main_text(ARTICLE).endswith("\nShort.")
