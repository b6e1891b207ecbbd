"""Input columns that have the names of results or of columns in between."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from basketry.llm import chunks, decontamination, html, langid, packing, suffixes, urls

TEXTS = ["one two three four five six seven", "", None, "sept huit neuf dix onze douze"]
NAMES = "own row kept n_bytes n_chunks spans stop start uid place seed length lang_pred score sequence_id offset".split()


def docs(spark, extra=NAMES):
    rows = [(i, t, "en", "a") for i, t in enumerate(TEXTS)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return plain.withColumns({c: F.lit("own") for c in extra})


def same(with_clashes, without):
    names = without.columns
    assert len(set(with_clashes.columns)) == len(with_clashes.columns)
    assert sorted(map(repr, with_clashes.select(*names).collect())) == sorted(map(repr, without.collect()))


def test_language_columns_replace_those_of_the_input(spark):
    model = langid.train(docs(spark))
    found = langid.predict(docs(spark), model, ["doc_id", "text", "own", "lang_pred", "score"])
    assert found.columns == ["doc_id", "text", "own", "lang_pred", "score"]
    assert {r["lang_pred"] for r in found.collect()} == {"en", "und"}
    assert langid.predict(docs(spark), model, ["score"]).columns == ["lang_pred", "score"]
    same(found.drop("own"), langid.predict(docs(spark, []), model, ["doc_id", "text"]))


def test_dedup_and_packing_see_only_their_own_columns(spark):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    for operator in (suffixes.repeats, chunks.repeated, lambda d: packing.pack_documents(d, vocabulary)):
        same(operator(docs(spark)), operator(docs(spark, [])))


def test_leaks_see_only_their_own_columns(spark):
    items = [(1, "two three four five six", "x", "x", "x")]
    bench = spark.createDataFrame(items, "item_id long, text string, item string, seed string, places string")
    clash = docs(spark, ["item", "item_id", "seed", "places", "row_key"])
    same(decontamination.leaks(clash, bench), decontamination.leaks(docs(spark, []), bench.select("item_id", "text")))


def test_pages_keep_columns_of_any_name(spark):
    rows = [(1, "http://a.org/x", "<p>one two three</p>", "own", "own", "own", "own", "own")]
    names = "page_id long, url string, html string, text string, host string, path string, canonical string, _html string"
    pages = spark.createDataFrame(rows, names)
    same(html.extract(pages, ["page_id", "text", "_html"]).drop("_html"), html.extract(pages.select("page_id", "html"), ["page_id"]))
    listed = pages.select("url", "host")
    same(urls.filter_urls(pages, listed), urls.filter_urls(pages.select("page_id", "url"), listed.select("url")))
