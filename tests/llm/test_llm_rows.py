"""Every operator on odd rows and on an empty table."""

from __future__ import annotations

import public_tokenizers
import pytest
from odd import no_docs, odd_docs, own_columns_kept

from basketry.llm import chunks, decontamination, html, jaccard, langid, packing, quality, secrets, suffixes, urls

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def benchmark(spark, rows=((1, "quick brown fox jumps over one lazy dog"), (2, None), (None, ""), (3, "zebra"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


PER_ROW = {
    "secrets": secrets.scan,
    "language": lambda d: langid.predict(d, langid.train(d), ["doc_id"]),
    "jaccard": jaccard.link,
    "suffixes": suffixes.repeats,
    "chunks": chunks.repeated,
    "quality": quality.judge,
}
SAME_COLUMNS = {
    "quality": quality.keep_good,
    "jaccard": lambda d: jaccard.one_of_each(d, 5, 80),
    "decontamination": lambda d: decontamination.without_leaks(d, benchmark(d.sparkSession)),
    "secrets": secrets.mask,
    "chunks": chunks.deduplicate,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_result_for_each_row(spark, name):
    docs = odd_docs(spark)
    found = PER_ROW[name](docs)
    assert sorted(r[0] or -1 for r in found.select("doc_id").collect()) == sorted(
        r[0] or -1 for r in docs.select("doc_id").collect()
    )


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, name):
    assert PER_ROW[name](no_docs(spark)).collect() == []


@pytest.mark.parametrize("name", SAME_COLUMNS)
def test_columns_stay_and_clash_with_nothing(spark, name):
    docs = odd_docs(spark)
    found = SAME_COLUMNS[name](docs)
    assert own_columns_kept(docs, found)
    assert found.schema.simpleString() == docs.schema.simpleString()


@pytest.mark.parametrize("name", SAME_COLUMNS)
def test_empty_table_in_empty_table_out(spark, name):
    assert SAME_COLUMNS[name](no_docs(spark)).collect() == []


def test_packing_takes_odd_rows(spark):
    docs = odd_docs(spark)
    pieces = packing.pack_documents(docs, VOCABULARY, payload="ids_crc32").toPandas()
    # one first piece for each row, and single end ids for null and empty texts
    assert (pieces.start == 0).sum() == docs.count()
    assert (pieces.doc_tokens == 1).sum() == 3
    assert packing.pack_documents(no_docs(spark), VOCABULARY).collect() == []


def test_pages_may_be_null_or_empty(spark):
    rows = [(1, None, None, "x"), (2, "no scheme", "", "x"), (2, "no scheme", "", "x"), (None, "http://A.org/x", "<p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    texts = html.extract(pages).collect()
    assert [r["text"] for r in texts] == [""] * 4
    judged = urls.filter_urls(pages, pages.limit(0)).collect()
    assert sorted((r["host"], r["path"], r["verdict"]) for r in judged) == [
        ("", "", "allow"),
        ("", "", "allow"),
        ("", "", "allow"),
        ("a.org", "/x", "allow"),
    ]
    assert html.extract(pages.limit(0)).collect() == []
    assert urls.filter_urls(pages.limit(0), pages).collect() == []


def test_empty_benchmark_leaks_nowhere(spark):
    docs = odd_docs(spark)
    assert decontamination.leaks(docs, benchmark(spark, ())).collect() == []
    found = decontamination.leaks(docs, benchmark(spark)).collect()
    # rows 4 (twice, one document), 5 and the one without id
    assert sorted((r["doc_id"] or -1, r["item_id"], r["covered"]) for r in found) == [(-1, 1, 8), (4, 1, 8), (5, 1, 8)]
