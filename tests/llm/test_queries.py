"""Text queries against their SQL; the pipeline; empty tables."""

import pytest

import corpus_pipeline
from heliogrid.llm import exact, html, jaccard, lines, mixing, packing, privacy, quality, suffix, urls
from heliogrid.llm.queries import ORACLES, QUERIES, URL_RULES
from tests.conftest import SF
from tests.test_queries import duck, rows_by_name  # noqa: F401

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):  # noqa: F811
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    assert rows_by_name(df.columns, df.collect()) == rows_by_name([d[0] for d in result.description], result.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns or name == "pack_sequences"
    one = sorted((r.doc_id, r.start, r.ids_crc32) for r in docs.collect())
    again = sorted((r.doc_id, r.start, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect())
    assert one and sum(x[1] == 0 for x in one) == sum(x[1] == 0 for x in again)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    for df in (
        suffix.repeat_report(docs),
        exact.exact_dedup(docs),
        privacy.with_spans(docs),
        jaccard.near_duplicates(docs),
        jaccard.keep_one_each(docs),
        lines.dedup_lines(docs),
        packing.pack(docs),
        mixing.mix_report(docs),
        mixing.mix(docs),
        quality.with_ledger(docs),
        html.extract_text(spark.createDataFrame([], "page_id bigint, url string, html string")),
        urls.filter_urls(spark.createDataFrame([], "page_id bigint, url string"), URL_RULES),
    ):
        assert df.collect() == []


def test_nulls_and_repeated_rows(spark):
    odd = [(None, None, None, None, None), (1, "", "en", None, 0), (2, " \n ", "en", "a", 3), (3, "x", "en", "a", 1), (3, "x", "en", "a", 1), (None, "x", None, "a", 1)]
    docs = spark.createDataFrame(odd, DOCS).withColumnRenamed("lang", "key")
    assert sorted(r.kept for r in exact.exact_dedup(docs).collect()) == [False] * 4 + [True] * 2
    groups = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert groups == {(None, 0): None, (1, 0): 1, (2, 0): 2, (3, 1): 3, (None, 1): 3}
    assert sorted((r.doc_id or 0, r.text or "") for r in jaccard.keep_one_each(docs).collect()) == [(0, ""), (1, ""), (2, " \n "), (3, "x")]
    assert all(r.n_removed == 0 for r in suffix.repeat_report(docs).collect())
    assert [(r.doc_id, r.length) for r in packing.pack(docs.filter("doc_id = 1")).collect()] == [(1, 1)]
    assert sum(r.taken for r in mixing.mix_report(docs).collect()) == 3
    assert [r.n_removed for r in lines.dedup_lines(docs.orderBy("doc_id"), counts="n_removed").collect()].count(1) == 1
    assert all(r.ledger.fail_bits & 1 for r in quality.with_ledger(docs).collect())
    assert all(r.spans == [] for r in privacy.with_spans(docs).collect())
