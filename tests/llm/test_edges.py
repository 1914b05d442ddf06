"""Nulls, empty tables, repeated rows and clashing columns, for every operator."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from tenure.llm import crosstok, langid, mixing, pieces, pitman_yor, quality, queries, repeats, sharding, simhash, toxicity, winnowing, wrappers

LABELS = "doc_id long, quality int, toxic int"
MODEL = queries.PIECE_MODEL


def label_rows(spark, rows=()):
    return spark.createDataFrame(list(rows), LABELS)


OPERATORS = {
    "op1": lambda spark, d: sharding.assign_shards(d, [1.0, 2.0, 1.0]),
    "op2": lambda spark, d: simhash.near_duplicates(d),
    "op3": lambda spark, d: langid.identify(d),
    "op4": lambda spark, d: repeats.repeat_digest(d),
    "op5": lambda spark, d: pieces.encode_documents(d, MODEL),
    "op7": lambda spark, d: winnowing.fingerprint_documents(d),
    "op8": lambda spark, d: toxicity.score_toxicity(d, label_rows(spark, [(0, 1, 1), (7, 1, 0), (9, None, None), (None, 1, 1)])),
    "op9": lambda spark, d: mixing.mix_sources(d),
    "op11": lambda spark, d: pitman_yor.score_documents(d, share=0.01),
    "op12": lambda spark, d: crosstok.align_documents(d, queries.BYTE_MODEL, MODEL),
    "op10": lambda spark, d: quality.quality_rules(d, label_rows(spark, [(0, 1, 1), (1, 0, 0), (None, 0, 0)]))[0],
}


def plain(df):
    return Counter(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_comes_out_and_extra_columns_do_not_matter(spark, docs, clashing, name):
    found = plain(OPERATORS[name](spark, docs))
    assert sum(found.values()) == docs.count()
    assert plain(OPERATORS[name](spark, clashing)) == found


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_gives_an_empty_result(spark, empty, name):
    assert OPERATORS[name](spark, empty).collect() == []


def test_pages_of_any_kind(spark):
    schema = "page_id long, url string, html string, text string, rules string"
    rows = [(1, None, None, "x", "y"), (1, None, None, "x", "y"), (None, "http://A.b/c", "<p>One<p>two", "x", "y"), (3, "", "", None, None)]
    out = wrappers.main_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in out) == [(0, "One two", 7), (1, "", 0), (1, "", 0), (3, "", 0)]
    assert wrappers.main_text(spark.createDataFrame([], schema)).collect() == []


def test_stages_take_any_rows(spark, docs, empty, tmp_path):
    label_rows(spark, [(7, 1, 0)]).write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        rows = out.collect()
        assert stage(spark, empty, str(tmp_path)).collect() == []
        if name != "pieces":
            assert tuple(out.columns) == corpus_pipeline.COLUMNS
        assert rows


def test_near_copies_and_equal_texts_leave_one_document(docs, clashing):
    found = simhash.near_duplicates(docs).collect()
    kept = simhash.keep_first(clashing)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == clashing.columns
    assert sorted(i for i in ids if i is not None) == sorted({r["component_id"] for r in found if r["component_id"] is not None})
    # 0, 1 and the repeated row are equal; 3, 4, 5 and a row without an id have no words.
    assert ids.count(0) == 1 and 1 not in ids and {6, 7, 8, 9, 10, 15} <= set(ids)
    assert [i for i in ids if i in (3, 4, 5)] == [3]


def test_a_stage_keeps_nulls_and_n_chars_follow_the_text(spark, docs):
    rows = corpus_pipeline.cut_repeats(spark, docs, "").collect()
    assert all((r["text"] is None) == (r["n_chars"] is None) for r in rows)
    assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] is not None)
