"""Piece ids against SentencePiece itself."""

from __future__ import annotations

import random

import pyarrow.parquet as pq
import pytest
import sentencepiece

from tenure.llm import pieces, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def theirs():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)


@pytest.fixture(scope="module")
def ours():
    vocabulary = pieces.read_vocabulary(queries.PIECE_MODEL)
    assert vocabulary.merges
    return pieces.Merger(vocabulary)


def test_ids_are_those_of_the_model(ours, theirs):
    texts = [t for t in pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist() if t and pieces.MARK not in t]
    assert [x.tolist() for x in ours.encode(texts)] == theirs.encode(texts)


def test_ids_of_odd_texts_are_those_of_the_model(ours, theirs):
    rnd = random.Random(1)
    texts = ["ention", "a", " ", "  ", "a  b   c    d     e", "tab\tnl\n\n", "日本語 😀é", "x" * 3000, "1234567 3.14", "\x01"]
    texts += ["".join(rnd.choice("aabeinorst  -.é日\n") for _ in range(rnd.randint(1, 60))) for _ in range(2000)]
    assert [x.tolist() for x in ours.encode(texts)] == theirs.encode(texts)


def test_long_words_are_merged_the_same_way(ours, theirs, monkeypatch):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("aeinorst日é") for _ in range(n)) for n in (513, 2000, 20_000)]
    expected = theirs.encode(texts)
    assert [x.tolist() for x in ours.encode(texts)] == expected
    monkeypatch.setattr(pieces, "LONG", 1)
    ours.reset()
    words = [w for t in texts for w in (t[:40], t[7:300])]
    assert [x.tolist() for x in ours.encode(words)] == theirs.encode(words)


def test_the_stage_gives_the_ids_of_the_model(spark, theirs):
    texts = ["the attention of mentions", "unbelievable results"]
    rows = pieces.encode(spark.createDataFrame([(t, t) for t in texts], "key string, text string"), queries.PIECE_MODEL)
    assert {r["key"]: r["ids"] for r in rows.collect()} == {t: theirs.encode(t) for t in texts}
