"""Alignment of two tokenizers against a plain count over byte ranges."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from tenure.llm import crosstok, packing
from tenure.llm.queries import BYTE_MODEL, PIECE_MODEL

ODD = ["", None, "a▁b", "x <s> </s> <|endoftext|> <unk> <0x41>", "tab\tand\n\nlines  two   three ", "\x00\x01", "日本語 Ünï 😀é", "the the the", "the the the"]


def brute(texts):
    both = crosstok.codec(BYTE_MODEL, PIECE_MODEL)
    total, per = Counter(), []
    for text in texts:
        links, n_groups, shown, ids = Counter(), 0, "", None
        if text:
            a = both.a.encode(" " + text, add_special_tokens=False).ids
            b = both.b.encode(text)
            whole = b" " + text.encode()
            if b"".join(both.a_bytes[i] for i in a) == whole and b"".join(both.b_bytes[i] for i in b) == whole:
                ids = a, b
                spans = []
                for side, table in ((a, both.a_bytes), (b, both.b_bytes)):
                    at, own = 0, []
                    for i in side:
                        own.append((at, at + len(table[i]), i))
                        at += len(table[i])
                    spans.append(own)
                owner = {}
                for s, e, i in spans[1]:
                    owner.update({x: (s, i) for x in range(s, e)})
                for s, e, i in spans[0]:
                    for _, other in {owner[x] for x in range(s, e)}:
                        links[i, other] += 1
                ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
                parts, last = [], 0
                for end in ends:
                    parts.append("|".join(",".join(str(i) for s, e, i in own if last < e <= end) for own in spans))
                    last = end
                n_groups, shown = len(ends), hashlib.sha256(";".join(parts).encode()).hexdigest()
        total.update(links)
        per.append((links, n_groups, shown, ids))
    highest = Counter()
    for (_, b), n in total.items():
        highest[b] = max(highest[b], n)
    return [
        (
            len(ids[0]) if ids else 0,
            len(ids[1]) if ids else 0,
            n_groups,
            sum(links.values()),
            sum(n for (a, b), n in links.items() if total[a, b] == highest[b]),
            sum(n * total[p] for p, n in links.items()),
            shown,
        )
        for links, n_groups, shown, ids in per
    ]


@pytest.mark.parametrize("slice_bytes", [crosstok.SLICE_BYTES, 200])
def test_against_byte_ranges(spark, docs, slice_bytes):
    rows = [(r["doc_id"], (r["text"] or None) and r["text"][:4000]) for r in docs.collect()]
    rows += [(100 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = crosstok.align_documents(df, BYTE_MODEL, PIECE_MODEL, slice_bytes).collect()
    expected = [(i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows]))]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)
    assert sum(r["n_links"] > 0 for r in found) > 15 and sum(r["n_links"] == 0 for r in found) >= 5


def test_pairs_of_the_corpus(spark):
    df = spark.createDataFrame([(1, "the the the"), (2, "the")], "doc_id long, text string")
    rows = crosstok.linked_pairs(df, BYTE_MODEL, PIECE_MODEL).collect()
    assert [(r["n"], r["best"]) for r in rows] == [(4, True)]


def test_stretches_change_nothing():
    both = crosstok.codec(BYTE_MODEL, PIECE_MODEL)
    text = "some words, more  words\n and 12 34 ' quoted's end. \u2003wide\u2003 x" * 40
    parts = crosstok._CUT.split(text)
    assert len(parts) > 10 and " ".join(parts) == text
    assert [i for p in parts for i in both.a.encode(" " + p, add_special_tokens=False).ids] == both.a.encode(" " + text, add_special_tokens=False).ids
    assert [i for p in parts for i in both.b.encode(p)] == both.b.encode(text)
    # No piece of the second vocabulary goes on after a blank inside it.
    assert not any(crosstok._BLANK in both.b.id_to_piece(i).lstrip(crosstok._BLANK) for i in range(both.b.get_piece_size()))


def test_both_forms_of_the_first_vocabulary_agree():
    both = crosstok.codec(BYTE_MODEL, PIECE_MODEL)
    rnd = random.Random(9)
    letters = "aeiournst'sdm  \n\t.,;()[]<|>0123456789éßñ日本語😀\u2003\xa0\u0301ǅ"
    for _ in range(3000):
        text = " " + "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60)))
        assert both.a_short.encode_ordinary(text) == both.a.encode(text, add_special_tokens=False).ids


def test_packing():
    rng = np.random.default_rng(0)
    for top in (1, 200, 70_000, 2**63):
        x = rng.integers(0, top, 1000, np.uint64)
        assert (packing.unpack(packing.pack(x)) == x).all()
        assert (packing.unpack(packing.pack(np.sort(x), True), True) == np.sort(x)).all()
    assert len(packing.unpack(packing.pack(np.array([], np.uint64)))) == 0


def test_runs_are_merged_once_each():
    runs = [(np.array(p, np.uint64), np.array(c, np.uint64)) for p, c in (([1, 5], [2, 3]), ([5, 9], [1, 1]), ([], []))]
    pairs, counts = crosstok.merge_runs(runs)
    assert (pairs.tolist(), counts.tolist()) == ([1, 5, 9], [2, 4, 1])
