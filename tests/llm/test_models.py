"""Held-out accuracy of the learned operators, and wrappers on pages of other kinds."""

from __future__ import annotations

import numpy as np
import pytest

from tenure.llm import mixing, queries
from tenure.llm.wrappers import extract, infer, rules

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in queries.op3_language(spark, SF).collect() if r["held_out"]]
    assert sum(lang[r["doc_id"]] == r["lang_pred"] for r in rows) / len(rows) > 0.97


def test_toxicity_of_held_out_documents(spark):
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in queries.op8_toxicity(spark, SF).collect() if r["held_out"] and r["doc_id"] in toxic]
    assert sum(toxic[r["doc_id"]] == r["predicted"] for r in rows) / len(rows) > 0.93


def test_quality_rules_agree_with_labels(spark):
    good = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in queries.op10_quality_rules(spark, SF).collect() if r["doc_id"] in good and not r["base_failed"]]
    assert sum(r["kept"] == bool(good[r["doc_id"]]) for r in rows) / len(rows) > 0.95


PAGE = """<html><head><title>T</title><style>x</style></head><body><header class="site-header"><h1>Site</h1></header>
<div class="cookie-notice">We use cookies</div><div id="menu"><a href=x>Home</a></div>
<main><article class="post"><header><h1>Title {0}</h1><p class="byline">By A</p></header>
<p>Para one &amp; two&nbsp;x {0}<b>bold</b></p><ul><li>item <a>l</a></li><li>it2</li></ul>
<form><input><label>Name</label><button>Go</button></form><aside>side</aside><div class="ad">buy</div>
<ul class=x><li><a>r{0}</a><li><a>q{0}</a></ul><script>var a="<p>no</p>"</script><p>last {0}</article>
<section id="comments"><p>comment {0}</p></section></main><div class="sidebar">sb</div><footer>f</footer></body></html>"""


def test_a_wrapper_leaves_the_article():
    pages = [PAGE.format(i) for i in range(10)]
    found = rules(infer(pages))
    assert extract(pages[3], found) == "Title 3 Para one & two x 3bold item l it2 last 3"
    assert extract("<div>a<p>b<div class='nav'>x</div></div>", found) == "a b"


def test_repeated_and_optional_parts_are_told_apart():
    wrapper = infer(["<div><p>a</p><p>b</p></div>", "<div><p>c</p><h2>d</h2></div>"])
    div = wrapper.children[0]
    assert [(c.key, c.repeated, c.optional) for c in div.children] == [("p", True, False), ("h2", False, True)]


def test_broken_pages_do_not_fail():
    for page in ("<", "<p", "</p></div>", "<!-- open", "<script>never closed", "<p>&#xZZ; &bogus; &amp", "<div " + "x" * 5000, "<b>" * 3000 + "t"):
        extract(page, None)
    assert extract("<ul>" * 500 + "deep", None) == "deep"


def test_sources_come_near_their_targets(spark):
    rows = mixing.mix_sources(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    sources = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        sources.setdefault((r["source"], r["target"]), []).append(r)
    for (source, target), own in sources.items():
        # A few open documents of each order of size settle what is left.
        assert abs(sum(r["taken"] for r in own) - target) <= 0.01 * target, source


def test_settling_keeps_the_sum_and_the_expectation():
    rng = np.random.default_rng(5)
    size = np.sort(rng.integers(1, 5000, 60))[::-1].astype(float)
    share = rng.random(60)
    total, mean = (size * share).sum(), np.zeros(60)
    for _ in range(4000):
        out = mixing.settle(size, share, rng.random(60))
        # The smallest of all is 6, but the five smallest may not be able to make up for the sixth.
        assert set(np.unique(out)) <= {0.0, 1.0} and abs((size * out).sum() - total) <= 60
        mean += out
    assert np.abs(mean / 4000 - share)[:12].max() < 0.1
