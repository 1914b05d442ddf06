"""The bound on training rows must not shift the prior of the classes."""

from __future__ import annotations

import random

import pytest

from tenure.llm import toxicity


def test_the_bound_does_not_move_the_bias(spark):
    rnd = random.Random(3)
    words = [f"word{i}" for i in range(60)]
    docs, labels = [], []
    # One text in nine is toxic; the insult stands in most of those and in some clean ones.
    for i in range(2700):
        toxic = int(i % 9 == 0)
        text = [rnd.choice(words) for _ in range(15)]
        if rnd.random() < (0.7 if toxic else 0.05):
            text.insert(5, "idiot")
        docs.append((i, " ".join(text)))
        labels.append((i, toxic))
    docs = spark.createDataFrame(docs, "doc_id long, text string").cache()
    labels = spark.createDataFrame(labels, "doc_id long, toxic int").cache()
    whole, bounded = toxicity.fit(docs, labels), toxicity.fit(docs, labels, bound=240)
    assert bounded.bias == pytest.approx(whole.bias, abs=0.5)
