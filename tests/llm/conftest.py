from __future__ import annotations

import random

import pytest

LETTERS = "abcdefghijklmnopqrstuvwxyz"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; the tables may have them too.
CLASHING = ("key", "size", "shard", "slot", "fp", "held_out", "score", "share", "copies", "n_bytes", "kept", "ids", "spans", "target", "decoded", "_row", "_range")


def words(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(LETTERS) for _ in range(rnd.randint(2, 8))) for _ in range(n))


def corpus() -> list[tuple]:
    """Plain, empty, null, repeated, very long, copied and nearly copied documents."""
    base = words(1, 120)
    passage = words(2, 60)
    near = base.split()
    near[60] = "changed"
    texts = [base, base, " ".join(near), None, "", "   \n\t ", "one", "Ünï çode 日本 😀", "a" * 3000, words(3, 20_000)]
    texts += [f"{words(10 + i, 40)}\n{passage}\n{words(50 + i, 30)}" for i in range(6)]
    rows = [(i, t, ("en", "de", None)[i % 3], ("s1", "s2", None)[i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], (None, "without an id but some words", "en", "s1", 28), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same rows with extra columns whose names the operators use."""
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
