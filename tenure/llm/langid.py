"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from a generator seeded by its code point.
An n-gram is bound by multiplying the vectors of its letters, the vector of place k permuted k
times (here: rotated), and a text is the bundle (sum) of its n-grams. A language is the sum of
the bundles of its texts. A text gets the language whose vector has the largest cosine with its
own after the mean of all languages is taken off both, since what they share tells nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.llm.common import fold, keyed

DIM = 1024
N = 3
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
#: Languages a model may have; the prototypes travel to every task.
MOST_LANGUAGES = 2_000
#: Texts taken together, and n-gram vectors kept between batches (at most 64 MB).
CHUNK, KEPT = 256, 1 << 15

_OTHER = re.compile(r"[\W\d_]+")


class Grams:
    """Vectors of n-grams of letters; kept up to a bound, always rebuilt the same."""

    def __init__(self, dim: int = DIM):
        self.dim, self.letters, self.known = dim, {}, np.empty(0, np.int64)
        self.vectors = np.empty((0, dim), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = np.random.default_rng(code).integers(0, 2, self.dim, np.int8) * np.int8(2) - np.int8(1)
        return self.letters[code]

    def build(self, grams: np.ndarray) -> np.ndarray:
        out = np.ones((len(grams), self.dim), np.int8)
        for k in range(N):
            codes, place = np.unique((grams >> (21 * k)) & 0x1FFFFF, return_inverse=True)
            table = np.stack([np.roll(self.letter(int(c)), k) for c in codes]) if len(codes) else out[:0]
            out *= table[place]
        return out

    def get(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of sorted distinct n-grams."""
        if len(self.known) > KEPT:
            self.known, self.vectors = self.known[:0], self.vectors[:0]
        new = np.setdiff1d(grams, self.known, assume_unique=True)
        if len(new):
            known = np.concatenate([self.known, new])
            order = np.argsort(known)
            self.vectors = np.concatenate([self.vectors, self.build(new)])[order]
            self.known = known[order]
        return self.vectors[np.searchsorted(self.known, grams)]


def grams_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of letters with their counts; words are set off by one blank."""
    if not isinstance(text, str):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    letters = _OTHER.sub(" ", text.lower()).strip()
    if not letters:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.unique(codes[:-2] | codes[1:-1] << 21 | codes[2:] << 42, return_counts=True)


def _counts(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of some texts and the matrix of counts, texts by n-grams."""
    each = [grams_of(t) for t in texts]
    every = np.unique(np.concatenate([g for g, _ in each])) if each else np.empty(0, np.int64)
    table = np.zeros((len(texts), len(every)), np.float32)
    for i, (g, c) in enumerate(each):
        table[i, np.searchsorted(every, g)] = c
    return every, table


def _bundles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bundle of each language over a task's texts, as one row per language and dimension."""
    grams, sums = Grams(), {}
    for batch in batches:
        for start in range(0, len(batch), CHUNK):
            part = batch.iloc[start : start + CHUNK]
            every, table = _counts(list(part["text"]))
            # Every text counts alike, however long.
            table /= np.maximum(table.sum(axis=1, keepdims=True), 1)
            langs = part["lang"].to_numpy()
            names = sorted(set(langs))
            if len(every):
                totals = np.stack([table[langs == x].sum(axis=0, dtype=np.float64) for x in names])
                bundle = np.rint((totals.astype(np.float32) @ grams.get(every).astype(np.float32)) * 1e6)
                for x, v in zip(names, bundle, strict=True):
                    sums[x] = sums.get(x, 0) + v.astype(np.int64)
    for x, v in sums.items():
        yield pd.DataFrame({"lang": x, "dim": np.arange(DIM, dtype=np.int32), "value": v})


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Language names in order and one vector each, from the rows with a language.

    A task sends one whole number per language and dimension, so sums do not depend on order.
    """
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    sums = rows.mapInPandas(_bundles, "lang string, dim int, value long").groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    found = sums.limit(DIM * MOST_LANGUAGES + 1).toPandas()
    if len(found) > DIM * MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names = sorted(set(found["lang"]))
    vectors = np.zeros((len(names), DIM))
    vectors[[names.index(x) for x in found["lang"]], found["dim"].to_numpy(int)] = found["value"]
    return names, vectors


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)


def _predictor(names: list[str], vectors: np.ndarray):
    plain = _unit(vectors.astype(np.float32))
    mean = plain.mean(axis=0) if len(names) > 1 else np.zeros(DIM, np.float32)
    centred = _unit(plain - mean)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams = Grams()
        for batch in batches:
            tags, scores = [], []
            for start in range(0, len(batch), CHUNK):
                every, table = _counts(list(batch["text"].iloc[start : start + CHUNK]))
                some = table.any(axis=1)
                if not len(every) or not names:
                    tags += [UNKNOWN] * len(table)
                    scores += [0.0] * len(table)
                    continue
                own = _unit(table @ grams.get(every).astype(np.float32))
                cosine = _unit(own - mean) @ centred.T
                best = cosine.argmax(axis=1)
                tags += [names[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
                scores += [(1 + float(c)) / 2 if s else 0.0 for c, s in zip(cosine.max(axis=1), some, strict=True)]
            out = pd.DataFrame({"held_out": batch["held_out"], "lang_pred": tags, "score": np.clip(scores, 0.0, 1.0)})
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return predict


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row.

    Learned from the rows that are not held out and name a language. The score is (1 + cosine) / 2.
    A text that is null, empty or without a letter gets ``und`` and score 0, and so does every
    text if nothing could be learned. Ties go to the first name; repeated rows are all judged,
    and learned from; other columns are not used.
    """
    held = fold("doc_id", FOLDS) == HELD_OUT
    names, vectors = learn(docs.where(~held))
    rows = keyed(docs.withColumn("held_out", held), "held_out", "text")
    tagged = rows.mapInPandas(_predictor(names, vectors), "doc_id string, held_out boolean, lang_pred string, score double")
    return tagged.withColumn("doc_id", F.col("doc_id").cast("long"))
