"""Toxicity: Levenshtein automata intersected with a lexicon trie, scored in their context.

The lexicon is learned: words, and stems (first letters of words), that labelled toxic texts have
far more often than clean ones, chosen one after another by how many toxic texts they newly
explain. The trie of the lexicon and the Levenshtein automaton of every term are walked
together; the states of the product are made when a text first needs them, so a word costs one
table look-up per letter. Hits are weighed by the words around them: one between quotation marks
counts apart from one addressed to somebody, and the densest window counts as well. A logistic
model over these few numbers gives the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.llm.common import fold, keyed

FOLDS, HELD_OUT = 5, 0
#: Labelled texts of each class that the model is fitted on, at most: smallest hash of the id.
SAMPLE = 20_000
#: Terms of toxic texts that are looked up in clean ones, terms of a lexicon, and forms set
#: aside, at most. They travel to every task.
MOST_CANDIDATES, MOST_TERMS, MOST_FORMS = 50_000, 2_000, 10_000
#: Lengths of stems and words; a term must be this many times likelier in toxic texts and newly
#: explain so many of them, each counted until ``COVER`` terms explain it.
STEM, LONGEST, RATIO, LEAST, COVER = range(4, 10), 32, 4.0, 3, 3
#: Edits allowed in a word of at least this many letters; none in stems.
EDITS = ((9, 2), (4, 1))
#: A misspelt hit counts less for each edit.
EDIT_DISCOUNT = 0.7
#: Words around a hit that are looked at for quotation marks, and width of the density window.
CONTEXT, WINDOW = 8, 12

# What stands between words, and quotation marks.
_TOKEN = re.compile(r"[\"“”„«»]|[^\s.,;:!?\"“”„«»()\[\]{}|…]+")
_QUOTES = frozenset("\"“”„«»")
FEATURES = ("abuse", "quoted", "dense", "share", "strongest")


class Term(NamedTuple):
    """A word or stem; ``weight`` is the logarithm of how many times likelier toxic texts have it."""

    text: str
    stem: bool
    weight: float


def edits(length: int) -> int:
    return next((k for least, k in EDITS if length >= least), 0)


class Lexicon:
    """Trie of terms and the product with their automata, built as words come in."""

    STATES = 50_000

    def __init__(self, terms: list[Term]):
        self.child: list[dict[str, int]] = [{}]
        self.end: list[list[Term]] = [[]]
        #: Most edits any term below a node allows.
        self.most = [0]
        for term in terms:
            allowed = 0 if term.stem else edits(len(term.text))
            node = 0
            self.most[0] = max(self.most[0], allowed)
            for c in term.text:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.end.append([])
                    self.most.append(0)
                node = self.child[node][c]
                self.most[node] = max(self.most[node], allowed)
            self.end[node].append(term)
        self.letters = {c for d in self.child for c in d}
        self.reset()

    def reset(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.step: list[dict[str, int]] = []
        self.last: list[tuple[float, bool]] = []
        self.stem: list[float] = []
        self.words: dict[str, tuple[float, bool]] = {}
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """Close under deletions (a letter of the term is missing) and number the state."""
        todo = list(pairs)
        while todo:
            node, e = todo.pop()
            for nxt in self.child[node].values():
                if e < self.most[nxt] and (nxt, e + 1) not in pairs:
                    pairs.add((nxt, e + 1))
                    todo.append((nxt, e + 1))
        least: dict[int, int] = {}
        for node, e in pairs:
            least[node] = min(e, least.get(node, e))
        key = frozenset(least.items())
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.step.append({})
            words = [
                (t.weight * EDIT_DISCOUNT**e, e > 0)
                for node, e in key
                for t in self.end[node]
                if not t.stem and e <= edits(len(t.text))
            ]
            self.last.append(max(words, default=(0.0, False)))
            self.stem.append(max((t.weight for node, e in key if e == 0 for t in self.end[node] if t.stem), default=0.0))
        return self.number[key]

    def _next(self, state: int, c: str) -> int:
        c = c if c in self.letters else "\0"
        found = self.step[state].get(c)
        if found is None:
            pairs: set[tuple[int, int]] = set()
            for node, e in self.states[state]:
                for letter, nxt in self.child[node].items():
                    if letter == c:
                        pairs.add((nxt, e))
                    elif e < self.most[nxt]:
                        pairs.add((nxt, e + 1))
                if e < self.most[node]:
                    pairs.add((node, e + 1))
            found = self.step[state][c] = self._state(pairs)
        return found

    def hit(self, word: str) -> tuple[float, bool]:
        """Weight of the best term that the word matches (0: none), and whether it is misspelt."""
        known = self.words.get(word)
        if known is None:
            if len(self.states) > self.STATES or len(self.words) > self.STATES * 4:
                self.reset()
            state, stem, whole = self.start, 0.0, (0.0, False)
            for c in word[:LONGEST]:
                state = self._next(state, c)
                stem = max(stem, self.stem[state])
                if not self.states[state]:
                    break
            else:
                if len(word) <= LONGEST:
                    whole = self.last[state]
            known = self.words[word] = max(whole, (stem, False))
        return known


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if isinstance(text, str) else []


def features(text: str | None, lexicon: Lexicon, spared: frozenset[str]) -> tuple[float, ...]:
    """Weighed hits outside and inside quotation, in the densest window, per word; the strongest."""
    found = tokens(text)
    hits: list[tuple[int, float]] = []
    for i, w in enumerate(found):
        weight, misspelt = lexicon.hit(w)
        if weight and not (misspelt and w in spared):
            hits.append((i, weight))
    if not hits:
        return 0.0, 0.0, 0.0, 0.0, 0.0
    abuse = quoted = 0.0
    for i, weight in hits:
        before = sum(w in _QUOTES for w in found[max(0, i - CONTEXT) : i])
        after = sum(w in _QUOTES for w in found[i + 1 : i + 1 + CONTEXT])
        if before % 2 and after:
            quoted += weight
        else:
            abuse += weight
    at = np.array([i for i, _ in hits])
    total = np.cumsum([0.0] + [w for _, w in hits])
    dense = float(np.max(total[np.searchsorted(at, at + WINDOW)] - total[:-1]))
    strongest = max(w for _, w in hits)
    return float(np.log1p(abuse)), float(np.log1p(quoted)), float(np.log1p(dense)), float(total[-1] / len(found)), strongest


def _terms(text: str | None) -> set[str]:
    out = set()
    for w in set(tokens(text)):
        if STEM[0] <= len(w) <= LONGEST:
            out.add("w" + w)
            out.update("s" + w[:k] for k in STEM if k < len(w))
    return out


def _term_counts(wanted: frozenset[str] | None):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch["text"]:
                found = _terms(text)
                seen.update(found if wanted is None else found & wanted)
            if seen:  # an empty column has no type
                yield pd.DataFrame({"term": list(seen), "n": list(seen.values())})

    return count


def _incidence(numbers: dict[str, int]):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"terms": [sorted(numbers[t] for t in _terms(x) if t in numbers) for x in batch["text"]]})

    return find


def _forms(lexicon_terms: list[Term]):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(lexicon_terms)
        for batch in batches:
            seen = Counter(w for text in batch["text"] for w in set(tokens(text)) if lexicon.hit(w)[1])
            if seen:  # an empty column has no type
                yield pd.DataFrame({"term": list(seen), "n": list(seen.values())})

    return find


def choose_terms(candidates: list[tuple[str, float]], docs: list[list[int]], toxic: int) -> list[Term]:
    """Greedy cover: the term that explains most toxic texts not yet explained ``COVER`` times.

    ``candidates`` are (term, weight); what a term explains counts by its weight, and ties go to
    the first in order. Words that merely come along in copies of one toxic text explain nothing new.
    """
    need = np.full(len(docs), COVER)
    where: list[list[int]] = [[] for _ in candidates]
    for d, terms in enumerate(docs):
        for t in terms:
            where[t].append(d)
    least = max(LEAST, toxic // 1000)
    rows = {t: np.array(w, int) for t, w in enumerate(where) if len(w) >= least}
    gain = {t: len(w) for t, w in rows.items()}
    chosen: list[Term] = []
    while gain and len(chosen) < MOST_TERMS:
        # A stem must explain notably more than its best whole word.
        t = max(gain, key=lambda k: (gain[k] * candidates[k][1] * (1.0 if candidates[k][0][0] == "w" else 0.8), -k))
        now = int(np.count_nonzero(need[rows[t]] > 0))
        if now < gain[t]:
            gain[t] = now
            if now < least:
                del gain[t]
            continue
        need[rows[t]] -= 1
        del gain[t]
        chosen.append(Term(candidates[t][0][1:], candidates[t][0][0] == "s", candidates[t][1]))
    return chosen


class Model(NamedTuple):
    terms: list[Term]
    spared: frozenset[str]
    weights: np.ndarray
    bias: float


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Newton steps on the penalised likelihood; a row stands for ``weight`` rows, or for itself."""
    c = np.ones(len(x)) if weight is None else weight
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    ridge = np.diag([penalty] * x.shape[1] + [1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (c * p * (1 - p))[:, None]) + ridge, a.T @ (c * (y - p)) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.max(np.abs(step)) < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    """Learn lexicon and weights from labelled rows that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT))

    each = known.select(F.col("toxic").cast("int").alias("toxic"), "doc_id").distinct()
    total = {r["toxic"]: r["count"] for r in each.groupBy("toxic").count().where("toxic IN (0, 1)").collect()}

    def sample(toxic: int) -> DataFrame:
        one = each.where(F.col("toxic") == toxic).select("doc_id")
        ids = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        return docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text")

    bad, good = sample(1), sample(0)
    n_bad, n_good = bad.count(), good.count()
    if not n_bad or not n_good:
        return Model([], frozenset(), np.zeros(len(FEATURES)), 10.0 if n_bad else -10.0)
    counts = bad.mapInPandas(_term_counts(None), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    often = counts.where(F.col("n") >= max(LEAST, n_bad // 1000)).orderBy(F.desc("n"), "term").limit(MOST_CANDIDATES)
    toxic = {r["term"]: r["n"] for r in often.toLocalIterator()}
    other = good.mapInPandas(_term_counts(frozenset(toxic)), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    clean = {r["term"]: r["n"] for r in other.toLocalIterator()}
    times = {t: (a / n_bad) / ((clean.get(t, 0) + 0.5) / (n_good + 1)) for t, a in sorted(toxic.items())}
    likely = [(t, float(np.log(x))) for t, x in times.items() if x >= RATIO]
    numbers = {t: i for i, (t, _) in enumerate(likely)}
    # At most ``bound`` short lists of term numbers.
    has = [r["terms"] for r in bad.mapInPandas(_incidence(numbers), "terms array<int>").toLocalIterator()]
    terms = choose_terms(likely, has, n_bad)
    forms = good.mapInPandas(_forms(terms), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    spared = frozenset(r["term"] for r in forms.orderBy(F.desc("n"), "term").limit(MOST_FORMS).collect())
    rows = [
        scored.toPandas().to_numpy(float)
        for scored in (x.mapInPandas(_featurise(terms, spared), ", ".join(f"{c} double" for c in FEATURES)) for x in (bad, good))
    ]
    y = np.concatenate([np.ones(len(rows[0])), np.zeros(len(rows[1]))])
    # Classes above the bound are thinned out: their rows stand for those left out, lest the prior
    # drift with the size of the table. The weights sum to the number of rows.
    weight = np.where(y == 1, max(1.0, total[1] / bound), max(1.0, total[0] / bound))
    weights, bias = fit_logistic(np.vstack(rows), y, weight=weight * len(y) / weight.sum())
    return Model(terms, spared, weights, bias)


def _featurise(terms: list[Term], spared: frozenset[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(terms)
        for batch in batches:
            yield pd.DataFrame([features(t, lexicon, spared) for t in batch["text"]], columns=FEATURES, dtype=float)

    return run


def _scorer(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(model.terms)
        for batch in batches:
            x = np.array([features(t, lexicon, model.spared) for t in batch["text"]], float).reshape(-1, len(FEATURES))
            score = 1 / (1 + np.exp(-np.clip(x @ model.weights + model.bias, -30, 30)))
            yield batch.assign(score=score, predicted=(score >= 0.5).astype(np.int32)).drop(columns="text")

    return run


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` that the model does not predict toxic; only the text leaves the JVM."""

    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = Lexicon(model.terms)
        for batch in batches:
            x = np.array([features(t, lexicon, model.spared) for t in batch], float).reshape(-1, len(FEATURES))
            yield pd.Series(x @ model.weights + model.bias < 0)

    return docs.where(F.pandas_udf(clean, "boolean")("text"))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Null and empty texts have no hits and get the score of such texts. If only one class is
    labelled, every row gets that class; if none, class 0. Labels of one document are counted
    once per class; a null id is scored, never learned from; repeated rows are all scored; other
    columns are not used.
    """
    model = fit(docs, labels)
    rows = keyed(docs.withColumn("held_out", fold("doc_id", FOLDS) == HELD_OUT), "held_out", "text")
    scored = rows.mapInPandas(_scorer(model), "doc_id string, held_out boolean, score double, predicted int")
    return scored.withColumn("doc_id", F.col("doc_id").cast("long"))
