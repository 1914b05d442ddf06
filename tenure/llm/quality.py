"""Quality rules: a decision list learned by sequential covering, run as Spark conditions.

Rules are conjunctions of thresholds on text statistics. A rule is grown on one part of the
labelled rows, one condition at a time by information gain, pruned on the other part, and kept
while it is right more often than not there; the rows it covers are then set aside. The ordered
rules become one chain of ``when`` conditions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.llm.common import keyed
from tenure.operators.staging import staged

# The base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
_BLANKS = " \t\n\x0b\x0c\r"

#: Labelled rows the list is learned from, at most: those with the smallest hash of their id.
TRAIN_ROWS = 20_000
#: Thresholds tried per statistic, rules per list, conditions per rule, rows a rule must cover.
THRESHOLDS, MOST_RULES, MOST_CONDITIONS, LEAST_COVER = 48, 12, 4, 5
#: A rule must be right in this share of the rows that it covers in the pruning part.
LEAST_PRECISION = 0.8

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "mark_share", "variety")
FEATURES = ("n_words", *RATIOS)
STATS_SCHEMA = "doc_id string, " + ", ".join(f"{c} long" for c in BASE) + ", " + ", ".join(f"{c} double" for c in RATIOS)


def repeated_words(ids: np.ndarray, distinct: int, width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more; ``ids`` number the words.

    Windows are compared exactly: the key takes one word more at a time and is ranked anew
    before it could leave 63 bits.
    """
    n = len(ids)
    if n <= width:
        return 0
    key, span = ids.astype(np.int64), max(distinct, 1)
    for k in range(1, width):
        if span * distinct >= 1 << 62:
            key, span = np.unique(key, return_inverse=True)[1].astype(np.int64), len(key)
        key, span = key[:-1] * distinct + ids[k:], span * distinct
    order = np.argsort(key)
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    edge = np.zeros(n + 1, np.int32)
    starts = np.flatnonzero(twice)
    edge[starts] += 1
    edge[starts + width] -= 1
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def text_stats(text: str) -> tuple:
    """The base counts and the ratios of one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    word_chars = len(text) - sum(text.count(c) for c in _BLANKS)
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set[str] = set()
    lines = repeats = 0
    for line in text.split("\n"):
        if line.strip(_BLANKS):
            lines += 1
            if line in seen:
                repeats += 1
            seen.add(line)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    again = repeated_words(ids, len(number))
    codes = np.frombuffer(raw, np.uint8)
    upper = int(np.count_nonzero((codes >= 65) & (codes <= 90)))
    digits = int(np.count_nonzero((codes >= 48) & (codes <= 57)))
    letters = int(np.count_nonzero((codes | 32) - 97 < 26)) + int(np.count_nonzero(codes >= 192))
    marks = word_chars - letters - digits
    chars, some = max(word_chars, 1), max(n, 1)
    return (
        n, word_chars, symbols, repeats, again,
        word_chars / some, symbols / some, repeats / max(lines, 1), again / some,
        upper / chars, digits / chars, marks / chars, len(number) / some,
    )


def _stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [text_stats(t) if isinstance(t, str) else text_stats("") for t in batch["text"]]
        out = pd.DataFrame(rows, columns=[*BASE, *RATIOS])
        out.insert(0, "doc_id", batch["doc_id"].to_numpy())
        yield out


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and the ratios of every whole text; null counts as empty."""
    stats = keyed(docs, "text").mapInPandas(_stats, STATS_SCHEMA)
    return stats.withColumn("doc_id", F.col("doc_id").cast("long"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")
    )


class Condition(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def holds(self, rows: pd.DataFrame) -> np.ndarray:
        v = rows[self.feature].to_numpy(float)
        return v > self.threshold if self.above else v <= self.threshold

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def _covered(rule: Rule, rows: pd.DataFrame) -> np.ndarray:
    return reduce(np.logical_and, (c.holds(rows) for c in rule), np.ones(len(rows), bool))


def _grow(rows: pd.DataFrame, bad: np.ndarray) -> Rule:
    """Add the condition with the largest information gain until no good row is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(rows), bool)
    while len(rule) < MOST_CONDITIONS and np.any(inside & ~bad):
        p, n = int(np.sum(inside & bad)), int(np.sum(inside & ~bad))
        found, most = None, 1e-9
        for feature in FEATURES:
            v = rows[feature].to_numpy(float)
            cuts = np.unique(np.quantile(v[inside], np.linspace(0, 1, THRESHOLDS + 1)[:-1], method="lower"))
            for cut in cuts:
                high = v > cut
                p1, n1 = int(np.sum(inside & bad & high)), int(np.sum(inside & ~bad & high))
                for above, p2, n2 in ((True, p1, n1), (False, p - p1, n - n1)):
                    if p2 < LEAST_COVER:
                        continue
                    gain = p2 * (np.log2(p2 / (p2 + n2)) - np.log2(p / (p + n)))
                    if gain > most:
                        found, most = Condition(feature, above, float(cut)), gain
        if found is None:
            break
        # Halfway to the next value seen, so that the rule does not hang on one row.
        v = rows[found.feature].to_numpy(float)[inside]
        upper = v[v > found.threshold]
        if len(upper):
            found = found._replace(threshold=float((found.threshold + upper.min()) / 2))
        rule.append(found)
        inside &= found.holds(rows)
    return tuple(rule)


def _prune(rule: Rule, rows: pd.DataFrame, bad: np.ndarray) -> Rule:
    """Drop trailing conditions while that does not lower (p - n) / (p + n)."""

    def worth(r: Rule) -> float:
        inside = _covered(r, rows)
        p, n = np.sum(inside & bad), np.sum(inside & ~bad)
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def learn(rows: pd.DataFrame) -> list[Rule]:
    """Ordered rules for low quality; needs the features, doc_id and quality (0 or 1).

    Every third row in the order given prunes. No rule is learned from one class alone.
    """
    bad = rows["quality"].to_numpy() == 0
    held = np.arange(len(rows)) % 3 == 2
    left = np.ones(len(rows), bool)
    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        a, b = left & ~held, left & held
        if np.sum(bad & a) < LEAST_COVER or not np.any(~bad):
            break
        rule = _grow(rows[a], bad[a])
        if not rule:
            break
        rule = _prune(rule, rows[b], bad[b])
        inside = _covered(rule, rows)
        hit = inside & b
        right = np.sum(hit & bad) + np.sum(inside & a & bad)
        every = np.sum(hit) + np.sum(inside & a)
        if every == 0 or right / every < LEAST_PRECISION or (np.any(hit) and np.sum(hit & bad) / np.sum(hit) < LEAST_PRECISION):
            break
        rules.append(rule)
        left &= ~inside
    return rules


def verdict(rules: list[Rule]) -> Column:
    """False where a rule fires, in order; true where none does."""
    chain = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        chain = chain.when(reduce(Column.__and__, (c.column() for c in rule)), F.lit(False))
    return chain.otherwise(F.lit(True))


def training_rows(stats: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> pd.DataFrame:
    """Labelled rows that pass the base rules, at most ``bound``, by the hash of their id."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.col("quality").cast("int").alias("quality"))
    joined = stats.where(~base_failed()).join(known, "doc_id").select("doc_id", *FEATURES, "quality")
    return joined.orderBy(F.xxhash64("doc_id"), *joined.columns).limit(bound).toPandas()


def quality_rules(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[Rule]]:
    """Per row: doc_id, n_words, the base counts, base_failed, kept; and the rules behind ``kept``.

    Null and empty texts have no words and fail the base rules. Without labels of both classes
    the base rules decide alone. Repeated rows and repeated labels count each time; a null id is
    judged but never learned from; other columns are not used.
    """
    stats = staged(document_stats(docs), "quality_stats")
    rules = learn(training_rows(stats, labels))
    judged = stats.select("doc_id", *BASE, base_failed().alias("base_failed"), verdict(rules).alias("_good"))
    return judged.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & F.col("_good")).alias("kept")), rules
