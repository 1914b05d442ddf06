"""SentencePiece encoding by batched Viterbi or batched merges, and decoding.

The vocabulary comes from a model file, whose path is a parameter; the driver reads it and the
tasks get its pieces. A piece has its blank mark only at its front, so a text is cut in front of
each run of marks and every distinct word is segmented once. Words of one length advance
together: hashes of all their substrings are looked up in the sorted hashes of the pieces of
that length, and one maximum per position over all words gives the back pointers. The
segmentation has the largest sum of piece scores; among equal sums the longer last piece wins.
That is the segmentation of a unigram model. The scores of a BPE model are the ranks of its merges:
there the same batches of words of one length are merged, in every word the neighbours of the
highest rank first, the left ones among equals.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: What an unknown letter costs below the lowest score.
UNKNOWN_PENALTY = 10.0
#: Texts segmented together, words remembered, and table cells per Viterbi step.
CHUNK, KEPT, CELLS = 512, 300_000, 1 << 20
#: Longer words are merged one by one.
LONG = 512

_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary(NamedTuple):
    """Piece texts by id, their scores (nan: never chosen), and the id of each byte."""

    pieces: list[str]
    scores: list[float]
    byte_ids: list[int]
    unknown: int
    #: Are the scores the ranks of merges?
    merges: bool = False


def read_vocabulary(path: str) -> Vocabulary:
    """Pieces, scores and byte pieces of a SentencePiece model file."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    special = [model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i) for i in ids]
    pieces = [model.id_to_piece(i) for i in ids]
    scores = [float("nan") if s else model.get_score(i) for i, s in zip(ids, special, strict=True)]
    bytes_ = {int(p[3:5], 16): i for i, p in enumerate(pieces) if model.is_byte(i)}
    kind = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto()).trainer_spec
    return Vocabulary(pieces, scores, [bytes_.get(b, -1) for b in range(256)], model.unk_id(), kind.model_type == kind.BPE)


class Segmenter:
    """Best segmentations of many words at once."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        usable = [(p, i, s) for i, (p, s) in enumerate(zip(vocabulary.pieces, vocabulary.scores, strict=True)) if s == s and p]
        self.longest = max((len(p) for p, _, _ in usable), default=1)
        self.unknown_score = min((s for _, _, s in usable), default=0.0) - UNKNOWN_PENALTY
        self.power = np.array([pow(int(_BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        self.tables = []
        for m in range(1, self.longest + 1):
            same = [x for x in usable if len(x[0]) == m]
            codes = self._codes([p for p, _, _ in same], m)
            keys = self._prefix(codes)[:, -1] if same else np.empty(0, np.uint64)
            order = np.argsort(keys)
            self.tables.append((keys[order], np.array([i for _, i, _ in same], np.int32)[order], np.array([s for _, _, s in same])[order]))
        self.reset()

    def reset(self) -> None:
        """Forget all words. Their ids lie one after another in ``flat``."""
        self.number: dict[str | None, int] = {}
        self.flat = np.empty(1 << 16, np.int32)
        self.starts = np.zeros(1 << 14, np.int64)

    @staticmethod
    def _codes(words: list[str], length: int) -> np.ndarray:
        raw = "".join(words).encode("utf-32-le", "surrogatepass")
        return np.frombuffer(raw, np.uint32).reshape(len(words), length).astype(np.uint64)

    @staticmethod
    def _prefix(codes: np.ndarray) -> np.ndarray:
        """Hashes of all prefixes; one more letter: hash * base + code + 1, in 64 bits."""
        out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
        for k in range(codes.shape[1]):
            out[:, k + 1] = out[:, k] * _BASE + codes[:, k] + np.uint64(1)
        return out

    def _same_length(self, words: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order of the words, and how many each word has."""
        n, most = len(words), min(self.longest, length)
        codes = self._codes(words, length)
        prefix = self._prefix(codes)
        score = np.full((n, length, most), -np.inf)
        piece = np.zeros((n, length, most), np.int32)
        for m in range(1, most + 1):
            keys, ids, values = self.tables[m - 1]
            if not len(keys):
                continue
            h = prefix[:, m:] - prefix[:, :-m] * self.power[m]
            place = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[place] == h
            # Longer pieces stand first, so that the first maximum is the longest.
            score[:, m - 1 :, most - m] = np.where(hit, values[place], -np.inf)
            piece[:, m - 1 :, most - m] = ids[place]
        lone = np.isinf(score[:, :, most - 1])
        score[:, :, most - 1][lone] = self.unknown_score
        piece[:, :, most - 1][lone] = -1 - codes[lone].astype(np.int32)
        best = np.zeros((n, length + 1))
        back = np.zeros((n, length + 1), np.int32)
        rows = np.arange(n)
        for e in range(1, length + 1):
            k = min(most, e)
            reach = best[:, e - k : e] + score[:, e - 1, most - k :]
            at = reach.argmax(axis=1)
            best[:, e] = reach[rows, at]
            back[:, e] = k - at
        cut = np.zeros((n, length + 1), bool)
        end = np.full(n, length)
        live = rows
        while len(live):
            cut[live, end[live]] = True
            end[live] -= back[live, end[live]]
            live = live[end[live] > 0]
        row, stop = np.nonzero(cut)
        return self._bytes(piece[row, stop - 1, most - back[row, stop]], np.bincount(row, minlength=n))

    def _bytes(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown letters as the pieces of their UTF-8 bytes, or as the unknown piece."""
        if not (ids < 0).any():
            return ids, counts
        size = np.ones(len(ids), np.int64)
        spelt: dict[int, list[int]] = {}
        for i in np.unique(ids[ids < 0]).tolist():
            raw = [self.vocabulary.byte_ids[b] for b in chr(-1 - i).encode("utf-8", "surrogatepass")]
            spelt[i] = raw if min(raw) >= 0 else [self.vocabulary.unknown]
            size[ids == i] = len(spelt[i])
        start = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.int32)
        out[start[ids >= 0]] = ids[ids >= 0]
        for i, raw in spelt.items():
            for k, b in enumerate(raw):
                out[start[ids == i] + k] = b
        word = np.repeat(np.arange(len(counts)), counts)
        return out, np.bincount(word, size, len(counts)).astype(np.int64)

    def _keep(self, words: list, ids: np.ndarray, counts: np.ndarray) -> None:
        n, start = len(self.number), int(self.starts[len(self.number)])
        while start + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while n + len(words) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[start : start + len(ids)] = ids
        self.starts[n + 1 : n + 1 + len(words)] = start + np.cumsum(counts)
        self.number.update(zip(words, range(n, n + len(words)), strict=True))

    def learn(self, words: list[str]) -> None:
        """Segment the words not yet known."""
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for length, same in by_length.items():
            step = max(1, CELLS // (length * min(self.longest, length)))
            for start in range(0, len(same), step):
                part = same[start : start + step]
                self._keep(part, *self._same_length(part, length))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Piece ids per text; null gives none."""
        if len(self.number) > KEPT:
            self.reset()
        parts: list[list[str | None]] = []
        for text in texts:
            words: list[str | None] = []
            for k, part in enumerate(text.split(MARK) if text else ()):
                if k:
                    words.append(None)  # a mark in the text itself
                # A blank goes in front of the text, as SentencePiece does.
                words += _WORDS.findall(("" if k else MARK) + part.replace(" ", MARK))
            parts.append(words)
        new = {w for words in parts for w in words} - self.number.keys()
        if None in new:
            new.discard(None)
            self._keep([None], *self._bytes(np.array([-1 - ord(MARK)], np.int32), np.ones(1, np.int64)))
        self.learn(list(new))
        at = np.array([self.number[w] for words in parts for w in words], np.int64)
        first, count = self.starts[at], self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(first - ends + count, count)]
        edges = np.concatenate([[0], ends])[np.cumsum([len(words) for words in parts])[:-1]]
        return np.split(ids, edges) if parts else []


class Merger(Segmenter):
    """Segmentations of a BPE model: neighbours are merged by rank."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary)
        self.usable = {p: (i, s) for i, (p, s) in enumerate(zip(vocabulary.pieces, vocabulary.scores, strict=True)) if s == s and p}
        keys = [k + self._salt(m) for m, (k, _, _) in enumerate(self.tables, 1)]
        keys, ids, scores = (np.concatenate(x) for x in (keys, [i for _, i, _ in self.tables], [v for _, _, v in self.tables]))
        order = np.argsort(keys)
        self.table = keys[order], ids[order], scores[order]

    @staticmethod
    def _salt(length) -> np.ndarray:
        """Keeps pieces of different lengths apart in one table."""
        return np.asarray(length, np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)

    def _found(self, prefix: np.ndarray, rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id and score of the piece from start to end, -1 and -inf where there is none."""
        size = end - start
        short = np.minimum(size, self.longest)
        h = prefix[rows, end] - prefix[rows, start] * self.power[short] + self._salt(size)
        keys, ids, scores = self.table
        place = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        hit = (keys[place] == h) & (size <= self.longest)
        return np.where(hit, ids[place], -1), np.where(hit, scores[place], -np.inf)

    def _same_length(self, words: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(words)
        codes = self._codes(words, length)
        if length > LONG:
            found = [self._by_heap(w, c) for w, c in zip(words, codes.tolist(), strict=True)]
            return self._bytes(np.concatenate(found), np.array([len(x) for x in found]))
        prefix = self._prefix(codes)
        # Of the part that starts at a letter: where it ends, where the one before it starts, and
        # the rank of its merge with the next one. There is no part before 0, nor after the end.
        end = np.tile(np.arange(1, length + 1), (n, 1))
        before = np.tile(np.arange(-1, length), (n, 1))
        rank = np.full((n, length), -np.inf)
        row = np.repeat(np.arange(n), length - 1)
        at = np.tile(np.arange(length - 1), n)
        rank[:, : length - 1] = self._found(prefix, row, at, at + 2)[1].reshape(n, length - 1)
        part = np.ones((n, length), bool)
        live = np.arange(n)
        while len(live):
            at = rank[live].argmax(axis=1)
            more = rank[live, at] > -np.inf
            live, at = live[more], at[more]
            gone = end[live, at]
            end[live, at] = stop = end[live, gone]
            before[live, stop] = at
            part[live, gone] = False
            rank[live, gone] = rank[live, at] = -np.inf
            on = stop < length
            r, a, e = live[on], at[on], stop[on]
            rank[r, a] = self._found(prefix, r, a, end[r, e])[1]
            on = at > 0
            r, a = live[on], before[live[on], at[on]]
            rank[r, a] = self._found(prefix, r, a, stop[on])[1]
        row, start = np.nonzero(part)
        ids = self._found(prefix, row, start, end[row, start])[0].astype(np.int32)
        ids = np.where(ids < 0, -1 - codes[row, start].astype(np.int32), ids)
        return self._bytes(ids, np.bincount(row, minlength=n))

    def _by_heap(self, word: str, codes: list[int]) -> np.ndarray:
        """The same for one long word, in a time that does not grow with the square of its length."""
        n, end, before = len(word), list(range(1, len(word) + 1)), list(range(-1, len(word)))
        heap: list[tuple[float, int, int, int]] = []

        def offer(start: int, middle: int, stop: int) -> None:
            found = self.usable.get(word[start:stop]) if stop - start <= self.longest else None
            if found:
                heapq.heappush(heap, (-found[1], start, middle, stop))

        for k in range(n - 1):
            offer(k, k + 1, k + 2)
        while heap:
            _, start, middle, stop = heapq.heappop(heap)
            # An offer is void once one of its parts was merged otherwise.
            if end[start] != middle or end[middle] != stop:
                continue
            end[start], end[middle], before[stop] = stop, -1, start
            if stop < n:
                offer(start, stop, end[stop])
            if start:
                offer(before[start], start, stop)
        out, at = [], 0
        while at < n:
            found = self.usable.get(word[at : end[at]])
            out.append(found[0] if found else -1 - codes[at])
            at = end[at]
        return np.array(out, np.int32)


def _encoder(vocabulary: Vocabulary, text: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segmenter = (Merger if vocabulary.merges else Segmenter)(vocabulary)
        for batch in batches:
            for start in range(0, len(batch), CHUNK):
                part = batch.iloc[start : start + CHUNK]
                ids = segmenter.encode([t if isinstance(t, str) else None for t in part[text]])
                yield part.drop(columns=text).assign(ids=ids)

    return run


def _decoder(vocabulary: Vocabulary, ids: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = [p.replace(MARK, " ").encode("utf-8") for p in vocabulary.pieces]
        for b, i in enumerate(vocabulary.byte_ids):
            if i >= 0:
                table[i] = bytes([b])
        for batch in batches:
            for start in range(0, len(batch), CHUNK):
                part = batch.iloc[start : start + CHUNK]
                texts = [b"".join([table[i] for i in row.tolist()])[1:].decode("utf-8", "replace") for row in part[ids]]
                yield part.assign(decoded=texts)

    return run


def _ddl(df: DataFrame, drop: tuple[str, ...] = ()) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.dtypes if c not in drop)


def encode(df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Replace ``text`` by ``ids array<int>``; null and empty texts have none.

    Letters outside the vocabulary become their UTF-8 bytes, and so does a blank mark in the text
    itself, which keeps decoding exact. Other columns stay; one named ``ids`` is replaced.
    """
    rows = df.drop("ids") if "ids" != text else df
    return rows.mapInPandas(_encoder(read_vocabulary(model), text), f"{_ddl(rows, (text,))}, ids array<int>".lstrip(", "))


def decode(df: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of ``ids``; an existing column of that name is replaced."""
    rows = df.drop("decoded")
    return rows.mapInPandas(_decoder(read_vocabulary(model), ids), f"{_ddl(rows)}, decoded string")


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_chars, n_tokens, ids, decoded_sha256, round_trip for every row.

    A null text counts as the empty one; repeated rows are all encoded; an empty table gives an
    empty result; other columns are not used.
    """
    body = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.length(body).cast("long").alias("n_chars"), F.sha2(body, 256).alias("sha"), body.alias("text"))
    back = decode(encode(rows, model), model)
    return back.select(
        "doc_id",
        "n_chars",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.sha2("decoded", 256) == F.col("sha")).alias("round_trip"),
    )
