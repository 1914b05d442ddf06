"""Alignment of two tokenizers: which of their tokens cover the same bytes, and how often.

Tasks encode whole texts by both vocabularies and align the tokens by byte offsets. Each text
leaves a digest and its records (second id, first id, links). Records of a block of texts are
pre-aggregated, split by a radix of the second id and written as sorted runs, compressed with
zstd: the pairs with their sums, and the texts behind each pair. Counting is an external merge:
a task takes the runs of one radix, or of a slice of them where a radix is large, and merges the
pairs through a heap, so that each comes out once with its count. Slices are merged the same way.
The order puts all pairs of one second id side by side, so its highest count is known at the last
of them. The counts then go along the runs once more, and every text gets the sum of its links'
counts and the number of its links that are the best of their second id.

Null and empty texts, and texts that a vocabulary cannot write back byte by byte, have no tokens:
all numbers 0, an empty digest. Repeated rows count as often as they occur; ids may be null. The
vocabularies never join across a single space between two words, so texts are encoded by the
stretches between those, and a stretch that a task has met before costs one lookup.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.llm.packing import pack, unpack
from tenure.operators.staging import staged

#: Runs are split by this many radices, a power of two.
RADICES = 16
#: A block of texts ends at so many records.
BLOCK_RECORDS = 1 << 20
#: Packed bytes of the runs that one merging task takes.
SLICE_BYTES = 32 << 20
#: Bytes of text that a task encodes at a time, and stretches of text that it remembers.
GROUP_BYTES, KNOWN = 1 << 20, 250_000
#: Longer stretches are encoded by the library that takes time in proportion.
SHORT = 1000
# Fixed value: what the first vocabulary splits text by, before it merges.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BLANK = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>\Z")


class Stretch(NamedTuple):
    """A stretch of text in both vocabularies; None stands for one that does not come back."""

    n_a: int
    n_b: int
    n_groups: int
    #: 64-bit numbers, one per link, second id in the upper half.
    links: bytes
    groups: str


class Codec:
    """Both tokenizers of a task, the bytes of every entry, and the stretches met so far."""

    def __init__(self, first: str, second: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        level = _byte_level()
        names = self.a.get_vocab()
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(level[c] for c in name) if all(c in level for c in name) else name.encode()
        self.b_bytes = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        # The same vocabulary as ranks: five times as fast, but not on long stretches.
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        ranks = {self.a_bytes[i]: i for name, i in names.items() if name not in special}
        self.a_short = tiktoken.Encoding("first", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_text, self.b_text = list(map(str, range(len(self.a_bytes)))), list(map(str, range(len(self.b_bytes))))
        self.a_size = [len(x) for x in self.a_bytes]
        self.b_size = [len(x) for x in self.b_bytes]
        self.known: dict[str, Stretch | None] = {}
        self.former: dict[str, Stretch | None] = {}

    def learn(self, parts: list[str]) -> None:
        """Have all these stretches in ``known``; what has not been met for long is forgotten."""
        if len(self.known) > KNOWN:
            self.former, self.known = self.known, {}
        new = []
        for part in dict.fromkeys(parts):
            if part not in self.known:
                if part in self.former:
                    self.known[part] = self.former[part]
                else:
                    new.append(part)
        for part, b in zip(new, self.b.encode(new, num_threads=1)):
            self.known[part] = self._aligned(part, self.first_ids(" " + part), b)

    def first_ids(self, text: str) -> list[int]:
        if len(text) <= SHORT:
            return self.a_short.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def _aligned(self, part: str, a: list[int], b: list[int]) -> Stretch | None:
        whole = b" " + part.encode()
        if b"".join([self.a_bytes[i] for i in a]) != whole or b"".join([self.b_bytes[i] for i in b]) != whole:
            return None
        links, groups = align(a, b, self.a_size, self.b_size)
        at, bt = self.a_text, self.b_text
        shown = [
            f"{at[a[i]]}|{bt[b[k]]}" if j - i == 1 == m - k else ",".join([at[x] for x in a[i:j]]) + "|" + ",".join([bt[x] for x in b[k:m]])
            for i, j, k, m in groups
        ]
        return Stretch(len(a), len(b), len(groups), array("Q", links).tobytes(), ";".join(shown))


def _byte_level() -> dict[str, int]:
    """Characters that stand for bytes in byte-level entries: printable ones for themselves, the
    others in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


def piece_bytes(piece: str) -> bytes:
    byte = _BYTE.match(piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace(_BLANK, " ").encode()


@lru_cache(maxsize=2)
def codec(first: str, second: str) -> Codec:
    """One per worker process; reading the vocabularies takes about a second."""
    return Codec(first, second)


_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")


def align(a: list[int], b: list[int], a_size: list[int], b_size: list[int]) -> tuple[list[int], list[tuple[int, int, int, int]]]:
    """All links in order, each one number with the second id in the upper half; and the groups as slices of both."""
    links, groups = [], []
    i = j = from_i = from_j = 0
    a_end, b_end = a_size[a[0]], b_size[b[0]]
    while True:
        # The stretch up to the nearer end belongs to one token of each side.
        links.append(b[j] << 32 | a[i])
        if a_end == b_end:
            i, j = i + 1, j + 1
            groups.append((from_i, i, from_j, j))
            if i == len(a):
                return links, groups
            from_i, from_j = i, j
            a_end, b_end = a_end + a_size[a[i]], b_end + b_size[b[j]]
        elif a_end < b_end:
            i += 1
            a_end += a_size[a[i]]
        else:
            j += 1
            b_end += b_size[b[j]]


# A pair is one number: the second id in the upper half, so that order is by it first.
_SHIFT = np.uint64(32)


def radix_of(pairs: np.ndarray) -> np.ndarray:
    spread = ((pairs >> _SHIFT) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
    return (spread >> np.uint64(32 - RADICES.bit_length() + 1)).astype(np.int64)


_DIGEST = ("n_a", "n_b", "n_groups", "n_links")
_RUN = ("pairs", "sums", "texts", "places", "links")


class _Block:
    """Digests and records of the texts of one block."""

    def __init__(self, name: int):
        self.name = name
        self.ids: list = []
        self.digests: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.links: list[np.ndarray] = []
        self.records = 0

    def add(self, doc_id: object, parts: list[str], codec: Codec) -> None:
        place = len(self.ids)
        self.ids.append(doc_id)
        found = [codec.known[p] for p in parts]
        if not found or None in found:
            self.digests.append((0, 0, 0, 0, ""))
            return
        linked = np.frombuffer(b"".join([s.links for s in found]), np.uint64)
        shown = hashlib.sha256(";".join([s.groups for s in found]).encode()).hexdigest()
        sizes = (sum([s.n_a for s in found]), sum([s.n_b for s in found]), sum([s.n_groups for s in found]))
        self.digests.append((*sizes, len(linked), shown))
        pairs, links = np.unique(linked, return_counts=True)
        self.pairs.append(pairs)
        self.links.append(np.stack([np.full(len(pairs), place), links]))
        self.records += len(pairs)

    def rows(self, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        n = len(self.ids)
        yield _batch(
            n,
            id_type,
            block=[self.name] * n,
            place=range(n),
            doc_id=self.ids,
            **dict(zip((*_DIGEST, "groups_sha256"), map(list, zip(*self.digests)))),
        )
        if not self.records:
            return
        pairs, (places, links) = np.concatenate(self.pairs), np.concatenate(self.links, axis=1)
        order = np.lexsort((places, pairs))
        pairs, places, links = pairs[order], places[order], links[order]
        radix = radix_of(pairs)
        out: dict[str, list] = {c: [] for c in ("radix", *_RUN)}
        for r in np.unique(radix).tolist():
            own = radix == r
            firsts = np.flatnonzero(np.diff(pairs[own], prepend=~pairs[own][0]))
            out["radix"].append(r)
            out["pairs"].append(pack(pairs[own][firsts], ascending=True))
            out["sums"].append(pack(np.add.reduceat(links[own], firsts)))
            out["texts"].append(pack(np.diff(firsts, append=int(own.sum()))))
            out["places"].append(pack(places[own]))
            out["links"].append(pack(links[own]))
        yield _batch(len(out["radix"]), id_type, block=[self.name] * len(out["radix"]), **out)


def _schema(id_type: pa.DataType) -> pa.Schema:
    numbers = [(c, pa.int64()) for c in ("block", "place", *_DIGEST, "radix")]
    return pa.schema([*numbers, ("doc_id", id_type), ("groups_sha256", pa.string()), *[(c, pa.binary()) for c in _RUN]])


def _batch(n: int, id_type: pa.DataType, **columns) -> pa.RecordBatch:
    schema = _schema(id_type)
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, pa.DataType]]:
    """A bounded number of texts at a time, by their number and their bytes."""
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(batch):
            before = sizes[start - 1] if start else 0
            end = max(start + 1, min(start + 512, int(np.searchsorted(sizes, before + GROUP_BYTES))))
            part = batch.slice(start, end - start)
            yield part.column("doc_id").to_pylist(), part.column("text").to_pylist(), kind
            start = end


def _encoder(first: str, second: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, count = codec(first, second), 0
        base = TaskContext.get().partitionId() << 20
        block, kind = _Block(base), pa.int64()
        for ids, texts, kind in _groups(batches):
            parts = [_CUT.split(t) if t else [] for t in texts]
            both.learn(list(chain.from_iterable(parts)))
            for doc_id, own in zip(ids, parts):
                block.add(doc_id, own, both)
                if block.records >= BLOCK_RECORDS or len(block.ids) >= BLOCK_RECORDS >> 4:
                    yield from block.rows(kind)
                    count += 1
                    block = _Block(base + count)
        if block.ids:
            yield from block.rows(kind)

    return run


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (pairs, counts) runs through a heap: each pair once, with the sum of its counts."""
    pairs: list[int] = []
    counts: list[int] = []
    streams = [zip(p.tolist(), c.tolist()) for p, c in runs]
    for pair, same in groupby(heapq.merge(*streams), key=itemgetter(0)):
        pairs.append(pair)
        counts.append(sum(n for _, n in same))
    return np.array(pairs, np.uint64), np.array(counts, np.uint64)


def _merged(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return merge_runs([(unpack(p, True), unpack(s)) for p, s in zip(rows["pairs"], rows["sums"])])


def _count_slice(rows: pd.DataFrame) -> pd.DataFrame:
    pairs, counts = _merged(rows)
    return pd.DataFrame({"radix": rows["radix"].iloc[:1], "pairs": [pack(pairs, True)], "sums": [pack(counts)]})


def _count_radix(rows: pd.DataFrame) -> pd.DataFrame:
    """Counts of a radix, and which of them are the highest of their second id."""
    pairs, counts = _merged(rows)
    owner = pairs >> _SHIFT
    firsts = np.flatnonzero(np.diff(owner, prepend=~owner[0]))
    highest = np.repeat(np.maximum.reduceat(counts, firsts), np.diff(firsts, append=len(pairs)))
    return pd.DataFrame(
        {"radix": rows["radix"].iloc[:1], "pairs": [pack(pairs, True)], "sums": [pack(counts)], "best": [pack(counts == highest)]}
    )


def _contribute(rows: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
    """(block, place, n_best, count_sum): what the pairs of these runs add to their texts."""
    if rows.empty:
        return pd.DataFrame({c: np.array([], np.int64) for c in ("block", "place", "n_best", "count_sum")})
    known = unpack(totals["pairs"].iloc[0], True)
    counts, best = unpack(totals["sums"].iloc[0]).astype(np.int64), unpack(totals["best"].iloc[0]).astype(np.int64)
    out = []
    for row in rows.itertuples():
        at = np.repeat(np.searchsorted(known, unpack(row.pairs, True)), unpack(row.texts).astype(np.int64))
        places, links = unpack(row.places).astype(np.int64), unpack(row.links).astype(np.int64)
        texts, back = np.unique(places, return_inverse=True)
        n_best, count_sum = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        np.add.at(n_best, back, links * best[at])
        np.add.at(count_sum, back, links * counts[at])
        out.append(pd.DataFrame({"block": row.block, "place": texts, "n_best": n_best, "count_sum": count_sum}))
    return pd.concat(out)


def encoded(docs: DataFrame, first: str, second: str) -> DataFrame:
    """One row per text (block, place, doc_id and digest) and one per run (block, radix and packed columns), written."""
    kind = docs.schema["doc_id"].dataType
    numbers = [T.StructField(c, T.LongType()) for c in ("block", "place", *_DIGEST, "radix")]
    schema = T.StructType(
        [*numbers, T.StructField("doc_id", kind), T.StructField("groups_sha256", T.StringType()), *[T.StructField(c, T.BinaryType()) for c in _RUN]]
    )
    return staged(docs.select("doc_id", "text").mapInArrow(_encoder(first, second), schema), "crosstok_runs")


def sliced(runs: DataFrame, slice_bytes: int = SLICE_BYTES) -> tuple[DataFrame, list[int]]:
    """Runs with the slice of their radix that merges them, and the number of slices by radix."""
    sizes = runs.groupBy("radix").agg(F.sum(sum(F.length(c) for c in _RUN)).alias("size")).collect()  # one row per radix
    slices = [1] * RADICES
    for r in sizes:
        slices[r["radix"]] = -(-r["size"] // slice_bytes)
    of_radix = F.element_at(F.array(*[F.lit(n) for n in slices]), (F.col("radix") + 1).cast("int"))
    return runs.withColumn("slice", F.pmod(F.xxhash64("block"), of_radix).cast("int")), slices


def pair_totals(runs: DataFrame) -> DataFrame:
    """(radix, pairs, sums, best), packed: corpus-wide counts of all linked pairs."""
    parts = runs.select("radix", "slice", "pairs", "sums").groupBy("radix", "slice")
    counted = parts.applyInPandas(_count_slice, "radix long, pairs binary, sums binary")
    return staged(
        counted.groupBy("radix").applyInPandas(_count_radix, "radix long, pairs binary, sums binary, best binary"), "crosstok_totals"
    )


def _unpack_totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            pairs = unpack(row.pairs, True)
            yield pd.DataFrame(
                {
                    "a_id": (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64),
                    "b_id": (pairs >> _SHIFT).astype(np.int64),
                    "n": unpack(row.sums).astype(np.int64),
                    "best": unpack(row.best).astype(bool),
                }
            )


def linked_pairs(docs: DataFrame, first: str, second: str) -> DataFrame:
    """(a_id, b_id, n, best): how often two entries overlap, and whether that is the most of the second."""
    runs, _ = sliced(encoded(docs, first, second).where("radix IS NOT NULL"))
    return pair_totals(runs).mapInPandas(_unpack_totals, "a_id long, b_id long, n long, best boolean")


def align_documents(docs: DataFrame, first: str, second: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    table = encoded(docs, first, second)
    runs, slices = sliced(table.where("radix IS NOT NULL"), slice_bytes)
    every = F.element_at(F.array(*[F.lit(n) for n in slices]), (F.col("radix") + 1).cast("int"))
    totals = pair_totals(runs).withColumn("slice", F.explode(F.sequence(F.lit(0), every - 1)))
    parts = (
        runs.select("radix", "slice", "block", *_RUN)
        .groupBy("radix", "slice")
        .cogroup(totals.groupBy("radix", "slice"))
        .applyInPandas(_contribute, "block long, place long, n_best long, count_sum long")
    )
    added = parts.groupBy("block", "place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    texts = table.where("place IS NOT NULL").select("block", "place", "doc_id", *_DIGEST, "groups_sha256")
    zero = F.lit(0).cast("long")
    return texts.join(added, ["block", "place"], "left").select(
        "doc_id", *_DIGEST, *[F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")], "groups_sha256"
    )
