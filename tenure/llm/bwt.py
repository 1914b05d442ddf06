"""Repeated strings by merging Burrows-Wheeler transforms of shards, in one task's memory.

Symbols are ``step`` bytes, so a string of ``depth`` symbols is a run of depth * step bytes at
any offset: the symbols of a text form ``step`` interleaved chains, each closed by an end mark.
Each shard's suffixes are sorted once. The merge keeps only from which shard the next suffix
comes (the interleave): one refinement reads the transforms of the shards along it and deals
the sources stably by symbol, which sorts the merged suffixes by one symbol more. A boundary
between neighbours that appears in refinement t is a common prefix of t - 1 symbols.
"""

from __future__ import annotations

import numpy as np


def symbols(data: np.ndarray, stops: np.ndarray, step: int) -> np.ndarray:
    """Rank (from 1) of the ``step`` bytes from each place on; cut off at the text's end."""
    n = len(data)
    rank = np.zeros(n, np.int64)
    for k in range(step):
        at = np.arange(n) + k
        byte = np.where(at < stops, data[np.minimum(at, n - 1)].astype(np.int64) + 1, 0)
        if int(rank.max(initial=0)) >= 1 << 53:
            rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        rank = rank * 257 + byte
    return np.unique(rank, return_inverse=True)[1].astype(np.int64) + 1


class Shard:
    """Sorted suffixes of some texts and their transform; end marks are rows of their own."""

    def __init__(self, rank: np.ndarray, bounds: np.ndarray, step: int, depth: int):
        """``rank``: symbols of the texts one after another; text i is bounds[i]:bounds[i + 1]."""
        n = len(rank)
        stops = np.repeat(bounds[1:], np.diff(bounds))
        starts = np.repeat(bounds[:-1], np.diff(bounds))
        here = np.arange(n)
        tails = np.flatnonzero(here + step >= stops)
        # Rows: n suffixes, then one end mark for each chain.
        follow = np.concatenate([here + step, np.full(len(tails), -1)])
        follow[tails] = n + np.arange(len(tails))
        symbol = np.concatenate([rank, np.zeros(len(tails), np.int64)])
        order_of = np.unique(symbol, return_inverse=True)[1]
        known, jump = 1, follow.copy()
        ranks = {1: order_of}
        jumps = {1: jump}
        while known * 2 <= depth:
            ranks[known * 2] = self._pair(ranks[known], ranks[known], jumps[known])
            jumps[known * 2] = np.where(jumps[known] < 0, -1, jumps[known][jumps[known]])
            known *= 2
        now, jump, left = ranks[known], jumps[known], depth - known
        while left:
            known = max(k for k in ranks if k <= left)
            now = self._pair(now, ranks[known], jump)
            jump = np.where(jump < 0, -1, jumps[known][jump])
            left -= known
        self.order = np.argsort(now, kind="stable")
        before = np.full(len(symbol), -1)
        before[follow[:n]] = here
        previous = before[self.order]
        self.transform = np.where(previous < 0, 0, symbol[previous])
        self.ends = len(tails)
        self.room = np.concatenate([stops - here, np.zeros(len(tails), np.int64)])
        self.offset = np.concatenate([here - starts, np.zeros(len(tails), np.int64)])
        self.text = np.concatenate([np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), np.full(len(tails), -1)])

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray, jump: np.ndarray) -> np.ndarray:
        second = np.where(jump < 0, 0, b[jump] + 1)
        return np.unique(a.astype(np.int64) * (int(b.max(initial=0)) + 2) + second, return_inverse=True)[1]


def order_of(symbol: np.ndarray) -> np.ndarray:
    """Stable order, by digits of 16 bits, which numpy sorts without comparing."""
    low = np.argsort(symbol.astype(np.uint16), kind="stable")
    if int(symbol.max(initial=0)) < 1 << 16:
        return low
    return low[np.argsort((symbol >> 16)[low].astype(np.uint16), kind="stable")]


def merge(transforms: list[np.ndarray], ends: list[int], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, common): merged order as row numbers of the shards one after another, and the
    symbols each row has in common with the row before it, up to ``depth``.
    """
    sizes = np.array([len(t) for t in transforms])
    along = np.concatenate(transforms)
    total = int(sizes.sum())
    kind = np.uint16 if along.max(initial=0) < 1 << 16 else np.int32
    along = along.astype(kind)
    source = np.repeat(np.arange(len(sizes)), sizes).astype(np.uint16)
    marks = np.repeat(np.arange(len(sizes)), ends).astype(np.uint16)
    block = np.zeros(total, np.int32)
    common = np.full(total, depth, np.int32)
    rows = np.empty(total, np.int64)
    for t in range(1, depth + 1):
        # Each shard is read in its own order, wherever the interleave puts its rows.
        rows[np.argsort(source, kind="stable")] = np.arange(total)
        symbol = along[rows]
        deal = order_of(symbol)
        source, symbol, block = source[deal], symbol[deal], block[deal]
        source[: len(marks)] = marks
        block[: len(marks)] = 0
        new = np.ones(total, bool)
        new[1:] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        common[new & (common == depth)] = t - 1
        block = np.cumsum(new, dtype=np.int32) - 1
    rows[np.argsort(source, kind="stable")] = np.arange(total)
    return rows, common


def repeated(texts: list[bytes], length: int, shard_bytes: int = 1 << 15) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, text, offset) of every string of ``length`` bytes that stands in several places.

    Equal strings share their group number; groups come one after another.
    """
    step = max(k for k in range(1, 11) if length % k == 0)
    depth = length // step
    sizes = np.array([len(t) for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    none = np.empty(0, np.int64)
    if not len(texts) or not bounds[-1]:
        return none, none, none
    data = np.frombuffer(b"".join(texts), np.uint8)
    rank = symbols(data, np.repeat(bounds[1:], sizes), step)
    shard_of = bounds[:-1] // shard_bytes
    cuts = np.concatenate([np.flatnonzero(np.diff(shard_of, prepend=-1)), [len(texts)]])
    shards = [
        Shard(rank[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], step, depth) for a, b in zip(cuts[:-1], cuts[1:], strict=True)
    ]
    rows, common = merge([s.transform for s in shards], [s.ends for s in shards], depth)
    text = np.concatenate([np.where(s.text < 0, -1, s.text + a)[s.order] for s, a in zip(shards, cuts[:-1], strict=True)])[rows]
    offset = np.concatenate([s.offset[s.order] for s in shards])[rows]
    whole = np.concatenate([s.room[s.order] for s in shards])[rows] >= length
    group = np.cumsum(common < depth)
    # Suffixes with fewer bytes left end in a mark, so no whole string shares their group.
    many = whole & (np.bincount(group[whole], minlength=int(group.max(initial=0)) + 1)[group] > 1)
    return group[many], text[many], offset[many]
