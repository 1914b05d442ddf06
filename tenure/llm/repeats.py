"""Removal of repeated passages: every byte under a string of 100 bytes seen earlier.

Any window of 100 bytes holds one least hash among its 24-byte grams, its anchor; equal windows
have equal anchors at equal places. So the windows of a text fall into runs of one anchor each,
some 40 windows long, and only runs with a common anchor can share a window:

1. Runs equal in all their bytes: all but the first are repeats, known from hashes alone.
2. Runs that share an anchor and differ: their bytes are fetched, and the Burrows-Wheeler
   transforms of shards of them are merged (``bwt.py``) to find the equal windows inside.
3. Anchors with very many different runs (a common line with something else around it): each of
   their windows is hashed to 128 bits and counted by an ordinary aggregate, which combines
   before it shuffles, so no task gets all rows of such an anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.llm.bwt import repeated
from tenure.llm.common import partitions
from tenure.operators.staging import staged

LENGTH = 100
GRAM = 24
#: Runs of one anchor above which its windows are counted one by one: what a task can still merge
#: in some 200 MB. Runs merged at a time: few enough for 16-bit symbols.
HOT, MERGED = 8_000, 500
#: Windows looked at together; positions in such a piece fit in 21 bits.
PIECE = 1 << 20
#: A run is packed as first window << 24 | windows - 1.
_SHIFT = 24
_POSITION = np.uint64((1 << 21) - 1)
_BASE = 0x9E3779B97F4A7C15
_OTHER = 0xC2B2AE3D27D4EB4F


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def rolling(data: np.ndarray, length: int, base: int = _BASE) -> np.ndarray:
    """Hashes of all strings of ``length`` bytes, by joining halves of powers of two."""
    part, size = data.astype(np.uint64) + np.uint64(1), 1
    out, have = None, 0
    while True:
        if length & size:
            # The strings gathered so far, followed by one of this size.
            if out is None:
                out = part
            else:
                n = len(part) - have
                out = out[:n] * np.uint64(pow(base, size, 1 << 64)) + part[have:]
            have += size
        size *= 2
        if size > length:
            return _mix(out)
        part = part[: len(part) - size // 2] * np.uint64(pow(base, size // 2, 1 << 64)) + part[size // 2 :]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbours."""
    out, size = values, 1
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


_POWERS = np.array([pow(_BASE, k, 1 << 64) for k in range(4096)], np.uint64)
_BACK = np.array([pow(pow(_BASE, -1, 1 << 64), k, 1 << 64) for k in range(4096)], np.uint64)


def _spans(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of data[start:stop] for short spans: sums of byte * base ** place."""
    # Places count from 0 anew every 2048 bytes, so that powers stay in one small table.
    place = np.arange(len(data)) & 2047
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS[place])])
    edge = np.minimum((start | 2047) + 1, stop)
    first = (total[edge] - total[start]) * _BACK[start & 2047]
    # What lies beyond the edge comes ``edge - start`` places later.
    return first + (total[stop] - total[edge]) * _POWERS[edge - start]


def runs_of(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, content, first window, last window) of the runs of a text, in order."""
    n = len(raw) - length + 1
    if n <= 0:
        none = np.empty(0, np.uint64)
        return none, none, none.astype(np.int64), none.astype(np.int64)
    found = []
    for at in range(0, n, PIECE):
        data = np.frombuffer(raw, np.uint8, min(PIECE, n - at) + length - 1, at)
        gram = rolling(data, GRAM)
        packed = (gram & ~_POSITION) | np.arange(len(gram), dtype=np.uint64)
        where = (_least(packed, length - GRAM + 1) & _POSITION).astype(np.int64)
        cut = np.flatnonzero(np.diff(where)) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(where)]]) - 1
        spot = where[first]
        content = _mix(_spans(data, first, last + length) + ((last - first) << 8 | (spot - first)).astype(np.uint64) * np.uint64(_OTHER))
        found.append((gram[spot], content, first + at, last + at))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _runs(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Runs of a batch; of equal ones only the first goes on, the others are repeats already."""
        for batch in batches:
            rows = [(key, *runs_of(text.encode("utf-8", "surrogatepass"), length)) for key, text in zip(batch["key"], batch["text"], strict=True)]
            key = np.concatenate([np.full(len(r[1]), r[0], np.int64) for r in rows])
            anchor, content, first, last = (np.concatenate([r[k] for r in rows]) for k in range(1, 5))
            order = np.lexsort((first, key, content, anchor))
            again = np.zeros(len(order), bool)
            again[order[1:]] = (anchor[order[1:]] == anchor[order[:-1]]) & (content[order[1:]] == content[order[:-1]])
            # Neighbouring repeats of a text go as one span.
            at = np.flatnonzero(again)
            joined = (np.diff(at) == 1) & (key[at[1:]] == key[at[:-1]]) & (last[at[:-1]] + 1 == first[at[1:]])
            joined &= first[at[1:]] // PIECE == first[at[:-1]] // PIECE  # keeps the packed width in bounds
            start = at[np.concatenate([[True], ~joined])] if len(at) else at
            stop = at[np.concatenate([~joined, [True]])] if len(at) else at
            wide = last[stop] - first[start]
            span = np.concatenate([first[~again], first[start]]) << _SHIFT | np.concatenate([(last - first)[~again], wide])
            owner = np.concatenate([key[~again], key[start]])
            settled = np.concatenate([np.zeros(int((~again).sum()), bool), np.ones(len(start), bool)])
            names = np.concatenate([anchor[~again], _mix(span[settled].astype(np.uint64) ^ owner[settled].astype(np.uint64))])
            if len(owner):
                yield pd.DataFrame(
                    {
                        "anchor": names.view(np.int64),
                        "content": np.concatenate([content[~again], np.zeros(len(start), np.uint64)]).view(np.int64),
                        "key": owner,
                        # A span that is settled has its sign turned.
                        "span": np.where(settled, ~span, span),
                    }
                )

    return run


def _bodies(parts: list[tuple]) -> pd.DataFrame:
    anchor, key, first, hot = (np.concatenate([p[k] for p in parts]) for k in range(4))
    return pd.DataFrame({"anchor": anchor, "key": key, "first": first, "hot": hot, "body": [b for p in parts for b in p[4]]})


def _cut(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts, held = [], 0
            for key, text, anchors, spans, hot in zip(*(batch[c] for c in ("key", "text", "anchors", "spans", "hots")), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                first = spans >> _SHIFT
                stop = first + (spans & ((1 << _SHIFT) - 1)) + length
                parts.append((anchors, np.full(len(spans), key), first, hot, [raw[a:b] for a, b in zip(first.tolist(), stop.tolist())]))
                held += int((stop - first).sum())
                if held > PIECE * 8:
                    yield _bodies(parts)
                    parts, held = [], 0
            if parts:
                yield _bodies(parts)

    return run


def _windows(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.iloc[start : start + 1024]
                data = np.frombuffer(b"".join(part["body"]), np.uint8)
                sizes = part["body"].str.len().to_numpy()
                count = sizes - length + 1
                ends = np.cumsum(count)
                inner = np.arange(ends[-1]) - np.repeat(ends - count, count)
                at = inner + np.repeat(np.cumsum(sizes) - sizes, count)
                yield pd.DataFrame(
                    {
                        "a": rolling(data, length)[at].view(np.int64),
                        "b": rolling(data, length, _OTHER)[at].view(np.int64),
                        "key": np.repeat(part["key"].to_numpy(np.int64), count),
                        "at": inner + np.repeat(part["first"].to_numpy(np.int64), count),
                    }
                )

    return run


def _merge(length: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        group, text, offset = repeated(list(rows["body"]), length)
        key, at = rows["key"].to_numpy(np.int64)[text], rows["first"].to_numpy(np.int64)[text] + offset
        order = np.lexsort((at, key, group))
        group, key, at = group[order], key[order], at[order]
        later = np.zeros(len(group), bool)
        later[1:] = (group[1:] == group[:-1]) & ((key[1:] != key[:-1]) | (at[1:] != at[:-1]))
        return _joined(key[later], at[later])

    return run


def _joined(key: np.ndarray, at: np.ndarray) -> pd.DataFrame:
    """Windows as packed spans of neighbours."""
    order = np.lexsort((at, key))
    key, at = key[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (key[1:] != key[:-1]) | (at[1:] > at[:-1] + 1)
    start = np.flatnonzero(new)
    stop = np.concatenate([start[1:], [len(at)]])[: len(start)] - 1
    return pd.DataFrame({"key": key[start], "span": at[start] << _SHIFT | (at[stop] - at[start])})


def _removed(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, spans in zip(batch["text"], batch["spans"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                if spans is None or not len(spans):
                    out.append((len(raw), 0, [], raw))
                    continue
                packed = np.sort(np.array(spans, np.int64))
                start = packed >> _SHIFT
                stop = start + (packed & ((1 << _SHIFT) - 1)) + length
                reach = np.maximum.accumulate(stop)
                new = np.concatenate([[True], start[1:] > reach[:-1]])
                first = start[new]
                last = np.concatenate([reach[:-1][new[1:]], reach[-1:]])
                keep = np.concatenate([[0], last]), np.concatenate([first, [len(raw)]])
                kept = b"".join(raw[a:b] for a, b in zip(*keep, strict=True))
                out.append((len(raw), len(raw) - len(kept), [[int(a), int(b)] for a, b in zip(first, last, strict=True)], kept))
            done = pd.DataFrame(out, columns=["n_bytes", "n_removed", "cut", "kept"])
            yield pd.concat([batch.drop(columns=["text", "spans"]).reset_index(drop=True), done], axis=1)

    return run


def numbered(docs: DataFrame, carry: list[str]) -> DataFrame:
    """key, text and the columns to carry; the order of the keys is that of the documents.

    Unique ids are their own keys. Otherwise rows are sorted by id (null last), then text, and
    written with their place as key.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), F.coalesce("text", F.lit("")).alias("text"), *carry)
    twice = docs.groupBy(F.col("doc_id").cast("long").alias("key")).count().where("count > 1 OR key IS NULL")
    if twice.isEmpty():
        return rows
    order = [F.col("key").asc_nulls_last(), F.col("text")]
    placed = rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    return staged(placed.withColumn("key", F.monotonically_increasing_id()), "repeat_docs")


def repeat_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """key, span: runs of windows of ``rows`` (key, text) that stand earlier too."""
    spark = rows.sparkSession
    long_enough = rows.where(F.octet_length("text") >= length).select("key", "text")
    runs = long_enough.mapInPandas(_runs(length), "anchor long, content long, key long, span long")
    same = Window.partitionBy("anchor", "content", F.col("span") < 0).orderBy("key", "span")
    marked = (
        runs.repartition(partitions(spark), "anchor")
        .withColumn("place", F.row_number().over(same))
        .withColumn("kinds", F.sum(((F.col("place") == 1) & (F.col("span") >= 0)).cast("long")).over(Window.partitionBy("anchor")))
        .where("span < 0 OR place > 1 OR kinds > 1")
    )
    marks = staged(
        marked.select("anchor", "key", "span", F.when(F.col("span") < 0, 0).when(F.col("place") > 1, 0).otherwise(F.col("kinds")).alias("kinds")),
        "repeat_marks",
    )
    known = marks.where("kinds = 0").select("key", F.when(F.col("span") < 0, F.bitwise_not("span")).otherwise(F.col("span")).alias("span"))
    open_ = (
        marks.where("kinds > 0")
        .groupBy("key")
        .agg(F.collect_list(F.struct("anchor", "span", (F.col("kinds") > HOT).alias("hot"))).alias("found"))
        .select("key", F.col("found.anchor").alias("anchors"), F.col("found.span").alias("spans"), F.col("found.hot").alias("hots"))
    )
    bodies = staged(
        long_enough.join(open_, "key").mapInPandas(_cut(length), "anchor long, key long, first long, hot boolean, body binary"),
        "repeat_bodies",
    )
    cold, hot = bodies.where("NOT hot"), bodies.where("hot")
    buckets = max(1, cold.count() // MERGED)
    merged = cold.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket")).applyInPandas(_merge(length), "key long, span long")
    windows = staged(hot.select("key", "first", "body").mapInPandas(_windows(length), "a long, b long, key long, at long"), "repeat_windows")
    firsts = windows.groupBy("a", "b").agg(F.min(F.struct("key", "at")).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = (
        windows.join(firsts, ["a", "b"])
        .where((F.col("key") != F.col("least.key")) | (F.col("at") != F.col("least.at")))
        .select("key", F.shiftleft("at", _SHIFT).alias("span"))
    )
    return known.unionByName(merged).unionByName(counted)


def remove_repeats(docs: DataFrame, length: int = LENGTH, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns to carry, n_bytes, n_removed, cut (pairs of byte offsets) and kept (bytes).

    A byte goes if a string of ``length`` bytes over it also starts earlier: in a document of
    smaller id, or earlier in its own. A null text is empty; texts shorter than ``length`` stay
    whole; a null id comes after all others; rows that share an id are ordered by text, so a
    repeated row is a copy of the row before it; an empty table gives an empty result.
    """
    named = [F.col(c).alias(f"_{c}") for c in carry]
    kept_names = [f"_{c}" for c in carry]
    rows = numbered(docs.select("doc_id", "text", *named), kept_names)
    spans = staged(repeat_spans(rows, length), "repeat_spans").groupBy("key").agg(F.collect_list("span").alias("spans"))
    # Through pandas as text, so that nulls do not turn whole numbers into floating point.
    types = dict(rows.dtypes)
    joined = rows.join(spans, "key", "left").select("text", "spans", *[F.col(c).cast("string").alias(c) for c in kept_names])
    out = joined.mapInPandas(
        _removed(length),
        ", ".join(f"`{c}` string" for c in kept_names) + ", n_bytes long, n_removed long, cut array<array<int>>, kept binary",
    )
    back = [F.col(f"_{c}").cast(types[f"_{c}"]).alias(c) for c in carry]
    return out.select(*back, "n_bytes", "n_removed", "cut", "kept")


def readable(kept: str) -> Column:
    """The bytes as text; what is left of a letter that was cut in two goes."""

    def decode(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: b.decode("utf-8", "ignore") if b is not None else None)

    return F.pandas_udf(decode, "string")(F.col(kept))


def repeat_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row; see ``remove_repeats``."""
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("cut").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
