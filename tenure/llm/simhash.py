"""Near-duplicates by SimHash and vantage-point trees over Hamming distance.

Distinct fingerprints are dealt to the leaves of a vantage-point tree that is built from a
bounded sample. A node keeps on its inner side what is at most radius + r away from its vantage
point and on its outer side what is more than the radius away: by the triangle inequality two
fingerprints that differ in r bits or fewer then share a side, so they share a leaf, and only
what lies on a boundary is in several leaves. Inside a leaf the same tree goes on until blocks
are small enough to compare exactly. Links go out as stars of each block, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.llm.common import keyed
from tenure.llm.components import components
from tenure.operators.staging import staged

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Fingerprints in a leaf, about; the sample that the tree is built from, per leaf and at most.
LEAF, PER_LEAF, SAMPLE = 4_096, 32, 1 << 20
#: A leaf above this number is cut into cells, and every two cells meet in a task of their own.
CELL = 1 << 17
#: Blocks up to this number are compared outright; larger ones that no vantage point divides
#: are searched by flipping bits.
BLOCK = 1_024
#: A division must leave at most this share of the pairs together.
USEFUL = 0.8
#: Shingles whose bits are counted at once.
CHUNK = 1 << 14

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of each word shingle, repeats included; of all words where there are fewer."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if isinstance(text, str) else []
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    found = (digest(joined[a:b]) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True))
    return np.fromiter(found, np.uint64, len(starts))


def bits_of(hashes: np.ndarray) -> int:
    """Each bit that is set in over half of the hashes."""
    count = np.zeros(64, np.int64)
    for k in range(0, len(hashes), CHUNK):
        part = hashes[k : k + CHUNK].astype("<u8").view(np.uint8)
        count += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """SimHash of the word shingles, repeats included; 0 without a word."""
    hashes = shingle_hashes(text, width)
    return bits_of(hashes) if len(hashes) else 0


def _fingerprints(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = np.array([fingerprint(t, width) for t in batch["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": prints})

    return run


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, fp: one signed 64-bit fingerprint per row."""
    rows = keyed(docs, "text").mapInPandas(_fingerprints(width), "doc_id string, fp long")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def choose_split(points: np.ndarray, radius: int, tries: int = 8) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that leave the fewest pairs together, None if none is useful."""
    n, best, found = len(points), USEFUL * len(points) ** 2, None
    for v in points[:: max(1, n // tries)][:tries]:
        tally = np.bincount(_distance(points, v), minlength=65)
        inside = np.cumsum(tally)
        for m in range(0, 64):
            near, far = int(inside[min(64, m + radius)]), n - int(inside[m])
            if near * near + far * far < best:
                best, found = near * near + far * far, (v, m)
    return found


#: A tree: (vantage point, radius, inner, outer) or the number of a leaf.
Tree = tuple | int


def build_tree(sample: np.ndarray, radius: int, per_leaf: int = PER_LEAF) -> tuple[Tree, int]:
    """Divide a sample until ``per_leaf`` are left or no division helps; number of leaves."""
    count = 0

    def grow(points: np.ndarray) -> Tree:
        nonlocal count
        split = choose_split(points, radius) if len(points) > per_leaf else None
        if split is None:
            count += 1
            return count - 1
        d = _distance(points, split[0])
        return (*split, grow(points[d <= split[1] + radius]), grow(points[d > split[1]]))

    return grow(sample), count


def route(tree: Tree, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(leaf, place) for every leaf that each of the points belongs to."""
    leaves, places = [], []
    todo = [(tree, np.arange(len(points)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            leaves.append(np.full(len(at), node, np.int64))
            places.append(at)
            continue
        d = _distance(points[at], node[0])
        todo += [(node[2], at[d <= node[1] + radius]), (node[3], at[d > node[1]])]
    return (np.concatenate(leaves), np.concatenate(places)) if leaves else (np.empty(0, np.int64), np.empty(0, np.int64))


def _router(tree: Tree, radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch["fp"].to_numpy(np.int64)
            leaf, place = route(tree, points.view(np.uint64), radius)
            yield pd.DataFrame({"leaf": leaf, "fp": points[place]})

    return run


def _settle(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> bool:
    """Lower the roots of linked places to their common least one; was anything lowered?"""
    low = np.minimum(root[a], root[b])
    if not (changed := bool(np.any(root[a] != root[b]))):
        return False
    np.minimum.at(root, a, low)
    np.minimum.at(root, b, low)
    return changed


def _compare(points: np.ndarray, radius: int) -> np.ndarray:
    """Least place each point is linked to inside a block, directly or over others."""
    near = _distance(points[:, None], points[None, :]) <= radius
    a, b = np.nonzero(near)
    root = np.arange(len(points))
    while _settle(root, a, b):
        root = root[root]
    return root


def _flip(points: np.ndarray, radius: int) -> np.ndarray:
    """The same for sorted points by looking up every word at most ``radius`` flips away."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    masks = [0]
    for _ in range(radius):
        masks = sorted({m ^ int(b) for m in masks for b in one} | set(masks))
    root, moved = np.arange(len(points)), True
    while moved:
        moved = False
        for mask in masks[1:]:
            other = points ^ np.uint64(mask)
            place = np.minimum(np.searchsorted(points, other), len(points) - 1)
            a = np.flatnonzero(points[place] == other)
            if len(a) and _settle(root, a, place[a]):
                moved = True
        root = root[root]
    return root


def link(points: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Stars over distinct points whose components are those of all pairs within ``radius``."""
    us, vs = [], []
    todo = [np.unique(points)]
    while todo:
        block = todo.pop()
        if len(block) < 2:
            continue
        if len(block) > BLOCK:
            split = choose_split(block, radius)
            if split is not None:
                d = _distance(block, split[0])
                todo += [block[d <= split[1] + radius], block[d > split[1]]]
                continue
            root = _flip(block, radius)
        else:
            root = _compare(block, radius)
        linked = np.flatnonzero(root != np.arange(len(block)))
        us.append(block[linked])
        vs.append(block[root[linked]])
    if not us:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(us), np.concatenate(vs)


def _link_cell(radius: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        u, v = link(rows["fp"].to_numpy(np.int64).view(np.uint64), radius)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return run


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v) over the distinct fingerprints ``fp``: same components as all pairs in the radius."""
    n = prints.count()
    wanted = min(SAMPLE, max(1, n // LEAF) * PER_LEAF)
    every = max(1, n // wanted)
    sample = prints.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).limit(2 * SAMPLE).select("fp").toPandas()
    points = np.sort(sample["fp"].to_numpy(np.int64)).view(np.uint64)
    # A small table is one leaf.
    tree, leaves = build_tree(points, radius) if n > LEAF else (0, 1)
    routed = staged(prints.select("fp").mapInPandas(_router(tree, radius), "leaf long, fp long"), "simhash_leaves")
    # One row per leaf; the sample bounds the number of leaves.
    sizes = routed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(CELL)).cast("int").alias("cells"))
    own = F.pmod(F.xxhash64("fp"), F.col("cells")).cast("int")
    dealt = routed.join(F.broadcast(sizes), "leaf").select(
        "leaf", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("other")
    )
    cells = dealt.select("leaf", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp")
    return cells.groupBy("leaf", "a", "b").applyInPandas(_link_cell(radius), "u long, v long")


def _rooted(distinct: DataFrame, radius: int) -> DataFrame:
    """(fp, least, root) of the distinct fingerprints (fp, least), written."""
    roots = components(links(distinct, radius))
    return staged(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        ),
        "simhash_roots",
    )


def keep_first(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The columns of ``docs``, of one document for each component of near duplicates.

    The smallest id stays, a null id only where the component has no other. Null and empty texts
    have fingerprint 0 and are one component; of repeated rows one stays.
    """
    printed = F.pandas_udf(lambda texts: pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)), "long")
    columns = [F.col(c).alias(f"_c{i}") for i, c in enumerate(docs.columns)]
    rows = staged(
        docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", printed("text").alias("fp"), F.struct(*columns).alias("row")),
        "simhash_rows",
    )
    found = _rooted(staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash_distinct"), radius)
    linked = rows.select("key", "doc_id", "fp").join(found.select("fp", "root"), "fp")
    # Combined before the shuffle, so a component of very many rows is no burden.
    first = linked.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first"))
    kept = rows.join(first.select("first.key"), "key", "left_semi")
    return kept.select(*[F.col(f"row._c{i}").alias(c) for i, c in enumerate(docs.columns)])


def near_duplicates(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint, component_id for every row.

    Two fingerprints are linked when they differ in at most ``radius`` bits; component_id is the
    smallest id reachable. Null and empty texts have fingerprint 0 and are linked like others; a
    null id is never the smallest, and alone it gives a null component; repeated rows and equal
    texts share their fingerprint; an empty table gives an empty result; other columns are not
    used.
    """
    prints = staged(fingerprints(docs, width), "simhash")
    rooted = _rooted(staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash_distinct"), radius)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = staged(rooted.join(least, "root").select("fp", "component_id"), "simhash_components")
    return prints.join(found, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
