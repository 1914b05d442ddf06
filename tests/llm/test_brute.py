"""Operators against plain Python over small inputs."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tenure.llm import bwt, components, mixing, pieces, quality, queries, repeats, sharding, simhash, toxicity, winnowing


def test_slots_have_no_gaps_and_one_more_shard_only_takes(docs):
    rows = sharding.assign_shards(docs, [1.0] * 4).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect() if r["doc_id"] is not None}
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["size"], r["text_crc32"]) == (len(text[r["doc_id"]]) + 8, zlib.crc32(text[r["doc_id"]]))


def test_shards_get_rows_by_weight(spark):
    df = spark.range(6000).selectExpr("id AS doc_id", "'' AS text")
    found = Counter(r["shard"] for r in sharding.assign_shards(df, [1.0, 2.0, 3.0]).collect())
    assert [round(found[s] / 1000, 1) for s in range(3)] == pytest.approx([1, 2, 3], abs=0.15)


def test_fingerprint_of_the_definition():
    def plain(text):
        w = text.encode().translate(simhash._LOWER).split()
        if not w:
            return 0
        shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    for text in ("", "A b", "A b c d É x", "to be or not to be or not to be", " x\x0by\x85z "):
        assert simhash.fingerprint(text) == plain(text)


def groups_of(points, radius):
    root = {p: p for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in points}


@pytest.mark.parametrize("block", [4, 64, 1024])
def test_trees_lose_no_link(monkeypatch, block):
    rnd = random.Random(block)
    points = [rnd.getrandbits(64) for _ in range(150)]
    points += [points[i] ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for i in range(100)]
    dense = rnd.getrandbits(64)
    points += [dense ^ (1 << a) ^ (1 << b) for a in range(8) for b in range(a)]
    points = sorted(set(points))
    expected = groups_of(points, 2)
    monkeypatch.setattr(simhash, "BLOCK", block)
    u, v = simhash.link(np.array(points, np.uint64), 2)
    stars = groups_of_links(points, zip(u.tolist(), v.tolist(), strict=True))
    assert same_partition(stars, expected)
    tree, leaves = simhash.build_tree(np.array(points, np.uint64), 2, per_leaf=20)
    leaf, place = simhash.route(tree, np.array(points, np.uint64), 2)
    at = defaultdict(set)
    for x, p in zip(leaf.tolist(), place.tolist(), strict=True):
        at[p].add(x)
    for i in range(len(points)):
        for j in range(i):
            if (points[i] ^ points[j]).bit_count() <= 2:
                assert at[i] & at[j]


def groups_of_links(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def same_partition(a, b):
    return len(set(a.values())) == len(set(b.values())) == len({(a[n], b[n]) for n in a})


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    edges = [(a, b) for a, b in edges if a != b]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == groups_of_links({n for e in edges for n in e}, edges)


def test_near_duplicates_end_to_end(docs):
    rows = [r for r in simhash.near_duplicates(docs).collect()]
    text = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    prints = {i: simhash.fingerprint(t) for i, t in text.items()}
    for r in rows:
        if r["doc_id"] is not None:
            assert int(r["fingerprint"], 16) == prints[r["doc_id"]]
            alike = [i for i, p in prints.items() if (p ^ prints[r["doc_id"]]).bit_count() <= 2]
            assert r["component_id"] <= min(alike)


def removed_by_definition(texts, length):
    seen, out = set(), []
    for raw in texts:
        cut = [False] * len(raw)
        for j in range(len(raw) - length + 1):
            if raw[j : j + length] in seen:
                cut[j : j + length] = [True] * length
            seen.add(raw[j : j + length])
        out.append(bytes(b for b, c in zip(raw, cut, strict=True) if not c))
    return out


@pytest.mark.parametrize(("hot", "merged"), [(1_000, 4_000), (1, 4_000), (3, 2)])
def test_repeats_by_definition(spark, monkeypatch, hot, merged):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "MERGED", merged)
    rnd = random.Random(hot)
    line = "".join(rnd.choice("abcd ") for _ in range(90))
    parts = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(80, 260))) for _ in range(12)]
    texts = [line + "".join(rnd.choice(parts) if rnd.random() < 0.7 else str(rnd.random()) * 8 for _ in range(4)) for _ in range(30)]
    texts += ["x" * 700, "xy" * 300, "", parts[0], texts[3]]
    rows = [(i, t) for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    found = {r["doc_id"]: r for r in repeats.repeat_digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for i, kept in enumerate(removed_by_definition([t.encode() for t in texts], 100)):
        assert found[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        assert found[i]["n_removed"] == len(texts[i].encode()) - len(kept)


def test_merged_transforms_find_every_repeated_string():
    rnd = random.Random(3)
    for trial in range(40):
        length, letters = rnd.choice([4, 7, 10, 20, 100]), rnd.choice([b"ab", b"abcd", bytes(range(256))])
        base = bytes(rnd.choice(letters) for _ in range(400))
        texts = [base[(a := rnd.randint(0, 300)) : a + rnd.randint(0, 200)] + bytes(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(rnd.randint(0, 12))]
        places = defaultdict(set)
        for i, x in enumerate(texts):
            for j in range(len(x) - length + 1):
                places[x[j : j + length]].add((i, j))
        found = defaultdict(set)
        for g, t, o in zip(*(x.tolist() for x in bwt.repeated(texts, length, shard_bytes=rnd.choice([1, 50, 300, 10**6]))), strict=True):
            found[g].add((t, o))
        assert {frozenset(v) for v in found.values()} == {frozenset(v) for v in places.values() if len(v) > 1}, trial


@pytest.fixture(scope="module")
def segmenter():
    return pieces.Segmenter(pieces.read_vocabulary(queries.PIECE_MODEL))


def test_best_segmentation_by_brute_force(segmenter):
    score = {p: (s, i) for i, (p, s) in enumerate(zip(segmenter.vocabulary.pieces, segmenter.vocabulary.scores, strict=True)) if s == s}
    for text in ("the quick", "unbelievable  results", "Ünïcode 日本", "aaaaaaaaaaaaaaaaaaaaaaa"):
        marked = "▁" + text.replace(" ", "▁")
        best = [(0.0, None)] + [None] * len(marked)
        for e in range(1, len(marked) + 1):
            for s in range(max(0, e - segmenter.longest), e):
                part = marked[s:e]
                if part in score or len(part) == 1:
                    value = best[s][0] + (score[part][0] if part in score else segmenter.unknown_score)
                    if best[e] is None or value > best[e][0]:
                        best[e] = (value, s)
        path, e = [], len(marked)
        while e:
            path.append(marked[best[e][1] : e])
            e = best[e][1]
        ids = segmenter.encode([text])[0].tolist()
        expected = []
        for part in reversed(path):
            expected += [score[part][1]] if part in score else [segmenter.vocabulary.byte_ids[b] for b in part.encode()]
        assert ids == expected


def test_decoding_gives_the_text_back(spark, docs):
    rows = pieces.encode_documents(docs, queries.PIECE_MODEL).collect()
    assert all(r["round_trip"] for r in rows)
    odd = ["▁", "a▁b ▁ ", "\x00x", "  two", "x" * 4000, "tab\tnl\n"]
    df = spark.createDataFrame([(t,) for t in odd], "text string")
    back = pieces.decode(pieces.encode(df.selectExpr("text AS original", "text"), queries.PIECE_MODEL), queries.PIECE_MODEL)
    assert all(r["decoded"] == r["original"] for r in back.collect())


def test_a_shared_run_leaves_a_common_hash(spark):
    run = " ".join(f"w{i}" for i in range(winnowing.K + winnowing.W - 1))
    rnd = random.Random(1)
    rows = [(i, " ".join(f"q{rnd.random()}" for _ in range(rnd.randint(0, 30))) + " " + run + " " + str(rnd.random())) for i in range(20)]
    df = winnowing.fingerprint(spark.createDataFrame(rows, "doc_id long, text string"), "text", "fp")
    found = [set(r["h"]) for r in df.select(winnowing.hashes("fp").alias("h")).collect()]
    assert all(a & b for a in found for b in found)


def test_next_text_across_ranges(spark):
    rows = [(i * 7 % 50, f"text {i * 7 % 50}") for i in range(50)]
    after = winnowing.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["next_text"] for r in after} == {i: f"text {i - 1 if i else 49}" for i in range(50)}


def test_rounding_keeps_the_words_of_a_source():
    rnd = np.random.default_rng(1)
    size = np.sort(rnd.integers(1, 500, 400))[::-1].astype(float)
    out = mixing.pivotal(size, np.full(400, 0.37), rnd.random(400))
    assert np.sum((out > 0) & (out < 1)) <= 1
    assert np.sum(out * size) == pytest.approx(0.37 * size.sum())


def test_mixing_reaches_its_targets_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    monkeypatch.setattr(mixing, "FAN", 3)
    rnd = random.Random(2)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 30)), rnd.choice(["a", "b", "c", None])) for i in range(900)]
    out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    taken, target = Counter(), {}
    for r in (found := out.collect()):
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    assert len(found) == 900
    for s in target:
        assert taken[s] == pytest.approx(target[s], abs=31)
    weights = dict(zip(["a", "b", "c", None], [1, 2, 3, 1], strict=True))
    total = sum(len(t.split()) for _, t, _ in rows)
    free = [s for s in target if target[s] < 2.9 * sum(len(t.split()) for _, t, x in rows if x == s)]
    assert sum(target.values()) == pytest.approx(total)
    assert len({round(target[s] / weights[s], 6) for s in free}) == 1


def test_targets_stop_at_three_times_the_source(spark):
    rows = [("a", 1000), ("b", 10), ("c", 20), (None, 500)]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    # b and c are capped at 30 and 60; the rest is shared by the weights 1 and 1.
    assert got == pytest.approx({"b": 30.0, "c": 60.0, "a": 720.0, None: 720.0})


def test_repeated_words_by_definition():
    rnd = random.Random(4)
    for _ in range(60):
        w = [rnd.choice("abc") for _ in range(rnd.randint(0, 40))]
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        text = " ".join(w)
        assert quality.text_stats(text)[4] == len(covered)
    ids = np.array([1 << 40, 5, 1 << 41] * 4) % 97
    assert quality.repeated_words(ids, 97) == 12


def test_a_rule_is_learned_and_runs_as_a_condition(spark):
    import pandas as pd

    rng = np.random.default_rng(0)
    frame = pd.DataFrame({f: rng.random(600) for f in quality.FEATURES})
    frame["quality"] = ((frame["symbol_share"] < 0.7) | (frame["variety"] < 0.5)).astype(int)
    rules = quality.learn(frame)
    kept = spark.createDataFrame(frame).select(quality.verdict(rules).alias("k"), "quality").collect()
    assert sum(r["k"] == bool(r["quality"]) for r in kept) >= 580
    assert quality.learn(frame.assign(quality=1)) == []


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_accepts_what_the_distance_allows():
    terms = [toxicity.Term("idiot", False, 1.0), toxicity.Term("disgusting", False, 1.0), toxicity.Term("bad", False, 1.0), toxicity.Term("stem", True, 1.0)]
    lexicon = toxicity.Lexicon(terms)
    rnd = random.Random(6)
    for _ in range(3000):
        word = list(rnd.choice(["idiot", "disgusting", "bad", "stemmed", "others"]))
        for _ in range(rnd.randint(0, 3)):
            k = rnd.randrange(len(word) + 1)
            word[k : k + rnd.randint(0, 1)] = rnd.choice([[], ["x"], ["i"], ["d"]])
            word = word or ["q"]
        word = "".join(word)
        best = [levenshtein(word, t.text) for t in terms[:3]]
        allowed = [0.7**d for d, t in zip(best, terms, strict=False) if d <= toxicity.edits(len(t.text))]
        if word.startswith("stem"):
            allowed.append(1.0)
        assert lexicon.hit(word)[0] == pytest.approx(max(allowed, default=0.0)), word


def test_quotation_counts_apart():
    lexicon = toxicity.Lexicon([toxicity.Term("idiot", False, 1.0)])
    said = toxicity.features('She wrote "you idiot there" in the report', lexicon, frozenset())
    meant = toxicity.features("you idiot there in the report", lexicon, frozenset())
    assert said[0] == 0 and said[1] > 0 and meant[0] > 0 and meant[1] == 0
