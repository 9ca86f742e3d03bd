"""Clusters, resampling and mixing against brute force, on edge cases."""
from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmura.llm import kmeans, mixing, resampling
from murmura.llm._ranks import ranked
from tests.llm.test_operators import SCHEMA, WORD, corpus

FEATURE = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def clashing(frame):
    for c in ("key", "grp", "rank", "row", "bucket", "cluster", "target", "__at", "__part"):
        frame = frame.withColumn(c, F.lit(1))
    return frame


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    odd = [(None, "alpha beta", "en", "s0", 10), (None, "alpha beta", "en", "s0", 10), (7, "x " * 3000, "en", "s0", 6000), (7, "x " * 3000, "en", "s0", 6000)]
    return corpus() + odd + [(1000 + i, " ".join(rng.choice(["one", "two", "Three", "vier", "cinq"]) for _ in range(rng.randrange(1, 60))), "en", rng.choice(["s1", "", None, "Z", "é"]), 0) for i in range(200)]


def test_ranks(spark):
    frame = spark.createDataFrame([(i * 7 % 500, i) for i in range(500)], "x long, y long").repartition(7)
    assert sorted((r["rank"], r["x"]) for r in ranked(frame, [F.desc("x")]).collect()) == [(500 - x, x) for x in range(499, -1, -1)]
    assert ranked(frame.where("x < 0"), [F.desc("x")]).count() == 0


# Clusters


def lloyd(vectors, clusters, rounds, seed):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors]
    order = sorted(range(len(kept)), key=lambda j: (hashlib.sha256(f"{seed}:{'' if kept[j][0] is None else kept[j][0]}".encode()).hexdigest(), vectors[j][1]))
    centroids = [kept[j][1] for j in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(own[k]) for x in zip(*own[k])] if own[k] else c for k, c in enumerate(centroids)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    sums = Counter()
    for _, k, d in found:
        sums[k] += d
    low = lambda v: min(v, kmeans.LONG)
    return [(i, k, low(d), low(sum(min(x, kmeans.LONG) for _, j, x in found if j == k)), low(sum(min(x, kmeans.LONG) for _, _, x in found)),
             hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()) for i, k, d in found]


def vectors(n, d, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(5, d))
    x = base[rng.integers(0, 5, n)] + rng.normal(size=(n, d)) * 0.2
    x[: n // 3] = x[0]  # a third are alike
    return [(int(i), [float(v) for v in r]) for i, r in enumerate(x)]


@pytest.mark.parametrize("n,d,k,block,net", [(400, 6, 8, 2048, 128), (400, 6, 8, 64, 8), (300, 1, 20, 100, 30), (5, 3, 8, 2048, 128), (1, 2, 3, 2048, 128)])
def test_clusters(spark, monkeypatch, n, d, k, block, net):
    monkeypatch.setattr(kmeans, "BLOCK", block)
    own = vectors(n, d)
    frame = clashing(spark.createDataFrame(own, "vec_id long, embedding array<double>").repartition(3)).drop("label")
    got = kmeans.cluster(frame, k, 4, 3, d)
    assert sorted(map(tuple, got.collect())) == sorted(lloyd(own, k, 4, 3))


def test_clusters_edges(spark):
    schema = "vec_id long, embedding array<double>"
    assert kmeans.cluster(spark.createDataFrame([], schema), components=2).count() == 0
    good = [(None, [0.5, 1.0]), (None, [0.5, 1.0]), (3, [0.5, 1.0]), (3, [-0.25, 7.0]), (4, [1e30, -1e30]), (5, [1e30, 1e17]), (6, [1e17, 3.0]), (9, [-0.0, 0.0])]
    bad = [(1, None), (2, [1.0]), (7, [None, 1.0]), (8, [float("nan"), 1.0]), (10, [float("inf"), 1.0]), (11, [1e308, 0.0]), (12, [1.0, 2.0, 3.0])]
    for k in (2, 3, 8, 20):
        got = kmeans.cluster(spark.createDataFrame(good + bad, schema).repartition(2), k, 5, 3, 2)
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
        assert sorted(map(tuple, got.collect()), key=key) == sorted(lloyd(good, k, 5, 3), key=key)


def test_cover_tree():
    x = np.array([v for _, v in vectors(300, 4, 2)]) * 1000
    order, tree = kmeans.cover_tree(x, 40)
    assert sorted(order) == list(range(300)) and tree.after[0] == len(tree.begin) and (tree.begin[0], tree.end[0]) == (0, 300)
    for node in range(len(tree.begin)):
        own = x[order[tree.begin[node] : tree.end[node]]]
        assert len(own) and np.sqrt(((own - tree.centre[node]) ** 2).sum(1)).max() <= tree.radius[node] * (1 + 1e-6) + 1e-6
        kids, _ = tree.children(np.array([node]))
        if len(kids):
            assert [tree.begin[node], *tree.end[kids][:-1]] == tree.begin[kids].tolist() and tree.end[kids][-1] == tree.end[node]


def test_pairs_are_pruned(spark):
    """Far groups are given away by node, without a look at their vectors."""
    x = np.repeat(np.array([[0.0, 0], [1e5, 0], [0, 1e5]]), 100, 0) + np.arange(300)[:, None] % 7
    _, block = kmeans.Block.build(x)
    nodes, got = block.assign(kmeans.Centroids([[0, 0], [100_000, 0], [0, 100_000]]))
    assert (got == -1).all() and sum(int(block.tree.end[n] - block.tree.begin[n]) for n, _ in nodes) == 300


# Resampling


def features(text):
    words = FEATURE.findall((text or "").translate({i: i + 32 for i in range(65, 91)}).encode())
    return len(words), [zlib.crc32(f) % 10_000 for f in [*words, *(b" ".join(p) for p in zip(words, words[1:]))]]


def resampled(rows, target, share, least, seed):
    own = [(r[0], *features(r[1])) for r in rows]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000)))) for b in s}
    out = []
    for i, n, f in own:
        w = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    rank = {id(r): k + 1 for k, r in enumerate(able[: share * len(able) // 100])}
    return [(*r[:4], rank.get(id(r))) for r in out]


def order(r):
    return tuple((v is None, v or 0) for v in r)


@pytest.mark.parametrize("share,least", [(25, 20), (100, 1), (1, 0)])
def test_resampling(spark, rows, share, least):
    target = ["alpha1 beta2", None, "two vier", "日本7 épsilon3 A-B"]
    docs = clashing(spark.createDataFrame(rows, SCHEMA).repartition(5))
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(docs, wanted, share, least)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(resampled(rows, target, share, least, 7), key=order)


def test_resampling_edges(spark):
    none, empty = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "text string")
    assert resampling.resample(none, empty).count() == 0
    rows = [(None, None, None, None, None), (1, "", None, None, 0), (2, " .-! ", None, None, 0), (3, "word" * 50_000 + " a" * 30, None, None, 0)]
    got = resampling.resample(spark.createDataFrame(rows, SCHEMA), empty, 100, 1)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(resampled(rows, [], 100, 1, 7), key=order)


# Mixing


def wanted(sizes, weights=(5, 2, 1), most=3):
    own = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    full: set = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        level = left / (sum(w for s, w in own.items() if s not in full) or 1)
        above = {s for s in own if s not in full and own[s] * level > most * sizes[s]}
        if not above:
            return {s: float(most * sizes[s]) if s in full else own[s] * level for s in own}
        full |= above


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_mixing(spark, rows, broadcast, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST", broadcast)
    got = mixing.mix(clashing(spark.createDataFrame(rows, SCHEMA).repartition(4))).collect()
    size = [len(WORD.findall((r[1] or "").encode())) for r in rows]
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], n) for r, n in zip(rows, size))
    sizes = Counter()
    for r, n in zip(rows, size):
        sizes[r[3]] += n
    told = wanted(sizes)
    source = {(r[0], n): r[3] for r, n in zip(rows, size)}
    taken, longest = Counter(), defaultdict(int)
    for r in got:
        s = source[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(told[s])
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
        longest[s] = max(longest[s], r["size"])
    for s in told:
        assert abs(taken[s] - told[s]) <= 0.5 * longest[s] + 1e-6
    assert sorted(map(tuple, mixing.mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(9)).collect()), key=order) == sorted(map(tuple, got), key=order)


def test_mixing_is_nested(spark):
    """A larger budget takes what a smaller one does, as thresholds grow."""
    rows = [(i, "w " * (1 + i % 9), None, f"s{i % 2}", 0) for i in range(600)]
    frame = spark.createDataFrame(rows, SCHEMA)
    small, large = ({r["doc_id"]: r["taken"] for r in mixing.mix(frame, share=x, passes=1).collect()} for x in (0.3, 0.6))
    assert sum(small.values()) < sum(large.values()) and sum(small[i] > large[i] for i in small) <= 2  # rows at a threshold


def test_mixing_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(none).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, 0), (2, " ", None, "a", 0), (None, "", None, "", 0)], SCHEMA)
    assert {(r["doc_id"], r["size"], r["target"], r["taken"]) for r in mixing.mix(blank).collect()} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0), (None, 0, 0.0, 0)}
    alike = spark.createDataFrame([(None, "one two", None, "a", 7)] * 500 + [(1, "x " * 1000, None, "b", 0)], SCHEMA).repartition(6)
    got = mixing.mix(alike).collect()
    by = Counter()
    for r in got:
        by[r["size"]] += r["taken"]
    assert by[2] == pytest.approx(2000 * 5 / 7, abs=2) and by[1000] in (0, 1000)
    alone = mixing.mix(spark.createDataFrame([(1, "a b c", None, "a", 5)], SCHEMA)).collect()
    assert [(r["target"], r["taken"]) for r in alone] == [(3.0, 3)]
