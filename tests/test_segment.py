"""Words of scripts without spaces against brute force."""
from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from murmura.operators import matching, segment

HAN = "天地玄黄"


def ways(text: str):
    for cuts in itertools.product((0, 1), repeat=len(text) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(text)]
        yield [text[a:b] for a, b in zip(at, at[1:])]


def best(text: str, counts: dict[str, int]) -> list[str]:
    """The way of least cost among all; of equal ones that with the longer words at the end."""
    total = sum(counts.values())
    cost = lambda w: round(-1000 * math.log(counts[w] / total)) if w in counts else round(-1000 * math.log(0.5 / total)) if len(w) == 1 else math.inf
    return min(ways(text), key=lambda way: (sum(map(cost, way)), [-len(w) for w in reversed(way)]))


@pytest.mark.parametrize("seed", range(4))
def test_best_ways(seed):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(HAN) for _ in range(rng.randrange(1, k)))
    counts = {word(5): rng.choice([1, 1, 5, 40]) for _ in range(14)}
    texts = [word(10) for _ in range(40)]
    text, at = matching.points(pa.array(texts))
    ends = segment.Lexicon(list(counts), list(counts.values())).cut(text, at)
    for t, a in zip(texts, at):
        cut = [0, *(np.flatnonzero(ends[a : a + len(t)]) + 1).tolist()]
        assert [t[i:j] for i, j in zip(cut, cut[1:])] == best(t, counts)


def test_words(spark):
    counts = {"天地": 50, "玄黄": 40, "天": 5, "地玄": 3}
    known = spark.createDataFrame([*counts.items(), ("", 9), ("日", 0), ("天地", 10)], "word string, n long")
    rows = [(1, "Ab天地玄黄c_1 x, 天地玄"), (2, None), (3, ""), (4, "天"), (5, "only Latin été"), (6, "天地" * 20_000)]
    got = {r["doc_id"]: r["words"] for r in segment.words(spark.createDataFrame(rows, "doc_id int, text string").repartition(2), "text", known, least=1).collect()}
    assert got == {1: ["ab", "天地", "玄黄", "c_1", "x", "天地", "玄"], 2: None, 3: [], 4: ["天"], 5: ["only", "latin", "été"], 6: ["天地"] * 20_000}
    short = segment.words(spark.createDataFrame(rows[:1], "doc_id int, text string"), "text", known)
    assert {(r["term"], r["tf"], r["df"]) for r in segment.word_counts(short, stop=("c_1",)).collect()} == {("ab", 1, 1), ("天地", 2, 1), ("玄黄", 1, 1)}
    nothing = segment.words(spark.createDataFrame(rows[:1], "doc_id int, text string"), "text", known.limit(0), least=1)
    assert nothing.first()["words"] == ["ab", *"天地玄黄", "c_1", "x", *"天地玄"]
    assert segment.words(spark.createDataFrame([], "doc_id int, text string"), "text", known).count() == 0


def test_dictionary(spark):
    rng = random.Random(4)
    vocabulary = ["天地", "玄黄", "宇宙洪", "荒", "日月"]
    texts = ["".join(rng.choices(vocabulary, k=12)) + ("。abc" if i % 3 else "") for i in range(60)] + [None, ""]
    counts, left, right = Counter(), defaultdict(set), defaultdict(set)
    for t in texts:
        for r in re.findall("[一-鿿]+", t or ""):
            for k in range(1, 5):
                for i in range(len(r) - k + 1):
                    w = r[i : i + k]
                    counts[w] += 1
                    left[w].add(r[i - 1] if i else "")
                    right[w].add(r[i + k : i + k + 1])
    total = sum(n for w, n in counts.items() if len(w) == 1)
    want = {w: n for w, n in counts.items() if len(w) == 1 or (n >= 5 and len(left[w]) >= 2 and len(right[w]) >= 2 and all(
        n * total >= 4.0 * counts[w[:i]] * counts[w[i:]] for i in range(1, len(w))))}
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").repartition(3)
    learnt = segment.dictionary(frame, "text", cohesion=4.0)
    assert {r["word"]: r["n"] for r in learnt.collect()} == want and set(vocabulary) <= set(want)
    parted = segment.words(frame.where("text <> ''"), "text", learnt, least=1)
    cut = [w for r in parted.collect() for w in r["words"] if w != "abc"]
    assert sum(w in vocabulary for w in cut) > 0.95 * len(cut)
    assert segment.dictionary(frame.limit(0), "text").count() == 0


@pytest.mark.parametrize("repeated", [False, True])
def test_counts(spark, repeated, monkeypatch):
    """r04 F2: words are counted where they stand, so what is shuffled has no keys; repeated and null keys count as before."""
    monkeypatch.setattr(segment, "COUNTED", 30)
    known = spark.createDataFrame([("天地", 50), ("玄黄", 40), ("天", 5)], "word string, n long")
    rows = [(1, "Ab天地玄黄 天地 x"), (2, "天地" * 9), (3, None), (4, ""), (5, "ab, 玄黄玄黄"), (None, "ab 天地")]
    rows += [(1, "天地 cd"), (2, "cd"), (None, "天地")] * repeated
    frame = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    out = segment.counts(frame, "text", known)
    want = segment.word_counts(segment.words(frame, "text", known))
    got = {(r["term"], r["tf"], r["df"]) for r in out.collect()}
    assert got == {(r["term"], r["tf"], r["df"]) for r in want.collect()}
    assert got >= {("ab", 3, 3), ("玄黄", 3, 2), ("天地", 14 if repeated else 12, 3)}
    if not repeated:
        assert "doc_id" not in out._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]


@pytest.mark.parametrize("letters", [HAN, "".join(map(chr, range(0x4E00, 0x4E50)))])
def test_best_ways_of_many_characters(letters, monkeypatch):
    """Nodes' children by bits (at most 64 characters) or by their keys; runs of one character among them, words longer than runs."""
    monkeypatch.setattr(matching, "STEPS", 0)
    rng = random.Random(7)
    word = lambda k: "".join(rng.choice(letters) for _ in range(rng.randrange(1, k)))
    texts = [word(10) for _ in range(40)]
    counts = {t[i : i + k]: rng.choice([1, 1, 5, 40]) for t in texts for k in (1, 2, 3, 4) for i in range(0, len(t) - k, 3)} | {c: 1 for c in letters} | {letters[0] * 30: 9}
    known = segment.Lexicon(list(counts), list(counts.values()))
    text, at = matching.points(pa.array(texts))
    ends = known.cut(text, at)
    assert (known.known.children is None) == (len(letters) > 64)
    for t, a in zip(texts, at):
        cut = [0, *(np.flatnonzero(ends[a : a + len(t)]) + 1).tolist()]
        assert [t[i:j] for i, j in zip(cut, cut[1:])] == best(t, counts)
