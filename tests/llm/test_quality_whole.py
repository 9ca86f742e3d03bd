"""The registered quality query against brute force over a whole table: model, perplexities and thresholds."""
from __future__ import annotations

import math
import struct
from collections import Counter, defaultdict

import pytest
import xxhash

from murmura.llm import quality

SF = "/root/testdata/sf0.001"


def spark_hash(i: int) -> int:
    h = xxhash.xxh64(struct.pack("<q", i), seed=42).intdigest()
    return h - (1 << 64) if h >> 63 else h


class KneserNey:
    """By the textbook, with contexts as texts; "" stands before and after a text."""

    def __init__(self, texts: list[str]) -> None:
        k = quality.ORDER
        self.grams = [Counter() for _ in range(k + 1)]
        for t in texts:
            self.grams[k].update(self.of(t))
        for n in range(k - 1, 0, -1):
            self.grams[n].update(g[1:] for g in self.grams[n + 1])
        self.contexts: dict = {}
        self.cuts = [None]
        for n in range(1, k + 1):
            c = Counter(self.grams[n].values())
            y = c[1] / (c[1] + 2 * c[2])
            assert c[1] and c[2] and c[3]
            self.cuts.append([min(max(i - (i + 1) * y * c[i + 1] / c[i], 0.01), i - 0.01) for i in (1, 2, 3)])
            sums = defaultdict(lambda: [0, 0.0])
            for g, x in self.grams[n].items():
                sums[g[:-1]][0] += x
                sums[g[:-1]][1] += self.cuts[n][min(x, 3) - 1]
            self.contexts |= {(n, g): (total, cut / total) for g, (total, cut) in sums.items()}
        self.known: dict = {}

    @staticmethod
    def of(text: str) -> list[tuple]:
        full = [""] * (quality.ORDER - 1) + list(text) + [""]
        return [tuple(full[i : i + quality.ORDER]) for i in range(len(text) + 1)]

    def p(self, g: tuple) -> float:
        if not g:
            return 1 / (len(self.grams[1]) + 1)
        if g not in self.known:
            n, held = len(g), self.contexts.get((len(g), g[:-1]))
            if held is None:
                self.known[g] = self.p(g[1:])
            else:
                c = self.grams[n][g]
                self.known[g] = (c - self.cuts[n][min(c, 3) - 1] if c else 0) / held[0] + held[1] * self.p(g[1:])
        return self.known[g]


def test_whole_query(spark, monkeypatch):
    monkeypatch.setattr(quality, "LEAST", 5)
    docs = [(r["doc_id"], r["text"] or "", r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    judged = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        judged[r["doc_id"]].append(r["quality"])
    trusted = {i for i, q in judged.items() if i is not None and min(q) == 1}
    learnt = {i for i in trusted if spark_hash(i) % 5}
    model = KneserNey([t for i, t, _ in docs if i in learnt and t])
    own = model.grams[quality.ORDER]
    average = sum(c * math.log2(model.p(g)) for g, c in own.items()) / own.total()
    told = {}
    for i, t, lang in docs:
        if t:
            s = sum(math.log2(model.p(g)) for g in model.of(t))
            told[i] = 2 ** (-(s + quality.PRIOR * average) / (len(t) + 1 + quality.PRIOR))
    held = defaultdict(list)
    for i, _, lang in docs:
        if i in trusted - learnt and i in told:
            held[None].append(told[i])
            held[lang or ""].append(told[i])
    limits = {k: sorted(v)[max(0, math.ceil(quality.QUANTILE * len(v)) - 1)] for k, v in held.items() if k is None or (k and len(v) >= 5)}
    assert len(limits) > 1  # languages have thresholds of their own
    got = {r["doc_id"]: r for r in quality.op9_quality(spark, SF).collect()}
    assert len(got) == len(docs)
    for i, t, lang in docs:
        limit = limits.get(lang, limits[None])
        assert got[i]["threshold"] == pytest.approx(limit)
        if not t:
            assert got[i]["perplexity"] is None and not got[i]["kept"]
        else:
            assert got[i]["perplexity"] == pytest.approx(told[i])
            if told[i] != pytest.approx(limit):
                assert got[i]["kept"] == (told[i] <= limit)
