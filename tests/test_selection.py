"""Quantiles against sorting."""
from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from murmura.operators import selection

POINTS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def quantile(values: list[float], p: float) -> float:
    at = p * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low if low == high else low + (high - low) * (at - math.floor(at))


def many() -> list[tuple]:
    rng = random.Random(8)
    spread = [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(400)]
    near = [0.5 + rng.random() * 1e-9 for _ in range(600)] + [0.7] * 300
    small = [2.0**k * (1 + s * 2.0**-52) for k in range(-4, 4) for s in (-1, 0, 1)] + [5e-324, -5e-324, 0.0, -0.0]
    rows = [("spread", x) for x in spread] + [("near", x) for x in near] + [("small", x) for x in small] + [(None, rng.random()) for _ in range(5)] + [("one", 3.0), ("none", None), ("one", None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most,parts,first", [(100_000, 65_536, 4096), (3, 65_536, 4096), (3, 8, 2)])
def test_quantiles(spark, most, parts, first, monkeypatch):
    monkeypatch.setattr(selection, "PARTS", parts)
    monkeypatch.setattr(selection, "FIRST", first)
    rows = many()
    frame = spark.createDataFrame(rows, "k string, x double").repartition(3)
    want = defaultdict(list)
    for k, x in rows:
        want[k] += [] if x is None else [x]
    got = {r["k"]: r["q"] for r in selection.quantiles(frame, "x", POINTS, ["k"], most).collect()}
    assert got == {k: [quantile(sorted(v), p) for p in POINTS] if v else None for k, v in want.items()}
    every = sorted(x for _, x in rows if x is not None)
    assert selection.quantiles(frame, "x", POINTS, None, most).first()["q"] == [quantile(every, p) for p in POINTS]


def test_quantiles_edges(spark):
    none = spark.createDataFrame([], "x double")
    assert [r["q"] for r in selection.quantiles(none, "x", POINTS).collect()] == [None]
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (1.0,), (None,)], "x double")
    got = selection.quantiles(odd, "x", [0.0, 1 / 3, 2 / 3, 1.0]).first()["q"]
    assert got[0] == float("-inf") and got[1] == 1.0 and got[2] == float("inf") and math.isnan(got[3])


def test_buckets_keep_the_order(spark):
    values = sorted(x for _, x in many() if x is not None)
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double")
    keys = [r[0] for r in frame.orderBy("i").select(selection.bucket(F.col("x"))).collect()]
    assert keys == sorted(keys)
