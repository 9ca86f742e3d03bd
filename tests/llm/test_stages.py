"""Every stage of the pipeline on nulls, repeated rows, empty tables, long texts and clashing columns."""
from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from murmura.llm import stages
from tests.llm.test_operators import SCHEMA, near, prose, removed

CLASHING = ("part", "perplexity", "unit", "cluster", "label", "rep", "chunk", "anchor", "row", "kept", "component_id", "n_shingles", "spans", "start", "length", "key", "__id")


def rows() -> list[tuple]:
    rng = random.Random(11)
    base = [prose(rng, 120) for _ in range(60)]
    passage = prose(rng, 80)
    texts = [*base, base[0], base[1] + " end", f"{base[2]} {passage}", f"{base[3]} {passage} tail", passage * 60, "x", " \n"]
    return [(i, t, ["en", "de", None][i % 3], "s", len(t)) for i, t in enumerate(texts)] + [
        (None, base[5], None, None, None), (None, None, None, None, None), (500, None, "en", "s", 0), (501, "", "en", "s", 0), (7, base[7], "de", "s", 1)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return where


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    for c in CLASHING:
        frame = frame.withColumn(c, F.lit("own"))
    return frame.cache()


@pytest.mark.parametrize("name,stage", stages.STAGES)
def test_empty(spark, folder, docs, name, stage):
    assert stage(spark, docs.limit(0), folder).count() == 0
    nulls = spark.createDataFrame([(None,) * 5] * 3, SCHEMA)
    assert stage(spark, nulls, folder).count() == {"quality": 0, "packing": 3}.get(name, 3)


def untouched(made, docs):
    assert made.columns == docs.columns
    assert {tuple(r) for r in made.select(*CLASHING).distinct().collect()} <= {("own",) * len(CLASHING)}


def test_quality(spark, folder, docs):
    made = stages.drop_unlikely(spark, docs, folder)
    untouched(made, docs)
    got = [(r["doc_id"], r["text"]) for r in made.collect()]
    assert all(t for _, t in got) and sum(i is not None and i < 60 for i, _ in got) >= 55
    assert got.count((7, rows()[7][1])) in (0, 2)  # repeated rows are judged alike


def test_near_duplicates(spark, folder, docs):
    made = stages.drop_near_duplicates(spark, docs, folder)
    untouched(made, docs)
    told = [r for r in rows() if r[0] is not None]
    want, _ = near(told, 5, 80)
    kept = sorted((r["doc_id"] for r in made.collect()), key=lambda i: (i is None, i or 0))
    assert kept == sorted([r[0] for r in told if want[r[0]] == r[0]]) + [None, None]
    assert kept.count(7) == 2


def test_repeats(spark, folder, docs):
    one = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    made = stages.cut_repeats(spark, one, folder)
    untouched(made, docs)
    own = [tuple(r) for r in one.select("doc_id", "text").collect()]
    told = removed(own)
    for r in made.collect():
        n, gone, *_ = told[r["doc_id"]]
        before = dict(own)[r["doc_id"]]
        assert (r["text"] is None) == (before is None)
        assert n - gone <= len((r["text"] or "").encode()) <= n
        assert gone or r["text"] == before
    whole = stages.cut_repeats(spark, docs, folder)
    assert whole.count() == docs.count() and whole.where("doc_id is null and text is not null").first()["text"] == rows()[5][1]


def test_packing(spark, folder, docs):
    made = stages.pack(spark, docs, folder).collect()
    by: dict = {}
    for r in made:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(o == sum(n for _, n in sorted(v)[:i]) for v in by.values() for i, (o, _) in enumerate(sorted(v)))
    whole = sum(r["length"] for r in made)
    assert {r["doc_id"] for r in made} == {r[0] for r in rows()} and whole > sum(len((r[1] or "").split()) for r in rows())


def test_run(spark, folder, docs):
    assert stages.run(spark, docs, folder).count() > 50
