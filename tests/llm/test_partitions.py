"""Results don't depend on how the input is dealt to partitions, in which order rows come, or whether a caller coalesces."""
from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from murmura.llm import fingerprint, hmm, kmeans, licences, merge_dropout, minhash, mixing, packing, quality, resampling, suffix_dedup, topk, warc
from tests.llm.test_operators import SCHEMA, corpus


def labels(spark):
    return spark.createDataFrame([(i * 3 - 5, int(i % 7 > 0)) for i in range(60)], "doc_id long, quality int")


def vectors(d):
    return d.select(F.col("doc_id").alias("vec_id"), F.array(*(F.crc32(F.concat(F.coalesce("text", F.lit("")), F.lit(str(i))).cast("binary")) / 2.0**32 for i in range(4))).alias("embedding"))


OPERATORS = {
    "fingerprints": lambda s, d: fingerprint.fingerprints_of_edits(d),
    "merge_dropout": lambda s, d: merge_dropout.encode(d),
    "suffix_dedup": lambda s, d: suffix_dedup.removed_spans(d),
    "without_repeats": lambda s, d: suffix_dedup.without_repeats(d),
    "licences": lambda s, d: licences.scan(d.withColumn("text", F.concat("text", F.lit(" Licensed under the MIT License. see")))),
    "hmm": lambda s, d: hmm.scores(d, rounds=1),
    "quality": lambda s, d: quality.classify(d, labels(s)),
    "minhash": lambda s, d: minhash.near_duplicates(d),
    "warc": lambda s, d: warc.read_records(warc.write_archives(d.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html")))),
    "topk": lambda s, d: topk.top_k(vectors(d), k=5, step=10),
    "kmeans": lambda s, d: kmeans.cluster(vectors(d), 5, components=4),
    "resampling": lambda s, d: resampling.resample(d, d.where("doc_id % 2 = 0"), least=3),
    "mixing": lambda s, d: mixing.mix(d),
}


def plain(df) -> list:
    return sorted(repr([round(v, 6) if isinstance(v, float) else bytes(v) if isinstance(v, bytearray) else v for v in r]) for r in df.collect())


@pytest.fixture(scope="module")
def dealt(spark):
    """The same rows in one partition, three, 64, and in another order."""
    rows = corpus()
    mixed = random.Random(2).sample(rows, len(rows))
    make = lambda r, n: spark.createDataFrame(spark.sparkContext.parallelize(r, n), SCHEMA)
    return {"one": make(rows, 1), "three": make(rows, 3), "many": make(mixed, 64)}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_rows_are_the_same(spark, dealt, name):
    made = OPERATORS[name]
    want = plain(made(spark, dealt["one"]))
    assert want
    assert plain(made(spark, dealt["three"])) == want
    assert plain(made(spark, dealt["many"])) == want
    assert plain(made(spark, dealt["many"]).coalesce(2)) == want


@pytest.mark.parametrize("deal,tasks", [("one", 1), ("three", 3), ("many", 64), ("many", 2), ("many", 6)])
def test_sequences_stay_apart(dealt, deal, tasks):
    got = packing.pack(dealt[deal], with_ids=False).coalesce(tasks).toPandas()
    whole = packing.pack(dealt["one"], with_ids=False).toPandas()
    assert got.groupby("doc_id")["length"].sum().equals(whole.groupby("doc_id")["length"].sum())
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part["offset"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]]
        assert part["length"].sum() <= packing.CAPACITY
