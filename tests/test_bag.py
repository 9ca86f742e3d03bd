"""The student of low rank: what it learns, and its edges."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from murmura.ml import bag, student


def test_learns(spark):
    rows = spark.createDataFrame([(f"{w} thing number {i}", x) for i in range(60) for w, x in (("good", "POS"), ("bad", "NEG"), ("plain", "NEU"), ("not good", "NEG"))], "sentence string, pred_label string").repartition(3)
    model = bag.train(rows, "sentence", features=1024, rounds=12, batch=8)
    got = bag.predict(model, rows.withColumnRenamed("pred_label", "truth"), "sentence")
    assert got.where("truth = pred_label").count() >= 235
    assert got.where("abs(p_neg + p_neu + p_pos - 1) > 1e-5 or confidence <> greatest(p_neg, p_neu, p_pos)").count() == 0


def test_beats_the_regression_on_pairs(spark):
    """Held-out sentences of which a label hangs on words of low frequency."""
    rng = np.random.default_rng(2)
    good, poor = [f"g{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    made = []
    for i in range(1500):
        own, label = [(good, "POS"), (poor, "NEG"), ([], "NEU")][i % 3]
        words = [*(f"w{k}" for k in rng.integers(0, 200, 8)), *([own[rng.integers(0, 40)]] if own else [])]
        rng.shuffle(words)
        made.append((i, " ".join(words), label))
    rows = spark.createDataFrame(made, "id int, sentence string, pred_label string").repartition(4)
    learn, held = rows.where("id % 5 <> 0"), rows.where("id % 5 = 0").withColumnRenamed("pred_label", "truth")
    one = bag.predict(bag.train(learn, "sentence", rounds=15, rate=2.0, batch=16), held, "sentence").where("truth = pred_label").count()
    two = student.predict(student.train(learn, "sentence", features=1 << 14, iterations=20), held).where("truth = pred_label").count()
    assert one > two and one > 170, (one, two)


def test_edges(spark):
    rows = spark.createDataFrame([("a b", "POS"), (None, "NEG"), ("", None), ("x", "other")], "sentence string, pred_label string")
    model = bag.train(rows, "sentence", features=64, rounds=2)
    got = bag.predict(model, rows.drop("pred_label").withColumn("pred", F.lit(1)), "sentence").collect()
    assert len(got) == 4 and all(abs(r["p_neg"] + r["p_neu"] + r["p_pos"] - 1) < 1e-5 for r in got)
    assert bag.predict(model, rows.limit(0).drop("pred_label"), "sentence").count() == 0
    assert np.isfinite(bag.train(rows.limit(0), "sentence", features=64, rounds=2).embeddings).all()
    with pytest.raises(ValueError, match="rank"):
        bag.train(rows, "sentence", rank=2)


def test_words_are_hashed_once(spark, monkeypatch):
    from murmura.plans import lexicon

    calls, real = [], bag.hashed
    monkeypatch.setattr(bag, "hashed", lambda *a: calls.append(a) or real(*a))
    got = lexicon.QUERIES["student_predict"][0](spark, "/root/testdata/sf0.001")
    assert len(calls) == 1
    assert got.columns == ["doc_id", "sentence_idx", "sentence", "pred_id", "pred_label", "confidence", "p_neg", "p_neu", "p_pos"]


@pytest.mark.parametrize("batch", [1, 3, 32])
def test_steps_by_brute_force(batch):
    """Rows without words, with words that stand several times, and words that rows share."""
    features, rank, rate = 50, 4, 0.1
    rng = np.random.default_rng(3)
    rows = [rng.integers(0, features, n).tolist() for n in (0, 5, 0, 1, 30, 2, 0, 0, 7, 3, 0)] + [[4, 4, 4, 9]]
    labels, weights = rng.integers(0, 3, len(rows)), rng.random(len(rows)) + 0.5

    class Sent:
        value = bag.Bag.fresh(features, rank)

    given = pa.RecordBatch.from_arrays([pa.array(labels.astype(np.int32)), pa.array(weights), pa.array(rows, pa.list_(pa.int32()))], ["label", "weight", "ids"])
    told = next(bag._learn(Sent, rate, batch)(iter([given.slice(0, 5), given.slice(5)])))
    own, head, bias = Sent.value.embeddings.copy(), Sent.value.head.copy(), Sent.value.bias.copy()
    for start, end in ((0, 5), (5, len(rows))):
        for a in range(start, end, batch):
            grads, heads, biases = np.zeros_like(own), np.zeros_like(head), np.zeros_like(bias)
            for i in range(a, min(a + batch, end)):
                mean = own[rows[i]].mean(0) if rows[i] else np.zeros(rank)
                z = np.exp(mean @ head + bias)
                wrong = (z / z.sum() - np.eye(3)[labels[i]]) * weights[i]
                for w in rows[i]:
                    grads[w] += head @ wrong / len(rows[i])
                heads += np.outer(mean, wrong)
                biases += wrong
            own, head, bias = own - rate * grads, head - rate * heads, bias - rate * biases
    at = np.asarray(told.column("row"))
    values = np.stack([np.asarray(told.column(f"v{k}")) for k in range(rank)], 1) / len(rows)
    inside = (at >= 0) & (at < features)
    moved = np.zeros_like(own)
    moved[at[inside]] = values[inside]
    np.testing.assert_allclose(moved, own - Sent.value.embeddings, atol=1e-12)
    np.testing.assert_allclose(np.stack([values[at == features + k][0] for k in range(3)], 1), head, atol=1e-12)
    np.testing.assert_allclose(values[at == features + 3][0][:3], bias, atol=1e-12)
    assert values[at == -1, 0] == 1
