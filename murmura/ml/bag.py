"""A student of low rank: a sentence is the mean of its words' and word pairs' embeddings, and a small head tells the label.

Words and pairs go by hash, in arrays that Spark makes once and keeps in a table. In a round every task learns from its rows,
starting from the same weights; what its steps changed is summed by embedding in Spark, weighted by rows, and the mean is
the next start. The driver holds the model alone: `features` times `rank` numbers.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from murmura.functions.text import bound
from murmura.ml.student import LABELS
from murmura.operators.candidates import class_weights
from murmura.sources.scratch import table

FEATURES, RANK, ROUNDS, BATCH, RATE = 1 << 14, 8, 6, 32, 0.25


def hashed(text: Column, features: int) -> Column:
    """The numbers of a text's words and of its pairs of neighbouring words; a null text has none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\W+"), lambda x: x != "")
    pairs = lambda w: F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return bound(words, lambda w: F.transform(F.concat(w, pairs(w)), lambda x: F.pmod(F.xxhash64(x), F.lit(features)).cast("int")))


def _given(rows: DataFrame, text: str, features: int) -> Column:
    """hashed() of a column of texts; a column of arrays holds it already."""
    return F.col(text) if isinstance(rows.schema[text].dataType, ArrayType) else hashed(F.col(text), features)


def _means(embeddings: np.ndarray, ids: np.ndarray, off: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of each row's embeddings; nothing for a row without any. n: the differences of off."""
    if n.all() and len(n):
        return np.add.reduceat(embeddings.take(ids, 0), off[:-1], axis=0) / n[:, None]
    out, full = np.zeros((len(n), embeddings.shape[1])), np.flatnonzero(n)
    if len(full):
        out[full] = np.add.reduceat(embeddings.take(ids, 0), off[full], axis=0) / n[full, None]
    return out


class Bag:
    """Embeddings, head and bias."""

    def __init__(self, embeddings: np.ndarray, head: np.ndarray, bias: np.ndarray) -> None:
        self.embeddings, self.head, self.bias = embeddings, head, bias

    @classmethod
    def fresh(cls, features: int, rank: int, seed: int = 7) -> Bag:
        rng = np.random.default_rng(seed)
        return cls(rng.uniform(-1 / rank, 1 / rank, (features, rank)), np.zeros((rank, len(LABELS))), np.zeros(len(LABELS)))

    def means(self, ids: np.ndarray, off: np.ndarray) -> np.ndarray:
        return _means(self.embeddings, ids, off, np.diff(off))

    def chances(self, means: np.ndarray) -> np.ndarray:
        z = means @ self.head + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def _ids(array: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    off = np.asarray(array.offsets).astype(np.int64)
    return np.asarray(array.values)[off[0] : off[-1]], off - off[0]


def _learn(start, rate: float, batch: int):
    """A task's change of each embedding and of the head (rows behind the embeddings), times its rows, and its rows at -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = start.value
        own = Bag(first.embeddings.copy(), first.head.copy(), first.bias.copy())
        seen, rank = 0, own.embeddings.shape[1]
        flat, across = own.embeddings.reshape(-1), np.arange(rank)
        for rows in batches:
            ids, off = _ids(rows.column("ids"))
            ids, n = ids.astype(np.int64), np.diff(off)
            least = np.maximum(n, 1)[:, None]
            truth, weights = np.eye(len(LABELS))[np.asarray(rows.column("label"))], np.asarray(rows.column("weight"))[:, None]
            seen += len(n)
            for a in range(0, len(n), batch):
                b = min(a + batch, len(n))
                part = ids[off[a] : off[b]]
                means = _means(own.embeddings, part, off[a : b + 1] - off[a], n[a:b])
                wrong = (own.chances(means) - truth[a:b]) * weights[a:b]
                back = np.repeat((wrong @ own.head.T) * (-rate / least[a:b]), n[a:b], 0)
                np.add.at(flat, (part[:, None] * rank + across).reshape(-1), back.reshape(-1))  # in one dimension, where it is fast
                own.head -= rate * (means.T @ wrong)
                own.bias -= rate * wrong.sum(0)
        if not seen:
            return
        moved = (own.embeddings - first.embeddings) * seen
        rows_moved = np.flatnonzero(np.abs(moved).any(1))
        head = np.zeros((len(LABELS) + 2, rank))
        head[: len(LABELS)] = ((own.head - first.head) * seen).T
        head[len(LABELS), : len(LABELS)] = (own.bias - first.bias) * seen
        head[-1, 0] = seen
        number = np.concatenate((rows_moved, len(moved) + np.arange(len(LABELS) + 1), [-1])).astype(np.int32)
        values = np.concatenate((moved[rows_moved], head))
        yield pa.RecordBatch.from_arrays([pa.array(number), *(pa.array(values[:, k]) for k in range(rank))], ["row", *(f"v{k}" for k in range(rank))])

    return run


def train(rows: DataFrame, text: str, features: int = FEATURES, rank: int = RANK, rounds: int = ROUNDS, rate: float = RATE, batch: int = BATCH) -> Bag:
    """The model of rows(text, pred_label); labels weigh as much as each other. Other labels and null ones don't count.

    Steps of `batch` rows grow smaller from round to round; a smaller batch learns more from few rows. text: a column of texts,
    or of hashed() that is stored, which is read again each round."""
    if rank < len(LABELS):
        raise ValueError("the rank is at least the number of labels")
    spark = rows.sparkSession
    number = F.array_position(F.array(*map(F.lit, LABELS)), F.col("pred_label")) - 1
    weight = F.lit(None).cast("double")
    for r in class_weights(rows).where(F.col("pred_label").isin(*LABELS)).collect():  # a row a label
        weight = F.when(F.col("pred_label") == r["pred_label"], r["weight"]).otherwise(weight)
    ids = _given(rows, text, features)
    data = rows.where(number >= 0).select(number.cast("int").alias("label"), weight.alias("weight"), ids.alias("ids"))
    if not isinstance(rows.schema[text].dataType, ArrayType):
        data = table(data, "features")
    model = Bag.fresh(features, rank)
    schema = "row int, " + ", ".join(f"v{k} double" for k in range(rank))
    for i in range(rounds):
        sent = spark.sparkContext.broadcast(model)
        moved = data.mapInArrow(_learn(sent, rate * (1 - i / rounds), batch), schema).groupBy("row").agg(*(F.sum(f"v{k}").alias(f"v{k}") for k in range(rank))).toPandas()  # at most features + 5 rows
        if not len(moved):
            break
        row, values = moved["row"].to_numpy(), moved[[f"v{k}" for k in range(rank)]].to_numpy()
        values = values / values[row == -1, 0][0]
        model = Bag(model.embeddings.copy(), model.head.copy(), model.bias.copy())
        inside = (row >= 0) & (row < features)
        model.embeddings[row[inside]] += values[inside]
        for k in range(len(LABELS)):
            model.head[:, k] += values[row == features + k][0]
        model.bias += values[row == features + len(LABELS)][0, : len(LABELS)]
        sent.unpersist()
    return model


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, off = _ids(rows.column("__ids"))
            p = model.value.chances(model.value.means(ids, off)).astype(np.float32)
            best = p.argmax(1)
            kept = [c for c in rows.schema.names if c != "__ids"]
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in kept), pa.array(best.astype(np.int16)), pa.array(LABELS, pa.string()).take(pa.array(best)), pa.array(p.max(1, initial=0)), *(pa.array(p[:, k]) for k in range(len(LABELS)))],
                [*kept, "pred_id", "pred_label", "confidence", *(f"p_{x.lower()}" for x in LABELS)])

    return run


def predict(model: Bag, rows: DataFrame, text: str) -> DataFrame:
    """rows with pred_id, pred_label, confidence, p_neg, p_neu, p_pos; a null or wordless text has the chances of the bias.

    text: a column of texts, or of hashed() that is stored, which is left out."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    ids = _given(rows, text, len(model.embeddings)).alias("__ids")
    rest = rows.drop(text) if isinstance(rows.schema[text].dataType, ArrayType) else rows
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields), "pred_id short, pred_label string, confidence float, p_neg float, p_neu float, p_pos float"])
    return rows.select(*rest.columns, ids).mapInArrow(_predict(sent), schema)
