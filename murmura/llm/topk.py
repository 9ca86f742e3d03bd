"""Exact top-k by inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it. Vectors of a pivot, sorted by distance, are cut into
annuli; an annulus is stored as blocks of bounded size. For a query q, a pivot p and vectors at distances up to r,
q.v <= q.p + |q| r, and by the triangle inequality |q - v| >= | |q - p| - r |, so q.v <= (|q|^2 + |v|^2 - (|q - p| - r)^2) / 2.
A query first expands the annuli of the highest bounds until they hold enough vectors, which gives a k-th score; of the
other annuli it visits those whose bounds reach that score.

The pivots come from a bounded sample of vectors, every vector is indexed. Pivots and annuli are at most ANNULI + PIVOTS
for each dimension, so their limits travel with the tasks.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmura.llm._store import table

#: The lowest score, and the largest component: floats of 32 bits stay far below it.
LOWEST, MOST = -(1 << 63), 1e140
SAMPLE, PIVOTS, ANNULI, BLOCK, QUERIES = 16_384, 64, 2048, 2048, 8192

_KEYED = "vec_id long, dim int, pivot int, r double, norm double, vec binary"


def _whole(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, flat components floor(1024 x) and offsets."""
    array = batch.column("embedding")
    off = np.asarray(array.offsets).astype(np.int64)
    flat = np.asarray(array.values.slice(off[0], off[-1] - off[0])).astype(np.float64)
    return np.asarray(batch.column("vec_id")), np.floor(1024 * flat), off - off[0]


def clean(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of the vectors that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) > MOST))
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)


def _pivots(rows: list[np.ndarray]) -> np.ndarray:
    """Far points first, then a few rounds of means."""
    x = np.stack(rows)
    chosen = [x[0]]
    far = ((x - x[0]) ** 2).sum(1)
    while len(chosen) < PIVOTS and far.max() > 0:
        chosen.append(x[far.argmax()])
        far = np.minimum(far, ((x - chosen[-1]) ** 2).sum(1))
    p = np.stack(chosen)
    for _ in range(5):
        near = ((x * x).sum(1)[:, None] - 2 * x @ p.T + (p * p).sum(1)).argmin(1)
        for i in range(len(p)):
            if (near == i).any():
                p[i] = x[near == i].mean(0)
    return p


def _key(pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, flat, off = _whole(batch)
            lens = np.diff(off)
            for d in np.unique(lens):
                which = np.flatnonzero(lens == d)
                x = flat[(off[which][:, None] + np.arange(d)).ravel()].reshape(len(which), d)
                p = pivots.get(int(d), np.zeros((1, d)))
                near = ((p * p).sum(1) - 2 * x @ p.T).argmin(1)
                r = np.sqrt(((x - p[near]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[which]), pa.array(np.full(len(which), d, np.int32)), pa.array(near.astype(np.int32)), pa.array(r),
                     pa.array(np.sqrt((x * x).sum(1))), pa.array([v.tobytes() for v in x], pa.binary())], [c.split()[0] for c in _KEYED.split(", ")])

    return run


class Index:
    """Keyed vectors with their block, and what is known of each annulus: dim, pivot, annulus, least and greatest r, greatest norm, rows."""

    def __init__(self, vectors: DataFrame) -> None:
        spark = vectors.sparkSession
        good = clean(vectors)
        sample = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
        by_dim: dict[int, list[np.ndarray]] = {}
        for row in sample:
            by_dim.setdefault(len(row["embedding"]), []).append(np.floor(1024 * np.array(row["embedding"], float)))
        self.pivots = {d: _pivots(rows) for d, rows in by_dim.items()}
        keyed = table(good.mapInArrow(_key(self.pivots), _KEYED), "keyed")
        total = keyed.count()
        rows = max(BLOCK, total // ANNULI)
        # The distances at which a pivot's annuli end; equal distances share an annulus, however many they are.
        cuts = keyed.groupBy("dim", "pivot").agg(F.count("*").alias("n"), F.percentile_approx("r", [i / 64 for i in range(1, 64)], 10_000).alias("q")).collect()
        ends = {}
        for c in cuts:
            parts = min(64, -(-c["n"] // rows))
            ends[c["dim"], c["pivot"]] = sorted({c["q"][i * 64 // parts - 1] for i in range(1, parts)})
        limits = spark.createDataFrame([(d, p, e) for (d, p), e in ends.items()], "dim int, pivot int, ends array<double>")
        placed = keyed.join(F.broadcast(limits), ["dim", "pivot"]).withColumn("annulus", F.size(F.filter("ends", lambda x: x < F.col("r")))).drop("ends")
        self.annuli = placed.groupBy("dim", "pivot", "annulus").agg(
            F.min("r").alias("low"), F.max("r").alias("high"), F.max("norm").alias("norm"), F.count("*").alias("n")).toPandas()
        self.annuli["blocks"] = -(-self.annuli["n"] // BLOCK)
        sizes = spark.createDataFrame(self.annuli[["dim", "pivot", "annulus", "blocks"]].astype(int).values.tolist(), "dim int, pivot int, annulus int, blocks long")
        self.vectors = placed.join(F.broadcast(sizes), ["dim", "pivot", "annulus"]).withColumn(
            "block", F.pmod(F.xxhash64("vec_id"), F.col("blocks"))).drop("blocks")


def _bounds(own: pd.DataFrame, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The highest score that each annulus can hold for each query, with room for rounding."""
    p = p[own["pivot"].to_numpy()]
    low, high, norm = (own[c].to_numpy() for c in ("low", "high", "norm"))
    qn = np.sqrt((q * q).sum(1))[:, None]
    inner = q @ p.T
    apart = np.sqrt(np.maximum(qn**2 + (p * p).sum(1) - 2 * inner, 0))
    gap = np.maximum(np.maximum(apart - high, low - apart), 0)
    best = np.minimum(inner + qn * high, (qn**2 + norm**2 - gap**2) / 2)
    return np.maximum(best + 1 + 1e-9 * np.abs(best), LOWEST)  # scores stop there, too


def _route(annuli: pd.DataFrame, pivots: dict[int, np.ndarray], k: int, first: bool):
    """Queries to the blocks they visit: those of the highest bounds, or the others whose bounds reach the k-th score."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for d, group in pdf.groupby("dim"):
                own = annuli[annuli["dim"] == d].reset_index(drop=True)
                q = np.stack([np.frombuffer(v, float) for v in group["vec"]])
                bound = _bounds(own, pivots.get(int(d), np.zeros((1, d))), q)
                order = np.argsort(-bound, axis=1, kind="stable")
                held = np.cumsum(own["n"].to_numpy()[order], axis=1)
                start = np.zeros_like(bound, bool)
                np.put_along_axis(start, order, np.concatenate((np.zeros((len(q), 1)), held[:, :-1]), 1) <= k, 1)  # the query itself may be one
                go = start if first else ~start & (bound >= group["least"].to_numpy()[:, None])
                i, j = np.nonzero(go)
                times = own["blocks"].to_numpy()[j]
                i, j = np.repeat(i, times), np.repeat(j, times)
                block = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
                yield pd.DataFrame({
                    "q_dim": d, "q_pivot": own["pivot"].to_numpy()[j], "q_annulus": own["annulus"].to_numpy()[j], "q_block": block,
                    "query_id": group["query_id"].to_numpy()[i], "least": group["least"].to_numpy()[i], "q": group["vec"].to_numpy()[i]})

    return run


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; beyond what doubles hold exactly, by Python's integers, and beyond 64 bits the nearest of these."""
    if a.shape[1] * max(1.0, np.abs(a).max(initial=0)) * max(1.0, np.abs(b).max(initial=0)) < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in a], object) @ np.array([[int(x) for x in r] for r in b], object).T
    return np.minimum(np.maximum(whole, LOWEST), -LOWEST - 1).astype(np.int64)


def _visit(k: int):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(queries):
            vectors = vectors.sort_values("vec_id", kind="stable")
            ids = vectors["vec_id"].to_numpy()
            v = np.stack([np.frombuffer(x, float) for x in vectors["vec"]])
            for a in range(0, len(queries), 256):
                part = queries.iloc[a : a + 256]
                scores = _exact(np.stack([np.frombuffer(x, float) for x in part["q"]]), v)
                for query, least, row in zip(part["query_id"], part["least"], scores):
                    at = np.flatnonzero((ids != query) & (row >= least))
                    if len(at) > k:  # ids ascend, so a stable order settles ties
                        at = at[np.argsort(~row[at], kind="stable")[:k]]
                    out.append(pd.DataFrame({"query_id": query, "vec_id": ids[at], "score": row[at]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})

    return run


def search(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query (query_id, dim, vec) with other vectors."""
    spark = queries.sparkSession
    queries = table(queries.groupBy("query_id").agg(F.min(F.struct("dim", "vec")).alias("x")).select("query_id", "x.dim", "x.vec"), "queries")
    chunks = max(1, -(-queries.count() // QUERIES))
    chunk = F.pmod(F.xxhash64("query_id"), F.lit(chunks))
    place = ["dim", "pivot", "annulus", "block"]
    schema = "q_dim int, q_pivot int, q_annulus int, q_block long, query_id long, least double, q binary"
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def visit(asked: DataFrame, first: bool) -> DataFrame:
        routed = asked.mapInPandas(_route(index.annuli, index.pivots, k, first), schema).withColumn("q_chunk", chunk)
        # Vectors go only to the chunks of queries that visit their block; a block that none visits isn't sent anywhere.
        visited = routed.select(*(F.col(f"q_{c}").alias(c) for c in place), "q_chunk").groupBy(*place).agg(F.collect_set("q_chunk").alias("chunks"))
        vectors = index.vectors.join(visited, place).select(*place, "vec_id", "vec", F.explode("chunks").alias("chunk"))
        return (
            vectors.groupBy("dim", "pivot", "annulus", "block", "chunk")
            .cogroup(routed.groupBy("q_dim", "q_pivot", "q_annulus", "q_block", "q_chunk"))
            .applyInPandas(_visit(k), "query_id long, vec_id long, score long")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))

    start = table(visit(queries.withColumn("least", F.lit(float("-inf"))), True), "start")
    reached = start.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("least"))
    asked = queries.join(reached, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    rest = visit(asked, False)
    return start.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, k: int = 10, step: int = 100) -> DataFrame:
    """The search with vectors whose vec_id is divisible by step as queries, against all others.

    Components become floor(1024 x). Vectors that are null or hold null or non-finite components (or ones above MOST, whose
    squares doubles don't hold), and those with a null vec_id, take no part. Scores beyond 64 bits are the nearest number of
    64 bits, and so equal to others beyond. A query sees vectors of its own dimension. Rows with the same vec_id are each a candidate for
    other queries; as a query the smallest of them counts. An empty table gives no rows."""
    index = Index(vectors)
    queries = index.vectors.where(F.col("vec_id") % step == 0).select(F.col("vec_id").alias("query_id"), "dim", "vec")
    return search(index, queries, k)


ORACLE = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, v.vec_id as vec_id,
  cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * v.e[i])) as bigint) as score
  from v as q join v on q.vec_id <> v.vec_id and len(q.e) = len(v.e) where q.vec_id % 100 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10"""


def op5_topk(spark, sf_dir: str) -> DataFrame:
    """The ten highest scores of each query over all embeddings."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
