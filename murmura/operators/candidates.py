"""Which rows a teacher sees: single-aspect rows, deterministic samples, shards and training sets.

Samples order rows by a hash, so that they are the same in every run and on every number of machines."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmura.functions.hashing import number, shard


def limit_each(rows: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= n).drop("__k")


def single(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows that no other shares the key with."""
    return rows.withColumn("__n", F.count("*").over(Window.partitionBy(*key))).where("__n = 1").drop("__n")


def sample(rows: DataFrame, key: list[str], n: int, seed: str = "") -> DataFrame:
    """n rows by hash of the key."""
    return rows.orderBy(number(F.lit(seed), *(F.col(k).cast("string") for k in key)), *key).limit(n)


def sharded(rows: DataFrame, key: list[str], n: int) -> DataFrame:
    return rows.withColumn("shard", shard(n, *(F.col(k).cast("string") for k in key)))


def confident(rows: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Rows at or above their label's threshold."""
    return rows.where(reduce(lambda a, b: a | b, ((F.col("pred_label") == k) & (F.col("confidence") >= t) for k, t in thresholds.items())))


def balanced(rows: DataFrame, key: list[str], n: int) -> DataFrame:
    """Up to n rows of each label by hash."""
    w = Window.partitionBy("pred_label").orderBy(number(*(F.col(k).cast("string") for k in key)), *key)
    return rows.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= n).drop("__k")


def repeated(rows: DataFrame, label: str, times: int) -> DataFrame:
    """Each row of a label so many times, numbered."""
    return rows.where(F.col("pred_label") == label).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def training_set(rows: DataFrame, key: list[str], thresholds: dict[str, float], n: int, times: int) -> DataFrame:
    """Confident rows, as many as n of each label but all NEG, these repeated."""
    sure = confident(rows, thresholds)
    others = sure.where(F.col("pred_label") != "NEG").withColumn("__h", number(*(F.col(k).cast("string") for k in key)))
    # The rank orders one hash and the keys, worked out once a row; only n rows of a partition and label reach the shuffle.
    w = Window.partitionBy("pred_label").orderBy("__h", *key)
    few = others.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= n).drop("__k", "__h")
    return few.withColumn("copy", F.lit(0)).unionByName(repeated(sure, "NEG", times))


def split(rows: DataFrame, key: list[str]) -> DataFrame:
    """is_valid for a fifth of fewer than 500 rows, else for 200 or a twentieth, by hash."""
    hashed = rows.withColumn("__h", number(*(F.col(k).cast("string") for k in key)))
    # The cut-off hash is found by counts of its upper half and then of the lower one (65,536 rows at most), so that no
    # task sorts or holds the chosen rows; only of those with just this hash some are chosen by key.
    upper = F.shiftright("__h", 16)
    counts = hashed.groupBy(upper.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()
    total = sum(r["n"] for r in counts)
    left = int(total * 0.2) if total < 500 else max(200, int(total * 0.05))
    for r in counts:
        if left <= r["n"]:
            break
        left -= r["n"]
    else:
        return rows.withColumn("is_valid", F.lit(total > 0))
    within = hashed.where(upper == r["p"]).groupBy("__h").agg(F.count("*").alias("n")).orderBy("__h").collect()
    for h in within:
        if left <= h["n"]:
            break
        left -= h["n"]
    at = hashed.where(F.col("__h") == h["__h"])
    tied = at.orderBy(*key).limit(left).select(*key, F.lit(True).alias("__tied"))
    out = hashed.where(F.col("__h") != h["__h"]).withColumn("is_valid", F.col("__h") < h["__h"])
    return out.unionByName(at.join(tied, key, "left").withColumn("is_valid", F.coalesce("__tied", F.lit(False))).drop("__tied")).drop("__h")


def class_weights(rows: DataFrame) -> DataFrame:
    """1 / count of each label, so that the mean is 1."""
    per = rows.groupBy("pred_label").agg(F.count("*").alias("cnt")).withColumn("raw", 1 / F.greatest("cnt", F.lit(1)))
    return per.join(F.broadcast(per.agg(F.avg("raw").alias("__m")))).select("pred_label", "cnt", (F.col("raw") / F.col("__m")).alias("weight"))


def overlap(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Distinct keys of a, those that b has, and the rate."""
    left, right = a.select(*key).distinct(), b.select(*key).distinct()
    return left.agg(F.count("*").alias("keys")).join(left.join(right, key).agg(F.count("*").alias("hits"))).select("keys", "hits", (F.col("hits") / F.nullif(F.col("keys"), F.lit(0))).alias("rate"))
