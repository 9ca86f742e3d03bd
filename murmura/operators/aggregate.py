"""Sentiment aggregates: all rows, confident rows, probability weights; totals and time series.

The three kinds come from conditional sums in one aggregation over one scan, and long forms from the wide ones, so no
plan joins an aggregate with another of the same rows."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.functions.labels import counts
from murmura.functions.times import bucket

KEYS = ["domain", "brand", "model", "aspect_l1", "aspect_l2"]
LABELS = ("POS", "NEU", "NEG")


def _rate(a: str, b: str) -> Column:
    return F.col(a) / F.nullif(F.col(b), F.lit(0))


def aggregate_all(preds: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Counts, rates and score by keys."""
    out = preds.groupBy(*keys).agg(*counts(F.col("pred_label")))
    return out.select(
        "*", *(_rate(f"{x}_cnt", "total_cnt").alias(f"{x}_rate") for x in ("pos", "neu", "neg")),
        ((F.col("pos_cnt") - F.col("neg_cnt")) / F.col("total_cnt")).alias("sent_score"))


def aggregate_hard(preds: DataFrame, threshold: float, keys: list[str] = KEYS) -> DataFrame:
    """The same over rows of a confidence of the threshold or more, and the part of the rows they are.

    A group with a null key has no confident rows, as a join on the keys would find none."""
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    sure = (F.col("confidence") >= threshold) & whole
    out = preds.groupBy(*keys).agg(
        F.count("*").alias("total_all"),
        *(F.count(F.when(sure & (F.col("pred_label") == x), 1)).alias(f"{x.lower()}_cnt_hard") for x in LABELS),
        F.count(F.when(sure, 1)).alias("total_hard"))
    return out.select(
        "*", *(_rate(f"{x}_cnt_hard", "total_hard").alias(f"{x}_rate_hard") for x in ("pos", "neu", "neg")),
        ((F.col("pos_cnt_hard") - F.col("neg_cnt_hard")) / F.nullif(F.col("total_hard"), F.lit(0))).alias("sent_score_hard"),
        (F.col("total_hard") / F.col("total_all")).alias("coverage"))


def aggregate_soft(preds: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Sums of probabilities, their shares and score by keys."""
    sums = [F.sum(F.col(f"p_{x}").cast("double")).alias(f"w_{x}") for x in ("pos", "neu", "neg")]
    total = F.nullif(F.col("w_total"), F.lit(0.0))
    return preds.groupBy(*keys).agg(*sums).withColumn("w_total", F.col("w_pos") + F.col("w_neu") + F.col("w_neg")).select(
        "*", *((F.col(f"w_{x}") / total).alias(f"{x}_share") for x in ("pos", "neu", "neg")),
        ((F.col("w_pos") - F.col("w_neg")) / total).alias("sent_score_soft"))


def timed(preds: DataFrame, grain: str) -> DataFrame:
    """Rows with a time, and the first day of its bucket."""
    return preds.where(F.col("ts").isNotNull()).withColumn("time_bucket", bucket(grain, F.col("ts")))


def all_long(preds: DataFrame, keys: list[str]) -> DataFrame:
    """A row per label that occurs."""
    return preds.groupBy(*keys, "pred_label").agg(F.count("*").alias("cnt"))


def hard_long(preds: DataFrame, threshold: float, keys: list[str]) -> DataFrame:
    """A row per label of confident rows, with the total of all rows; a group without any has one row without label."""
    wide = aggregate_hard(preds, threshold, keys)
    rows = F.filter(
        F.array(*(F.struct(F.lit(x).alias("label"), F.col(f"{x.lower()}_cnt_hard").alias("cnt")) for x in LABELS)), lambda r: r["cnt"] > 0)
    return wide.select(*keys, "total_all", F.explode_outer(rows).alias("r")).select(*keys, "total_all", "r.label", F.coalesce("r.cnt", F.lit(0)).alias("cnt"))


def soft_long(preds: DataFrame, keys: list[str]) -> DataFrame:
    """A row per label with its sum of probabilities."""
    wide = aggregate_soft(preds, keys)
    return wide.select(*keys, F.expr("stack(3, 'POS', w_pos, 'NEU', w_neu, 'NEG', w_neg) as (label, weight)"))


def examples(preds: DataFrame, k: int, ties: list[str], keys: list[str] = KEYS) -> DataFrame:
    """The k rows of highest p_pos and of highest p_neg in each group, with the side and the rank."""
    sides = F.explode(F.array(*(F.struct(F.lit(x).alias("side"), F.col(f"p_{x}").alias("p")) for x in ("pos", "neg"))))
    order = Window.partitionBy(*keys, "side").orderBy(F.desc("__p"), *ties)
    both = preds.withColumn("__s", sides).withColumn("side", F.col("__s.side")).withColumn("__p", F.col("__s.p")).drop("__s")
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("__p")


def pivot_score(hard: DataFrame, values: list[str]) -> DataFrame:
    """Mean hard score by aspect_l1 and aspect_l2; the values are given, so no job looks for them."""
    return hard.groupBy("aspect_l1").pivot("aspect_l2", values).agg(F.avg("sent_score_hard"))


def pivot_hits(rows: DataFrame, values: list[str], hits: str = "hit_count") -> DataFrame:
    """Sum of hits by aspect_l1 and aspect_l2, 0 where there are none."""
    return rows.groupBy("aspect_l1").pivot("aspect_l2", values).agg(F.sum(hits)).fillna(0, values)


def report_counts(lines: DataFrame, l2: DataFrame) -> DataFrame:
    """lines(model, aspect_l2, sentiment, ..) with the count of their sentiment in l2(model, aspect_l2, pos_cnt, neg_cnt)."""
    told = l2.groupBy("model", "aspect_l2").agg(F.sum("pos_cnt").alias("__pos"), F.sum("neg_cnt").alias("__neg"))
    cnt = F.when(F.col("sentiment") == "POS", F.col("__pos")).otherwise(F.col("__neg"))
    return lines.join(told, ["model", "aspect_l2"], "left").withColumn("cnt", F.coalesce(cnt, F.lit(0))).drop("__pos", "__neg")


def enrich(preds: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of pairs where preds has null, by pair_id."""
    side = pairs.select("pair_id", *(F.col(c).alias(f"__{c}") for c in columns))
    return preds.join(side, "pair_id", "left").withColumns({c: F.coalesce(c, f"__{c}") for c in columns}).drop(*(f"__{c}" for c in columns))
