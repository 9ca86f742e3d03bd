"""Checks of predictions, labels, times and tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmura.functions.labels import argmax
from murmura.functions.times import parse
from murmura.operators import selection


def label_dist(rows: DataFrame, threshold: float) -> DataFrame:
    return rows.groupBy("pred_label").agg(F.count("*").alias("cnt"), F.count(F.when(F.col("confidence") >= threshold, 1)).alias("cnt_confident"))


def consistency(rows: DataFrame) -> DataFrame:
    """Labels that are and aren't those of the greatest probability."""
    same = F.col("pred_label") == argmax(F.col("p_neg"), F.col("p_neu"), F.col("p_pos"))
    return rows.agg(F.count(F.when(same, 1)).alias("matches"), F.count(F.when(~same, 1)).alias("mismatches"))


def crosstab(rows: DataFrame) -> DataFrame:
    return rows.groupBy("pred_id", "pred_label").agg(F.count("*").alias("cnt"))


def probabilities(rows: DataFrame, tolerance: float = 1e-2) -> DataFrame:
    """Ranges of probabilities and confidence, the greatest error of the sum, values out of range, and the verdict."""
    error = F.abs(F.col("p_neg") + F.col("p_neu") + F.col("p_pos") - 1)
    out = ~F.col("p_neg").between(0, 1) | ~F.col("p_neu").between(0, 1) | ~F.col("p_pos").between(0, 1)
    return rows.agg(
        F.count("*").alias("n"), *(f(c).alias(f"{n}_{c}") for c in ("p_neg", "p_neu", "p_pos", "confidence") for n, f in (("min", F.min), ("max", F.max), ("avg", F.avg))),
        F.max(error).alias("max_error"), F.count(F.when(out, 1)).alias("out_of_range")).withColumn(
        "passed", (F.col("n") > 0) & (F.col("max_error") <= tolerance))


def quantiles(rows: DataFrame, points: list[float], by: list[str] | None = None) -> DataFrame:
    """Exact interpolated quantiles of confidence, a column each."""
    return selection.quantiles(rows, "confidence", points, by).select(*(by or []), *(F.get("q", i).alias(f"q{round(100 * p)}") for i, p in enumerate(points)))


def aspect_shares(rows: DataFrame, label: str, k: int) -> DataFrame:
    """The k commonest aspects of a label with their share of it."""
    per = rows.where(F.col("pred_label") == label).groupBy(F.concat_ws("##", "aspect_l1", "aspect_l2").alias("aspect")).agg(F.count("*").alias("cnt"))
    return per.join(F.broadcast(per.agg(F.sum("cnt").alias("__all")))).withColumn("share", F.col("cnt") / F.col("__all")).drop("__all").orderBy(F.desc("cnt"), "aspect").limit(k)


def time_quality(rows: DataFrame) -> DataFrame:
    """Null and blank times, and the least and greatest as text."""
    return rows.agg(
        F.count("*").alias("n"), F.count(F.when(F.col("ctime").isNull(), 1)).alias("nulls"), F.count(F.when(F.trim("ctime") == "", 1)).alias("blanks"),
        F.min("ctime").alias("min_ctime"), F.max("ctime").alias("max_ctime"))


def time_probe(rows: DataFrame) -> DataFrame:
    """How many times read as numbers, as milliseconds, as dates, and not at all."""
    x = F.expr("try_cast(ctime as double)")
    return rows.agg(
        F.count(x).alias("numeric"), F.count(F.when(x > 1e11, 1)).alias("millis"), F.count(F.when(x.isNull() & parse("ctime").isNotNull(), 1)).alias("written"),
        F.count(F.when(parse("ctime").isNull(), 1)).alias("unread"))


def pseudolabels(rows: DataFrame) -> DataFrame:
    """Unknown labels, confidences out of range, and repeated pair ids."""
    repeats = rows.groupBy("pair_id").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("repeated_ids"))
    return rows.agg(
        F.count(F.when(~F.col("pred_label").isin("POS", "NEU", "NEG"), 1)).alias("bad_labels"),
        F.count(F.when(~F.col("confidence").between(0, 1), 1)).alias("bad_confidence")).join(repeats)


def deduplicated(rows: DataFrame) -> DataFrame:
    """The most confident row of each pair id."""
    order = Window.partitionBy("pair_id").orderBy(F.desc("confidence"), "pred_label")
    return rows.withColumn("__k", F.row_number().over(order)).where("__k = 1").drop("__k")


def enforce(rows: DataFrame, schema: dict[str, str]) -> DataFrame:
    """The columns of a schema: casts that give null instead of failing, 0 for whole numbers that are missing, null for missing columns."""
    def one(name: str, kind: str):
        value = F.col(name).try_cast(kind) if name in rows.columns else F.lit(None).cast(kind)
        return (F.coalesce(value, F.lit(0).cast(kind)) if kind in ("int", "long", "bigint") else value).alias(name)

    return rows.select(*(one(n, k) for n, k in schema.items()))


def blocklist(rows: DataFrame) -> DataFrame:
    """Brands and models as terms, also in lower case."""
    names = rows.select(F.explode(F.array("brand", "model", F.lower("brand"), F.lower("model"))).alias("term"))
    return names.where(F.col("term").isNotNull() & (F.col("term") != "")).distinct()


def days(rows: DataFrame, low: str, high: str) -> DataFrame:
    """Null days and days out of bounds."""
    return rows.agg(
        F.count("*").alias("n"), F.count(F.when(F.col("day").isNull(), 1)).alias("null_days"),
        F.count(F.when(~F.col("day").between(F.lit(low).cast("date"), F.lit(high).cast("date")), 1)).alias("out_of_bounds"))


def missing_columns(rows: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in rows.columns]
