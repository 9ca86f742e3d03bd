"""Tables for the web: bounded aspect lists, pies, daily and weekly rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.functions.labels import counts
from murmura.sources.scratch import table

OTHER = "OTHER"


def bucket_map(preds: DataFrame, keep: int, column: str = "aspect_l1") -> DataFrame:
    """Each value with itself, if it is one of the keep most frequent, or OTHER; ties go by name."""
    sizes = preds.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), column).limit(keep).select(F.col(column).alias("__top"))
    return sizes.join(F.broadcast(top), F.col(column) == F.col("__top"), "left").select(column, F.coalesce("__top", F.lit(OTHER)).alias("bucket"))


def bucketed(preds: DataFrame, keep: int) -> DataFrame:
    return preds.join(bucket_map(preds, keep), "aspect_l1", "left").withColumn("bucket", F.coalesce("bucket", "aspect_l1"))


def latest(preds: DataFrame, days: int, column: str = "ts") -> DataFrame:
    """Rows of the last days up to the latest day of all; the limit is one row."""
    rows = preds.where(F.col(column).isNotNull()).withColumn("day", F.to_date(column))
    limit = rows.agg(F.max("day").alias("max_day"))
    return rows.join(F.broadcast(limit), F.col("day").between(F.date_sub("max_day", days - 1), F.col("max_day"))).drop("max_day")


def _narrow(rows: DataFrame, keys: list, weight: Column | None, name: str) -> DataFrame:
    """Keys, label and weight of each row as a table: it has the limit, and only rows within it are shuffled for their counts."""
    return table(rows.select(*keys, "pred_label", (F.lit(1) if weight is None else weight).alias("__weight")), name)


def latest_tally(rows: DataFrame, keys: list[str], weight: Column | None, days: int) -> DataFrame:
    """Counts by keys and day over the last days up to the latest day of all; the source is read once."""
    daily = _narrow(rows.where(F.col("day").isNotNull()), [*keys, "day"], weight, "daily")
    limit = daily.agg(F.max("day").alias("__max"))
    recent = daily.join(F.broadcast(limit), F.col("day") >= F.date_sub("__max", days - 1))
    return tally(recent, [*keys, "day"], None if weight is None else F.col("__weight"))


def weekly_tally(rows: DataFrame, keys: list[str], weight: Column | None, n: int) -> DataFrame:
    """Counts by keys and week from Monday (week_start, week_end) over the last n weeks, in the same way."""
    start = F.date_sub("day", F.weekday("day"))
    weekly = _narrow(rows.where(F.col("day").isNotNull()), [*keys, start.alias("week_start")], weight, "weekly")
    limit = weekly.agg(F.max("week_start").alias("__max"))
    recent = weekly.join(F.broadcast(limit), F.col("week_start") >= F.date_sub("__max", 7 * (n - 1)))
    return tally(recent, [*keys, "week_start"], None if weight is None else F.col("__weight")).withColumn("week_end", F.date_add("week_start", 6))


def latest_buckets(rows: DataFrame, keys: list[str], keep: int, days: int) -> DataFrame:
    """Counts by keys, bucket of the aspect and day over the last days; buckets go by the counts of all rows, with a day or without.

    The source is read once."""
    daily = _narrow(rows, [*keys, "aspect_l1", "day"], None, "daily")
    sizes = daily.where(F.col("aspect_l1").isNotNull()).groupBy("aspect_l1").agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), "aspect_l1").limit(keep).select(F.col("aspect_l1").alias("__top"), F.col("aspect_l1").alias("bucket"))
    limit = daily.agg(F.max("day").alias("__max"))
    recent = daily.join(F.broadcast(limit), F.col("day") >= F.date_sub("__max", days - 1)).join(F.broadcast(top), F.col("aspect_l1") == F.col("__top"), "left")
    bucket = F.when(F.col("aspect_l1").isNotNull(), F.coalesce("bucket", F.lit(OTHER)))
    return tally(recent, [*keys, bucket.alias("bucket"), "day"])


def pie(daily: DataFrame, label: str, by: list[str]) -> DataFrame:
    """Counts of a label by bucket, and their share of the product's, or of all; daily: counts by bucket and day."""
    cnt = F.sum(f"{label.lower()}_cnt").cast("long")
    out = daily.groupBy(*by, "bucket").agg(cnt.alias("cnt")).where("cnt > 0")
    if by:
        return out.withColumn("share", F.col("cnt") / F.sum("cnt").over(Window.partitionBy(*by)))
    total = out.agg(F.sum("cnt").alias("__all"))
    return out.join(F.broadcast(total)).withColumn("share", F.col("cnt") / F.col("__all")).drop("__all")


def tally(rows: DataFrame, keys: list, weight: Column | None = None) -> DataFrame:
    return rows.groupBy(*keys).agg(*counts(F.col("pred_label"), weight))


def products(rows: DataFrame) -> DataFrame:
    """First and last day and counts of each product."""
    return rows.groupBy("product_id").agg(
        F.min_by("brand", F.col("ord")).alias("brand"), F.min_by("model", F.col("ord")).alias("model"),
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("weight").cast("long").alias("total_cnt"))


def span_tally(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts with the first and last day."""
    return rows.groupBy(*keys).agg(*counts(F.col("pred_label"), F.col("weight")), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def weeks(rows: DataFrame, n: int) -> DataFrame:
    """Rows of the last n weeks from Monday, with week_start and week_end."""
    out = rows.withColumn("week_start", F.date_sub("day", F.weekday("day")))
    limit = out.agg(F.max("week_start").alias("__w"))
    return out.join(F.broadcast(limit), F.col("week_start") >= F.date_sub("__w", 7 * (n - 1))).drop("__w").withColumn("week_end", F.date_add("week_start", 6))
