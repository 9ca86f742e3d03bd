"""The serving table of daily counts, and what dashboards and exports ask of it."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.functions.times import month_end_bin, sunday_week
from murmura.sources.scratch import table

PERIODS = (7, 30, 90, 180, 365)


def daily_stats(preds: DataFrame) -> DataFrame:
    """date, brand, model, aspect, sentiment, count of rows with a time."""
    return preds.where(F.col("ts").isNotNull()).groupBy(
        F.date_format("ts", "yyyy-MM-dd").alias("date"), "brand", "model", F.col("aspect_l1").alias("aspect"), F.col("pred_label").alias("sentiment")
    ).agg(F.count("*").alias("count"))


def replace_range(old: DataFrame, new: DataFrame) -> DataFrame:
    """old without any date in the range that new covers, and new: loading the same days twice changes nothing."""
    span = new.agg(F.min("date").alias("__lo"), F.max("date").alias("__hi"))
    kept = old.join(F.broadcast(span), ~F.coalesce(F.col("date").between(F.col("__lo"), F.col("__hi")), F.lit(False))).drop("__lo", "__hi")
    return kept.unionByName(new)


def _part(label: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("sentiment") == label, F.col("count"))), F.lit(0)).cast("long")


def kpi(stats: DataFrame, brands: list[str] | None = None) -> DataFrame:
    """Volume, rates and a hundred times their difference, for the chosen brands."""
    rows = stats if brands is None else stats.where(F.col("brand").isin(brands))
    total = F.nullif(F.col("volume"), F.lit(0))
    return rows.agg(F.sum("count").cast("long").alias("volume"), _part("POS").alias("p"), _part("NEG").alias("n")).select(
        "volume", (F.col("p") / total).alias("pos_rate"), (F.col("n") / total).alias("neg_rate"), (100 * (F.col("p") - F.col("n")) / total).alias("nps"))


def sums(stats: DataFrame, *keys) -> DataFrame:
    return stats.groupBy(*keys).agg(F.sum("count").cast("long").alias("cnt"))


def top_values(stats: DataFrame, column: str, k: int, label: str | None = None) -> DataFrame:
    """The k values of the greatest counts; ties go by name. At most k rows, so they may be broadcast."""
    rows = stats if label is None else stats.where(F.col("sentiment") == label)
    return sums(rows.where(F.col(column).isNotNull()), column).orderBy(F.desc("cnt"), column).limit(k)


def with_other(stats: DataFrame, column: str, k: int, label: str | None = None) -> DataFrame:
    """Rows with the values beyond the top k named Other."""
    top = top_values(stats, column, k, label).select(F.col(column).alias("__top"))
    return stats.join(F.broadcast(top), F.col(column) == F.col("__top"), "left").withColumn(column, F.coalesce("__top", F.lit("Other"))).drop("__top")


def product_key(stats: DataFrame) -> DataFrame:
    """Rows that have brand and model, with both as one key."""
    return stats.withColumn("product_key", F.concat("brand", F.lit(" "), "model")).where(F.col("product_key").isNotNull())


def aspect_lists(stats: DataFrame) -> DataFrame:
    """Each product's aspects with their counts in one list, the most frequent first."""
    rows = sums(product_key(stats), "product_key", "aspect")
    listed = F.array_sort(F.collect_list(F.struct((-F.col("cnt")).alias("order"), "aspect", "cnt")))
    return rows.groupBy("product_key").agg(listed.alias("x")).select(
        "product_key", F.array_join(F.transform("x", lambda r: F.concat_ws(":", r["aspect"], r["cnt"].cast("string"))), "|").alias("aspects"))


def period_summary(stats: DataFrame, periods: tuple[int, ...] = PERIODS) -> DataFrame:
    """Counts of each product over each period up to the latest date of all; null where there are none."""
    rows = product_key(stats).withColumn("day", F.to_date("date"))
    last = rows.agg(F.max("day").alias("last"))
    frame = rows.select("product_key").distinct().select("product_key", F.explode(F.array(*map(F.lit, periods))).alias("period_days"))
    inside = rows.join(F.broadcast(last)).select(
        "product_key", "sentiment", "count", F.explode(F.filter(
            F.array(*map(F.lit, periods)), lambda p: F.col("day") > F.date_sub("last", p))).alias("period_days"))
    made = inside.groupBy("product_key", "period_days").agg(
        _part("POS").alias("pos"), _part("NEU").alias("neu"), _part("NEG").alias("neg"), F.sum("count").cast("long").alias("total"))
    return frame.join(made, ["product_key", "period_days"], "left")


def trend(stats: DataFrame, grain: str) -> DataFrame:
    """Counts of each product by day, week from Sunday or month end, without gaps between its first and last."""
    day = F.to_date("date")
    label = {"day": day, "week": sunday_week(day), "month": month_end_bin(day)}[grain]
    # A table, as the ends and the counts both come from it.
    rows = table(product_key(stats).withColumn("bin", label).groupBy("product_key", "bin").agg(
        _part("POS").alias("pos"), _part("NEU").alias("neu"), _part("NEG").alias("neg")), "bins")
    step = {"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month"}[grain]
    ends = rows.groupBy("product_key").agg(F.min("bin").alias("a"), F.max("bin").alias("b"))
    if grain == "month":
        bins = F.expr(f"transform(sequence(trunc(a, 'MM'), trunc(b, 'MM'), {step}), x -> last_day(x))")
    else:
        bins = F.expr(f"sequence(a, b, {step})")
    frame = ends.select("product_key", F.explode(bins).alias("bin"))
    return frame.join(rows, ["product_key", "bin"], "left").fillna(0, ["pos", "neu", "neg"])


# The periods of an exported product, their days before the last one, and the grain of their trend.
EXPORTED = {"last_7_days": (6, "day"), "last_1_month": (29, "week"), "last_3_months": (90, "month"), "last_6_months": (180, "month"), "last_12_months": (365, "month")}


def product_documents(stats: DataFrame) -> DataFrame:
    """product_key and one nested JSON object: aspects of positive and negative rows, and of each period a summary and a trend.

    Weeks go by their Sunday and months by the month end before them, without gaps between the first and the last that
    has rows; a period without rows is null. Counts become one row for each product, aspect, label and day before
    anything is nested, so lists are bounded by aspects and by the days of a year."""
    # A table, as aspects, days and the list of products come from it.
    rows = table(product_key(stats).select("product_key", "sentiment", "aspect", F.to_date("date").alias("day"), "count"), "keyed")
    by_aspect = rows.where(F.col("sentiment").isin("POS", "NEG")).groupBy("product_key", "sentiment", "aspect").agg(F.sum("count").cast("long").alias("count"))
    listed = lambda x: F.transform(F.array_sort(F.collect_list(F.when(F.col("sentiment") == x, F.struct((-F.col("count")).alias("o"), "aspect", "count")))), lambda r: F.struct(r["aspect"], r["count"]))
    aspects = by_aspect.groupBy("product_key").agg(listed("POS").alias("POS"), listed("NEG").alias("NEG"))
    parts = [_part(x).alias(x) for x in ("POS", "NEG", "NEU")]
    daily = rows.groupBy("product_key", "day").agg(*parts)
    last = F.broadcast(daily.agg(F.max("day").alias("last")))
    asked = F.explode(F.array(*(F.struct(F.lit(p).alias("period"), F.lit(d).alias("days"), F.lit(g).alias("grain")) for p, (d, g) in EXPORTED.items())))
    inside = daily.join(last).select("*", asked.alias("p")).where(F.col("day") >= F.date_sub("last", F.col("p.days"))).select("product_key", "p.period", "p.grain", "day", "POS", "NEG", "NEU")
    bin_ = F.when(F.col("grain") == "day", F.col("day")).when(F.col("grain") == "week", sunday_week(F.col("day"))).otherwise(month_end_bin(F.col("day")))
    binned = inside.groupBy("product_key", "period", "grain", bin_.alias("bin")).agg(*(F.sum(x).alias(x) for x in ("POS", "NEG", "NEU")))
    ends = binned.groupBy("product_key", "period", "grain").agg(F.min("bin").alias("a"), F.max("bin").alias("b"))
    bins = F.expr("""case grain when 'day' then sequence(a, b, interval 1 day) when 'week' then sequence(a, b, interval 7 days)
        else transform(sequence(trunc(a, 'MM'), trunc(b, 'MM'), interval 1 month), x -> last_day(x)) end""")
    whole = ends.select("product_key", "period", "grain", F.explode(bins).alias("bin")).join(binned, ["product_key", "period", "grain", "bin"], "left").fillna(0, ["POS", "NEG", "NEU"])
    trend_ = F.array_sort(F.collect_list(F.struct(F.col("bin").cast("string").alias("date"), "POS", "NEG", "NEU")))
    sums_ = [F.sum(x).alias(x) for x in ("POS", "NEG", "NEU")]
    told = whole.groupBy("product_key", "period", "grain").agg(trend_.alias("trend"), *sums_).select("product_key", "period", F.struct(
        F.col("grain").alias("granularity"), F.struct("POS", "NEG", "NEU", (F.col("POS") + F.col("NEG") + F.col("NEU")).alias("Total")).alias("summary"), "trend").alias("s"))
    stats_ = told.groupBy("product_key").agg(F.map_from_entries(F.collect_list(F.struct("period", "s"))).alias("m"))
    out = rows.select("product_key").distinct().join(aspects, "product_key", "left").join(stats_, "product_key", "left")
    none = F.array().cast("array<struct<aspect:string,count:bigint>>")
    return out.select("product_key", F.to_json(F.struct(
        F.struct(F.coalesce("POS", none).alias("POS"), F.coalesce("NEG", none).alias("NEG")).alias("brand_aspect_dist"),
        F.struct(*(F.col("m")[p].alias(p) for p in EXPORTED)).alias("period_stats")), {"ignoreNullFields": "false"}).alias("document"))


def mix(stats: DataFrame, label: str, k: int = 12) -> DataFrame:
    """A label's counts by aspect, the top k and Other, with their share."""
    rows = sums(with_other(stats.where(F.col("sentiment") == label), "aspect", k), "aspect")
    return rows.join(F.broadcast(rows.agg(F.sum("cnt").alias("__all")))).withColumn("share", F.col("cnt") / F.col("__all")).drop("__all")


def quotes(rows: DataFrame, keys: list[str], aspect: str, label: str, k: int, most: int) -> DataFrame:
    """The k most frequent aspects of each product for a label, with the first most distinct sentences."""
    # Equal sentences are counted first and only the first few of an aspect are gathered, so no list follows the data.
    once = rows.where(F.col("pred_label") == label).groupBy(*keys, aspect, "sentence").agg(F.count("*").alias("n"))
    sizes = once.groupBy(*keys, aspect).agg(F.sum("n").alias("cnt"))
    top = sizes.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("cnt"), aspect))).where(F.col("rank") <= k)
    first = once.withColumn("__k", F.row_number().over(Window.partitionBy(*keys, aspect).orderBy(F.asc_nulls_last("sentence")))).where(F.col("__k") <= most)
    shown = first.groupBy(*(F.col(c).alias(f"__{c}") for c in [*keys, aspect])).agg(F.array_sort(F.collect_list("sentence")).alias("quotes"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in [*keys, aspect]]
    return top.join(shown, same).select(*keys, aspect, "cnt", "quotes", "rank")
