"""Exact quantiles by selection: histograms are refined around the asked ranks, so nothing holds all distinct values.

A first pass counts by exponent and the next bits of the value, in buckets that keep the order; of those in which an asked
rank falls, later passes count by equal parts between the least and the greatest value found, until the buckets in
question hold few rows, which are then sorted. A histogram has some thousand rows a group, whatever the input has.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.sources.scratch import table

#: Parts of an exponent and of a bucket, and rows that are sorted at last at most.
FIRST, PARTS, SORTED = 4096, 65_536, 100_000


def bucket(x: Column) -> Column:
    """A whole number that doesn't fall as x grows; not-a-number is the greatest, as in Spark's order."""
    size = F.abs(x)
    exponent = F.floor(F.log2(size))
    own = exponent * FIRST + F.floor((size / F.pow(F.lit(2.0), exponent.cast("double")) - 1) * FIRST).cast("long") + (FIRST << 11)
    far = F.lit(1 << 40)
    return F.when(F.isnan(x), far + 1).when(x == float("inf"), far).when(x == float("-inf"), -far).when(x == 0, F.lit(0).cast("long")).when(x > 0, own).otherwise(-own)


def _group(by: list[str]) -> Column:
    """One text for each combination of values, null among them."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in by]
    return F.concat(F.lit(""), *parts)


def _hit(hist: DataFrame, ranks: Column) -> DataFrame:
    """The buckets of hist(g, before, key, n, low, high) that hold one of the ranks, with these, and how many rows lie before."""
    order = Window.partitionBy("g", "before").orderBy("key")
    start = F.col("before") + F.sum("n").over(order) - F.col("n")
    found = hist.withColumn("start", start).withColumn("ranks", F.filter(ranks, lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n"))))
    return found.where(F.size("ranks") > 0).select("g", F.col("start").alias("before"), "n", "low", "high", "ranks")


def quantiles(rows: DataFrame, column: str, points: list[float], by: list[str] | None = None, most: int = SORTED) -> DataFrame:
    """by and q, an array of the exact quantiles at the points (0 to 1), between neighbouring values by proportion.

    Null values don't count; a group of nothing else has null quantiles, and so has an empty table without by. Null keys
    are a group of their own."""
    by = by or []
    x = rows.select(*by, _group(by).alias("g"), F.col(column).cast("double").alias("x"))
    told = x.where("x is not null").select("g", "x")
    hist = told.groupBy("g", bucket(F.col("x")).alias("key")).agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).withColumn("before", F.lit(0).cast("long"))
    place = lambda p: F.lit(float(p)) * (F.col("rows") - 1)
    asked = F.array_distinct(F.array(*(f(place(p)).cast("long") for p in points for f in (F.floor, F.ceil))))
    sized = hist.withColumn("rows", F.sum("n").over(Window.partitionBy("g"))).withColumn("asked", asked)
    hit = table(_hit(sized.drop("rows"), F.col("asked")), "buckets")
    same = F.col("low").eqNullSafe(F.col("high"))
    done = hit.where(same).select("g", F.explode("ranks").alias("rank"), F.col("low").alias("value"))
    while True:
        opened = hit.where(~same)
        left = opened.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if not left:
            break
        held = opened.groupBy("g").agg(F.collect_list(F.struct("low", "high", "before", "ranks")).alias("open"))  # two for each point at most
        inside = told.join(held, "g").withColumn("o", F.get(F.filter("open", lambda o: (F.col("x") >= o["low"]) & (F.col("x") <= o["high"])), 0)).where("o is not null")
        if left <= most:
            counted = inside.groupBy("g", "o.before", F.col("o.ranks").alias("asked"), F.col("x").alias("key")).agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        else:
            part = F.floor((F.col("x") - F.col("o.low")) / (F.col("o.high") - F.col("o.low")) * PARTS)
            counted = inside.groupBy("g", "o.before", F.col("o.ranks").alias("asked"), part.alias("key")).agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        hit = table(_hit(counted, F.col("asked")), "buckets")
        done = done.unionByName(hit.where(same).select("g", F.explode("ranks").alias("rank"), F.col("low").alias("value")))
    values = done.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("v"))

    def at(p: float) -> Column:
        low, high = (F.col("v")[f(place(p)).cast("long")] for f in (F.floor, F.ceil))
        return F.when(low == high, low).otherwise(low + (high - low) * (place(p) - F.floor(place(p))))

    groups = x.groupBy("g").agg(*(F.first(c).alias(c) for c in by), F.count("x").alias("rows")) if by else x.agg(F.count("x").alias("rows")).withColumn("g", F.lit(""))
    return groups.join(values, "g", "left").select(*by, F.when(F.col("rows") > 0, F.array(*map(at, points))).alias("q"))
