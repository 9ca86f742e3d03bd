"""Ranks over a whole table by a distributed sort."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.llm._store import table


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """df with its rows' numbers from 1 in the given order.

    Rows are dealt by ranges of the order and sorted within; a row's number in its partition and the rows of the partitions
    before give its rank. Only one row a partition meets in one task, and these are as many as spark.sql.shuffle.partitions.
    Rows that the order can't tell apart are numbered in any order."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = table(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "sorted")
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("__part").agg(F.count("*").alias("n")).select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    return placed.join(F.broadcast(starts), "__part").withColumn(
        name, F.col("__start") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1).drop("__at", "__part", "__start")
