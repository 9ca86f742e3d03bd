"""Lines of files over many splits, with the numbers that they have in their file; JSON records from them.

A file is read in splits, each in order. The lines of each split are counted first (a row a split), running sums tell how
many lines lie before it, and a line's number is that and its place in its split. Only files that are one JSON value over
several lines are read as a whole.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmura.sources.reviews import records

#: Splits of which the counts are broadcast at most, some 200 bytes each; more are joined.
SPLITS = 100_000


def lines(spark: SparkSession, paths: str | list[str], pattern: str = "*", folders: bool = False) -> DataFrame:
    """path, number (from 0), value of every line below the paths, without its end and without a byte order mark at a file's begin.

    Only a line feed, or one after a carriage return, ends a line. An empty file has no lines. folders: the files of a folder
    are parts in the order of their names; path is the folder, and numbers go on from part to part."""
    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(paths, lineSep="\n")
    # Files, split sizes and settings decide which splits a task reads, so both passes number them alike.
    placed = read.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    splits = placed.groupBy("path", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    whole = F.regexp_replace("path", "/[^/]*$", "") if folders else F.col("path")
    before = Window.partitionBy(whole).orderBy("path", "block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = splits.select("path", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), "first")
    shifts = F.broadcast(shifts) if splits.count() <= SPLITS else shifts
    plain = F.regexp_replace("value", "\r$", "")
    number = F.col("id") + F.col("shift")
    first = (F.col("id") == F.col("first")) & (F.col("block") == 0)
    return placed.join(shifts, ["path", "block"]).select(
        whole.alias("path"), number.alias("number"), F.when(first, F.regexp_replace(plain, "^﻿", "")).otherwise(plain).alias("value"))


def line_records(rows: DataFrame, nested: bool = False, first: int = 0) -> DataFrame:
    """path, source_line, record (VARIANT) of each object that stands in a line of rows(path, number, value).

    Blank and broken lines are left out, and others that aren't objects. nested: a line may be an array, whose objects all
    have the line's number. first: the number of a file's first line."""
    value = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    raw = rows.where(value != "").select("path", (F.col("number") + first).alias("source_line"), value.alias("raw"))
    if nested:
        parts = F.when(F.col("raw").startswith("["), F.when(F.try_parse_json("raw").isNotNull(), F.from_json("raw", "array<string>"))).otherwise(F.array("raw"))
        raw = raw.select("path", "source_line", F.explode(parts).alias("raw"))
    return raw.where(F.col("raw").rlike(r"^\s*\{")).withColumn("record", F.try_parse_json("raw")).where("record is not null").drop("raw")


def file_kinds(rows: DataFrame) -> DataFrame:
    """path, whole: whether a file is one JSON value, and not lines of such. One row a file is shuffled by each task.

    It is, where its first line that isn't blank is all there is, or isn't a value by itself."""
    real = rows.where(F.trim("value") != "")
    told = real.groupBy("path").agg(F.min_by("value", "number").alias("head"), F.count("*").alias("n"))
    return told.select("path", ((F.col("n") == 1) | F.try_parse_json(F.trim("head")).isNull() & F.trim("head").rlike(r"^[\[{]")).alias("whole"))


def legacy_kinds(rows: DataFrame, probed: int = 6) -> DataFrame:
    """The same by the first lines that aren't blank: a file is lines where two of them or more, and half of them, are objects."""
    ok = F.trim("value").rlike(r"^\{(?s:.*)\}$") & F.try_parse_json(F.trim("value")).isNotNull()
    order = Window.partitionBy("path").orderBy("number")
    # Spark keeps the first `probed` rows of each file in a task before it shuffles.
    first = rows.where(F.trim("value") != "").withColumn("k", F.row_number().over(order)).where(F.col("k") <= probed)
    told = first.groupBy("path").agg(F.count("*").alias("n"), F.count(F.when(ok, 1)).alias("good"))
    return told.select("path", ((F.col("n") < 2) | (F.col("good") < 2) | (F.col("good") < F.floor(F.col("n") / 2))).alias("whole"))


def json_records(spark: SparkSession, folder: str, legacy: bool = False) -> DataFrame:
    """path, source_line, record of every .json and .jsonl file below a folder.

    A .jsonl file is lines; a .json file is what file_kinds() or, with legacy, legacy_kinds() finds. Lines are numbered from
    0 and elements of arrays by their place; with legacy from 1, and arrays within lines are taken apart. A file that is
    neither costs only itself. Files that are one value are named on the driver, which has listed them, and read whole."""
    rows = lines(spark, folder, "*.{json,jsonl}")
    kinds = (legacy_kinds if legacy else file_kinds)(rows.where(~F.col("path").endswith(".jsonl")))
    whole = [r["path"] for r in kinds.where("whole").select("path").collect()]
    found = line_records(rows.where(~F.col("path").isin(whole)) if whole else rows, legacy, 1 if legacy else 0)
    if not whole:
        return found
    texts = spark.read.text(whole, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^﻿", "").alias("value"))
    return found.unionByName(records(texts).select("path", F.col("source_line").cast("long").alias("source_line"), "record"))
