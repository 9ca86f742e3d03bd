"""Readers of raw reviews: JSON arrays, single objects and lines, whatever the file's name says.

Files are read as text, so that a broken file costs only itself, and records become VARIANT values, whose fields may
differ from row to row."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The names of fields, in order of preference.
CONTENT_KEYS = ("content", "text", "comment", "review", "body", "评价内容")
TIME_KEYS = ("ctime", "create_time", "comment_time", "time", "date", "createdAt", "created_at")
ID_KEYS = ("id", "review_id", "doc_id", "comment_id", "content_id")


def files(spark: SparkSession, folder: str) -> DataFrame:
    """path and value (the whole text, without a byte order mark) of every .json and .jsonl file below a folder."""
    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{json,jsonl}").text(folder, wholetext=True)
    return read.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^﻿", "").alias("value"))


def records(texts: DataFrame) -> DataFrame:
    """path, source_line (from 0), record (VARIANT) of each object, and of files that hold none: error.

    A file that begins with [ is an array; one that is a single object as a whole is that; all others are lines, of which
    blank and broken ones are left out. Elements that aren't objects are left out."""
    body = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
    parsed = F.try_parse_json(body)
    # try_parse_json ignores what follows a first object, so an object over one line, or a last line that closes one, decides.
    one = body.startswith("{") & parsed.isNotNull() & ((F.size(lines) == 1) | F.try_parse_json(F.get(lines, 0)).isNull())
    kind = F.when(body.startswith("["), F.when(parsed.isNotNull(), "array").otherwise("broken")).when(one, "object").otherwise("lines")
    typed = texts.withColumn("kind", kind).withColumn("body", body)
    elements = typed.where("kind = 'array'").select("path", F.expr("from_json(body, 'array<string>')").alias("parts")).select("path", F.posexplode("parts").alias("source_line", "raw"))
    single = typed.where("kind = 'object'").select("path", F.lit(0).alias("source_line"), F.col("body").alias("raw"))
    rows = typed.where("kind = 'lines'").select("path", F.posexplode(F.split("value", r"\r?\n")).alias("source_line", "raw"))
    found = elements.unionByName(single).unionByName(rows).withColumn("record", F.try_parse_json("raw"))
    return found.where(F.col("raw").rlike(r"^\s*\{") & F.col("record").isNotNull()).drop("raw")


def errors(texts: DataFrame) -> DataFrame:
    """Files that begin as an array and are none."""
    return texts.where(F.trim("value").startswith("[") & F.try_parse_json(F.trim("value")).isNull()).select("path", F.lit("broken array").alias("error"))


def field(record: Column, keys: tuple[str, ...]) -> Column:
    """The first of the keys whose value is a number, a boolean or a text that isn't empty; objects and lists don't count."""
    def one(key: str) -> Column:
        value = F.try_variant_get(record, f"$['{key}']", "variant")
        kind = F.schema_of_variant(value)
        text = F.try_variant_get(record, f"$['{key}']", "string")
        scalar = value.isNotNull() & ~kind.startswith("OBJECT") & ~kind.startswith("ARRAY") & (kind != "VOID") & (text != "")
        return F.when(scalar, F.when(kind == "BOOLEAN", F.initcap(text)).otherwise(F.trim(text)))

    return F.coalesce(*map(one, keys))


def path_parts(path: Column) -> tuple[Column, Column]:
    """Brand and model of a relative path; a file at the top has its own name and unknown."""
    parts = F.split(path, "/")
    return F.get(parts, 0), F.when(F.size(parts) >= 2, F.get(parts, 1)).otherwise(F.lit("unknown"))


def clean_sentences(found: DataFrame, domain: str, root: str) -> DataFrame:
    """A row per sentence: domain, brand, model, doc_id, sentence_idx, sentence, ctime, source_path."""
    from murmura.functions.hashing import document_id
    from murmura.functions.text import ENDS, sentences

    relative = F.regexp_replace(F.col("path"), "^.*?" + root.rstrip("/").replace("file://", "").replace(".", r"\.") + "/", "")
    brand, model = path_parts(relative)
    docs = found.select(
        F.lit(domain).alias("domain"), brand.alias("brand"), model.alias("model"),
        F.coalesce(field(F.col("record"), ID_KEYS), document_id(F.col("path"), F.col("source_line"))).alias("doc_id"),
        field(F.col("record"), CONTENT_KEYS).alias("content"), field(F.col("record"), TIME_KEYS).alias("ctime"), F.col("path").alias("source_path"))
    return docs.where(F.col("content") != "").select(
        "domain", "brand", "model", "doc_id", F.posexplode(sentences(F.col("content"), ENDS.replace(".", ""))).alias("sentence_idx", "sentence"), "ctime", "source_path")


def manifest(docs: DataFrame, sentences: DataFrame, path: str) -> DataFrame:
    """Documents, sentences, least and greatest time of each source."""
    counted = sentences.groupBy(path).agg(F.count("*").alias("sentences"))
    return docs.groupBy(path).agg(F.count("*").alias("docs"), F.min("ctime").alias("min_ctime"), F.max("ctime").alias("max_ctime")).join(counted, path, "left").fillna(0, ["sentences"])
