"""Ingest with declared mappings, column probing, and guards: what older inputs need."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.sources.scratch import table

from murmura.functions.times import parse

# Names that columns go by, in order of preference.
NAMES = {
    "sentence": ("sentence", "sent", "text", "content"),
    "sentence_id": ("sentence_id", "id", "row_id"),
    "aspect_l1": ("aspect_l1", "L1"),
    "aspect_l2": ("aspect_l2", "L2"),
    "label": ("pred_label", "label", "sentiment", "polarity"),
    "confidence": ("confidence", "conf", "score"),
    "p_neg": ("p_neg", "p0"), "p_neu": ("p_neu", "p1"), "p_pos": ("p_pos", "p2"),
}


def looks_like_lines(value: Column, probed: int = 6) -> Column:
    """Whether a text is one object a line: of the first lines at least two, and half of them, are objects."""
    lines = F.slice(F.filter(F.split(value, r"\r?\n"), lambda x: F.trim(x) != ""), 1, probed)
    good = F.size(F.filter(lines, lambda x: F.try_parse_json(x).isNotNull() & F.trim(x).startswith("{") & F.trim(x).endswith("}")))
    return (F.size(lines) >= 2) & (good >= 2) & (2 * good >= F.size(lines))


def dotted(record: Column, path: str) -> Column:
    """The text at a dotted path of a VARIANT."""
    return F.try_variant_get(record, "$" + "".join(f"['{p}']" for p in path.split(".")), "string")


def legacy_time(ctime: str) -> Column:
    """The time as yyyy-MM-dd HH:mm:ss where it can be read, else as it is."""
    return F.coalesce(F.date_format(parse(ctime), "yyyy-MM-dd HH:mm:ss"), F.col(ctime))


def normal_records(records: DataFrame, mapping: dict[str, str], extra: tuple[str, ...] = ()) -> DataFrame:
    """Fields by declared dotted paths; the id is the record's uuid or id, or a hash of content and url; extra fields make a map."""
    fields = {n: dotted(F.col("record"), p) for n, p in mapping.items()}
    out = records.select("path", "source_line", *(c.alias(n) for n, c in fields.items()), dotted(F.col("record"), "uuid").alias("__uuid"), dotted(F.col("record"), "id").alias("__id"),
                         F.create_map(*(x for e in extra for x in (F.lit(e), dotted(F.col("record"), e)))).alias("extra_json") if extra else F.create_map().cast("map<string,string>").alias("extra_json"))
    url = F.coalesce("url", F.lit("")) if "url" in mapping else F.lit("")
    out = out.withColumn("doc_id", F.coalesce("__uuid", "__id", F.sha1(F.concat(F.coalesce("content", F.lit("")), F.lit("|"), url))))
    if "ctime" in mapping:
        out = out.withColumn("ctime", legacy_time("ctime"))
    return out.withColumn("parse_error", F.col("content").isNull()).withColumn("error_msg", F.when(F.col("content").isNull(), "no content")).drop("__uuid", "__id")


def pick(df: DataFrame, *wanted: str) -> DataFrame:
    """Columns under their usual names, whichever name they have here; what has none is null."""
    def one(name: str) -> Column:
        found = next((c for c in NAMES.get(name, (name,)) if c in df.columns), None)
        return (F.col(found) if found else F.lit(None).cast("string")).alias(name)

    return df.select(*map(one, wanted))


def time_columns(df: DataFrame) -> list[str]:
    """Columns whose names speak of time."""
    return [c for c in df.columns if re.search(r"time|date|day|ts|created|updated", c, re.I)]


def epoch_unit(df: DataFrame, column: str) -> str:
    """Seconds or milliseconds, by the greatest value; one row comes to the driver."""
    top = df.agg(F.max(F.expr(f"try_cast(`{column}` as double)"))).first()[0]
    return "none" if top is None else "ms" if top > 1e12 else "s"


def packed_prompts(rows: DataFrame, size: int, order: list[str]) -> DataFrame:
    """Batches of numbered lines "i. [l1::l2] sentence" for a teacher: each shard's rows in order, so many a batch.

    Rows are dealt by ranges of shard and order; a row's place in its range and the rows that its shard has in the ranges
    before number it, so a shard of any size is no task of its own."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = table(rows.repartitionByRange(parts, "shard", *order).sortWithinPartitions("shard", *order).withColumn("__at", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    before = Window.partitionBy("__s").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(F.col("shard").alias("__s"), F.col("__part").alias("__p")).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    starts = starts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first"))
    same = F.col("shard").eqNullSafe(F.col("__s")) & (F.col("__part") == F.col("__p"))
    numbered = placed.join(F.broadcast(starts), same).withColumn("__k", F.col("__at") + F.col("__start"))  # as many starts as ranges and shards
    line = F.concat((F.col("__k") % size + 1).cast("string"), F.lit(". ["), "aspect_l1", F.lit("::"), "aspect_l2", F.lit("] "), F.regexp_replace("sentence", r"[\r\n]+", " "))
    return numbered.groupBy("shard", F.floor(F.col("__k") / size).alias("batch")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__k", line.alias("line")))), lambda x: x["line"]), "\n").alias("prompt"), F.count("*").alias("n"))


# What models are called besides their names.
SUFFIXES = ("pro", "ultra", "max", "plus", "se")


def good_terms(terms: DataFrame, blocked: DataFrame, longest: int = 10, ascii_allowed: tuple[str, ...] = (), bad: str | None = None) -> DataFrame:
    """Terms that aren't brands or models, names of versions or their suffixes, too long, or ASCII without leave.

    bad: a pattern of terms that say nothing."""
    term = F.trim("term")
    version = term.rlike(r"(?i)^[a-z]*[0-9]+(pro|plus|max|ultra|mini|se)?$") | F.lower(term).isin(*SUFFIXES)
    if bad:
        version = version | term.rlike(bad)
    is_ascii = F.col("term").rlike(r"^[A-Za-z0-9\-+.]+$")
    allowed = F.lower("term").isin(*ascii_allowed) if ascii_allowed else F.lit(False)
    return terms.where(~version & (F.length("term") <= longest) & (~is_ascii | allowed)).join(blocked.select(F.lower("term").alias("__b")).distinct(), F.lower("term") == F.col("__b"), "left_anti")


def tagged_nouns(tokens: DataFrame) -> DataFrame:
    """Tokens that a tagger calls nouns or foreign words."""
    return tokens.where(F.col("pos").startswith("n") | (F.col("pos") == "eng"))


def legacy_brand_model(path: Column, domain: str, brand: str | None = None, model: str | None = None) -> tuple[Column, Column]:
    """Brand and model of a relative path whose first folder may be the domain; given values come first, and what a short path lacks is null."""
    parts = F.split(path, "/")
    first = F.when(F.get(parts, 0) == domain, 1).otherwise(0)
    n = F.size(parts)
    return (F.lit(brand) if brand is not None else F.when(n >= 2, F.get(parts, first)),
            F.lit(model) if model is not None else F.when(n >= 3, F.get(parts, first + 1)))


def guard(path: str, domain: str) -> None:
    """Refuses a path that does not belong to the domain."""
    if domain.lower() not in path.lower():
        raise ValueError(f"{path} is no path of {domain}")
