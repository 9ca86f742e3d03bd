"""The engine's inputs made of the driver's tables, in Spark and in SQL for DuckDB."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.functions.labels import argmax
from murmura.functions.times import parse
from murmura.sources.scratch import shared  # noqa: F401

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
K5 = "domain, brand, model, aspect_l1, aspect_l2"
KEY_SQL = ", ".join(KEY)


def preds(spark: SparkSession, sf_dir: str, timed: bool = True, stored: bool = True) -> DataFrame:
    """Predictions: a row per line item, with null models and times in four spellings; `ts`, the time that is read, only if asked for.

    stored: chances are worked out once a row, as queries with filters need it; those that only add up are faster without."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*KEY, "l_shipdate", "l_linestatus")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand", "p_type")
    ship = F.col("l_shipdate").cast("timestamp")
    epoch = F.unix_seconds(ship)
    wn = F.pow((F.col("l_orderkey") * 7 + F.col("l_partkey") * 3) % 97 + 1, F.lit(4))
    wu = F.pow((F.col("l_partkey") * 13 + F.col("l_suppkey")) % 89 + 1, F.lit(4))
    wp = F.pow((F.col("l_orderkey") * 11 + F.col("l_linenumber") * 5) % 101 + 1, F.lit(4))
    kind = F.col("l_linenumber") % 5
    ctime = (
        F.when(kind == 0, epoch.cast("string")).when(kind == 1, (epoch * 1000).cast("string"))
        .when(kind == 2, F.date_format(ship, "yyyy-MM-dd HH:mm:ss")).when(kind == 3, F.date_format(ship, "yyyy/MM/dd")).otherwise("n/a"))
    chances = [(w / (wn + wu + wp)).alias(n) for n, w in (("p_neg", wn), ("p_neu", wu), ("p_pos", wp))]
    # Stored values would be columns; as expressions they would be worked out anew wherever a filter or the parser looks at them.
    made = [F.inline_outer(F.array(F.struct(*chances, ctime.alias("ctime")) if timed else F.struct(*chances)))] if timed or stored else chances
    rows = items.join(part, F.col("l_partkey") == F.col("p_partkey")).select("*", *made).select(
        F.lit("phone").alias("domain"), F.col("p_brand").alias("brand"), F.when(F.col("l_suppkey") % 20 != 0, F.col("p_type")).alias("model"),
        F.concat(F.lit("L"), (F.col("l_partkey") % 15).cast("string")).alias("aspect_l1"), F.col("l_linestatus").alias("aspect_l2"), *KEY,
        "p_neg", "p_neu", "p_pos", (F.col("ctime") if timed else ctime).alias("ctime"))
    if timed:  # read once a row, however many filters and columns look at it
        rows = rows.select("*", F.inline_outer(F.array(F.struct(parse("ctime").alias("ts")))))
    label = argmax(F.col("p_neg"), F.col("p_neu"), F.col("p_pos"))
    number = F.when(label == "NEG", 0).when(label == "NEU", 1).otherwise(2)
    out = rows.select(
        "*", label.alias("pred_label"), number.alias("pred_id"), F.greatest("p_neg", "p_neu", "p_pos").alias("confidence"),
        F.concat_ws("-", F.lit("s"), F.col("l_orderkey"), F.col("l_linenumber")).alias("sentence"), F.md5(F.concat_ws("#", *KEY)).alias("pair_id"))
    # The time stands between confidence and sentence.
    names = [c for c in out.columns if c != "ts"]
    return out.select(*names[: names.index("sentence")], "ts", *names[names.index("sentence") :]) if timed else out


PREDS = """items as (select 'phone' as domain, p_brand as brand, case when l_suppkey % 20 = 0 then null else p_type end as model,
  concat('L', cast(l_partkey % 15 as varchar)) as aspect_l1, l_linestatus as aspect_l2, l_orderkey, l_linenumber, l_partkey, l_suppkey,
  wn / (wn + wu + wp) as p_neg, wu / (wn + wu + wp) as p_neu, wp / (wn + wu + wp) as p_pos,
  case l_linenumber % 5 when 0 then cast(cast(epoch(l_shipdate) as bigint) as varchar) when 1 then cast(cast(epoch(l_shipdate) as bigint) * 1000 as varchar)
    when 2 then strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') when 3 then strftime(l_shipdate, '%Y/%m/%d') else 'n/a' end as ctime
  from (select *, power((l_orderkey * 7 + l_partkey * 3) % 97 + 1, 4) as wn, power((l_partkey * 13 + l_suppkey) % 89 + 1, 4) as wu,
    power((l_orderkey * 11 + l_linenumber * 5) % 101 + 1, 4) as wp from lineitem) join part on l_partkey = p_partkey),
timed as (select *, try_cast(ctime as double) as x from items),
preds as (select * exclude (x), case when p_neg >= p_neu and p_neg >= p_pos then 'NEG' when p_neu >= p_pos then 'NEU' else 'POS' end as pred_label,
  case when p_neg >= p_neu and p_neg >= p_pos then 0 when p_neu >= p_pos then 1 else 2 end as pred_id, greatest(p_neg, p_neu, p_pos) as confidence,
  case when x is not null then case when x > 1e11 then make_timestamp(cast(x * 1000 as bigint)) else make_timestamp(cast(x * 1000000 as bigint)) end
    else coalesce(try_cast(ctime as timestamp), try_strptime(ctime, '%Y/%m/%d')) end as ts,
  concat_ws('-', 's', l_orderkey, l_linenumber) as sentence, md5(concat_ws('#', l_orderkey, l_linenumber, l_partkey, l_suppkey)) as pair_id from timed)"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of additions does not show."""
    return df.select(*(F.round(c, places).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))


def sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, sentence_idx, sentence of the documents."""
    from murmura.functions.text import sentences

    return documents(spark, sf_dir).select("doc_id", F.posexplode(sentences(F.col("text"))).alias("sentence_idx", "sentence"))


_STRIP = r"regexp_replace(x, '^[\s\x{A0}\x{3000}]+|[\s\x{A0}\x{3000}]+$', '', 'g')"
SENT = rf"""parts as (select doc_id, list_filter(list_transform(regexp_split_to_array(text, '[。！？!?；;.]+|[\r\n]+'), lambda x: {_STRIP}), lambda x: x <> '') as p from documents),
sent as (select doc_id, cast(unnest(range(0, len(p))) as integer) as sentence_idx, unnest(p) as sentence from parts)"""

#: A lexicon of words that the documents have.
WORDS = [
    ("looks", "colour", "the"), ("looks", "shape", "and"), ("looks", "shape", "of"), ("sound", "speaker", "und"), ("sound", "speaker", "der"),
    ("power", "battery", "de"), ("power", "charger", "la"), ("power", "charger", "les"), ("price", "value", "that"), ("price", "value", "The"),
    ("price", "offer", "for"), ("care", "service", "est"), ("care", "service", "los"), ("care", "service", "of"), ("care", "parts", "2024"), ("care", "parts", "--"),
]


def terms(spark: SparkSession) -> DataFrame:
    from murmura.operators.lexicon import SCHEMA

    return spark.createDataFrame([("doc", a, b, t, i) for i, (a, b, t) in enumerate(WORDS)], SCHEMA)


TERMS = "terms as (select * from (values " + ", ".join(f"('{a}', '{b}', '{t}', {i})" for i, (a, b, t) in enumerate(WORDS)) + ") v(l1, l2, term, ord))"
#: The first aspect of each usable term, and what the words of each sentence hit.
TAGGED = f"""{TERMS}, {SENT},
usable as (select * from terms where not regexp_matches(term, '^[0-9]+$') and regexp_matches(term, '[a-zA-Z]')),
known as (select lower(term) as term, arg_min(l1, ord) as l1, arg_min(l2, ord) as l2 from usable group by lower(term)),
hit as (select distinct doc_id, sentence_idx, unnest(regexp_split_to_array(lower(sentence), '[^a-z0-9_]+')) as hit_term from sent),
tagged as (select doc_id, sentence_idx, hit_term, l1 as aspect_l1, l2 as aspect_l2 from hit join known on hit_term = term)"""
