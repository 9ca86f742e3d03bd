"""Importance resampling towards a target distribution of hashed n-grams, in Spark SQL alone.

Arrays of words and pairs of words become bucket numbers, which are exploded and counted by bucket, in the corpus and in
the target. What a bucket gains a document is a table of at most BUCKETS rows and so is broadcast; a document's gains are
summed before they are shuffled, as its features lie in one task. The highest scores are ranked by a distributed sort.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm._ranks import ranked
from murmura.llm._store import table

BUCKETS, SHARE, LEAST, SEED = 10_000, 25, 20, 7
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _bound(value: Column, use) -> Column:
    """use(value) with the value worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def _buckets(words: Column) -> Column:
    """The buckets of a text's words and pairs of neighbouring words, in this order."""
    last = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, 1, last), F.slice(words, 2, last), lambda x, y: F.concat_ws(" ", x, y))
    return F.transform(F.concat(words, pairs), lambda f: F.pmod(F.crc32(f.cast("binary")), F.lit(BUCKETS)).cast("int"))


def features(texts: DataFrame, *keep: str) -> DataFrame:
    """The columns to keep, n_words and buckets of every text; a null text has no words."""
    words = F.filter(F.split(F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER), GAP), lambda w: w != "")
    made = texts.select(*keep, _bound(words, lambda w: F.struct(F.size(w).alias("n"), _buckets(w).alias("b"))).alias("f"))
    return made.select(*keep, F.col("f.n").alias("n_words"), F.col("f.b").alias("buckets"))


def counts(made: DataFrame, name: str) -> DataFrame:
    """bucket and how many features lie in it."""
    return made.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias(name))


def gains(own: DataFrame, wanted: DataFrame) -> DataFrame:
    """bucket, gain of the buckets that occur in the corpus: at most BUCKETS rows."""
    held = table(counts(own, "s").join(counts(wanted, "t"), "bucket", "left").select("bucket", "s", F.coalesce("t", F.lit(0)).alias("t")), "buckets")
    whole = held.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("s")).first()
    target = wanted.agg(F.coalesce(F.sum(F.size("buckets").cast("long")), F.lit(0)).alias("t")).first()
    ratio = (F.col("t") + 1.0) * F.lit(float(whole["s"] + BUCKETS)) / ((F.col("s") + 1.0) * F.lit(float(target["t"] + BUCKETS)))
    return held.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least: int = LEAST, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank: documents scored by how like the target's their features are.

    weight is the floored mean of the gains of a document's features, score the weight with Gumbel noise keyed by seed and
    doc_id. Of the documents with at least `least` words share per cent are drawn, those of the highest scores; equal
    scores go by doc_id, then by n_features and weight. rank is null where a document isn't drawn.

    A null, empty or wordless text has no features and weight 0. Repeated rows are each a document, with equal noise; a null
    doc_id has the noise of an empty one and comes before the others among equals. Other columns are ignored. An empty
    target gains nothing that it would tell apart but the frequency of buckets; an empty table gives no rows."""
    own = table(features(docs, "doc_id").withColumn("row", F.monotonically_increasing_id()), "features")
    known = gains(own, features(target))
    met = own.select("row", "doc_id", "n_words", F.size("buckets").cast("long").alias("n_features"), F.explode_outer("buckets").alias("bucket"))
    summed = met.join(F.broadcast(known), "bucket", "left").groupBy("row", "doc_id", "n_words", "n_features").agg(F.coalesce(F.sum("gain"), F.lit(0)).alias("gain"))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    weight = F.when(F.col("n_features") > 0, F.floor(F.col("gain") / F.col("n_features"))).otherwise(F.lit(0)).cast("long")
    scored = table(summed.select("doc_id", "n_words", "n_features", weight.alias("weight"), (weight + noise).alias("score")), "scores")
    able = scored.where(F.col("n_words") >= least)
    drawn = able.count() * share // 100
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("weight")]
    placed = ranked(able, order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def _half_bytes() -> list[int]:
    """What each half byte adds to a CRC-32: four steps of the division."""
    out = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


def resample_sql() -> str:
    """The same in SQL for DuckDB; the CRC-32 of each distinct feature by half bytes, the lower first."""
    words = f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{GAP}'), lambda x: x <> '')"
    grams = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    crc = f"""xor(list_reduce(list_concat([4294967295], list_transform(range(0, len(x)), lambda i: cast('0x' || substr(x, case when i % 2 = 0 then i + 2 else i end, 1) as bigint))),
  lambda c, v: xor(c >> 4, {_half_bytes()}[(xor(c, v) & 15) + 1])), 4294967295)"""
    return f"""
with d as materialized (select doc_id, len(w) as n_words, {grams} as g from (select doc_id, {words} as w from documents)),
b as materialized (select unnest({grams}) as f from (select {words} as w from benchmark)),
u as materialized (select row_number() over () as row, doc_id, n_words, len(g) as n_features, g from d),
f as materialized (select row, unnest(g) as f from u),
k as materialized (select f, {crc} % {BUCKETS} as bucket from (select f, hex(encode(f)) as x from (select f from f union select f from b))),
s as (select bucket, count(*) as s from f join k using (f) group by 1), t as (select bucket, count(*) as t from b join k using (f) group by 1),
n as (select (select count(*) from f) as n_own, (select count(*) from b) as n_target),
a as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::double) * (n_own + {BUCKETS}) / ((s + 1.0::double) * (n_target + {BUCKETS})))) as gain from s left join t using (bucket), n),
m as (select row, sum(gain) as gain from f join k using (f) join a using (bucket) group by 1),
r as (select doc_id, n_words, n_features, cast(coalesce(floor(gain / n_features), 0) as bigint) as weight, cast('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8) as bigint) as h from u left join m using (row)),
c as (select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296))) as bigint) as score from r),
o as (select *, row_number() over (order by score desc, doc_id) as rank, count(*) over () * {SHARE} // 100 as k from c where n_words >= {LEAST})
select doc_id, n_features, weight, score, case when rank <= k then rank end as rank from o
union all select doc_id, n_features, weight, score, null from c where n_words < {LEAST}"""


def op12_resampling(spark, sf_dir: str) -> DataFrame:
    """All documents, those drawn towards the benchmark's features with their ranks."""
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
