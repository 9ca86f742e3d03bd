"""Queries: web tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from murmura.functions import labels
from murmura.functions.times import bucket, seconds_day
from murmura.operators import web
from murmura.plans.proxy import PREDS, preds, rounded

BUCKETS = PREDS + """, sizes as (select aspect_l1, count(*) as n from preds where aspect_l1 is not null group by 1),
top as (select aspect_l1 from sizes order by n desc, aspect_l1 limit 10),
bmap as (select aspect_l1, case when aspect_l1 in (select aspect_l1 from top) then aspect_l1 else 'OTHER' end as bucket from sizes),
b as (select preds.*, bucket, cast(ts as date) as day from preds join bmap using (aspect_l1)),
recent as (select * from b where day between (select max(day) from b) - 29 and (select max(day) from b))"""
_COUNTS = "count(case when pred_label = 'POS' then 1 end) as pos_cnt, count(case when pred_label = 'NEU' then 1 end) as neu_cnt, count(case when pred_label = 'NEG' then 1 end) as neg_cnt, count(*) as total_cnt"
_PID = "case when trim(brand) <> '' and trim(model) <> '' then trim(brand) || '__' || trim(model) else coalesce(nullif(trim(brand), ''), nullif(trim(model), ''), 'unknown_product') end"
V1 = PREDS + f""", v as (select *, cast(ts as date) as day, {_PID} as product_id, 1 + l_linenumber % 3 as weight,
  l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey as ord from preds where ts is not null)"""
_W = ", ".join(f"cast(coalesce(sum(case when pred_label = '{x}' then weight end), 0) as bigint) as {x.lower()}_cnt" for x in ("POS", "NEU", "NEG")) + ", cast(sum(weight) as bigint) as total_cnt"
_RAW = ["POSITIVE", "+", "2", "neg", "-", "0", "neutral", "1", "??", None]


def _bucketed(s, d):
    return web.bucketed(preds(s, d), 10)


def _recent(s, d, by):
    return web.latest_buckets(preds(s, d).withColumn("day", F.to_date("ts")), by, 10, 30)


def _v1(s, d):
    rows = preds(s, d).where(F.col("ts").isNotNull())
    return rows.select(
        "*", F.to_date("ts").alias("day"), labels.product_id(F.col("brand"), F.col("model")).alias("product_id"),
        (1 + F.col("l_linenumber") % 3).alias("weight"), (F.col("l_orderkey") * 1000000 + F.col("l_linenumber") * 100000 + F.col("l_suppkey")).alias("ord"))


def _pie(label, by):
    keys = ", ".join([*by, "bucket"])
    over = f"partition by {', '.join(by)}" if by else ""
    return (
        lambda s, d: rounded(web.pie(_recent(s, d, by), label, by)),
        f"with {BUCKETS}, c as (select {keys}, count(*) as cnt from recent where pred_label = '{label}' group by all) select *, round(cnt / sum(cnt) over ({over}), 6) as share from c")


def _days(s, d, keys, n=7):
    return web.latest_tally(_v1(s, d), keys, F.col("weight"), n)


def _weeks(s, d, keys):
    return web.weekly_tally(_v1(s, d), keys, F.col("weight"), 4)


def _days_sql(keys):
    return f"with {V1} select {keys}, day, {_W} from v where day between (select max(day) from v) - 6 and (select max(day) from v) group by all"


def _weeks_sql(keys):
    return f"""with {V1}, w as (select *, cast(date_trunc('week', day) as date) as week_start from v)
    select {keys}, week_start, week_start + 6 as week_end, {_W} from w where week_start >= (select max(week_start) from w) - 21 group by all"""


def _spellings(s, d):
    n = F.col("l_linenumber") + F.col("l_suppkey")
    raw = F.get(F.array(*map(F.lit, _RAW)), (n % len(_RAW)).cast("int"))
    return preds(s, d).select(raw.alias("raw")).withColumn("sentiment", labels.normal_sentiment(F.col("raw"))).groupBy("raw", "sentiment").agg(F.count("*").alias("cnt"))


_SPELL_SQL = "[" + ", ".join("null" if x is None else f"'{x}'" for x in _RAW) + "]"

QUERIES = {
    "l1_bucket_map": (lambda s, d: web.bucket_map(preds(s, d), 10), f"with {BUCKETS} select * from bmap"),
    "pie_product_pos": _pie("POS", ["brand", "model"]),
    "pie_product_neg": _pie("NEG", ["brand", "model"]),
    "pie_all_pos": _pie("POS", []),
    "pie_all_neg": _pie("NEG", []),
    "web_overall_l1": (lambda s, d: web.tally(_bucketed(s, d), ["bucket"]), f"with {BUCKETS} select bucket, {_COUNTS} from b group by 1"),
    "web_products": (
        lambda s, d: web.tally(_bucketed(s, d), ["brand", "model"]), f"with {BUCKETS} select brand, model, {_COUNTS} from b group by 1, 2"),
    "web_l1_list": (lambda s, d: _bucketed(s, d).groupBy("bucket").agg(F.count("*").alias("cnt")), f"with {BUCKETS} select bucket, count(*) as cnt from b group by 1"),
    "web_ts_day": (
        lambda s, d: web.tally(_bucketed(s, d).where("ts is not null"), ["brand", "bucket", F.to_date("ts").alias("day")]),
        f"with {BUCKETS} select brand, bucket, day, {_COUNTS} from b where ts is not null group by all"),
    "web_ts_week": (
        lambda s, d: web.tally(_bucketed(s, d).where("ts is not null"), ["bucket", bucket("week", F.col("ts")).alias("week")]),
        f"with {BUCKETS} select bucket, cast(date_trunc('week', ts) as date) as week, {_COUNTS} from b where ts is not null group by all"),
    "web_ts_soft": (
        lambda s, d: rounded(_bucketed(s, d).where("ts is not null").groupBy("bucket", bucket("week", F.col("ts")).alias("week")).agg(
            *(F.sum(f"p_{x}").alias(f"w_{x}") for x in ("pos", "neu", "neg")))),
        f"with {BUCKETS} select bucket, cast(date_trunc('week', ts) as date) as week, round(sum(p_pos), 6) as w_pos, round(sum(p_neu), 6) as w_neu, round(sum(p_neg), 6) as w_neg from b where ts is not null group by 1, 2"),
    "web_ready_day": (
        lambda s, d: preds(s, d).groupBy(seconds_day("ctime").alias("day")).agg(F.count("*").alias("cnt")),
        f"with {PREDS} select case when try_cast(ctime as double) <= 1e11 then cast(make_timestamp(cast(try_cast(ctime as double) * 1000000 as bigint)) as date) end as day, count(*) as cnt from preds group by 1"),
    "product_id": (
        lambda s, d: preds(s, d).groupBy(labels.product_id(F.when(F.col("l_linenumber") != 3, F.col("brand")), F.col("model")).alias("product_id")).agg(F.count("*").alias("cnt")),
        f"with {PREDS}, p as (select case when l_linenumber <> 3 then brand end as brand, model from preds) select {_PID} as product_id, count(*) as cnt from p group by 1"),
    "normalize_sentiment": (
        _spellings, f"""with {PREDS}, r as (select {_SPELL_SQL}[1 + (l_linenumber + l_suppkey) % {len(_RAW)}] as raw from preds)
        select raw, case when upper(raw) in ('POS', 'POSITIVE', '+', '2') then 'POS' when upper(raw) in ('NEG', 'NEGATIVE', '-', '0') then 'NEG' else 'NEU' end as sentiment, count(*) as cnt from r group by 1, 2"""),
    "v1_product_list": (
        lambda s, d: web.products(_v1(s, d)),
        f"""with {V1} select product_id, min_by(brand, ord) as brand, min_by(model, ord) as model, min(day) as first_day, max(day) as last_day, cast(sum(weight) as bigint) as total_cnt from v group by 1"""),
    "v1_pie_product": (
        lambda s, d: web.span_tally(_v1(s, d), ["product_id", "aspect_l1"]),
        f"with {V1} select product_id, aspect_l1, {_W}, min(day) as first_day, max(day) as last_day from v group by 1, 2"),
    "v1_pie_all": (lambda s, d: web.span_tally(_v1(s, d), ["aspect_l1"]), f"with {V1} select aspect_l1, {_W}, min(day) as first_day, max(day) as last_day from v group by 1"),
    "v1_daily_product": (lambda s, d: _days(s, d, ["product_id", "aspect_l1"]), _days_sql("product_id, aspect_l1")),
    "v1_daily_all": (lambda s, d: _days(s, d, ["aspect_l1"]), _days_sql("aspect_l1")),
    "v1_weekly_product": (lambda s, d: _weeks(s, d, ["product_id", "aspect_l1"]), _weeks_sql("product_id, aspect_l1")),
    "v1_weekly_all": (lambda s, d: _weeks(s, d, ["aspect_l1"]), _weeks_sql("aspect_l1")),
}
