"""Queries: the serving table, dashboard figures and exports."""
from __future__ import annotations

from pyspark.sql import functions as F

from murmura.operators import serving
from murmura.plans.proxy import KEY, PREDS, preds, rounded

STATS = PREDS + """, stats as (select strftime(ts, '%Y-%m-%d') as date, brand, model, aspect_l1 as aspect, pred_label as sentiment, count(*) as count from preds where ts is not null group by all)"""
KEYED = STATS + ", k as (select *, brand || ' ' || model as product_key, cast(date as date) as day from stats where brand is not null and model is not null)"
_P = ", ".join(f"cast(coalesce(sum(case when sentiment = '{a}' then count end), 0) as bigint) as {b}" for a, b in (("POS", "pos"), ("NEU", "neu"), ("NEG", "neg")))


def stats(s, d):
    return serving.daily_stats(preds(s, d))


def _top(k, column="aspect", cond="true"):
    return f"(select {column} from stats where {cond} group by {column} order by sum(count) desc, {column} limit {k})"


def _mix(label):
    return (
        lambda s, d: rounded(serving.mix(stats(s, d), label)),
        f"""with {STATS}, r as (select case when aspect in {_top(12, cond=f"sentiment = '{label}'")} then aspect else 'Other' end as aspect, count from stats where sentiment = '{label}'),
        g as (select aspect, cast(sum(count) as bigint) as cnt from r group by 1) select *, round(cnt / sum(cnt) over (), 6) as share from g""")


def _trend(grain):
    label = {"day": "day", "week": "day - cast(dayofweek(day) as integer)", "month": "case when day = last_day(day) then day else cast(date_trunc('month', day) - interval 1 day as date) end"}[grain]
    series = {
        "day": "unnest(generate_series(cast(a as timestamp), cast(b as timestamp), interval 1 day))", "week": "unnest(generate_series(cast(a as timestamp), cast(b as timestamp), interval 7 day))",
        "month": "last_day(cast(unnest(generate_series(date_trunc('month', cast(a as timestamp)), date_trunc('month', cast(b as timestamp)), interval 1 month)) as date))"}[grain]
    return (
        lambda s, d: serving.trend(stats(s, d), grain),
        f"""with {KEYED}, r as (select product_key, cast({label} as date) as bin, {_P} from k group by 1, 2), e as (select product_key, min(bin) as a, max(bin) as b from r group by 1),
        f as (select product_key, cast({series} as date) as bin from e)
        select product_key, bin, coalesce(pos, 0) as pos, coalesce(neu, 0) as neu, coalesce(neg, 0) as neg from f left join r using (product_key, bin)""")


def _reload(s, d):
    """Loading the last year again, twice, in place of what is there."""
    old = stats(s, d)
    new = old.where(F.col("date") >= "2001-01-01").withColumn("count", F.col("count") * 2)
    return serving.replace_range(serving.replace_range(old, new), new).groupBy("date").agg(F.sum("count").alias("count"))


QUERIES = {
    "daily_stats": (stats, f"with {STATS} select * from stats"),
    "load_range": (_reload, f"with {STATS} select date, cast(sum(case when date >= '2001-01-01' then 2 * count else count end) as bigint) as count from stats group by 1"),
    "dash_kpi": (
        lambda s, d: rounded(serving.kpi(stats(s, d), ["Brand#1", "Brand#2"])),
        f"""with {STATS}, t as (select cast(sum(count) as bigint) as volume, {_P} from stats where brand in ('Brand#1', 'Brand#2'))
        select volume, round(pos / nullif(volume, 0), 6) as pos_rate, round(neg / nullif(volume, 0), 6) as neg_rate, round(100.0::double * (pos - neg) / nullif(volume, 0), 6) as nps from t"""),
    "dash_pie": (lambda s, d: serving.sums(stats(s, d), "aspect", "sentiment"), f"with {STATS} select aspect, sentiment, cast(sum(count) as bigint) as cnt from stats group by 1, 2"),
    "dash_global": (lambda s, d: serving.sums(stats(s, d), "sentiment"), f"with {STATS} select sentiment, cast(sum(count) as bigint) as cnt from stats group by 1"),
    "dash_stacked": (
        lambda s, d: serving.sums(stats(s, d).join(F.broadcast(serving.top_values(stats(s, d), "aspect", 5).select("aspect")), "aspect", "left_semi"), "aspect", "sentiment"),
        f"with {STATS} select aspect, sentiment, cast(sum(count) as bigint) as cnt from stats where aspect in {_top(5)} group by 1, 2"),
    "dash_sunburst": (
        lambda s, d: serving.sums(serving.with_other(stats(s, d), "aspect", 9), "brand", "aspect", "sentiment"),
        f"with {STATS} select brand, case when aspect in {_top(9)} then aspect else 'Other' end as aspect, sentiment, cast(sum(count) as bigint) as cnt from stats group by all"),
    "dash_mix_pos": _mix("POS"),
    "dash_mix_neg": _mix("NEG"),
    "dash_trend": (lambda s, d: serving.sums(stats(s, d), "date", "sentiment"), f"with {STATS} select date, sentiment, cast(sum(count) as bigint) as cnt from stats group by 1, 2"),
    "dash_top_neg": (
        lambda s, d: serving.top_values(stats(s, d), "aspect", 10, "NEG"),
        f"with {STATS} select aspect, cast(sum(count) as bigint) as cnt from stats where sentiment = 'NEG' group by 1 order by 2 desc, 1 limit 10"),
    "dash_brands": (lambda s, d: stats(s, d).where("brand is not null and brand <> ''").select("brand").distinct(), f"with {STATS} select distinct brand from stats where brand is not null and brand <> ''"),
    "dash_models": (
        lambda s, d: stats(s, d).where(F.col("brand").isin("Brand#1", "Brand#2") & (F.col("model") != "")).select("model").distinct(),
        f"with {STATS} select distinct model from stats where brand in ('Brand#1', 'Brand#2') and model <> ''"),
    "json_aspect_dist": (
        lambda s, d: serving.aspect_lists(stats(s, d)),
        f"""with {KEYED}, r as (select product_key, aspect, cast(sum(count) as bigint) as cnt from k group by 1, 2)
        select product_key, string_agg(aspect || ':' || cnt, '|' order by cnt desc, aspect) as aspects from r group by 1"""),
    "json_period_summary": (
        lambda s, d: serving.period_summary(stats(s, d)),
        f"""with {KEYED}, f as (select distinct product_key, cast(p as integer) as period_days from k, unnest([7, 30, 90, 180, 365]) as t(p)),
        r as (select product_key, period_days, {_P.replace('coalesce(sum(case', 'coalesce(sum(case')}, cast(sum(count) as bigint) as total from f join k using (product_key)
          where day > (select max(day) from k) - period_days group by 1, 2)
        select product_key, period_days, pos, neu, neg, total from f left join r using (product_key, period_days)"""),
    "json_trend_day": _trend("day"),
    "json_trend_week": _trend("week"),
    "json_trend_month": _trend("month"),
    "quote_pool": (
        lambda s, d: serving.quotes(preds(s, d), ["brand"], "aspect_l1", "NEG", 10, 3).select("brand", "aspect_l1", "cnt", "rank", F.array_join("quotes", "|").alias("quotes")),
        f"""with {PREDS}, g as (select brand, aspect_l1, count(*) as cnt, array_to_string(list_sort(list_distinct(list(sentence)))[1:3], '|') as quotes from preds where pred_label = 'NEG' group by 1, 2)
        select brand, aspect_l1, cnt, cast(rank as integer) as rank, quotes from (select *, row_number() over (partition by brand order by cnt desc, aspect_l1) as rank from g) where rank <= 10"""),
    "product_overview": (
        lambda s, d: preds(s, d).groupBy("brand", "model").agg(
            F.count("*").alias("rows"), F.count_distinct("l_orderkey").alias("docs"), F.count(F.when(F.col("ts").isNull(), 1)).alias("unread"),
            F.to_date(F.min("ts")).alias("first_day"), F.to_date(F.max("ts")).alias("last_day")),
        f"with {PREDS} select brand, model, count(*) as rows, count(distinct l_orderkey) as docs, count(case when ts is null then 1 end) as unread, cast(min(ts) as date) as first_day, cast(max(ts) as date) as last_day from preds group by 1, 2"),
    "platform_breakdown": (
        lambda s, d: preds(s, d).groupBy(F.coalesce("model", F.lit("UNKNOWN")).alias("platform")).agg(F.count("*").alias("cnt")),
        f"with {PREDS} select coalesce(model, 'UNKNOWN') as platform, count(*) as cnt from preds group by 1"),
    "top_neg_rows": (
        lambda s, d: rounded(preds(s, d).orderBy(F.desc("p_neg"), *KEY).limit(20).select(*KEY, "p_neg")),
        f"with {PREDS} select {', '.join(KEY)}, round(p_neg, 6) as p_neg from (select * from preds order by p_neg desc, {', '.join(KEY)} limit 20)"),
}
