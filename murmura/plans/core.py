"""Queries: aggregates, time series and examples over predictions."""
from __future__ import annotations

from pyspark.sql import functions as F

from murmura.functions import labels
from murmura.functions.times import bucket
from murmura.operators import aggregate as agg
from murmura.plans.proxy import K5, KEY, KEY_SQL, PREDS, preds, rounded

T = 0.7
WK = ["domain", "brand", "aspect_l1", "time_bucket"]
WK_SQL = "domain, brand, aspect_l1, time_bucket"
WEEKLY = PREDS + ", w as (select *, cast(date_trunc('week', ts) as date) as time_bucket from preds where ts is not null)"


def _counts(suffix: str = "", cond: str = "true") -> str:
    return ", ".join(f"count(case when pred_label = '{x}' and {cond} then 1 end) as {x.lower()}_cnt{suffix}" for x in ("POS", "NEU", "NEG"))


def _all_sql(source: str, keys: str) -> str:
    return f"""select *, round(pos_cnt / nullif(total_cnt, 0), 6) as pos_rate, round(neu_cnt / nullif(total_cnt, 0), 6) as neu_rate, round(neg_cnt / nullif(total_cnt, 0), 6) as neg_rate,
  round((pos_cnt - neg_cnt) / total_cnt, 6) as sent_score from (select {keys}, {_counts()}, count(*) as total_cnt from {source} group by {keys})"""


def _hard_sql(source: str, keys: str) -> str:
    whole = " and ".join(f"{k.strip()} is not null" for k in keys.split(","))
    cond = f"confidence >= {T} and {whole}"
    return f"""select *, round(pos_cnt_hard / nullif(total_hard, 0), 6) as pos_rate_hard, round(neu_cnt_hard / nullif(total_hard, 0), 6) as neu_rate_hard,
  round(neg_cnt_hard / nullif(total_hard, 0), 6) as neg_rate_hard, round((pos_cnt_hard - neg_cnt_hard) / nullif(total_hard, 0), 6) as sent_score_hard, round(total_hard / total_all, 6) as coverage
  from (select {keys}, count(*) as total_all, {_counts('_hard', cond)}, count(case when {cond} then 1 end) as total_hard from {source} group by {keys})"""


def _soft_sql(source: str, keys: str) -> str:
    return f"""select {keys}, round(w_pos, 6) as w_pos, round(w_neu, 6) as w_neu, round(w_neg, 6) as w_neg, round(t, 6) as w_total, round(w_pos / nullif(t, 0), 6) as pos_share,
  round(w_neu / nullif(t, 0), 6) as neu_share, round(w_neg / nullif(t, 0), 6) as neg_share, round((w_pos - w_neg) / nullif(t, 0), 6) as sent_score_soft
  from (select *, w_pos + w_neu + w_neg as t from (select {keys}, sum(p_pos) as w_pos, sum(p_neu) as w_neu, sum(p_neg) as w_neg from {source} group by {keys}))"""


def _weekly(spark, d):
    return agg.timed(preds(spark, d), "week")


def _pairs(spark, d):
    rows = preds(spark, d)
    left = rows.select("pair_id", F.when(F.col("l_linenumber") % 2 == 0, F.col("brand")).alias("brand"), "model")
    right = rows.where(F.col("l_linenumber") % 3 != 0).groupBy("pair_id").agg(F.min("brand").alias("brand"), F.min(F.coalesce("model", F.lit("none"))).alias("model"))
    return agg.enrich(left, right, ["brand", "model"])


def _parse(spark, d):
    return preds(spark, d).select(*KEY, "ctime", F.unix_seconds("ts").alias("epoch"))


def _buckets(spark, d):
    rows = preds(spark, d).where(F.col("ts").isNotNull())
    grains = F.explode(F.array(*(F.struct(F.lit(g).alias("grain"), bucket(g, F.col("ts")).alias("bucket")) for g in ("day", "week", "month"))))
    return rows.select(grains.alias("b")).groupBy("b.grain", "b.bucket").agg(F.count("*").alias("cnt"))


def _from_id(spark, d):
    lost = F.when(F.col("l_suppkey") % 7 != 0, F.col("pred_label"))
    return preds(spark, d).groupBy(labels.label_from_id(lost, F.col("pred_id")).alias("label")).agg(F.count("*").alias("cnt"))


def _confidence(spark, d):
    lost = F.when(F.col("l_suppkey") % 3 != 0, F.col("confidence"))
    value = labels.confidence(lost, F.col("p_neg"), F.col("p_neu"), F.col("p_pos"))
    return rounded(preds(spark, d).groupBy("aspect_l1").agg(F.avg(value).alias("avg_confidence"), F.max(value).alias("max_confidence")))


QUERIES = {
    "agg_all": (lambda s, d: rounded(agg.aggregate_all(preds(s, d, False, False))), f"with {PREDS} {_all_sql('preds', K5)}"),
    "agg_hard": (lambda s, d: rounded(agg.aggregate_hard(preds(s, d, False, False), T)), f"with {PREDS} {_hard_sql('preds', K5)}"),
    "agg_soft": (lambda s, d: rounded(agg.aggregate_soft(preds(s, d, False, False))), f"with {PREDS} {_soft_sql('preds', K5)}"),
    "label_from_id": (_from_id, f"with {PREDS} select pred_label as label, count(*) as cnt from preds group by 1"),
    "confidence_fallback": (_confidence, f"with {PREDS} select aspect_l1, round(avg(confidence), 6) as avg_confidence, round(max(confidence), 6) as max_confidence from preds group by 1"),
    "hard_filter": (
        lambda s, d: rounded(preds(s, d).where(F.col("confidence") >= 0.8).select(*KEY, "pred_label", "confidence")),
        f"with {PREDS} select {KEY_SQL}, pred_label, round(confidence, 6) as confidence from preds where confidence >= 0.8"),
    "parse_ctime": (_parse, f"with {PREDS} select {KEY_SQL}, ctime, cast(epoch(ts) as bigint) as epoch from preds"),
    "time_bucket": (
        _buckets, f"with {PREDS} " + " union all ".join(
            f"select '{g}' as grain, cast(date_trunc('{g}', ts) as date) as bucket, count(*) as cnt from preds where ts is not null group by 2" for g in ("day", "week", "month"))),
    "ts_all": (lambda s, d: rounded(agg.aggregate_all(_weekly(s, d), WK)), f"with {WEEKLY} {_all_sql('w', WK_SQL)}"),
    "ts_all_long": (lambda s, d: agg.all_long(_weekly(s, d), WK), f"with {WEEKLY} select {WK_SQL}, pred_label, count(*) as cnt from w group by all"),
    "ts_hard": (lambda s, d: rounded(agg.aggregate_hard(_weekly(s, d), T, WK)), f"with {WEEKLY} {_hard_sql('w', WK_SQL)}"),
    "ts_hard_long": (
        lambda s, d: agg.hard_long(_weekly(s, d), T, WK),
        f"""with {WEEKLY}, a as (select {WK_SQL}, count(*) as total_all from w group by all),
        h as (select {WK_SQL}, pred_label as label, count(*) as cnt from w where confidence >= {T} group by all)
        select {WK_SQL}, total_all, label, coalesce(cnt, 0) as cnt from a left join h using ({WK_SQL})"""),
    "ts_soft": (lambda s, d: rounded(agg.aggregate_soft(_weekly(s, d), WK)), f"with {WEEKLY} {_soft_sql('w', WK_SQL)}"),
    "ts_soft_long": (
        lambda s, d: rounded(agg.soft_long(_weekly(s, d), WK)),
        f"with {WEEKLY} " + " union all ".join(f"select {WK_SQL}, '{x}' as label, round(sum(p_{x.lower()}), 6) as weight from w group by {WK_SQL}" for x in ("POS", "NEU", "NEG"))),
    "examples_topk": (
        lambda s, d: rounded(agg.examples(preds(s, d, False), 3, KEY, ["brand", "aspect_l1"]).select("brand", "aspect_l1", "side", "rank", *KEY, "p_pos", "p_neg")),
        f"with {PREDS} " + " union all ".join(
            f"""select brand, aspect_l1, '{x}' as side, cast(rank as integer) as rank, {KEY_SQL}, round(p_pos, 6) as p_pos, round(p_neg, 6) as p_neg from
            (select *, row_number() over (partition by brand, aspect_l1 order by p_{x} desc, {KEY_SQL}) as rank from preds) where rank <= 3""" for x in ("pos", "neg"))),
    "pivot_l2": (
        lambda s, d: rounded(agg.pivot_score(agg.aggregate_hard(preds(s, d, False, False), T), ["F", "O"])),
        f"with {PREDS}, h as ({_hard_sql('preds', K5).replace('round((pos_cnt_hard - neg_cnt_hard) / nullif(total_hard, 0), 6)', '(pos_cnt_hard - neg_cnt_hard) / nullif(total_hard, 0)')}) "
        "select aspect_l1, round(avg(case when aspect_l2 = 'F' then sent_score_hard end), 6) as \"F\", round(avg(case when aspect_l2 = 'O' then sent_score_hard end), 6) as \"O\" from h group by 1"),
    "pairs_enrich": (
        _pairs, f"""with {PREDS}, r as (select pair_id, min(brand) as b, min(coalesce(model, 'none')) as m from preds where l_linenumber % 3 <> 0 group by 1)
        select pair_id, coalesce(case when l_linenumber % 2 = 0 then brand end, b) as brand, coalesce(model, m) as model from preds left join r using (pair_id)"""),
}
