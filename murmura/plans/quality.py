"""Queries: checks of predictions, times and tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from murmura.functions import labels
from murmura.operators import quality as q
from murmura.operators import web
from murmura.plans.proxy import PREDS, preds, rounded
from murmura.plans.web import V1, _v1

POINTS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
_Q = ", ".join(f"round(quantile_cont(confidence, {p}), 6) as q{round(100 * p)}" for p in POINTS)
_STATS = ", ".join(f"round({f}({c}), 6) as {f}_{c}" for c in ("p_neg", "p_neu", "p_pos", "confidence") for f in ("min", "max", "avg"))


def _shares(s, d):
    rows = preds(s, d)
    sure = rows.where(F.col("confidence") >= 0.8)
    parts = [q.aspect_shares(r, x, 10).withColumn("label", F.lit(x)).withColumn("confident", F.lit(c)) for x in ("POS", "NEG") for r, c in ((rows, False), (sure, True))]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]))


def _shares_sql():
    def one(label, cond, flag):
        return f"""select *, '{label}' as label, {flag} as confident from (select aspect_l1 || '##' || aspect_l2 as aspect, count(*) as cnt, round(count(*) / sum(count(*)) over (), 6) as share
        from preds where pred_label = '{label}' and {cond} group by 1 order by 2 desc, 1 limit 10)"""

    return f"with {PREDS} " + " union all ".join(one(x, c, f) for x in ("POS", "NEG") for c, f in (("true", "false"), ("confidence >= 0.8", "true")))


def _enforced(s, d):
    rows = preds(s, d).select("brand", F.col("ctime").alias("cnt"), F.to_date("ts").cast("string").alias("day"))
    return q.enforce(rows, {"brand": "string", "cnt": "long", "day": "date", "extra": "string"}).groupBy("brand", "day", "extra").agg(F.sum("cnt").alias("cnt"))


QUERIES = {
    "argmax_label": (
        lambda s, d: preds(s, d).groupBy(labels.argmax(F.col("p_neg"), F.col("p_neu"), F.col("p_pos")).alias("label")).agg(F.count("*").alias("cnt")),
        f"with {PREDS} select pred_label as label, count(*) as cnt from preds group by 1"),
    "label_dist": (
        lambda s, d: q.label_dist(preds(s, d), 0.8),
        f"with {PREDS} select pred_label, count(*) as cnt, count(case when confidence >= 0.8 then 1 end) as cnt_confident from preds group by 1"),
    "argmax_consistency": (
        lambda s, d: q.consistency(preds(s, d).withColumn("pred_label", F.when(F.col("l_suppkey") % 11 == 0, "NEU").otherwise(F.col("pred_label")))),
        f"with {PREDS}, x as (select *, case when l_suppkey % 11 = 0 then 'NEU' else pred_label end as said from preds) select count(case when said = pred_label then 1 end) as matches, count(case when said <> pred_label then 1 end) as mismatches from x"),
    "id_label_crosstab": (lambda s, d: q.crosstab(preds(s, d)), f"with {PREDS} select pred_id, pred_label, count(*) as cnt from preds group by 1, 2"),
    "prob_sanity": (
        lambda s, d: rounded(q.probabilities(preds(s, d))),
        f"""with {PREDS} select count(*) as n, {_STATS}, round(max(abs(p_neg + p_neu + p_pos - 1)), 6) as max_error,
        count(case when not (p_neg between 0 and 1 and p_neu between 0 and 1 and p_pos between 0 and 1) then 1 end) as out_of_range, true as passed from preds"""),
    "conf_quantiles": (lambda s, d: rounded(q.quantiles(preds(s, d), POINTS)), f"with {PREDS} select {_Q} from preds"),
    "conf_quantiles_by_label": (lambda s, d: rounded(q.quantiles(preds(s, d), POINTS, ["pred_label"])), f"with {PREDS} select pred_label, {_Q} from preds group by 1"),
    "aspect_share_topk": (_shares, _shares_sql()),
    "ctime_quality": (
        lambda s, d: q.time_quality(preds(s, d).withColumn("ctime", F.when(F.col("l_suppkey") % 9 == 0, None).when(F.col("l_suppkey") % 10 == 0, " ").otherwise(F.col("ctime")))),
        f"""with {PREDS}, c as (select case when l_suppkey % 9 = 0 then null when l_suppkey % 10 = 0 then ' ' else ctime end as ctime from preds)
        select count(*) as n, count(case when ctime is null then 1 end) as nulls, count(case when trim(ctime) = '' then 1 end) as blanks, min(ctime) as min_ctime, max(ctime) as max_ctime from c"""),
    "ctime_probe": (
        lambda s, d: q.time_probe(preds(s, d)),
        f"""with {PREDS}, c as (select try_cast(ctime as double) as x, ts from preds) select count(x) as numeric, count(case when x > 1e11 then 1 end) as millis,
        count(case when x is null and ts is not null then 1 end) as written, count(case when ts is null then 1 end) as unread from c"""),
    "pseudolabel_checks": (
        lambda s, d: q.pseudolabels(preds(s, d).withColumn("confidence", F.when(F.col("l_suppkey") % 13 == 0, F.lit(1.5)).otherwise(F.col("confidence")))),
        f"""with {PREDS} select 0::bigint as bad_labels, (select count(*) from preds where l_suppkey % 13 = 0) as bad_confidence,
        (select count(*) from (select pair_id from preds group by 1 having count(*) > 1)) as repeated_ids"""),
    "enforce_schema": (
        _enforced,
        f"""with {PREDS} select brand, cast(ts as date) as day, cast(null as varchar) as extra, cast(sum(case when regexp_matches(ctime, '^[0-9]+$') then cast(ctime as bigint) else 0 end) as bigint) as cnt from preds group by 1, 2"""),
    "brand_model_blocklist": (
        lambda s, d: q.blocklist(preds(s, d)),
        f"with {PREDS}, t as (select unnest([brand, model, lower(brand), lower(model)]) as term from preds) select distinct term from t where term is not null and term <> ''"),
    "web_ready_sanity": (
        lambda s, d: q.days(preds(s, d).withColumn("day", F.to_date("ts")), "2000-01-01", "2001-06-30"),
        f"""with {PREDS} select count(*) as n, count(case when ts is null then 1 end) as null_days,
        count(case when cast(ts as date) not between date '2000-01-01' and date '2001-06-30' then 1 end) as out_of_bounds from preds"""),
    "product_list_sanity": (
        lambda s, d: web.products(_v1(s, d)).agg(F.count("*").alias("n"), F.count(F.when(F.col("first_day") > F.col("last_day"), 1)).alias("bad")),
        f"with {V1} select count(distinct product_id) as n, 0::bigint as bad from v"),
    "count_invariant": (
        lambda s, d: web.span_tally(_v1(s, d), ["product_id", "aspect_l1"]).agg(F.count(F.when(F.col("total_cnt") != F.col("pos_cnt") + F.col("neu_cnt") + F.col("neg_cnt"), 1)).alias("broken")),
        "select 0::bigint as broken"),
}
