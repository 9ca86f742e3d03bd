"""Queries: samples, shards and training sets."""
from __future__ import annotations

from pyspark.sql import functions as F

from murmura.operators import candidates as c
from murmura.operators import quality
from murmura.plans.proxy import KEY, KEY_SQL, PREDS, preds, rounded

TH = {"POS": 0.8, "NEU": 0.7, "NEG": 0.6}
_SURE = " or ".join(f"(pred_label = '{k}' and confidence >= {t})" for k, t in TH.items())
_HASH = f"cast(concat('0x', substr(md5(concat_ws('#', {KEY_SQL})), 1, 8)) as bigint)"
_SEEDED = f"cast(concat('0x', substr(md5(concat_ws('#', '42', {KEY_SQL})), 1, 8)) as bigint)"


def _sure(s, d):
    return c.confident(preds(s, d, False), TH)


QUERIES = {
    "single_aspect": (
        lambda s, d: c.single(preds(s, d), ["l_orderkey", "brand"]).select(*KEY),
        f"with {PREDS} select {KEY_SQL} from (select *, count(*) over (partition by l_orderkey, brand) as n from preds) where n = 1"),
    "inner_limit": (
        lambda s, d: c.limit_each(preds(s, d), ["domain", "brand", "model"], KEY, 5).select(*KEY),
        f"with {PREDS} select {KEY_SQL} from (select *, row_number() over (partition by domain, brand, model order by {KEY_SQL}) as k from preds) where k <= 5"),
    "train_candidates": (
        lambda s, d: c.sample(preds(s, d), KEY, 500, "42").select(*KEY, "brand", "aspect_l1"),
        f"with {PREDS} select {KEY_SQL}, brand, aspect_l1 from preds order by {_SEEDED}, {KEY_SQL} limit 500"),
    "shard_assign": (
        lambda s, d: c.sharded(preds(s, d), KEY, 16).groupBy("shard").agg(F.count("*").alias("cnt")),
        f"with {PREDS} select cast({_HASH} % 16 as integer) as shard, count(*) as cnt from preds group by 1"),
    "label_threshold_filter": (lambda s, d: _sure(s, d).select(*KEY, "pred_label"), f"with {PREDS} select {KEY_SQL}, pred_label from preds where {_SURE}"),
    "balanced_sample": (
        lambda s, d: c.balanced(preds(s, d), KEY, 300).select(*KEY, "pred_label"),
        f"with {PREDS} select {KEY_SQL}, pred_label from (select *, row_number() over (partition by pred_label order by {_HASH}, {KEY_SQL}) as k from preds) where k <= 300"),
    "oversample_neg": (
        lambda s, d: c.repeated(_sure(s, d), "NEG", 2).select(*KEY, "copy"),
        f"with {PREDS} select {KEY_SQL}, cast(i as integer) as copy from preds, range(0, 2) as r(i) where pred_label = 'NEG' and ({_SURE})"),
    "train_v2": (
        lambda s, d: c.training_set(preds(s, d, False), KEY, TH, 400, 2).select(*KEY, "pred_label", "copy"),
        f"""with {PREDS}, sure as (select * from preds where {_SURE})
        select {KEY_SQL}, pred_label, 0 as copy from (select *, row_number() over (partition by pred_label order by {_HASH}, {KEY_SQL}) as k from sure where pred_label <> 'NEG') where k <= 400
        union all select {KEY_SQL}, pred_label, cast(i as integer) as copy from sure, range(0, 2) as r(i) where pred_label = 'NEG'"""),
    "train_valid_split": (
        lambda s, d: c.split(preds(s, d), KEY).select(*KEY, "is_valid"),
        f"""with {PREDS}, n as (select case when count(*) < 500 then floor(count(*) * 0.2) else greatest(200, floor(count(*) * 0.05)) end as c from preds)
        select {KEY_SQL}, row_number() over (order by {_HASH}, {KEY_SQL}) <= (select c from n) as is_valid from preds"""),
    "class_weights": (
        lambda s, d: rounded(c.class_weights(preds(s, d))),
        f"with {PREDS}, p as (select pred_label, count(*) as cnt, 1.0::double / count(*) as raw from preds group by 1) select pred_label, cnt, round(raw / (select avg(raw) from p), 6) as weight from p"),
    "key_overlap": (
        lambda s, d: rounded(c.overlap(preds(s, d), _sure(s, d), ["l_orderkey", "brand"])),
        f"""with {PREDS}, a as (select distinct l_orderkey, brand from preds), b as (select distinct l_orderkey, brand from preds where {_SURE}),
        t as (select (select count(*) from a) as keys, (select count(*) from a join b using (l_orderkey, brand)) as hits) select keys, hits, round(hits / nullif(keys, 0), 6) as rate from t"""),
    "hash_sample": (
        lambda s, d: preds(s, d).where(c.number(*(F.col(k).cast("string") for k in KEY)) / 4294967296.0 < 0.1).select(*KEY),
        f"with {PREDS} select {KEY_SQL} from preds where {_HASH} / 4294967296.0::double < 0.1"),
    "pair_dedup": (
        lambda s, d: quality.deduplicated(preds(s, d)).groupBy("pred_label").agg(F.count("*").alias("cnt")),
        f"with {PREDS} select pred_label, count(*) as cnt from (select *, row_number() over (partition by pair_id order by confidence desc, pred_label) as k from preds) where k = 1 group by 1"),
}
