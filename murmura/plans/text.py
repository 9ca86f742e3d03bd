"""Queries: ingest, sentences, cleaning and terms."""
from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from murmura.functions import text
from murmura.functions.hashing import document_id, fraction
from murmura.operators import coverage, ingest
from murmura.plans.proxy import SENT, documents, sent, shared
from murmura.sources import reviews
from murmura.streaming import incremental

_LEGACY = r"""regexp_split_to_array(text, '[。！？；…!?;.]+')"""
_STRIPX = r"regexp_replace({}, '^[\s\x{{A0}}\x{{3000}}]+|[\s\x{{A0}}\x{{3000}}]+$', '', 'g')"
STOP = ("the", "and", "of")
_HAN = r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}]"


def tokens_sql(column: str) -> str:
    """Words of letters, digits and _, and pairs of neighbouring ideographs."""
    words = rf"regexp_split_to_array(regexp_replace(lower({column}), '({_HAN}+)', ' \1 ', 'g'), '[^\p{{L}}\p{{N}}_]+')"
    pairs = f"case when regexp_matches(x, '^{_HAN}{{2}}') then list_transform(range(1, length(x)), lambda i: substr(x, i, 2)) else [x] end"
    return f"list_filter(flatten(list_transform({words}, lambda x: {pairs})), lambda x: length(x) >= 2)"




def _legacy(s, d):
    return documents(s, d).select("doc_id", F.posexplode(text.sentences_legacy(F.col("text"))).alias("sentence_idx", "sentence"))


def _clean(s, d):
    rows = documents(s, d).select("doc_id", text.clean(F.concat(F.lit("<b>\x01"), "text", F.lit("</b> 😀🇩🇪🤖 end")), (r"\bend$",)).alias("t"))
    return rows.select("doc_id", F.length("t").alias("n"), F.md5("t").alias("digest"))


def _html(s, d):
    rows = s.read.parquet(f"{d}/pages.parquet").select("page_id", text.without_tags(F.col("html")).alias("t"))
    return rows.select("page_id", F.md5("t").alias("digest"))


def _paths(s, d):
    path = F.when(F.col("doc_id") % 5 == 0, F.concat(F.col("doc_id").cast("string"), F.lit(".json"))).when(
        F.col("doc_id") % 5 == 1, F.concat_ws("/", "source", F.concat(F.col("doc_id").cast("string"), F.lit(".json")))).otherwise(
        F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".json"))))
    brand, model = reviews.path_parts(path)
    return documents(s, d).select("doc_id", brand.alias("brand"), model.alias("model"))


def _fields(s, d):
    rows = s.read.parquet(f"{d}/events.parquet").select("event_id", F.try_parse_json("props").alias("v"))
    return rows.select("event_id", reviews.field(F.col("v"), ("missing", "k")).alias("value"))


def _ids(s, d):
    return documents(s, d).select("doc_id", document_id(F.concat_ws("/", "source", "lang"), F.col("doc_id")).alias("id"))


def _manifest(s, d):
    docs = documents(s, d).select("source", F.concat(F.lit("2024-"), (F.col("doc_id") % 12 + 10).cast("string")).alias("ctime"), "doc_id")
    rows = sent(s, d).join(docs.select("doc_id", "source"), "doc_id")
    return reviews.manifest(docs, rows, "source")


def _clean_stats(s, d):
    rows = documents(s, d).withColumn("n", F.size(text.sentences(F.col("text"))))
    return rows.groupBy("source").agg(F.count("*").alias("reviews"), F.sum("n").alias("sentences"), (F.count(F.when(F.col("n") == 0, 1)) / F.count("*")).alias("empty_ratio"))


def _ingest(s, d):
    """Files of every kind that readers must take, written to the shared folder of the session or a local one."""
    folder = shared(s)
    root = f"{folder.rstrip('/')}/reviews-{os.getpid()}"
    line = lambda **x: json.dumps(x, ensure_ascii=False)
    made = {
        "acme/one": [line(id=7, content="好。不好！", ctime=1766475000) + "\n\n{broken\n" + line(comment=" Fine. ", id=True)],
        "acme/two": ["[" + line(text={"a": 1}, body="nested falls through; yes") + ", 3, " + line(text=12.5) + "]"],
        "acme/three": [line(review_id="r1", review="single object\nwith two lines")],
        "broken": ["[{\"content\": 1"],
    }
    for name, values in made.items():
        s.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/{name}")
    read = s.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(root, wholetext=True)
    texts = read.select(F.col("_metadata.file_path").alias("path"), F.col("value"))
    out = reviews.clean_sentences(reviews.records(texts), "test", root)
    return out.select("domain", "brand", "doc_id", "sentence_idx", "sentence", "ctime").withColumn("doc_id", F.when(F.length("doc_id") == 32, "hashed").otherwise(F.col("doc_id")))


def _changed(s, d):
    before = incremental.inventory(s, d, "*.parquet").where(~F.col("path").contains("orders"))
    return incremental.changed(incremental.renewed(s, d, before, "*.parquet"), before).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.length("sha1").alias("digits"))


_PATH_SQL = """case when doc_id % 5 = 0 then doc_id || '.json' when doc_id % 5 = 1 then source || '/' || doc_id || '.json' else source || '/' || lang || '/' || doc_id || '.json' end"""
_CLEAN_SQL = r"""regexp_replace('<b>' || chr(1) || text || '</b> 😀🇩🇪🤖 end', '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g')"""

QUERIES = {
    "sentence_split": (sent, f"with {SENT} select doc_id, sentence_idx, sentence from sent"),
    "sentence_split_legacy": (
        _legacy,
        f"""with a as (select doc_id, list_filter(list_transform({_LEGACY}, lambda x: {_STRIPX.format('x')}), lambda x: x <> '') as p from documents),
        b as (select doc_id, list_filter(flatten(list_transform(p, lambda x: case when length(x) > 120 then list_transform(regexp_split_to_array(x, '[，,]+'), lambda y: {_STRIPX.format('y')}) else [x] end)), lambda z: length(z) >= 2) as q from a)
        select doc_id, cast(unnest(range(0, len(q))) as integer) as sentence_idx, unnest(q) as sentence from b"""),
    "nonblank_sentences": (
        lambda s, d: sent(s, d).where(F.length("sentence") >= 6).groupBy("doc_id").agg(F.count("*").alias("cnt")),
        f"with {SENT} select doc_id, count(*) as cnt from sent where length(sentence) >= 6 group by 1"),
    "clean_text": (
        _clean,
        rf"""with a as (select doc_id, regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace({_CLEAN_SQL}, '<[^>]+>', ' ', 'g'),
        '[\x{{1F600}}-\x{{1F64F}}\x{{1F300}}-\x{{1F5FF}}\x{{1F680}}-\x{{1F6FF}}\x{{1F1E0}}-\x{{1F1FF}}]', '', 'g'), '\s+', ' ', 'g')), '\bend$', '', 'g') as t from documents)
        select doc_id, cast(length(t) as integer) as n, md5(t) as digest from a"""),
    "html_strip": (
        _html, r"select page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) as digest from pages"),
    "path_brand_model": (
        _paths, f"with p as (select doc_id, string_split({_PATH_SQL}, '/') as x from documents) select doc_id, x[1] as brand, case when len(x) >= 2 then x[2] else 'unknown' end as model from p"),
    "json_field_priority": (_fields, "select event_id, nullif(json_extract_string(props, '$.k'), '') as value from events"),
    "doc_id_hash": (_ids, "select doc_id, md5(source || '/' || lang || '#' || doc_id) as id from documents"),
    "prompt_text": (
        lambda s, d: sent(s, d).select("doc_id", "sentence_idx", text.prompt(F.lit("looks"), F.lit("shape"), F.col("sentence")).alias("prompt")),
        f"with {SENT} select doc_id, sentence_idx, '[looks::shape] ' || regexp_replace(sentence, '[\\r\\n]+', ' ', 'g') as prompt from sent"),
    "file_name": (
        lambda s, d: documents(s, d).select("doc_id", text.file_name(F.col("text")).alias("name")),
        rf"""select doc_id, substr(regexp_replace({_STRIPX.format("text")}, '[\\/:*?"<>|\s]+', '_', 'g'), 1, 120) as name from documents"""),
    "ngrams": (
        lambda s, d: coverage.phrase_counts(documents(s, d), "text", 2).where("tf >= 3"),
        f"""with t as (select {tokens_sql('text')} as w from documents), g as (select unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as term from t)
        select term, count(*) as tf from g group by 1 having count(*) >= 3"""),
    "token_counts": (
        lambda s, d: coverage.token_counts(documents(s, d), "text", STOP),
        f"""with t as (select doc_id, unnest({tokens_sql('text')}) as term from documents) select term, count(*) as tf, count(distinct doc_id) as df from t where term not in {STOP} group by 1"""),
    "valid_terms": (
        lambda s, d: coverage.token_counts(documents(s, d), "text").where(text.is_term(F.col("term"), 2, 12, STOP)).select("term"),
        f"""with t as (select distinct unnest({tokens_sql('text')}) as term from documents) select term from t where length(term) between 2 and 12 and regexp_matches(term, '\\p{{L}}') and not regexp_matches(term, '^[0-9]+$') and term not in {STOP}"""),
    "tokens_mixed": (
        lambda s, d: coverage.token_counts(documents(s, d).withColumn("text", F.concat(F.lit("屏幕很好abc续航差_x "), F.col("text"), F.lit(" 高清"))), "text"),
        f"""with m as (select doc_id, '屏幕很好abc续航差_x ' || text || ' 高清' as text from documents), t as (select doc_id, unnest({tokens_sql('text')}) as term from m)
        select term, count(*) as tf, count(distinct doc_id) as df from t group by 1"""),
    "text_sample": (
        lambda s, d: documents(s, d).where(fraction(F.col("text")) < 0.25).select("doc_id"),
        "select doc_id from documents where cast(concat('0x', substr(md5(text), 1, 8)) as bigint) / 4294967296.0::double < 0.25"),
    "ingest_manifest": (
        _manifest,
        f"""with {SENT}, c as (select doc_id, count(*) as n from sent group by 1)
        select source, count(*) as docs, min('2024-' || (doc_id % 12 + 10)) as min_ctime, max('2024-' || (doc_id % 12 + 10)) as max_ctime, cast(coalesce(sum(n), 0) as bigint) as sentences from documents left join c using (doc_id) group by 1"""),
    "clean_stats": (
        _clean_stats,
        f"""with {SENT} select source, count(*) as reviews, cast(sum(len(p)) as bigint) as sentences, count(case when len(p) = 0 then 1 end) / count(*) as empty_ratio from documents join parts using (doc_id) group by 1"""),
    "ingest_files": (
        _ingest,
        """select 'test' as domain, * from (values ('acme', '7', 0, '好', '1766475000'), ('acme', '7', 1, '不好', '1766475000'), ('acme', 'True', 0, 'Fine.', null), ('acme', 'hashed', 0, 'nested falls through', null), ('acme', 'hashed', 1, 'yes', null),
        ('acme', 'hashed', 0, '12.5', null), ('acme', 'r1', 0, 'single object', null), ('acme', 'r1', 1, 'with two lines', null)) v(brand, doc_id, sentence_idx, sentence, ctime)"""),
    "changed_files": (_changed, "select 'orders.parquet' as name, 40 as digits"),
}


def _prompts(s, d):
    rows = sent(s, d).select(
        "*", (F.col("doc_id") % 4).alias("shard"), F.lit("looks").alias("aspect_l1"), F.lit("shape").alias("aspect_l2"))
    return ingest.packed_prompts(rows, 5, ["doc_id", "sentence_idx"])


_MODELS = ("Pro", "ultra", "屏幕", "非常非常长的一个词语啊", "ip68", "x100", "mate60pro", "se")


def _good(s, d):
    blocked = documents(s, d).select(F.col("lang").alias("term")).distinct()
    words = coverage.token_counts(documents(s, d), "text").where("df >= 3").select("term")
    more = s.createDataFrame([(x,) for x in _MODELS], "term string")
    return ingest.good_terms(words.unionByName(more), blocked, 8, ("the", "de", "en", "nd", "der", "ip68", "屏幕"))


def _records(s, d):
    rows = s.read.parquet(f"{d}/events.parquet").select(
        F.lit("p").alias("path"), F.col("event_id").alias("source_line"), F.try_parse_json(F.concat(F.lit('{"id":'), "event_id", F.lit(',"a":{"b":"'), "event_type", F.lit('"},"t":"2024/01/02"}'))).alias("record"))
    out = ingest.normal_records(rows, {"content": "a.b", "ctime": "t"}, ("t",))
    return out.select("doc_id", "content", "ctime", "parse_error", F.col("extra_json")["t"].alias("extra"))


QUERIES |= {
    "prompt_pack": (
        _prompts,
        f"""with {SENT}, k as (select doc_id % 4 as shard, row_number() over (partition by doc_id % 4 order by doc_id, sentence_idx) - 1 as k, sentence from sent)
        select shard, k // 5 as batch, string_agg((k % 5 + 1) || '. [looks::shape] ' || regexp_replace(sentence, '[\\r\\n]+', ' ', 'g'), chr(10) order by k) as prompt, count(*) as n from k group by 1, 2"""),
    "good_terms": (
        _good,
        f"""with t as (select doc_id, unnest({tokens_sql('text')}) as term from documents), c as (select term from t group by 1 having count(distinct doc_id) >= 3)
        , m as (select term from c union all select unnest([{", ".join(f"'{x}'" for x in _MODELS)}]))
        select term from m where not regexp_matches(lower(term), '^[a-z]*[0-9]+(pro|plus|max|ultra|mini|se)?$') and lower(term) not in ('pro', 'ultra', 'max', 'plus', 'se') and length(term) <= 8
        and (not regexp_matches(term, '^[A-Za-z0-9+.-]+$') or term in ('the', 'de', 'en', 'nd', 'der', 'ip68', '屏幕')) and term not in (select lang from documents)"""),
    "normal_records": (
        _records, "select cast(event_id as varchar) as doc_id, event_type as content, '2024-01-02 00:00:00' as ctime, event_type is null as parse_error, '2024/01/02' as extra from events"),
}
