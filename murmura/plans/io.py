"""Queries: files in and out, resumed runs, and what older inputs need. Each writes what it reads to the shared folder."""
from __future__ import annotations

import json
import os
import tempfile
import uuid

from pyspark.sql import functions as F

from murmura.functions import text, times
from murmura.operators import aggregate, coverage, ingest, serving
from murmura.plans.proxy import KEY, PREDS, documents, preds, shared
from murmura.plans.serving import STATS, stats
from murmura.plans.text import tokens_sql
from murmura.sources import config, lines, mirror, sheets, sqlite, steplog, tables
from murmura.sources.scratch import table
from murmura.streaming import incremental


def _folder(s, name: str) -> str:
    """A new folder in the shared one."""
    return f"{shared(s)}/{name}-{uuid.uuid4().hex}"


def _local(name: str) -> str:
    """A path on the driver's machine, for files that only it opens."""
    return os.path.join(tempfile.mkdtemp(prefix="murmura-"), name)


ASPECTS = """domain: phone
aspects:
  - l1: screen
    l2: {panel: [oled, 屏幕], film: terms/film.txt}
"""
NESTED = """domain: car
l1:
  - name: seat
    aliases: [chair]
    l2: [{name: fabric, terms: [leather, 12]}, {terms: [x]}]
"""


def _yaml(s, d):
    root = _folder(s, "configs")
    for path, content in (("domains/phone/aspects.yaml", ASPECTS), ("domains/phone/domain.yaml", "domain: phone"), ("domains/phone/terms/film.txt", "屏幕膜 # film\n\nfoil"),
                          ("aspects_car.yaml", NESTED), ("domain_car.yaml", "domain: car")):
        tables.write_text(s, f"{root}/{path}", content)
    return config.lexicon(s, config.resolve(s, root, "Phone")[0]).unionByName(config.lexicon(s, config.resolve(s, root, "car")[0]))


_YAML_SQL = """select * from (values ('phone', 'screen', 'panel', 'oled', 0), ('phone', 'screen', 'panel', '屏幕', 1), ('phone', 'screen', 'film', '屏幕膜', 2), ('phone', 'screen', 'film', 'foil', 3),
('car', 'seat', '_L1', 'chair', 0), ('car', 'seat', 'fabric', 'leather', 1), ('car', 'seat', 'fabric', '12', 2), ('car', 'seat', 'unnamed', 'x', 3)) v(domain, l1, l2, term, ord)"""


def _term_files(s, d):
    root = _folder(s, "terms")
    tables.write_text(s, f"{root}/screen__panel.txt", "oled\n# no term\noled\nlcd # old")
    tables.write_text(s, f"{root}/power__cell.txt", " battery ")
    return tables.lexicon_files(s, root)


def _word_set(s, d):
    root = _folder(s, "words")
    tables.write_text(s, f"{root}/stop.txt", "the\n the\n# no word\n\nof")
    return tables.word_set(s, root)


def _sqlite(s, d):
    path = _local("stats.db")
    made = stats(s, d)
    for _ in range(2):
        sqlite.load_range(made, path)
    return sqlite.read(s, path, f"select date, brand, aspect, sentiment, sum(count) from {sqlite.TABLE} group by 1, 2, 3, 4", "date string, brand string, aspect string, sentiment string, count long")


def _workbook(s, d):
    path = _local("book.xlsx")
    per = stats(s, d).groupBy("brand", "sentiment").agg(F.sum("count").cast("long").alias("count"))
    sheets.write({"by brand": per, "too large": stats(s, d), "notes": s.createDataFrame([("<a> & b",)], "note string")}, path, 1000)
    return sheets.read(s, path, "by brand").select("brand", "sentiment", F.col("count").cast("long").alias("count"))


def _sheet_terms(s, d):
    path = _local("terms.xlsx")
    rows = stats(s, d).groupBy("aspect").agg(F.sum("count").cast("long").alias("df")).select(F.col("aspect").alias("Term"), "df")
    sheets.write({"terms": rows}, path)
    return sheets.terms(sheets.read(s, path), "unmapped").select("term", "df", "source")


def _line_files(s, d):
    """JSON lines of each language, in a folder of parts that go on one after the other: some documents behind a blank or broken line, some in arrays of two."""
    one = F.to_json(F.struct("doc_id", F.col("text").alias("content")))
    value = F.concat(
        F.when(F.col("doc_id") % 7 == 0, F.lit("{broken\n")).otherwise(""), F.when(F.col("doc_id") % 11 == 0, F.lit("\r\n")).otherwise(""),
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("["), one, F.lit(", 3, {\"doc_id\": -1}]"))).otherwise(one))
    root = _folder(s, "lines")
    rows = s.read.parquet(f"{d}/documents.parquet").select("lang", "doc_id", value.alias("value"))
    rows.repartitionByRange(int(s.conf.get("spark.sql.shuffle.partitions")), "lang", "doc_id").sortWithinPartitions("lang", "doc_id").select("lang", "value").write.partitionBy("lang").text(root)
    return root


def _lines(s, d, legacy):
    rows = lines.lines(s, _line_files(s, d), folders=True)
    found = lines.line_records(rows, legacy, 1 if legacy else 0)
    told = F.try_variant_get("record", "$.doc_id", "bigint")
    return found.select(F.regexp_extract("path", "lang=([^/]*)$", 1).alias("lang"), "source_line", told.alias("doc_id"), F.coalesce(F.length(F.try_variant_get("record", "$.content", "string")), F.lit(0)).alias("n"))


_LINES_SQL = """with a as (select *, case when doc_id % 7 = 0 then 1 else 0 end + case when doc_id % 11 = 0 then 1 else 0 end as before from documents),
b as (select *, cast(sum(before + 1) over (partition by lang order by doc_id) - 1 as bigint) as line from a)"""


def _hive(s, d):
    root = _folder(s, "preds")
    rows = preds(s, d, False).select("brand", "aspect_l1", "pred_label", "l_linenumber")
    rows.where("l_linenumber <= 2").drop("l_linenumber").write.partitionBy("aspect_l1").parquet(f"{root}/part=one")
    rows.where("l_linenumber > 2").drop("l_linenumber").write.parquet(f"{root}/part=two")
    return tables.hive(s, root).groupBy("part", "aspect_l1").agg(F.count("*").alias("cnt"))


def _layouts(s, d):
    """The same rows in each of the layouts that predictions may have."""
    root = _folder(s, "layouts")
    rows = preds(s, d, False).select("brand", (F.col("l_partkey") % 3).alias("shard"))
    rows.write.partitionBy("shard").parquet(f"{root}/sharded")
    rows.write.parquet(f"{root}/flat")
    rows.write.parquet(f"{root}/deep/a/b")
    out = None
    for name in ("sharded", "flat", "deep"):
        part = tables.predictions(s, f"{root}/{name}").groupBy(F.lit(name).alias("layout"), F.col("shard").cast("int").alias("shard")).agg(F.count("*").alias("cnt"))
        out = part if out is None else out.unionByName(part)
    return out


def _reconcile(s, d):
    """A folder with a file that its manifest doesn't name."""
    root = _folder(s, "reconcile")
    # Worked out by all tasks; one task writes a file only out of what was made, a column of few values.
    brands = table(preds(s, d, False, False).select("brand", (F.col("l_linenumber") < 4).alias("named")), "brands")
    brands.where("named").select("brand").coalesce(1).write.parquet(root)
    named = [r[0] for r in s.read.parquet(root).select(F.col("_metadata.file_path")).distinct().collect()]
    brands.where("not named").select("brand").coalesce(1).write.mode("append").parquet(root)
    where = _folder(s, "manifest")
    tables.write_text(s, f"{where}/manifest.jsonl", "\n".join([json.dumps({"file": named[0]}), named[0].rsplit("/", 1)[1], "", "gone.parquet", "notes.txt"]))
    return tables.reconciled(s, f"{where}/manifest.jsonl", root)


def _latest(s, d):
    root = _folder(s, "runs")
    for run, lines in (("2024-01-02", "x < 3"), ("2024-01-10", "x < 5"), ("2023-12-31", "x < 7")):
        preds(s, d, False).selectExpr("l_linenumber as x").where(lines).write.parquet(f"{root}/{run}/step")
    return s.read.parquet(tables.latest_run(s, root) + "/step").groupBy("x").agg(F.count("*").alias("cnt"))


def _snapshot(s, d):
    root = _folder(s, "serving")
    for stamp in ("1", "2"):
        tables.publish({"daily_stats": stats(s, d).where(F.col("sentiment") == ("POS" if stamp == "1" else "NEG"))}, root, stamp)
    return tables.latest(s, root, "daily_stats").groupBy("sentiment").agg(F.sum("count").cast("long").alias("count"))


def _csv_pair(s, d):
    root = _folder(s, "pair")
    tables.write_pair(stats(s, d).groupBy("brand").agg(F.sum("count").alias("count")), f"{root}/brands")
    back = s.read.option("header", "true").csv(f"{root}/brands.csv")
    return back.select(F.col(back.columns[0]).alias("brand"), F.col("count").cast("long").alias("count"))


def _mirrored(s, d):
    """Predictions in two lots of files: the second run reads only the row groups that the first hasn't."""
    source, target = _folder(s, "predicted"), _folder(s, "mirrored")
    rows = preds(s, d, False).select("l_orderkey", "l_linenumber", "pred_label")
    step = lambda df: df.select("pred_label", (F.col("l_linenumber") * 2).alias("doubled"), mirror.FILE, mirror.GROUP)
    for part in (0, 1):
        rows.where(F.col("l_orderkey") % 2 == part).write.mode("append").option("parquet.block.size", 1 << 18).parquet(f"{source}/lot={part}")
        mirror.run(s, source, target, step, batches=2, schema=rows.schema)
    told = mirror.manifest(s, target).agg(F.sum("rows").alias("manifest_rows"))
    made = s.read.option("recursiveFileLookup", "true").parquet(target)
    return made.groupBy("pred_label").agg(F.count("*").alias("cnt"), F.sum("doubled").cast("long").alias("doubled")).join(F.broadcast(told))


def _days(s, d):
    """Monthly stats in a folder a month, of which those from 2001 on are loaded again, doubled, without 2001-02."""
    path = _folder(s, "months")
    rows = table(stats(s, d).groupBy(F.substring("date", 1, 7).alias("month"), "brand", "sentiment").agg(F.sum("count").cast("long").alias("count")), "months")
    tables.load_days(s, path, rows, "month")
    tables.load_days(s, path, rows.where("month >= '2001-01' and month <> '2001-02'").withColumn("count", F.col("count") * 2), "month")
    return tables.days(s, path, "month").groupBy("month").agg(F.sum("count").alias("count"))


def _logged(s, d):
    """A step over predictions with the log's record of it."""
    root = _folder(s, "steps")
    rows = preds(s, d, False).select("brand", "model", "pred_label")
    steplog.logged(rows, "predict", f"{root}/out", f"{root}/log", counts={"no_model": F.col("model").isNull(), "negative": F.col("pred_label") == "NEG"})
    steplog.logged(s.read.parquet(f"{root}/out").groupBy("pred_label").count(), "count", f"{root}/counts", f"{root}/log", [f"{root}/out"])
    told = steplog.records(s, f"{root}/log").where("status = 'done' and output_files > 0 and output_bytes > 0")
    return told.select("step", "rows", F.coalesce(F.col("counts")["no_model"], F.lit(0)).alias("no_model"), F.coalesce(F.col("counts")["negative"], F.lit(0)).alias("negative"), (F.size("inputs") > 0).alias("has_inputs"))


def _first(s, d):
    return tables.first_rows(s.read.parquet(f"{d}/orders.parquet"), 25).select("o_orderkey")


def _resumed(s, d):
    """Half of the work first, then all of it: nothing is done twice."""
    target = _folder(s, "resume")
    rows = preds(s, d, False).select(*KEY, "pred_label")
    step = lambda df: df.withColumn("doubled", F.col("l_linenumber") * 2)
    incremental.resume(rows.where("l_orderkey % 2 = 0"), step, target, KEY, 3)
    incremental.resume(rows, step, target, KEY, 2)
    return s.read.parquet(target).groupBy("pred_label").agg(F.count("*").alias("cnt"), F.sum("doubled").alias("doubled"))


def _remembered(s, d):
    cache = _folder(s, "replies")
    words = table(coverage.token_counts(documents(s, d), "text").where("df >= 5"), "words")
    ask = lambda df: df.select("term", F.length("term").alias("reply"))
    incremental.remember(words.where("length(term) < 5"), ["term"], cache, ask)
    return incremental.remember(words, ["term"], cache, lambda df: df.select("term", (-F.length("term")).alias("reply")))


def _documents(s, d):
    rows = serving.product_documents(stats(s, d))
    at = lambda path: F.get_json_object("document", path)
    totals = [at(f"$.period_stats.{p}.summary.Total").cast("long").alias(p) for p in serving.EXPORTED]
    return rows.select(
        "product_key", *totals, at("$.period_stats.last_7_days.granularity").alias("grain"), at("$.brand_aspect_dist.NEG[0].aspect").alias("worst"),
        F.size(F.from_json(at("$.period_stats.last_12_months.trend"), "array<struct<date:string>>")).alias("months"))


def _documents_sql():
    sums = ", ".join(f"cast(sum(case when day >= last - {n} then count end) as bigint) as {p}" for p, (n, _) in serving.EXPORTED.items())
    return f"""with {STATS}, k as (select *, brand || ' ' || model as product_key, cast(date as date) as day from stats where brand is not null and model is not null),
    l as (select max(day) as last from k), t as (select product_key, {sums} from k, l group by 1),
    b as (select product_key, min(m) as a, max(m) as b from (select product_key, case when day = last_day(day) then day else cast(date_trunc('month', day) - interval 1 day as date) end as m from k, l where day >= last - 365) group by 1),
    n as (select product_key, arg_min(aspect, (-c, aspect)) as worst from (select product_key, aspect, sum(count) as c from k where sentiment = 'NEG' group by 1, 2) group by 1)
    select t.*, case when last_7_days is not null then 'day' end as grain, worst, cast(date_diff('month', a, b) + 1 as integer) as months from t left join b using (product_key) left join n using (product_key)"""


def _micro(s, d):
    rows = preds(s, d).where("ts is not null").select(*KEY, (F.unix_micros("ts") + F.col("l_suppkey")).cast("string").alias("ctime"))
    return rows.select(F.date_format(times.parse("ctime", micro=True), "yyyy-MM-dd").alias("day")).groupBy("day").agg(F.count("*").alias("cnt"))


def _audited(s, d):
    made = times.audited(preds(s, d).select("ctime"), "ctime")
    return made.groupBy(F.year("time").alias("year")).agg(F.count("*").alias("cnt"))


def _legacy_paths(s, d):
    path = F.when(F.col("doc_id") % 4 == 0, F.concat_ws("/", F.lit("doc"), "source", "lang", F.lit("a.json"))).when(
        F.col("doc_id") % 4 == 1, F.concat_ws("/", "source", F.lit("a.json"))).when(F.col("doc_id") % 4 == 2, F.lit("a.json")).otherwise(F.concat_ws("/", "source", "lang", F.lit("a.json")))
    brand, model = ingest.legacy_brand_model(path, "doc")
    return documents(s, d).select("doc_id", brand.alias("brand"), model.alias("model"))


def _pos(s, d):
    """A tagger by word ends stands in for one of a language."""
    words = documents(s, d).select(F.explode(text.tokens(F.col("text"))).alias("term"))
    tagged = words.select("term", F.when(F.col("term").rlike("(tion|ment)$"), "n").when(F.col("term").rlike("^[a-z]+$"), "eng").otherwise("x").alias("pos"))
    return coverage.pos_top(ingest.tagged_nouns(tagged), 3)


def _hits(s, d):
    per = preds(s, d, False).groupBy("aspect_l1", "aspect_l2", "brand").agg(F.count("*").alias("hit_count")).where("brand <> 'Brand#1'")
    return aggregate.pivot_hits(per, ["F", "O"])


def _report(s, d):
    rows = preds(s, d, False)
    l2 = rows.where("model is not null").groupBy("model", "aspect_l2", "brand").agg(*(F.count(F.when(F.col("pred_label") == x, 1)).alias(f"{x.lower()}_cnt") for x in ("POS", "NEG")))
    lines = rows.where("model is not null").select("model").distinct().select("model", F.explode(F.array(F.lit("F"), F.lit("no"))).alias("aspect_l2")).withColumn(
        "sentiment", F.when(F.length("model") % 2 == 0, "POS").otherwise("NEG"))
    return aggregate.report_counts(lines, l2)


def _blank(s, d):
    found = text.sentences_or_blank(text.sentences_legacy(F.col("text"), 30))
    return documents(s, d).select("doc_id", F.posexplode(found).alias("sentence_idx", "sentence")).where("sentence = ''").select("doc_id", "sentence_idx")


def _valid(s, d):
    cleaned = text.clean(F.col("text"), keep_latin=False)
    bad, told = text.validity(cleaned, 20)
    return documents(s, d).select("doc_id", F.length(cleaned).alias("n"), bad.alias("parse_error"), told.alias("error_msg"))


_LEGACY = r"""list_filter(list_transform(regexp_split_to_array(text, '[。！？；…!?;.]+'), lambda x: regexp_replace(x, '^[\s\x{A0}\x{3000}]+|[\s\x{A0}\x{3000}]+$', '', 'g')), lambda x: x <> '')"""

QUERIES = {
    "yaml_lexicon": (_yaml, _YAML_SQL),
    "term_files": (_term_files, "select * from (values ('screen', 'panel', 'oled'), ('screen', 'panel', 'lcd'), ('power', 'cell', 'battery')) v(l1, l2, term)"),
    "word_set": (_word_set, "select * from (values ('the'), ('of')) v(term)"),
    "sqlite_load": (_sqlite, f"with {STATS} select date, brand, aspect, sentiment, cast(sum(count) as bigint) as count from stats group by 1, 2, 3, 4"),
    "workbook": (_workbook, f"with {STATS} select brand, sentiment, cast(sum(count) as bigint) as count from stats group by 1, 2"),
    "sheet_terms": (_sheet_terms, f"with {STATS} select aspect as term, cast(sum(count) as double) as df, 'unmapped' as source from stats group by 1"),
    "hive_scan": (
        _hive, f"with {PREDS} select case when l_linenumber <= 2 then 'one' else 'two' end as part, aspect_l1, count(*) as cnt from preds group by 1, 2"),
    "prediction_layouts": (
        _layouts, f"with {PREDS} select layout, cast(l_partkey % 3 as integer) as shard, count(*) as cnt from preds, (values ('sharded'), ('flat'), ('deep')) v(layout) group by 1, 2"),
    "manifest_reconcile": (
        _reconcile, f"with {PREDS}, t as (select count(case when l_linenumber < 4 then 1 end) as manifest_rows, count(*) as folder_rows from preds) select 1::bigint as manifest_files, manifest_rows, 2::bigint as folder_files, folder_rows, manifest_rows = folder_rows as agree from t"),
    "latest_run": (_latest, f"with {PREDS} select l_linenumber as x, count(*) as cnt from preds where l_linenumber < 5 group by 1"),
    "snapshot": (_snapshot, f"with {STATS} select sentiment, cast(sum(count) as bigint) as count from stats where sentiment = 'NEG' group by 1"),
    "csv_pair": (_csv_pair, f"with {STATS} select brand, cast(sum(count) as bigint) as count from stats group by 1"),
    "first_rows": (_first, "select o_orderkey from orders limit 25"),
    "mirrored": (
        _mirrored, f"""with {PREDS} select pred_label, count(*) as cnt, cast(sum(2 * l_linenumber) as bigint) as doubled, (select count(*) from preds) as manifest_rows from preds group by 1"""),
    "load_days": (
        _days, f"""with {STATS} select substr(date, 1, 7) as month, cast(sum(case when date >= '2001-01' then 2 * count else count end) as bigint) as count from stats
        where substr(date, 1, 7) <> '2001-02' group by 1"""),
    "step_log": (
        _logged, f"""with {PREDS} select 'predict' as step, count(*) as rows, count(case when model is null then 1 end) as no_model, count(case when pred_label = 'NEG' then 1 end) as negative, false as has_inputs from preds
        union all select 'count', count(distinct pred_label), 0, 0, true from preds"""),
    "json_lines": (lambda s, d: _lines(s, d, False), f"{_LINES_SQL} select lang, line as source_line, doc_id, cast(length(text) as integer) as n from b where doc_id % 5 <> 0"),
    "json_lines_legacy": (
        lambda s, d: _lines(s, d, True),
        f"""{_LINES_SQL} select lang, line + 1 as source_line, doc_id, cast(length(text) as integer) as n from b
        union all select lang, line + 1, -1, 0 from b where doc_id % 5 = 0"""),
    "resumed": (_resumed, f"with {PREDS} select pred_label, count(*) as cnt, cast(sum(2 * l_linenumber) as bigint) as doubled from preds group by 1"),
    "remembered_replies": (
        _remembered, f"with t as (select term from (select doc_id, unnest({tokens_sql('text')}) as term from documents) group by 1 having count(distinct doc_id) >= 5) select term, cast(case when length(term) < 5 then length(term) else -length(term) end as integer) as reply from t"),
    "json_documents": (_documents, _documents_sql()),
    "micro_times": (_micro, f"with {PREDS} select strftime(ts + to_microseconds(l_suppkey), '%Y-%m-%d') as day, count(*) as cnt from preds where ts is not null group by 1"),
    "audited_times": (
        _audited, f"""with {PREDS}, u as (select quantile_disc(try_cast(ctime as double), 0.5) > 1e12 as ms from preds where regexp_matches(ctime, '^[0-9]+$')),
        r as (select case when regexp_matches(ctime, '^[0-9]+$') then make_timestamp(cast(try_cast(ctime as double) * case when ms then 1000 else 1000000 end as bigint)) else ts end as time from preds, u)
        select cast(year(time) as integer) as year, count(*) as cnt from r group by 1"""),
    "legacy_paths": (
        _legacy_paths, """select doc_id, case doc_id % 4 when 2 then null else source end as brand, case doc_id % 4 when 0 then lang when 3 then lang end as model from documents"""),
    "pos_top": (
        _pos, f"""with t as (select unnest({tokens_sql('text')}) as term from documents), p as (select term, case when regexp_matches(term, '(tion|ment)$') then 'n' when regexp_matches(term, '^[a-z]+$') then 'eng' end as pos from t)
        select term, pos || ':' || count(*) as pos_top3 from p where pos is not null group by term, pos"""),
    "pivot_hits": (
        _hits, f"""with {PREDS} select aspect_l1, count(case when aspect_l2 = 'F' then 1 end) as "F", count(case when aspect_l2 = 'O' then 1 end) as "O" from preds where brand <> 'Brand#1' group by 1"""),
    "report_counts": (
        _report, f"""with {PREDS}, m as (select distinct model, case when length(model) % 2 = 0 then 'POS' else 'NEG' end as sentiment from preds where model is not null)
        select m.model, l as aspect_l2, sentiment, (select count(*) from preds p where p.model = m.model and p.aspect_l2 = l and p.pred_label = sentiment) as cnt from m, (values ('F'), ('no')) v(l)"""),
    "blank_sentences": (
        _blank, f"""with a as (select doc_id, {_LEGACY} as p from documents),
        b as (select doc_id, list_filter(flatten(list_transform(p, lambda x: case when length(x) > 120 then list_transform(regexp_split_to_array(x, '[，,]+'), lambda y: trim(y, ' ' || chr(10) || chr(9) || chr(13))) else [x] end)), lambda z: length(z) >= 30) as q from a)
        select doc_id, 0 as sentence_idx from b where len(q) = 0"""),
    "clean_validity": (
        _valid, r"""with a as (select doc_id, regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), '[A-Za-z]', '', 'g') as t from documents)
        select doc_id, cast(length(t) as integer) as n, length(t) < 20 as parse_error, case when length(t) < 20 then 'text too short' end as error_msg from a"""),
}
