"""Edge cases on small literal frames."""
from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from murmura.functions import labels, text, times
from murmura.ml import student, teacher
from murmura.operators import aggregate, candidates, lexicon, serving, web
from murmura.sources import reviews, tables
from murmura.streaming import incremental

TIMES = ["1766475000", "1766475000123", "1766475000123456", "1766475000.5", "2026-01-01", "2026/01/01", "2026-01-01 10:20:30", "2026/01/01 10:20:30", "2026", "abc", "", None]


def test_times(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TIMES)], "i int, ctime string")
    got = [r[0] for r in rows.orderBy("i").select(F.date_format(times.parse("ctime", micro=True), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2025-12-23 07:30:00"] * 4 + ["2026-01-01 00:00:00"] * 2 + ["2026-01-01 10:20:30"] * 2 + ["1970-01-01 00:33:46", None, None, None]
    days = [r[0] for r in rows.where("i in (0, 4)").orderBy("i").select(times.seconds_day("ctime")).collect()]
    assert days == [datetime.date(2025, 12, 23), None]


def test_labels(spark):
    rows = spark.createDataFrame([("b", "m"), ("b", " "), (None, "m"), ("", None)], "b string, m string")
    assert [r[0] for r in rows.select(labels.product_id(F.col("b"), F.col("m"))).collect()] == ["b__m", "b", "m", "unknown_product"]
    raw = spark.createDataFrame([("positive",), (" - ",), ("1",), ("?",), (None,)], "r string")
    assert [r[0] for r in raw.select(labels.normal_sentiment(F.col("r"))).collect()] == ["POS", "NEG", "NEU", "NEU", "NEU"]
    ties = spark.createDataFrame([(0.4, 0.4, 0.2), (0.2, 0.4, 0.4), (0.3, 0.3, 0.4)], "a double, b double, c double")
    assert [r[0] for r in ties.select(labels.argmax(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["NEG", "NEU", "POS"]
    weights = spark.createDataFrame([("3.9",), ("x",), (None,)], "w string")
    assert [r[0] for r in weights.select(labels.weight(F.col("w"))).collect()] == [3, 1, 1]


def test_text(spark):
    rows = spark.createDataFrame([(" 好。不好！ ok?\n　end ",), ("",), (None,), ("...",)], "t string")
    got = [r[0] for r in rows.select(text.sentences(F.col("t"))).collect()]
    assert got == [["好", "不好", "ok", "end"], [], None, []]
    long = spark.createDataFrame([("a" * 70 + "，" + "b" * 70,)], "t string")
    assert [len(x) for x in long.select(text.sentences_legacy(F.col("t"))).first()[0]] == [70, 70]


@pytest.mark.parametrize("hits,expected", [("OLED屏幕续航program ram 屏幕膜", ["oled", "屏幕", "续航", "ram", "屏幕膜"]), ("roledo", []), ("a 1.5K b", ["1.5k"])])
def test_tags(spark, hits, expected):
    terms = [("s", "x", "OLED"), ("s", "x", "oled"), ("s", "y", "屏幕"), ("s", "z", "屏幕膜"), ("p", "x", "续航"), ("p", "y", "ram"), ("p", "z", "1.5K"), ("q", "x", "屏幕"), ("q", "x", "12"), ("q", "x", "--"), ("q", "x", " ")]
    frame = spark.createDataFrame([("d", *t, i) for i, t in enumerate(terms)], lexicon.SCHEMA)
    rows = spark.createDataFrame([(1, hits)], "doc_id int, sentence string")
    assert sorted(r["hit_term"] for r in lexicon.tag(rows, frame).collect()) == sorted(expected)
    assert [(r["term"], r["other_l1"]) for r in lexicon.conflicts(frame).collect()] == [("屏幕", "q")]


def test_hard_counts_and_null_keys(spark):
    rows = spark.createDataFrame(
        [("d", "b", "m", "x", "y", "POS", 0.9), ("d", "b", "m", "x", "y", "NEG", 0.5), ("d", "b", None, "x", "y", "POS", 0.9)],
        "domain string, brand string, model string, aspect_l1 string, aspect_l2 string, pred_label string, confidence double")
    got = {r["model"]: r for r in aggregate.aggregate_hard(rows, 0.8).collect()}
    assert (got["m"]["total_all"], got["m"]["total_hard"], got["m"]["coverage"], got["m"]["sent_score_hard"]) == (2, 1, 0.5, 1.0)
    assert (got[None]["total_hard"], got[None]["pos_rate_hard"]) == (0, None)
    assert aggregate.aggregate_all(rows.limit(0)).count() == 0


def test_range_load_keeps_other_days(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "date string, brand string, model string, aspect string, sentiment string, count long")
    root = f"file://{tmp_path}/t"
    tables.load_range(spark, root, frame([("2024-01-01", "a", "m", "x", "POS", 1), ("2024-01-02", "a", "m", "x", "POS", 2), ("2024-02-01", "a", "m", "x", "POS", 4)]))
    new = frame([("2024-01-01", "b", "m", "x", "NEG", 8), ("2024-01-03", "b", "m", "x", "NEG", 16)])
    for _ in range(2):
        tables.load_range(spark, root, new)
    assert tables.latest(spark, root, "daily_stats").agg(F.sum("count")).first()[0] == 28
    assert serving.replace_range(frame([]), new).count() == 2


def test_readers(spark, tmp_path):
    import json

    folder = tmp_path / "in" / "acme" / "one"
    folder.mkdir(parents=True)
    (folder / "a.jsonl").write_text('﻿{"content": "one. two", "id": 1}\n\n{bad\n{"text": true, "time": 5}\n')
    (folder / "b.json").write_text(json.dumps([{"content": {"x": 1}, "body": "nested"}, 3, {"content": "  "}]))
    (folder / "c.json").write_text('{\n "review": "pretty",\n "review_id": "r"\n}')
    (folder / "d.json").write_text('{"content": "extra"}\n{"content": "data"}')
    (folder / "e.json").write_text("[1, 2")
    texts = reviews.files(spark, f"file://{tmp_path}/in")
    rows = reviews.clean_sentences(reviews.records(texts), "t", f"{tmp_path}/in").collect()
    assert sorted(r["sentence"] for r in rows) == sorted(["one. two", "True", "nested", "pretty", "extra", "data"])
    assert {(r["brand"], r["model"]) for r in rows} == {("acme", "one")}
    assert {r["doc_id"] for r in rows} >= {"1", "r"}
    assert reviews.errors(texts).count() == 1


def test_lexicon_dialects(spark):
    one = tables.lexicon(spark, {"aspects": [{"l1": "a", "l2": {"b": ["x", "y"]}}]}, "d")
    two = tables.lexicon(spark, {"l1": [{"name": "a", "aliases": ["z"], "l2": [{"name": "b", "terms": ["x", "y"]}]}]}, "d")
    assert {(r["l2"], r["term"]) for r in one.collect()} == {("b", "x"), ("b", "y")}
    assert {(r["l2"], r["term"]) for r in two.collect()} == {("b", "x"), ("b", "y"), ("_L1", "z")}


def test_stream_takes_each_file_once(spark, tmp_path):
    src, out, mark = (f"{tmp_path}/{x}" for x in ("src", "out", "mark"))
    first = spark.range(3).coalesce(1)
    first.write.parquet(src)
    for _ in range(2):
        incremental.run_available(spark, src, first.schema, lambda df: df.withColumn("twice", F.col("id") * 2), out, mark)
    assert spark.read.parquet(out).count() == 3
    spark.range(3, 5).write.mode("append").parquet(src)
    incremental.run_available(spark, src, first.schema, lambda df: df.withColumn("twice", F.col("id") * 2), out, mark)
    assert spark.read.parquet(out).count() == 5


def test_teacher_replies_by_position(spark):
    class Short:
        def reply(self, prompts):
            return "```json\n" + str([{"label": "it is POSITIVE", "confidence": 1}] * (len(prompts) - 1)).replace("'", '"') + "\n```"

    rows = spark.createDataFrame([(i, "x") for i in range(10)], "i int, p string").coalesce(1)
    got = teacher.label(rows, Short(), "p", batch=5)
    assert sorted(r["i"] for r in got.collect()) == [0, 1, 2, 3, 5, 6, 7, 8]
    assert {r["pred_label"] for r in got.collect()} == {"POS"}
    assert teacher.parse_reply("no list") == []


def test_student_learns(spark):
    rows = spark.createDataFrame([(f"{w} thing number {i}", l) for i in range(30) for w, l in (("good", "POS"), ("bad", "NEG"), ("plain", "NEU"))], "sentence string, pred_label string")
    model = student.train(rows, "sentence", features=256, iterations=20)
    got = student.predict(model, rows.withColumnRenamed("pred_label", "truth"))
    assert got.where("truth = pred_label").count() == 90
    assert got.where("abs(p_neg + p_neu + p_pos - 1) > 1e-5").count() == 0


def test_shards_part_the_rows(spark):
    rows = candidates.sharded(spark.range(1000), ["id"], 8)
    sizes = rows.groupBy("shard").count().collect()
    assert sum(r["count"] for r in sizes) == 1000 and len(sizes) == 8
    assert web.bucket_map(spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "aspect_l1 string"), 2).where("bucket = 'OTHER'").count() == 1


def test_steps_end_to_end(spark, tmp_path):
    import json

    from murmura.plans import steps

    folder = tmp_path / "in" / "acme" / "one"
    folder.mkdir(parents=True)
    lines = [json.dumps({"id": i, "content": f"the screen is {'good' if i % 2 else 'bad'}! the battery {'good' if i % 3 else 'bad'} today!", "ctime": 1700000000 + 86400 * i}) for i in range(60)]
    (folder / "a.jsonl").write_text("\n".join(lines))
    terms = spark.createDataFrame([("d", "display", "panel", "screen", 0), ("d", "power", "cell", "battery", 1)], lexicon.SCHEMA)
    run = steps.Run(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/run", "d", terms, teacher.LexiconTeacher(frozenset({"good"}), frozenset({"bad"})), samples=100, shards=2)
    assert run.run("web,5") == ["00", "tag", "01", "02", "03", "05", "web"]
    sizes = {r["table"]: r["rows"] for r in run.manifest().collect()}
    assert sizes["aspect_sentences"] == sizes["predictions"] == sizes["aspect_pairs"] and sizes["train_pseudolabel"] == 100
    assert run.read("aspect_sentiment_all").agg(F.sum("total_cnt")).first()[0] == sizes["predictions"]
    before = run.read("aspect_sentiment_all").inputFiles()
    run.run("05")
    assert run.read("aspect_sentiment_all").inputFiles() == before
    assert steps.normal_steps("5, 1,ingest,05") == ["00", "01", "05"]
    with pytest.raises(ValueError):
        steps.normal_steps("9")


def test_ingest_guards(spark):
    from murmura.operators import ingest

    rows = spark.createDataFrame([("{\"a\":1}\n{\"a\":2}",), ("{\"a\":1}\nx\ny\nz\n{}",), ("[1]",), (None,)], "v string")
    assert [r[0] for r in rows.select(ingest.looks_like_lines(F.col("v"))).collect()][:3] == [True, False, False]
    frame = spark.createDataFrame([(1, "x", 1_700_000_000_000.0)], "id int, sent string, create_time double")
    assert ingest.pick(frame, "sentence_id", "sentence", "label").first().asDict() == {"sentence_id": 1, "sentence": "x", "label": None}
    assert ingest.time_columns(frame) == ["create_time"] and ingest.epoch_unit(frame, "create_time") == "ms"
    with pytest.raises(ValueError):
        ingest.guard("/data/phone", "car")
