"""Steps that must not hold a whole batch, column or group at once."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from murmura.operators import coverage, lexicon, matching, segment


def test_parts_of_a_batch(monkeypatch):
    """rows of a batch are cut in parts of bounded bytes, null and empty ones among them."""
    monkeypatch.setattr(matching, "PIECE", 10)
    batch = pa.record_batch([pa.array([1, 2, 3, 4, 5]), pa.array([["天地", "ab"], None, [], ["玄黄" * 9], ["天"]])], ["id", "w"])
    for whole, ids in ((batch, [1, 2, 3, 4, 5]), (batch.slice(1, 3), [2, 3, 4])):
        parts = list(segment._parts(whole, "w"))
        assert [i for p in parts for i in p.column("id").to_pylist()] == ids and len(parts) > 1
        assert [w for p in parts for w in p.column("w").to_pylist()] == whole.column("w").to_pylist()


@pytest.mark.parametrize("dense", [0, 1 << 22])
def test_strings_in_pieces(dense, monkeypatch):
    """strings are counted the same in pieces, with a table of codes or without."""
    runs = pa.array([["天地玄黄天地", "天"], [], ["地地"] * 3, ["玄黄天地玄黄"]])

    def told(counted):
        monkeypatch.setattr(segment, "COUNTED", counted)
        out = {}
        for part in segment._strings(3)(iter([pa.record_batch([runs], ["runs"])])):
            for r in part.to_pylist():
                n, a0, a1, b0, b1 = out.get(r["word"], (0, 1 << 21, 0, 1 << 21, 0))
                out[r["word"]] = (n + r["n"], min(a0, r["a0"]), max(a1, r["a1"]), min(b0, r["b0"]), max(b1, r["b1"]))
        return out

    monkeypatch.setattr(segment, "DENSE", dense)
    whole = told(1 << 24)
    assert whole["天地"] == (3, 0, ord("黄"), 0, ord("玄"))
    assert whole["地"] == (9, 0, ord("天"), 0, ord("玄")) and whole == told(8)


@pytest.mark.parametrize("steps", [0, 1 << 22])
def test_automaton_by_table(steps, monkeypatch):
    """the table of all steps finds what failure links find, over short parts too."""
    monkeypatch.setattr(matching, "STEPS", steps)
    monkeypatch.setattr(matching, "STRIDE", 3)
    terms = ["abcab", "bca", "a", "cabcabca", "屏幕"]
    texts = ["abcabcabca屏幕x", "", "屏abcab" * 5]
    text, at = matching.points(pa.array(texts))
    begin, number = matching.Automaton(terms).find(text)
    row = np.searchsorted(at, begin, side="right") - 1
    got = {(int(r), int(b - at[r]), terms[n]) for r, b, n in zip(row, begin, number)}
    assert got == {(r, i, t) for r, x in enumerate(texts) for t in terms for i in range(len(x)) if x.startswith(t, i)} and len(got) == len(begin)


def test_counts_and_first_places(spark):
    """counts without a shuffle of words, with repeated and null keys; first rows in batches."""
    rows = [(1, 0, ["a", "b", "a"]), (1, 0, ["a"]), (2, 0, ["a", "c"]), (2, 1, []), (3, 0, None), (None, 0, ["b", "c"]), (4, 1, ["c"]), (4, 0, ["c", "c"])]
    frame = spark.createDataFrame(rows, "doc_id int, sentence_idx int, words array<string>").repartition(3)
    got = {r["term"]: (r["tf"], r["df"]) for r in coverage.word_counts(frame, "words", ["doc_id", "sentence_idx"]).collect()}
    assert got == {"a": (4, 2), "b": (2, 1), "c": (5, 3)}
    own = frame.where("doc_id is not null")
    for only in (None, ["a", "c"]):
        first = {(r["term"], r["k"], r["doc_id"], r["sentence_idx"]) for r in coverage.first_places(own, "words", ["doc_id", "sentence_idx"], 2, only).collect()}
        assert first == {("a", 1, 1, 0), ("a", 2, 2, 0), ("c", 1, 2, 0), ("c", 2, 4, 0)} | ({("b", 1, 1, 0)} if only is None else set())


@pytest.mark.parametrize("room", [4_000_000, 3])
def test_keys_by_mark(spark, room, monkeypatch):
    """keys with a term and without, by one pass, with a lexicon that is broadcast or isn't."""
    monkeypatch.setattr(matching, "BROADCAST", room)
    rows = [(1, 0, "the Oled x"), (1, 0, "nothing"), (2, 0, "none"), (2, 1, None), (None, 0, "oled"), (3, 0, "oled")]
    frame = spark.createDataFrame(rows, "doc_id int, sentence_idx int, sentence string").withColumn("pool", F.coalesce(F.length("sentence") >= 5, F.lit(False)))
    terms = spark.createDataFrame([("d", "screen", "panel", "oled", 0)], lexicon.SCHEMA)
    marked = lexicon.mark(frame, terms, "tagged")
    assert marked.columns == ["doc_id", "sentence_idx", "pool", "tagged"]
    by = lambda has: sorted(tuple(r) for r in coverage.keys_by(marked, ["doc_id", "sentence_idx"], "tagged", "pool", has).collect())
    assert by(True) == [(1, 0), (1, 0)] and by(False) == []
    wide = marked.withColumn("pool", F.lit(True))
    assert coverage.keys_by(wide, ["doc_id", "sentence_idx"], "tagged", "pool", False).count() == 3


def test_sqlite_ranges(spark, tmp_path):
    """loads of a part and of all days leave the same rows whether indexes are kept or made anew, and a failed load leaves what was there."""
    import sqlite3

    from murmura.sources import sqlite

    path = str(tmp_path / "stats.db")
    row = lambda day, brand, n: (day, brand, None, "x", "POS", n)
    frame = lambda rows: spark.createDataFrame(rows, "date string, brand string, model string, aspect string, sentiment string, count long").repartition(3)
    old = [row(f"2024-01-{i:02}", f"b{k}", i) for i in range(1, 21) for k in range(5)]
    assert sqlite.load_range(frame(old), path) == (0, 100) and sqlite.load_range(frame(old), path) == (100, 100)
    new = [row("2024-01-03", "b9", 7), row("2024-01-04", "b9", 8)]
    assert sqlite.load_range(frame(new), path) == (10, 2)
    assert sqlite.load_range(frame([]), path) == (0, 0)
    back = sqlite.read(spark, path, f"select * from {sqlite.TABLE}", "date string, brand string, model string, aspect string, sentiment string, count long")
    want = sorted([r for r in old if r[0] not in ("2024-01-03", "2024-01-04")] + new, key=str)
    assert sorted(map(tuple, back.collect()), key=str) == want
    with pytest.raises(Exception):
        sqlite.load_range(frame(old).withColumn("count", F.expr("raise_error('no')").cast("long")), path)
    with sqlite3.connect(path) as db:
        assert db.execute(f"select count(*) from {sqlite.TABLE}").fetchone() == (92,)
        assert {r[1] for r in db.execute(f"pragma index_list({sqlite.TABLE})")} == {"idx_date", "idx_query"}


def test_lines_over_parts(spark, tmp_path):
    """the files of a folder are one sequence of lines."""
    from murmura.sources import lines

    for name, rows in (("a/part-1", "﻿x\ny\n"), ("a/part-2", ""), ("a/part-3", "﻿z"), ("b/part-1", "u\r\nv")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(rows.encode())
    got = sorted((r["path"][-1], r["number"], r["value"]) for r in lines.lines(spark, str(tmp_path), folders=True).collect())
    assert got == [("a", 0, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 0, "u"), ("b", 1, "v")]


def test_prompts_of_one_shard(spark):
    """a shard's rows are numbered over many ranges."""
    from murmura.operators import ingest

    rows = spark.range(1003).select(F.when(F.col("id") < 1000, F.lit(1)).alias("shard"), "id", F.lit("a").alias("aspect_l1"), F.lit("b").alias("aspect_l2"), F.col("id").cast("string").alias("sentence")).repartition(5)
    made = {(r["shard"], r["batch"]): (r["prompt"], r["n"]) for r in ingest.packed_prompts(rows, 7, ["id"]).collect()}
    want = {(1, b): ("\n".join(f"{i % 7 + 1}. [a::b] {i}" for i in range(b * 7, min(1000, b * 7 + 7))), min(1000, b * 7 + 7) - b * 7) for b in range(143)}
    assert made == want | {(None, 0): ("\n".join(f"{i + 1}. [a::b] {1000 + i}" for i in range(3)), 3)}


def test_remembered_once(spark, tmp_path):
    """F8: rows are worked out once, however often they are looked at."""
    from murmura.streaming import incremental

    worked = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            worked.add(b.num_rows)
            yield b

    rows = spark.range(10).mapInArrow(seen, "id long")
    assert incremental.remember(rows, ["id"], str(tmp_path / "cache"), lambda df: df.selectExpr("id", "id + 1 as reply")).count() == 10
    assert worked.value == 10


def test_times_are_read_once(spark):
    """A filter on the time doesn't read it again, nor does a column made of it."""
    from pyspark.sql import functions as F

    from murmura.plans.proxy import preds

    rows = preds(spark, "/root/testdata/sf0.001")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    one = plan(rows.select("ts")).count("yyyy/MM/dd HH:mm:ss")
    assert plan(rows.where("ts is not null").select(F.to_date("ts").alias("day")).where("day is not null")).count("yyyy/MM/dd HH:mm:ss") == one


def test_limits_before_counts(spark):
    """Rows outside the last days aren't counted by group, and documents of products read their source once."""
    from murmura.operators import serving, web

    rows = spark.createDataFrame([("a", 1, "POS"), ("a", 9, "NEG"), ("b", 9, "POS"), ("b", 10, "NEU")], "k string, n int, pred_label string").selectExpr("k", "date_add(date'2024-01-01', n) as day", "pred_label")
    for made in (web.latest_tally(rows, ["k"], None, 2), web.weekly_tally(rows, ["k"], None, 1)):
        assert "Aggregate" in made._jdf.queryExecution().optimizedPlan().toString().split("Join")[0] and sum(r["total_cnt"] for r in made.collect()) == 3
    stats = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr("'2024-01-01' as date", "'b' as brand", "l_linestatus as model", "'x' as aspect", "'POS' as sentiment", "1 as count")
    assert not any("lineitem" in f for f in serving.product_documents(stats).inputFiles())


@pytest.mark.parametrize("most", [1000, 10])
def test_all_aspects_by_bits(spark, most, monkeypatch):
    """A key has one row where its aspects are made distinct, whatever it has; repeated and null keys, more aspects than a number has bits."""
    monkeypatch.setattr(lexicon, "MASKED", most, raising=False)
    terms = spark.createDataFrame([("d", None if i == 3 else f"l{i % 50}", str(i), f"t{i:03}", i) for i in range(150)] + [("d", "x", "y", "t001", 150)], lexicon.SCHEMA)
    rows = spark.createDataFrame([(1, "t001 t003 t149"), (1, "t001t062t063"), (None, "t064"), (None, "t064 t003"), (2, "none"), (3, None)], "id int, s string")
    out = lexicon.tag_all(rows, terms, ["id"], "s")
    name = lambda i: (None if i == 3 else f"l{i % 50}", str(i))
    want = [(1, *name(i)) for i in (1, 3, 149, 62, 63)] + [(1, "x", "y"), (None, *name(64)), (None, *name(3))]
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, want))
    if most == 1000:
        assert "bit_or" in out._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("most", [1, 5, 2_000_000])
def test_term_stats_of_repeated_keys(spark, most):
    """one pass over the sentences; rows that share a key count once, in whatever tasks they lie."""
    rows = [(1, 0, "Aa bb aa"), (1, 1, "aa"), (2, 0, "aa cc"), (2, 2, "bb"), (2, 2, "bb cc"), (2, 1, "--"), (3, 0, "cc " + "x" * 200), (4, 1, "cc"), (4, 0, "dd dd")]
    for parts in (1, 4):
        frame = spark.createDataFrame(rows, "doc_id long, sentence_idx int, sentence string").repartition(parts)
        got = {r["term"]: (r["tf"], r["df"], r["examples"]) for r in coverage.term_stats(frame, "sentence", most=most).collect()}
        assert got.pop("bb") in [(3, 2, "Aa bb aa\n" + x) for x in ("bb", "bb cc")]
        assert got == {"aa": (4, 3, "Aa bb aa\naa"), "cc": (4, 4, got["cc"][2]), "dd": (2, 1, "dd dd"), "x" * 200: (1, 1, "cc " + "x" * 97)}
        assert got["cc"][2] in ("aa cc\nbb cc", "aa cc\nbb")
    assert coverage.term_stats(frame.limit(0), "sentence", most=most).count() == 0


def test_term_stats_reads_sentences_once(spark, monkeypatch):
    plans, real = [], coverage.table
    seen = lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df
    monkeypatch.setattr(coverage, "table", lambda df, name: real(seen(df), name))
    frame = spark.createDataFrame([(1, 0, "aa bb"), (2, 0, "aa")], "doc_id long, sentence_idx int, sentence string")
    seen(coverage.term_stats(frame, "sentence"))
    assert not any("Join" in x or "Generate" in x for x in plans)
