"""Terms in texts against brute force."""
from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from murmura.operators import lexicon, matching


def places(text: str, terms: list[str]) -> set:
    return {(i, t) for t in terms for i in range(len(text)) if text.startswith(t, i)}


def tagged(text: str, terms: list[str]) -> list[str]:
    """The leftmost longest terms at word ends, each once."""
    out, at = [], 0
    word = re.compile("[a-z0-9_]")
    while at < len(text):
        fit = [t for t in terms if text.startswith(t, at) and not (word.match(t[0]) and at and word.match(text[at - 1]))
               and not (word.match(t[-1]) and at + len(t) < len(text) and word.match(text[at + len(t)]))]
        if fit:
            out.append(max(fit, key=len))
            at += len(out[-1])
        else:
            at += 1
    return list(dict.fromkeys(out))


def made(seed: int, letters: str, n: int, texts: int, most: int):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(letters) for _ in range(rng.randrange(1, k)))
    return sorted({word(6) for _ in range(n)}), [word(most) if rng.random() < 0.95 else "" for _ in range(texts)]


@pytest.mark.parametrize("letters,stride", [("ab", 1024), ("ab", 7), ("ab c", 16), ("a屏é_😀 ", 5)])
def test_automaton(letters, stride, monkeypatch):
    monkeypatch.setattr(matching, "STRIDE", stride)
    terms, texts = made(3, letters, 40, 60, 90)
    known = matching.Automaton([*terms, terms[0]])
    text, at = matching.points(pa.array(texts))
    begin, number = known.find(text)
    row = np.searchsorted(at, begin, side="right") - 1
    got = {(int(r), int(b - at[r]), known.terms[n]) for r, b, n in zip(row, begin, number)}
    assert len(got) == len(begin) and got == {(r, i, t) for r, x in enumerate(texts) for i, t in places(x, terms)}


@pytest.mark.parametrize("room,texts", [(4_000_000, 100_000), (20, 7)])
@pytest.mark.parametrize("letters", ["ab c", "a屏é_😀 b."])
def test_find(spark, letters, room, texts, monkeypatch):
    monkeypatch.setattr(matching, "BROADCAST", room)
    monkeypatch.setattr(matching, "TEXTS", texts)
    terms, rows = made(5, letters, 40, 80, 60)
    terms += ["a" + x for x in "abcabcabc"]  # a character of more than a shard
    frame = spark.createDataFrame([(i, x or None, "x") for i, x in enumerate(rows)] + [(0, rows[0], "y")], "id int, s string, term string").repartition(3)
    known = spark.createDataFrame([(t,) for t in [*terms, "", None]], "term string")
    for longest, way in ((True, tagged), (False, lambda x, ts: sorted({t for _, t in places(x, ts)}))):
        got = sorted((r["id"], r["term"], r["hit"]) for r in matching.find(frame, known, F.col("s"), "hit", longest).collect())
        assert got == sorted((i, k, t) for i, x, k in [*((i, x, "x") for i, x in enumerate(rows)), (0, rows[0], "y")] for t in way(x, terms))


def test_find_edges(spark):
    frame = spark.createDataFrame([(1, "abc"), (2, None), (3, "")], "id int, s string")
    none = spark.createDataFrame([], "term string")
    assert matching.find(frame, none, F.col("s"), "hit", True).count() == 0
    assert matching.find(frame.where("id > 1"), spark.createDataFrame([("a",)], "term string"), F.col("s"), "hit", False).count() == 0
    long = spark.createDataFrame([(1, "x needle y " * 100_000)], "id int, s string")
    assert [r["hit"] for r in matching.find(long, spark.createDataFrame([("needle",), ("need",)], "term string"), F.col("s"), "hit", True).collect()] == ["needle"]


def test_many_terms(spark):
    """200,000 terms, more than one expression could hold."""
    terms = spark.range(200_000).select(F.lit("d").alias("domain"), (F.col("id") % 7).cast("string").alias("l1"), F.lit("x").alias("l2"), F.concat(F.lit("term"), "id").alias("term"), F.col("id").cast("int").alias("ord"))
    rows = spark.range(3000).select("id", F.concat(F.lit("a Term"), F.col("id") * 61, F.lit(", xterm1 term"), F.col("id") * 67, F.lit(" 中term2中")).alias("sentence"))
    got = {(r["id"], r["hit_term"], r["aspect_l1"]) for r in lexicon.tag(rows, terms).collect()}
    want = {(i, f"term{k}", str(k % 7)) for i in range(3000) for k in (i * 61, i * 67, 2) if k < 200_000}
    assert got == want


def test_a_large_lexicon_travels_once(spark, monkeypatch):
    """A text of many different characters isn't sent once for each of them: what is shuffled stays near the size of texts and terms."""
    from murmura.sources.scratch import table

    monkeypatch.setattr(matching, "BROADCAST", 1000)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = table(spark.range(4000).select("id", F.concat_ws(" ", *(F.concat(F.lit(x), F.substring(F.md5(F.concat("id", F.lit(x))), 1, 12)) for x in letters)).alias("sentence")), "rows")
    terms = spark.range(26 * 20).select(F.lit("d").alias("domain"), F.lit("l").alias("l1"), F.lit("x").alias("l2"), F.concat(F.substring(F.lit(letters), (F.col("id") % 26 + 1).cast("int"), 1), F.substring(F.md5(F.concat(
        (F.col("id") * 7).cast("string"), F.substring(F.lit(letters), (F.col("id") % 26 + 1).cast("int"), 1))), 1, 12)).alias("term"), F.col("id").cast("int").alias("ord"))
    out = lexicon.tag(rows, terms, drop=("sentence",))
    assert set(out.columns) == {"id", "hit_term", "aspect_l1", "aspect_l2"} and out.count() == sum(i * 7 < 4000 for i in range(520))
    plan = out._jdf.queryExecution().executedPlan()
    assert "Generate" not in plan.toString()


def test_tables_leave_no_shuffle(spark):
    """The shuffle that made a table is gone when it is written."""
    from murmura.llm import _store
    from murmura.sources import scratch

    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    for made in (scratch.table, _store.table):
        before = tracker.shuffleStatuses().size()
        made(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
        assert tracker.shuffleStatuses().size() <= before


def test_units_get_only_their_terms(spark, monkeypatch):
    """r04 F1: terms with a common beginning don't go to every unit, and texts are stored and sent packed, once."""
    made = {}

    def kept(df, name, real=matching.table):
        made[name] = real(df, name)
        return made[name]

    for name, value in (("BROADCAST", 1000), ("FINE", 4000), ("UNIT", 4000), ("SHARD", 3000), ("table", kept)):
        monkeypatch.setattr(matching, name, value)
    rows = spark.range(2000).select("id", F.concat(F.lit("so the thing"), F.col("id") % 500, F.lit(" is here and the thing"), F.col("id") % 500, F.lit("x isn't")).alias("sentence")).repartition(4)
    terms = spark.range(500).select(F.concat(F.lit("the thing"), "id").alias("term"), F.col("id").alias("n"))
    out = matching.find(rows, terms, F.col("sentence"), "hit", True, carry=("n",), drop=("sentence",))
    assert sorted((r["id"], r["hit"], r["n"]) for r in out.collect()) == [(i, f"the thing{i % 500}", i % 500) for i in range(2000)]
    units = made["answers"].select("unit").distinct().count()
    sent = [matching._unpacked(pa.scalar(bytes(r["terms"]), pa.binary())).num_rows for r in made["answers"].collect()]
    assert units > 4 and sum(sent) <= 2000
    assert sum(len(r["rows"]) for r in made["pieces"].collect()) < rows.agg(F.sum(F.length("sentence"))).first()[0]


@pytest.mark.parametrize("sizes", [0, 32])
def test_units_without_terms_and_whole_words(spark, sizes, monkeypatch):
    """Terms are found by hashes or by automata; units without any, nulls, marks and ideographs among them."""
    for name, value in (("BROADCAST", 10), ("FINE", 40), ("UNIT", 40), ("SHARD", 30), ("SIZES", sizes)):
        monkeypatch.setattr(matching, name, value)
    terms = ["the cat", "cat", "the", "a_b 1", "屏幕", "屏", "-x-", "é t", "cat's", " cat "]
    texts = ["the cat's cat", "nothing", None, "", "xthe cats", "a_b 1-x- é the cat", "屏幕屏cat", "-x-x -x-", "zzz", "café the é the", " cat  cat "] * 9
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, s string").repartition(5)
    got = sorted((r["id"], r["hit"]) for r in matching.find(rows, spark.createDataFrame([(t,) for t in terms], "term string"), F.col("s"), "hit", True).collect())
    assert got == sorted((i, t) for i, x in enumerate(texts) for t in tagged(x or "", terms))


@pytest.mark.parametrize("most", [1, 1 << 24])
def test_words_and_pairs(spark, most, monkeypatch):
    from murmura.operators import coverage

    monkeypatch.setattr(coverage, "COUNTED", most)
    texts = ["a b a b 1 c", "a b", "é a  b", "b", "_ 1x", None, "", "c", " a", "1x b_", "_ 1x _"]
    want, pairs = set(), {}
    for t in texts:
        p = re.findall("[a-z0-9_]+|[^a-z0-9_]+", t or "")
        want |= {w for w in p if re.search("[a-z_]", w)}
        for k in {a + b + c for a, b, c in zip(p, p[1:], p[2:]) if b == " " and re.search("[a-z_]", a) and re.search("[a-z_]", c)}:
            pairs[k] = pairs.get(k, 0) + 1
    frame = spark.createDataFrame([(t,) for t in texts], "s string").repartition(2)
    got = [r["term"] for r in coverage.words_and_pairs(frame, F.col("s"), 2).collect()]
    assert sorted(got) == sorted(want | {k for k, n in pairs.items() if n >= 2})
