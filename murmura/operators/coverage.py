"""How much of the text a lexicon covers, and which terms to add to it."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.functions.text import ngrams, tokens
from murmura.operators.matching import _WORD, pieces, widths
from murmura.sources.scratch import table

#: Bytes of texts whose words and pairs are counted at once.
COUNTED = 1 << 24


def tag_counts(sentences: DataFrame, tagged: DataFrame, key: list[str]) -> DataFrame:
    """Sentences in all, with a tag, and the ratio."""
    return sentences.agg(F.count("*").alias("total")).join(tagged.select(*key).distinct().agg(F.count("*").alias("covered"))).select(
        "total", "covered", F.when(F.col("total") > 0, F.col("covered") / F.col("total")).otherwise(0.0).alias("ratio"))


def hit_counts(tagged: DataFrame, *keys: str) -> DataFrame:
    return tagged.groupBy(*keys).agg(F.count("*").alias("hits"))


def covered(pool: DataFrame, tagged: DataFrame, key: list[str]) -> DataFrame:
    return pool.join(tagged.select(*key), key, "left_semi")


def uncovered(pool: DataFrame, tagged: DataFrame, key: list[str]) -> DataFrame:
    return pool.join(tagged.select(*key), key, "left_anti")


def keys_by(marked: DataFrame, key: list[str], mark: str, pool: str, with_mark: bool) -> DataFrame:
    """The keys of the rows of a pool (a boolean column) of which any row with that key, in the pool or not, has a mark, or none has.

    A key stands once for each of its rows. A null key meets no other and counts as unmarked."""
    own = F.lit(True)
    for k in key:
        own = own & F.col(k).isNotNull()
    per = marked.groupBy(*key).agg(F.max(F.coalesce(F.col(mark) & own, F.lit(False))).alias("__has"), F.count(F.when(F.col(pool), 1)).alias("__n"))
    kept = per.where((F.col("__n") > 0) & (F.col("__has") if with_mark else ~F.col("__has")))
    return kept.select(*key, F.explode(F.sequence(F.lit(1).cast("long"), "__n")).alias("__i")).drop("__i")


def word_counts(rows: DataFrame, words: str, key: list[str]) -> DataFrame:
    """term, tf, df: how often the words of a column occur, and with how many keys; null keys don't count.

    A row's distinct words count once where they stand, so only counts are shuffled. What rows with the same key count
    too often is taken off; only such rows are looked at again."""
    own = F.lit(True)
    for k in key:
        own = own & F.col(k).isNotNull()
    both = rows.select(F.explode(F.array(
        F.struct(F.col(words).alias("w"), F.lit(1).cast("long").alias("tf"), F.lit(0).cast("long").alias("df")),
        F.struct(F.array_distinct(words).alias("w"), F.lit(0).cast("long").alias("tf"), F.when(own, 1).otherwise(0).cast("long").alias("df")))).alias("x"))
    counts = both.select(F.explode("x.w").alias("term"), "x.tf", "x.df").groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    again = table(rows.where(own).groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key), "repeated")
    if not again.limit(1).count():
        return counts
    more = rows.join(again, key, "left_semi").select(*key, F.explode(F.array_distinct(words)).alias("term")).groupBy("term", *key).agg(F.count("*").alias("n"))
    less = more.groupBy("term").agg(F.sum(F.col("n") - 1).alias("less"))
    return counts.join(less, "term", "left").select("term", "tf", (F.col("df") - F.coalesce("less", F.lit(0))).alias("df"))


def token_counts(texts: DataFrame, column: str, stop: tuple[str, ...] = ()) -> DataFrame:
    """Words with how often they occur and in how many texts."""
    counts = word_counts(texts.select("doc_id", tokens(F.col(column)).alias("words")), "words", ["doc_id"])
    return counts.where(~F.col("term").isin(*stop)) if stop else counts


def _first(words: str, key: list[str], n: int, only: list[str] | None):
    """The rows of a batch's words, of each word those of its first n keys, each key once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(only, pa.string()) if only is not None else None
        for batch in batches:
            lists = batch.column(words)
            term, row = lists.flatten(), np.asarray(pc.list_parent_indices(lists)).astype(np.int64)
            if asked is not None:
                keep = pc.is_in(term, asked)
                term, row = term.filter(keep), row[np.asarray(keep)]
            place = np.zeros(batch.num_rows, np.int64)
            for k in key:
                own = np.asarray(pc.rank(batch.column(k), sort_keys="ascending", null_placement="at_start", tiebreaker="dense")).astype(np.int64)
                place = place * (batch.num_rows + 1) + own
            place = np.unique(place, return_inverse=True)[1]
            told = term.dictionary_encode()
            pair, first = np.unique(np.asarray(told.indices).astype(np.int64) * (batch.num_rows + 1) + place[row], return_index=True)
            code = pair // (batch.num_rows + 1)
            begin = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
            nth = np.arange(len(code)) - np.repeat(begin, np.diff(np.append(begin, len(code))))
            first = first[nth < n]
            out = batch.select([c for c in batch.schema.names if c != words]).take(pa.array(row[first]))
            yield pa.RecordBatch.from_arrays([*out.columns, term.take(pa.array(first))], [*out.schema.names, "term"])

    return run


def first_places(rows: DataFrame, words: str, key: list[str], n: int, only: list[str] | None = None) -> DataFrame:
    """The columns of rows but for words, term and k, from 1: the first n rows of each word (of `only`) by key, rows with the same key once.

    Each batch gives the first rows of its own words, so what is shuffled and ordered is a small part of all words."""
    rest = rows.drop(words)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields), "term string"])
    near = rows.select(*rest.columns, words).mapInArrow(_first(words, key, n, only), schema)
    once = near.groupBy("term", *key).agg(F.count("*").alias("__n"), *(F.first(c).alias(c) for c in rest.columns if c not in key)).drop("__n")
    order = Window.partitionBy("term").orderBy(*key)
    return once.withColumn("k", F.row_number().over(order)).where(F.col("k") <= n)


def phrase_counts(texts: DataFrame, column: str, n: int) -> DataFrame:
    rows = texts.select("doc_id", F.explode(ngrams(tokens(F.col(column)), n)).alias("term"))
    return rows.groupBy("term").agg(F.count("*").alias("tf"))


def _words_and_pairs(column: str, least: int, most: int):
    """term, n: the words with a letter (n: least), and the pairs with one space between, with how many texts have them, of some `most` bytes of texts."""
    def told(held: list[pa.Array]) -> pa.RecordBatch:
        texts = pc.fill_null(pa.concat_arrays(held), "").cast(pa.large_binary())
        off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
        off = off - off[0]
        word = _WORD[data]
        edge = np.zeros(len(data) + 1, bool)  # where a text begins
        edge[off] = True
        begin = np.flatnonzero(word & (edge[:-1] | ~np.append(False, word[:-1])[: len(word)]))
        end = np.flatnonzero(word & (edge[1:] | ~np.append(word[1:], False)[: len(word)])) + 1
        if not len(begin):
            return pa.RecordBatch.from_arrays([pa.array([], pa.string()), pa.array([], pa.int64())], ["term", "n"])
        upto = np.concatenate(([0], np.cumsum(end - begin))).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(upto), pa.py_buffer(data[word].tobytes())]).dictionary_encode()
        code = np.asarray(words.indices).astype(np.int64)
        letter = np.add.reduceat(word & ((data < 48) | (data > 57)), begin, dtype=np.int64) > 0
        known = np.zeros(len(words.dictionary), bool)
        known[code[letter]] = True
        text = np.searchsorted(off, begin, side="right") - 1
        two = np.flatnonzero(letter[:-1] & letter[1:] & (text[:-1] == text[1:]) & (begin[1:] == end[:-1] + 1) & (data[end[:-1]] == 32)[: len(begin) - 1] if len(begin) > 1 else np.zeros(0, bool))
        pair, told = np.unique(code[two] * len(known) + code[two + 1], return_inverse=True)
        once = np.sort(told * len(texts) + text[two])
        n = np.bincount(once[np.append(True, once[1:] != once[:-1])[: len(once)]] // len(texts), minlength=len(pair))
        first, second = (words.dictionary.take(pa.array(x)) for x in (pair // len(known), pair % len(known)))
        single = words.dictionary.filter(pa.array(known))
        terms = pa.concat_arrays([single, pc.binary_join_element_wise(first, second, pa.scalar(" ", pa.large_string()))])
        return pa.RecordBatch.from_arrays([terms.cast(pa.string()), pa.array(np.concatenate((np.full(len(single), least), n)).astype(np.int64))], ["term", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            texts = batch.column(column)
            for i, j in pieces(widths(texts), most):
                held.append(texts.slice(i, j - i))
                size += int(widths(held[-1]).sum())
                if size >= most:
                    yield told(held)
                    held, size = [], 0
        if held:
            yield told(held)

    return run


def words_and_pairs(texts: DataFrame, text: Column, least: int) -> DataFrame:
    """term: every word of ASCII (a-z, 0-9, _) with a letter or _, and every two of them with one space between that `least` texts or more have.

    Words and pairs are counted where they stand, so only counts are shuffled."""
    told = texts.select(text.alias("text")).mapInArrow(_words_and_pairs("text", least, COUNTED), "term string, n long")
    return told.groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("term")


def _counted(n: int, most: int):
    """Of the words of some `most` words' rows: each word with tf, df and its first n rows; behind them the runs of neighbouring keys."""
    def told(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        doc, idx, lists = (rows.column(c) for c in ("doc_id", "sentence_idx", "words"))
        d = np.asarray(pc.rank(doc, sort_keys="ascending", null_placement="at_end", tiebreaker="dense")).astype(np.int64)
        i = np.asarray(idx).astype(np.int64)
        _, one, place = np.unique(d * (i.max() + 1) + i, return_index=True, return_inverse=True)
        term, row = lists.flatten(), np.asarray(pc.list_parent_indices(lists)).astype(np.int64)
        coded = term.dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        pair = np.sort(code * len(one) + place[row])  # np.unique() would hash first, which takes ten times as long
        pair = pair[np.append(True, pair[1:] != pair[:-1])[: len(pair)]]
        df = np.bincount(pair // len(one), minlength=len(coded.dictionary))
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(df) - df, df)
        shown = pa.array(one[pair[nth < n] % len(one)])
        first = pa.StructArray.from_arrays([doc.is_null().take(shown), doc.take(shown), idx.take(shown), rows.column("s").take(shown)], ["absent", "doc_id", "sentence_idx", "s"])
        places = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.minimum(df, n)))), pa.int32()), first)
        begin = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (i[1:] != i[:-1] + 1))))
        end = np.append(begin[1:], len(i)) - 1
        names, none = ["term", "tf", "df", "places", "doc_id", "lo", "hi"], lambda k, *kinds: [pa.nulls(k, x) for x in kinds]
        yield pa.RecordBatch.from_arrays([
            coded.dictionary, pa.array(np.bincount(code, minlength=len(df))), pa.array(df), places, *none(len(df), doc.type, pa.int64(), pa.int64())], names)
        yield pa.RecordBatch.from_arrays([
            *none(len(begin), pa.string(), pa.int64(), pa.int64(), places.type), doc.take(pa.array(begin)), pa.array(i[begin]), pa.array(i[end])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += len(batch.column("words").flatten())
            if size >= most:
                yield from told(held)
                held, size = [], 0
        if held:
            yield from told(held)

    return run


#: Words that a task counts together, some 200 MB with all that is worked out of them.
COUNTED = 2_000_000


def term_stats(sentences: DataFrame, column: str, examples: int = 2, most: int = COUNTED) -> DataFrame:
    """tf, df over sentences and the first examples of each word.

    Sentences are read once. A task counts many words together and sends each with its first sentences, so neither words nor
    sentences are shuffled. Keys that may stand in several rows are told by runs of neighbouring keys that overlap; the
    documents that have any are counted by word and key."""
    key, kinds = ["doc_id", "sentence_idx"], dict(sentences.dtypes)
    place = f"struct<absent: boolean, doc_id: {kinds['doc_id']}, sentence_idx: {kinds['sentence_idx']}, s: string>"
    rows = sentences.select(*key, tokens(F.col(column)).alias("words"), F.substring(column, 1, 100).alias("s"))
    counted = lambda some: some.mapInArrow(_counted(examples, most), f"term string, tf long, df long, places array<{place}>, doc_id {kinds['doc_id']}, lo long, hi long")
    parts = table(counted(rows), "counted")
    before = Window.partitionBy("doc_id").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    over = parts.where("term is null").withColumn("reached", F.max("hi").over(before)).where("reached >= lo")
    again = table(over.select(F.col("doc_id").alias("__doc")).distinct(), "repeated")
    found = parts.where("term is not null").select("term", "tf", "df", "places")
    if again.limit(1).count():
        same = F.col("doc_id").eqNullSafe(F.col("__doc"))
        plain = counted(rows.join(again, same, "left_anti")).where("term is not null").select("term", "tf", "df", "places")
        apart = rows.join(again, same, "left_semi").select(*key, "s", F.explode("words").alias("term")).groupBy("term", *key).agg(F.count("*").alias("tf"), F.first("s").alias("s"))
        found = plain.unionByName(apart.select("term", "tf", F.lit(1).cast("long").alias("df"), F.array(F.struct(F.col("doc_id").isNull().alias("absent"), *key, "s")).cast(f"array<{place}>").alias("places")))
    stats = found.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"), F.slice(F.array_sort(F.flatten(F.collect_list("places"))), 1, examples).alias("places"))
    return stats.select("term", "tf", "df", F.array_join(F.transform("places", lambda x: x["s"]), "\n").alias("examples"))


def pos_top(tokens: DataFrame, k: int = 3) -> DataFrame:
    """tokens(term, pos) -> term and its k commonest tags with their counts, as tag:count joined by commas."""
    per = tokens.groupBy("term", "pos").agg(F.count("*").alias("n"))
    ranked = per.withColumn("k", F.row_number().over(Window.partitionBy("term").orderBy(F.desc("n"), "pos"))).where(F.col("k") <= k)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("k", "pos", "n"))), lambda x: F.concat_ws(":", x["pos"], x["n"].cast("string")))
    return ranked.groupBy("term").agg(F.array_join(listed, ",").alias(f"pos_top{k}"))


def merge_candidates(*sources: tuple[str, DataFrame]) -> DataFrame:
    """Terms of several sources: greatest df and tf, and the sources' names."""
    rows = None
    for name, df in sources:
        part = df.select("term", "df", "tf", F.lit(name).alias("source"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("term").agg(F.max("df").alias("df"), F.max("tf").alias("tf"), F.array_join(F.array_sort(F.collect_set("source")), "|").alias("source"))


def samples(matches: DataFrame, n: int) -> DataFrame:
    """The first n sentences of each term."""
    order = Window.partitionBy("term").orderBy("doc_id", "sentence_idx")
    return matches.withColumn("k", F.row_number().over(order)).where(F.col("k") <= n)


# From what on an aspect is called consistent (hits, share of all hits, lead over the second), and what priority weighs.
CONSISTENT = (8, 0.55, 4)
WEIGHTS = (2.0, 0.001, 10.0)


def top_terms(counts: DataFrame, k: int) -> DataFrame:
    """The k terms of the greatest df, then tf; at most k rows, so they may be broadcast."""
    return counts.orderBy(F.desc("df"), F.desc("tf"), "term").limit(k)


def suggest(terms: DataFrame, sampled: DataFrame, tagged: DataFrame, examples: int = 2) -> DataFrame:
    """What to do with each of terms(term, df, tf), by the aspects that its sampled sentences have.

    sampled(term, doc_id, sentence_idx, k, sentence), tagged(doc_id, sentence_idx, aspect_l1, aspect_l2). An aspect counts
    once a sentence; share is the best aspect's part of all hits; ties go by name."""
    key = ["doc_id", "sentence_idx"]
    aspects = tagged.select(*key, F.concat_ws("##", "aspect_l1", "aspect_l2").alias("aspect")).distinct()
    base = sampled.groupBy("term").agg(
        F.count("*").alias("sample_n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("k") <= examples, F.struct("k", "sentence")))), lambda x: x["sentence"]), "\n").alias("examples"))
    with_tags = sampled.select("term", *key).join(aspects, key)
    held = with_tags.select("term", *key).distinct().groupBy("term").agg(F.count("*").alias("covered"))
    order = Window.partitionBy("term").orderBy(F.desc("n"), "aspect")
    hits = with_tags.groupBy("term", "aspect").agg(F.count("*").alias("n"))
    ranked = hits.withColumn("k", F.row_number().over(order)).withColumn("all", F.sum("n").over(Window.partitionBy("term")))
    nth = lambda k, c: F.max(F.when(F.col("k") == k, F.col(c)))
    best = ranked.groupBy("term").agg(nth(1, "aspect").alias("best"), nth(1, "n").alias("best_n"), nth(2, "aspect").alias("second"), nth(2, "n").alias("second_n"), F.max("all").alias("hits"))
    out = terms.join(base, "term", "left").join(held, "term", "left").join(best, "term", "left").fillna(0, ["sample_n", "covered", "best_n", "second_n", "hits"]).fillna("", ["examples"])
    out = out.withColumn("uncovered", F.col("sample_n") - F.col("covered")).withColumn("covered_ratio", F.col("covered") / F.greatest("sample_n", F.lit(1))).withColumn(
        "share", F.coalesce(F.col("best_n") / F.nullif(F.col("hits"), F.lit(0)), F.lit(0.0)))
    n, part, lead = CONSISTENT
    sure = (F.col("best_n") >= n) & (F.col("share") >= part) & (F.col("best_n") - F.col("second_n") >= lead)
    return out.select(
        "term", "df", "tf", "sample_n", "covered", "uncovered", "covered_ratio", "best", "best_n", "second", "second_n", "share",
        F.when(F.col("sample_n") == 0, "IGNORE").when(sure, "ADD").otherwise("REVIEW").alias("recommendation"),
        F.when(F.col("sample_n") == 0, "no_sample_in_pool").when(sure, "high_consistency").when(F.col("covered") == 0, "mostly_uncovered_need_manual").otherwise("ambiguous").alias("reason"),
        (WEIGHTS[0] * F.col("uncovered") + WEIGHTS[1] * F.col("df") + WEIGHTS[2] * F.col("share")).alias("priority"), "examples")


def ranked(suggested: DataFrame) -> DataFrame:
    """Suggestions in the order in which people read them."""
    return suggested.orderBy("recommendation", F.desc("priority"), "term")


def decide(suggested: DataFrame, allowed: DataFrame, replies: DataFrame, least: int = 3) -> DataFrame:
    """term, decision, target (l1##l2), confidence, status of each suggestion.

    Too few sentences: IGNORE; a consistent aspect that is allowed(l1, l2): ADD; else what replies(term, decision, target,
    confidence) say, remembered ones included: an ADD to a target that isn't allowed goes to the best aspect if that is, or
    nowhere. Without a reply there is no decision."""
    pairs = allowed.select(F.concat_ws("##", "l1", "l2").alias("p")).distinct()
    mark = lambda name, column: pairs.select(F.col("p").alias(column), F.lit(True).alias(name))
    told = replies.select("term", F.upper(F.trim("decision")).alias("said"), F.col("target").alias("wanted"), F.col("confidence").alias("sure"))
    rows = suggested.join(told, "term", "left").join(mark("best_ok", "best"), "best", "left").join(mark("wanted_ok", "wanted"), "wanted", "left")
    few = F.col("sample_n") < least
    clear = (F.col("recommendation") == "ADD") & (F.col("reason") == "high_consistency") & F.col("best_ok").isNotNull()
    add = F.col("said") == "ADD"
    status = (
        F.when(few, "rule_min_sample").when(clear, "rule_high_consistency").when(F.col("said").isNull(), "pending")
        .when(add & F.col("wanted_ok").isNull() & F.col("best_ok").isNotNull(), "fallback_to_best")
        .when(add & F.col("wanted_ok").isNull(), "invalid_target_forced_ignore").otherwise("ok"))
    rows = rows.withColumn("status", status)
    decision = F.when(F.col("status").isin("rule_min_sample", "invalid_target_forced_ignore"), "IGNORE").when(F.col("status").isin("rule_high_consistency", "fallback_to_best"), "ADD").when(F.col("status") == "ok", F.col("said"))
    target = F.when(F.col("status").isin("rule_high_consistency", "fallback_to_best"), F.col("best")).when((F.col("status") == "ok") & add, F.col("wanted"))
    sure = F.when(F.col("status") == "rule_min_sample", 0.0).when(F.col("status") == "rule_high_consistency", 0.9).otherwise(F.col("sure"))
    return rows.select("term", decision.alias("decision"), target.alias("target"), sure.alias("confidence"), "status")


def apply_updates(decided: DataFrame) -> DataFrame:
    """Where each decision (decision, target) leads: an ADD to its target, or nowhere if it has none."""
    return decided.where((F.upper(F.regexp_replace("decision", r"\s", "")) == "ADD") & F.col("target").isNotNull()).select(
        "term", F.split("target", "##")[0].alias("l1"), F.split("target", "##")[1].alias("l2"))


def gates(tagged: DataFrame, sentences: DataFrame, key: list[str], l1: float = 0.85, l2: float = 0.7, unclassified: float = 0.1) -> DataFrame:
    """The shares of sentences with an l1, with an l2 below it that isn't its own, and without any, and whether each keeps its limit."""
    per = tagged.groupBy(*key).agg(F.max((F.col("aspect_l2") != "_L1").cast("int")).alias("fine"))
    n = sentences.agg(F.count("*").alias("n")).join(per.agg(F.count("*").alias("a"), F.coalesce(F.sum("fine"), F.lit(0)).alias("b")))
    share = lambda c: F.coalesce(F.col(c) / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0))
    return n.select(share("a").alias("l1"), share("b").alias("l2"), (1 - share("a")).alias("unclassified")).select(
        "*", (F.col("l1") >= l1).alias("l1_ok"), (F.col("l2") >= l2).alias("l2_ok"), (F.col("unclassified") <= unclassified).alias("unclassified_ok"))


def gate(tagged: DataFrame, sentences: DataFrame, key: list[str], least: float) -> DataFrame:
    """Whether the covered part of the sentences reaches a limit."""
    return tag_counts(sentences, tagged, key).select("ratio", F.lit(least).alias("least"), (F.col("ratio") >= least).alias("passed"))
