"""Lexicons: which terms stand for which aspects, and tagging of sentences with them."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmura.operators import matching
from murmura.operators.matching import find
from murmura.sources.scratch import table

SCHEMA = "domain string, l1 string, l2 string, term string, ord int"


def usable(terms: DataFrame) -> DataFrame:
    """Terms that aren't blank, digits or marks only."""
    stripped = terms.withColumn("term", F.trim("term"))
    return stripped.where((F.col("term") != "") & F.col("term").rlike(r"[^\p{P}\p{S}\s]") & ~F.col("term").rlike(r"^[0-9]+$"))


def matcher(terms: DataFrame) -> DataFrame:
    """The first aspect of each term, whatever its case."""
    order = Window.partitionBy(F.lower("term")).orderBy("ord")
    return usable(terms).withColumn("__n", F.row_number().over(order)).where("__n = 1").select(F.lower("term").alias("term"), "l1", "l2")


def conflicts(terms: DataFrame) -> DataFrame:
    """Terms that a later entry gives to another aspect: the one kept and the other."""
    order = Window.partitionBy("term").orderBy("ord")
    first = F.first(F.struct("l1", "l2")).over(order)
    return usable(terms).withColumn("kept", first).where((F.col("kept.l1") != F.col("l1")) | (F.col("kept.l2") != F.col("l2"))).select(
        "term", F.col("kept.l1").alias("kept_l1"), F.col("kept.l2").alias("kept_l2"), F.col("l1").alias("other_l1"), F.col("l2").alias("other_l2"))


def tag(sentences: DataFrame, terms: DataFrame, column: str = "sentence", drop: tuple[str, ...] = ()) -> DataFrame:
    """A row per sentence, without the columns to drop, and distinct term, with the term's aspect: the leftmost longest terms whatever their case."""
    known = matcher(terms).select("term", F.col("l1").alias("aspect_l1"), F.col("l2").alias("aspect_l2"))
    if (terms.agg(F.sum(F.length("term"))).first()[0] or 0) > matching.BROADCAST:
        known = table(known, "lexicon")  # worked out once
    return find(sentences, known, F.lower(column), "hit_term", longest=True, carry=("aspect_l1", "aspect_l2"), drop=drop)


def mark(sentences: DataFrame, terms: DataFrame, name: str, column: str = "sentence") -> DataFrame:
    """sentences, without their text, with whether tag() has a row for each, as column name."""
    return matching.mark(sentences, matcher(terms), F.lower(column), name, True, (column,))


def substrings(sentences: DataFrame, terms: DataFrame, column: str = "sentence") -> DataFrame:
    """Every term that a sentence contains, in its own case, overlapping ones too."""
    return find(sentences, terms, F.col(column), "term", longest=False)


#: Aspects that are told by the bits of numbers, BITS in each.
MASKED, BITS = 1000, 63


def tag_all(sentences: DataFrame, terms: DataFrame, key: list[str], column: str = "sentence") -> DataFrame:
    """key, aspect_l1, aspect_l2: every aspect of every term that a sentence contains, each once a sentence.

    A sentence's aspects are bits, so a key has one row where it is made distinct; with more aspects than MASKED, one for each."""
    aspects = usable(terms).select("term", F.col("l1").alias("aspect_l1"), F.col("l2").alias("aspect_l2")).distinct()
    names = aspects.select("aspect_l1", "aspect_l2").distinct().limit(MASKED + 1).collect()
    if not 0 < len(names) <= MASKED:
        return substrings(sentences.select(*key, column), usable(terms), column).join(aspects, "term").select(*key, "aspect_l1", "aspect_l2").distinct()
    numbered = terms.sparkSession.createDataFrame([(*r, i) for i, r in enumerate(names)], "aspect_l1 string, aspect_l2 string, __n int")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("aspect_l1", "aspect_l2")]
    masks = [f"__m{i}" for i in range(-(-len(names) // BITS))]
    bit = lambda i: F.when(F.floor(F.col("__n") / BITS) == i, F.expr(f"shiftleft(1L, __n % {BITS})")).otherwise(F.lit(0).cast("long"))
    marked = aspects.alias("a").join(F.broadcast(numbered.alias("b")), same).groupBy("term").agg(*(F.bit_or(bit(i)).alias(m) for i, m in enumerate(masks)))
    found = find(sentences.select(*key, column), marked, F.col(column), "term", False, carry=tuple(masks), drop=(column,))
    per = found.groupBy(*key).agg(*(F.bit_or(m).alias(m) for m in masks))
    every = F.sequence(F.lit(0), F.lit(BITS - 1))
    held = lambda i, m: F.transform(F.filter(every, lambda k: F.getbit(F.col(m), k) == 1), lambda k: k + i * BITS)
    return per.select(*key, F.explode(F.flatten(F.array(*(held(i, m) for i, m in enumerate(masks))))).alias("__n")).join(F.broadcast(numbered), "__n").select(*key, "aspect_l1", "aspect_l2")


def assign(terms: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """The aspects of terms by regular expressions (l1, l2, pattern): ASCII terms last, then shorter ones first."""
    cases = F.filter(F.array(*(F.when(F.col("term").rlike(p), F.struct(F.lit(a).alias("l1"), F.lit(b).alias("l2"))) for a, b, p in rules)), lambda x: x.isNotNull())
    return terms.select("term", F.explode(cases).alias("a")).select("term", "a.l1", "a.l2")


def merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Terms of known l1 added to a lexicon; each aspect's terms once, by length and text."""
    known = old.select("l1").distinct()
    both = old.select("l1", "l2", "term").unionByName(new.join(F.broadcast(known), "l1", "left_semi").select("l1", "l2", "term")).where(F.trim("term") != "").distinct()
    order = Window.partitionBy("l1", "l2").orderBy(F.length("term"), "term")
    return both.withColumn("ord", F.row_number().over(order))
