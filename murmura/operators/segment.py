"""Words of scripts without spaces: a dictionary with counts, and the likeliest way to cut a text into its words.

The dictionary is learnt from the texts: strings of neighbouring ideographs that occur often, much oftener than their parts
would side by side by chance, and beside different neighbours. A run of ideographs is then cut into the words whose costs
(negative logarithms of their shares of all counts) have the least sum.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.functions.text import HAN
from murmura.operators.matching import Automaton, distinct, pieces, points, widths
from murmura.sources.scratch import table

#: Words of a dictionary at most, the commonest: it is a model of fixed size and so is broadcast.
WORDS = 500_000
#: What a cost is counted in, and a cost above all others.
UNIT, NEVER = 1000, 1 << 61
#: Characters that are cut at once; bytes of texts whose strings are counted at once, and codes that are counted in a table.
PIECE, COUNTED, DENSE = 1 << 19, 1 << 24, 1 << 22
#: The ideographs of functions.text.HAN.
_RANGES = ((0x3400, 0x4DBF), (0x4E00, 0x9FFF))


def runs(text: Column) -> Column:
    """The runs of ideographs of a text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"{HAN}+"), F.lit(0))


def _strings(longest: int):
    """word, n, a0, a1, b0, b1: the strings of a batch's runs, how often they occur, least and greatest neighbour on either side (0: the end of a run)."""
    def counted(values: pa.Array) -> Iterator[pa.RecordBatch]:
        text, _ = points(values)
        # Characters by their place in the alphabet, which keeps their order; 0 stands for the end of a run.
        there = np.zeros(0x110001, bool)
        there[text] = True
        there[0x110000] = False
        chars = np.concatenate(([0], np.flatnonzero(there)))
        number = np.zeros(0x110001, np.int32)
        number[chars[1:]] = np.arange(1, len(chars))
        text = np.concatenate((np.zeros(1, np.int32), number[text], np.zeros(longest + 1, np.int32)))
        here = np.flatnonzero(text)
        node, width, made = np.zeros(len(here), np.int64), len(chars), np.zeros((1, 0), np.int32)
        for k in range(1, longest + 1):
            inside = text[here + k - 1] > 0
            here, node = here[inside], node[inside]
            if not len(here):
                break
            node = node * width + text[here + k - 1]
            if len(made) * width <= DENSE:
                n = np.bincount(node, minlength=len(made) * width)
                codes = np.flatnonzero(n)
                n, place = n[codes], np.cumsum(n > 0) - 1
                node = place[node]
            else:
                codes, node, n = np.unique(node, return_inverse=True, return_counts=True)
            ends = []
            for side in (text[here - 1], text[here + k]):
                low, high = np.full(len(codes), width, np.int32), np.zeros(len(codes), np.int32)
                np.minimum.at(low, node, side)
                np.maximum.at(high, node, side)
                ends += [chars[low], chars[high]]
            made = np.concatenate((made[codes // width], chars[codes % width][:, None].astype(np.int32)), 1)
            word = [made[i : i + 65536].tobytes().decode("utf-32-le") for i in range(0, len(made), 65536)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w[i : i + k] for w in word for i in range(0, len(w), k)], pa.string()), pa.array(n.astype(np.int64)), *(pa.array(x.astype(np.int32)) for x in ends)], ["word", "n", "a0", "a1", "b0", "b1"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("runs").flatten()
            for i, j in pieces(widths(values), COUNTED):
                yield from counted(values.slice(i, j - i))

    return run


def dictionary(texts: DataFrame, column: str, longest: int = 4, least: int = 5, cohesion: float = 8.0, words: int = WORDS) -> DataFrame:
    """word, n: every ideograph, and every string of 2 to `longest` that occurs `least` times or more, `cohesion` times as often
    as any two parts of it would stand side by side by chance, and not always beside the same neighbour on either side.

    The end of a run is a neighbour of its own kind. At most `words` words, the commonest, ties by the word. Null and empty
    texts have none. Strings are counted where they stand before anything is shuffled."""
    told = texts.select(runs(F.col(column)).alias("runs")).where(F.size("runs") > 0).mapInArrow(_strings(longest), "word string, n long, a0 int, a1 int, b0 int, b1 int")
    once = table(told.groupBy("word").agg(F.sum("n").alias("n"), F.min("a0").alias("a0"), F.max("a1").alias("a1"), F.min("b0").alias("b0"), F.max("b1").alias("b1")), "strings")
    whole = once.where(F.length("word") == 1).agg(F.sum("n").alias("total"))
    often = once.where((F.col("n") >= least) & (F.length("word") > 1) & (F.col("a0") < F.col("a1")) & (F.col("b0") < F.col("b1"))).select("word", "n")
    parts = often.select("word", "n", F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("i")).select(
        "word", "n", F.substring(F.col("word"), F.lit(1), F.col("i")).alias("left"), F.substring(F.col("word"), F.col("i") + 1, F.lit(longest)).alias("right"))
    # A part occurs as often as the whole at least, so rarer strings can't be one.
    counts = once.where(F.col("n") >= least).select("word", "n")
    met = parts.join(counts.toDF("left", "n_left"), "left").join(counts.toDF("right", "n_right"), "right")
    firm = met.groupBy("word", "n").agg(F.max(F.col("n_left").cast("double") * F.col("n_right")).alias("chance")).join(F.broadcast(whole)).where(
        F.col("n") * F.col("total").cast("double") >= cohesion * F.col("chance")).select("word", "n")
    return firm.unionByName(once.where(F.length("word") == 1).select("word", "n")).orderBy(F.desc("n"), "word").limit(words)


class Lexicon:
    """Words with whole costs; a character that is no word costs more than any."""

    def __init__(self, words: list[str], counts: list[int]) -> None:
        self.known = Automaton(words)
        self.known.terms = []  # places are all that is asked for
        n = np.array(counts, float)
        self.cost = np.rint(-UNIT * np.log(n / n.sum())).astype(np.int64)
        self.unknown = int(np.rint(-UNIT * np.log(0.5 / n.sum()))) if len(n) else UNIT

    def cut(self, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where words end in runs of code points that begin at `at` and are parted by one place.

        The least sum counts; of equal ones that with the longer last word, and so on towards the begin. The runs are
        worked on side by side, a place of each at once."""
        size, longest = np.diff(at) - 1, max(1, self.known.longest)
        # Longer runs first: the places of all runs at the same distance from their begins then stand side by side, those of fewer runs further on.
        order = np.argsort(-size, kind="stable")
        starts, sizes = at[:-1][order], size[order]
        most = int(size.max(initial=0))
        live = np.searchsorted(-sizes, -np.arange(most))
        offset = np.concatenate(([0], np.cumsum(live)))
        place = np.zeros(len(text), np.int64)
        rank = np.repeat(np.arange(len(sizes)), sizes)
        far = np.arange(len(rank)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place[starts[rank] + far] = offset[far] + rank
        # A cost's low bits tell the row, longer words first, so that the least number tells both.
        bits = longest.bit_length()
        never = (longest + 1) * (max(self.unknown, int(self.cost.max(initial=0))) + 1)
        costs = np.full((longest, offset[-1]), never, np.int32 if never << bits < 1 << 31 else np.int64)
        for end, number in self.known.ends(text):
            costs[longest - self.known.size[number], place[end]] = self.cost[number]
        np.minimum(costs[-1], self.unknown, out=costs[-1])
        costs <<= bits
        costs |= np.arange(longest, dtype=costs.dtype)[:, None]
        best, back = np.full((longest, len(sizes)), NEVER, np.int64), np.ones(offset[-1], np.int32)
        best[0] = 0
        for t in range(most):
            a, m = offset[t], live[t]
            least = (best[np.arange(t + 1 - longest, t + 1) % longest, :m] + costs[:, a : a + m]).min(0)
            row = least & ((1 << bits) - 1)
            best[(t + 1) % longest, :m] = least - row
            back[a : a + m] = longest - row
        ends = np.zeros(len(text), bool)
        p, first = (at[1:] - 2)[size > 0], at[:-1][size > 0]
        while len(p):
            ends[p] = True
            p = p - back[place[p]]
            inside = p >= first
            p, first = p[inside], first[inside]
        return ends


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """A batch by rows whose lists together have a bounded number of bytes; a longer row is a batch of its own."""
    lists = batch.column(column)
    off = np.asarray(lists.offsets).astype(np.int64)
    upto = np.concatenate(([0], np.cumsum(widths(lists.values.slice(off[0], off[-1] - off[0])), dtype=np.int64)))
    for i, j in pieces(np.diff(upto[off - off[0]])):
        yield batch.slice(i, j - i)


def _segment(lexicon, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _parts(whole, column)):
            lists = batch.column(column)
            off = np.asarray(lists.offsets).astype(np.int64)
            values = lists.values.slice(off[0], off[-1] - off[0])
            text, at = points(values)
            ends = np.zeros(len(text), bool)
            ends[(at[1:] - 2)[np.diff(at) > 1]] = True  # a value is a word, but for runs of ideographs
            first = text[at[:-1]]
            han = np.flatnonzero(np.logical_or.reduce([(first >= a) & (first <= b) for a, b in _RANGES]) & (np.diff(at) > 2))
            sizes = np.cumsum(np.diff(at)[han])
            for some in np.split(han, np.flatnonzero(np.diff(sizes // PIECE)) + 1) if len(han) else []:
                n = np.diff(at)[some]
                own = np.concatenate(([0], np.cumsum(n)))
                place = np.arange(own[-1]) - np.repeat(own[:-1], n) + np.repeat(at[some], n)
                ends[place] = lexicon.value.cut(text[place], own)
            real = text < 0x110000
            flat, ends = text[real], ends[real]
            width = 1 + (flat >= 0x80).astype(np.int64) + (flat >= 0x800) + (flat >= 0x10000)
            upto = np.cumsum(width)[ends]
            words = pa.Array.from_buffers(pa.large_string(), len(upto), [None, pa.py_buffer(np.concatenate(([0], upto)).astype(np.int64)), pa.py_buffer(flat.tobytes().decode("utf-32-le").encode())])
            total = np.concatenate(([0], np.cumsum(ends)))  # words before each character
            chars = np.concatenate(([0], np.cumsum(np.diff(at) - 1)))  # characters before each value
            made = pa.ListArray.from_arrays(pa.array(total[chars[off - off[0]]].astype(np.int32), mask=np.append(~np.asarray(pc.is_valid(lists)), False)), words.cast(pa.string()))
            yield batch.set_column(batch.schema.get_field_index(column), column, made)

    return run


def _lexicon(known: DataFrame, most: int):
    """The words of known in a broadcast lexicon."""
    used = known.where("n > 0 and word <> ''").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most).toPandas()
    return known.sparkSession.sparkContext.broadcast(Lexicon(used["word"].tolist(), used["n"].tolist()))


def _split(column: str) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(column), f"({HAN}+)", " $1 "), r"[^\p{L}\p{N}_]+"), lambda x: x != "")


def words(texts: DataFrame, column: str, known: DataFrame, name: str = "words", least: int = 2, most: int = WORDS) -> DataFrame:
    """texts with the words of a column, as column name: letters, digits and _ in lower case, runs of ideographs cut by known(word, n).

    Words of fewer characters than least are left out. A null text has null words, an empty one none. Words of known with a
    count below one don't count, repeated ones count together; of more than `most` the commonest are used."""
    made = _lexicon(known, most)
    split = texts.withColumn(name, _split(column))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in split.schema.fields)
    return split.mapInArrow(_segment(made, name), schema).withColumn(name, F.filter(name, lambda x: F.length(x) >= least))


def _counted(lexicon, column: str, least: int):
    """term, tf, df: how often the words of some COUNTED bytes occur, and in how many rows."""
    def told(held: list[tuple[pa.Array, np.ndarray]], rows: int) -> pa.RecordBatch:
        coded = pa.concat_arrays([x for x, _ in held]).dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        pair = distinct(code * rows + np.concatenate([x for _, x in held]))
        n = len(coded.dictionary)
        return pa.RecordBatch.from_arrays([coded.dictionary, pa.array(np.bincount(code, minlength=n)), pa.array(np.bincount(pair // rows, minlength=n))], ["term", "tf", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, rows = [], 0, 0
        for batch in _segment(lexicon, column)(batches):
            lists = batch.column(column)
            found, row = lists.flatten(), np.asarray(pc.list_parent_indices(lists)).astype(np.int64)
            keep = pc.greater_equal(pc.utf8_length(found), least)
            held.append((found.filter(keep), row[np.asarray(keep)] + rows))
            size, rows = size + int(widths(found).sum()), rows + batch.num_rows
            if size >= COUNTED:
                yield told(held, rows)
                held, size, rows = [], 0, 0
        if rows:
            yield told(held, rows)

    return run


def counts(texts: DataFrame, column: str, known: DataFrame, least: int = 2, most: int = WORDS) -> DataFrame:
    """word_counts() of the words() of a column: term, tf, df.

    Words are counted where they stand, so only counts are shuffled; only texts whose doc_id stands in several rows go by word and key."""
    made = _lexicon(known, most)
    several = table(texts.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("__id")), "repeated")
    none = several.isEmpty()
    same = F.col("doc_id").eqNullSafe(F.col("__id"))
    own = texts if none else texts.join(several, same, "left_anti")
    told = own.select(_split(column).alias("words")).mapInArrow(_counted(made, "words", least), "term string, tf long, df long")
    if not none:
        told = told.unionByName(word_counts(words(texts.join(several, same, "left_semi"), column, known, least=least, most=most)))
    return told.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def word_counts(segmented: DataFrame, name: str = "words", stop: tuple[str, ...] = ()) -> DataFrame:
    """term, tf, df of doc_id's words."""
    rows = segmented.select("doc_id", F.explode(name).alias("term"))
    once = (rows.where(~F.col("term").isin(*stop)) if stop else rows).groupBy("term", "doc_id").agg(F.count("*").alias("n"))
    return once.groupBy("term").agg(F.sum("n").alias("tf"), F.count("*").alias("df"))
