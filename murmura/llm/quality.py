"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted texts.

Texts are read as code points, in n-grams of ORDER; an n-gram goes by a 64-bit hash, so the alphabet is open. Counts of
trusted n-grams are added up across partitions; discounts, context weights and interpolated probabilities come from joins
of the count tables, sharded by n-gram and by context. What the trusted texts haven't shown leans on shorter n-grams, and
an unknown symbol has what the shortest leave over.

Documents meet these tables by joins. Texts that are read together are packed into units of about UNIT bytes; a unit's
distinct n-grams, however often its texts have them, are joined with the sharded tables, and what these know of them meets
the unit again. So an n-gram is sent once for a unit, and nothing of the model is gathered anywhere. A text goes if its
perplexity is above a quantile of the trusted texts of its language.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from murmura.llm._store import discard, table
from murmura.llm._text import columns, mix, pieces, tidy

ORDER = 5
#: The model learns from all trusted texts but one of so many, by a hash of their ids; thresholds take all of these, as the
#: model fits too well what it has learnt from.
HELD = 5
#: Bytes of texts in a unit, and the units that a small table has at least, so that they spread.
UNIT, UNITS = 1 << 26, 16
#: The quantile of trusted perplexity above which a text goes, and the trusted texts that a language needs for one of its own.
QUANTILE, LEAST = 0.998, 50
#: Symbols of average likelihood that are added to each text, so that few symbols alone can't make it unlikely.
PRIOR = 16

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LENGTH = np.arange(ORDER + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
#: Hashes of the n-grams that end at a symbol, and of those that end before it.
_SUFFIXES = [f"c{n}" for n in range(1, ORDER + 1)]
_CONTEXTS = [f"x{n}" for n in range(1, ORDER)]
_GRAMS = [*_SUFFIXES, *_CONTEXTS]
_CODES = ["code", "below", "context"]
#: Bits of a symbol, and how many symbols of an n-gram the second of two numbers holds.
BITS, LOW = 21, 3


def symbols(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of texts between boundaries, the places at which an n-gram ends, and the offsets of the texts' places."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    at = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[off]
    # ORDER boundaries stand before each text, one after it
    n = np.diff(at)
    full = np.zeros(len(points) + (ORDER + 1) * len(n), np.uint32)
    begin = at[:-1] + np.arange(len(n)) * (ORDER + 1) + ORDER
    place = np.arange(at[-1] + len(n)) + np.repeat(begin - (at[:-1] + np.arange(len(n))), n + 1)
    ends = np.zeros(len(place), bool)
    ends[at[1:] + np.arange(len(n))] = True
    full[place[~ends]] = points + np.uint32(1)
    return full, place, at + np.arange(len(at))


def code(full: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n symbols that end at each place."""
    out = np.zeros(len(place), np.uint64)
    for k in range(n):
        out *= _STEP
        out += full[place - (n - 1 - k)]
    return mix(out + _LENGTH[n]).view(np.int64)


def grams(full: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Rows of hashes (_GRAMS) at each place."""
    return np.stack([*(code(full, place, n) for n in range(1, ORDER + 1)), *(code(full, place - 1, n) for n in range(1, ORDER))])


def packed(full: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER symbols that end at each place in two numbers: the last LOW, and those before; a symbol has BITS bits."""
    high, low = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    for k in range(ORDER):
        own = full[place - (ORDER - 1 - k)].astype(np.int64)
        if k < ORDER - LOW:
            high = high << BITS | own
        else:
            low = low << BITS | own
    return high, low


@tidy
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = columns(batch)
        for i, j in pieces(off, 1 << 21):
            full, place, _ = symbols(data[off[i] : off[j]], off[i : j + 1] - off[i])
            number, first = _distinct(code(full, place, ORDER))
            high, low = packed(full, place[first])
            yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low), pa.array(np.bincount(number, minlength=len(first)).astype(np.int64))], ["high", "low", "c"])


def _coded(n: int):
    """code: the hash of each packed n-gram; below: of all its symbols but the first, context: of all but the last; c: its count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low = np.asarray(batch.column("high")), np.asarray(batch.column("low"))
            full = np.zeros((batch.num_rows, ORDER), np.uint32)
            for k in range(ORDER):
                own, at = (high, ORDER - LOW - 1 - k) if k < ORDER - LOW else (low, ORDER - 1 - k)
                full[:, k] = own >> (BITS * at) & ((1 << BITS) - 1)
            full, place = full.ravel(), np.arange(batch.num_rows) * ORDER + ORDER - 1
            made = [code(full, place, n), *([code(full, place, n - 1), code(full, place - 1, n - 1)] if n > 1 else [])]
            yield pa.RecordBatch.from_arrays([*map(pa.array, made), batch.column("c")], _CODES[: len(made)] + ["c"])

    return tidy(run)


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    n = dict(counts.where("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect())
    n1, n2, n3, n4 = (n.get(k, 0) for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(k - (k + 1) * y * b / a, 0.01), k - 0.01) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


class Tables:
    """The model as a table: for each n-gram (code) its log2 probability p and, as a context, its log2 weight w, where it has them.

    first: the weight of what has no context; unknown: the log2 probability of a symbol without context that the trusted
    texts don't have, less that weight; average: that of a symbol of the trusted texts."""

    def __init__(self, known: DataFrame, first: float, unknown: float, average: float) -> None:
        self.known, self.first, self.unknown, self.average = known, first, unknown, average


def train(texts: DataFrame) -> Tables | None:
    """The model of all of texts; None if there are no symbols."""
    # Symbols are shuffled and kept, which take a fourth of the hashes of all their parts; those are worked out where they are used.
    counts = [table(texts.select("text").mapInArrow(_count, "high long, low long, c long").groupBy("high", "low").agg(F.sum("c").alias("c")), "ngrams")]
    for n in range(ORDER - 1, 0, -1):
        # Below the highest order an n-gram counts once for each symbol before it.
        high, low = (F.col(c).bitwiseAND(F.lit((1 << BITS * max(0, k)) - 1)).alias(c) for c, k in (("high", n - LOW), ("low", min(n, LOW))))
        counts.insert(0, table(counts[0].select(high, low).groupBy("high", "low").agg(F.count("*").alias("c")), "ngrams"))
    seen = counts[0].count()
    if not seen:
        return None
    probabilities, weights, first = [], [], 0.0
    unknown = 1 / (seen + 1)
    for n, made in enumerate(counts, 1):
        d1, d2, d3 = _discounts(made)
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        total, weight = F.sum("c"), F.sum(cut) / F.sum("c")
        level = made.mapInArrow(_coded(n), ", ".join(f"{c} long" for c in [*_CODES[: 3 if n > 1 else 1], "c"]))
        if n == 1:
            whole = made.agg(total.alias("total"), weight.alias("weight")).first()
            first = float(np.log2(whole["weight"]))
            own = level.select("code", ((F.col("c") - cut) / F.lit(whole["total"])).alias("own"), F.lit(whole["weight"]).alias("weight"), "c", F.lit(unknown).alias("q"))
        else:
            contexts = table(level.groupBy("context").agg(total.alias("total"), weight.alias("weight")), "contexts")
            own = level.join(contexts, "context").select("code", "below", ((F.col("c") - cut) / F.col("total")).alias("own"), "weight", "c")
            own = own.join(probabilities[-1].select(F.col("code").alias("below"), F.pow(F.lit(2.0), F.col("p")).alias("q")), "below")
            weights.append(contexts.select(F.col("context").alias("code"), F.log2("weight").alias("w")))
        probabilities.append(table(own.select("code", F.log2(F.col("own") + F.col("weight") * F.col("q")).alias("p"), "c"), "probabilities"))
        discard(made)
    average = probabilities[-1].agg(F.sum(F.col("c") * F.col("p")) / F.sum("c")).first()[0]
    every = reduce(DataFrame.union, [p.select("code", "p") for p in probabilities])
    known = table(every.join(reduce(DataFrame.union, weights), "code", "full"), "model")
    for made in (*probabilities, *weights):
        discard(made)
    return Tables(known, first, float(np.log2(unknown)), average)


class Model:
    """What is known of some n-grams, as arrays in the order of their codes; not a number where it isn't known."""

    def __init__(self, known: pa.Table, first: float, unknown: float, average: float) -> None:
        codes = known.column("code").to_numpy()
        order = np.argsort(codes)
        self.codes, self.p, self.w = codes[order], known.column("p").to_numpy()[order], known.column("w").to_numpy()[order]
        self.first, self.unknown, self.average, self.guard = first, unknown, average, 0

    def _find(self, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.full(len(asked), np.nan)
        at = np.minimum(np.searchsorted(self.codes, asked), len(self.codes) - 1)
        return np.where(self.codes[at] == asked, values[at], np.nan)

    def log2(self, codes: np.ndarray) -> np.ndarray:
        """Of each column of hashes the log2 probability of its last symbol."""
        out = np.zeros(codes.shape[1])
        left = np.arange(codes.shape[1])
        for n in range(ORDER, 0, -1):
            p = self._find(self.p, codes[n - 1, left])
            found = ~np.isnan(p)
            out[left[found]] += p[found]
            left = left[~found]
            out[left] += np.nan_to_num(self._find(self.w, codes[ORDER + n - 2, left])) if n > 1 else self.first
        out[left] += self.unknown
        return out

    def perplexity(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Of each text by symbol and end, with PRIOR average ones; not a number for an empty text. Its n-grams add to the guard."""
        full, place, at = symbols(data, off)
        last = code(full, place, ORDER)
        self.guard = (self.guard + int(last.view(np.uint64).sum(dtype=np.uint64))) % (1 << 63)
        # Equal n-grams are looked up once.
        number, first = _distinct(last)
        sums = np.add.reduceat(self.log2(grams(full, place[first]))[number], at[:-1]) if len(place) else np.zeros(0)
        n = np.diff(at)
        return np.where(n > 1, np.exp2(-(sums + PRIOR * self.average) / (n + PRIOR)), np.nan)


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each code among the distinct ones, and where each of these stands first."""
    number, own = pd.factorize(codes)
    first = np.zeros(len(own), np.int64)
    first[number[::-1]] = np.arange(len(codes))[::-1]
    return number, first


def fresh_name(name: str, columns: list[str]) -> str:
    """name, or name with a number where a column has it already."""
    taken = {c.lower() for c in columns}
    return next(n for n in (name, *(f"{name}{i}" for i in range(len(taken) + 1))) if n not in taken)


def _pack(part: str, together: int):
    """unit, blob: pieces of a task's rows, compressed; a partition's pieces fill units one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = -1, 0
        for batch in batches:
            parts = np.asarray(batch.column(part))
            batch = batch.select([c for c in batch.schema.names if c != part])
            ends = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)] if len(parts) else []
            for a, b in zip(ends, ends[1:]):
                own = batch.slice(a, b - a)
                _, off = columns(own)
                for i, j in pieces(off, 1 << 22):
                    last, held = (parts[a], 0) if parts[a] != last else (last, held)
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                        out.write_batch(own.slice(i, j - i))
                    yield pa.RecordBatch.from_arrays([pa.array([(int(last) // together << 20) + held // UNIT]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["unit", "blob"])
                    held += int(off[j] - off[i])

    return tidy(run)


def _unpack(blobs: pa.Table) -> Iterator[pa.RecordBatch]:
    for blob in blobs.column("blob"):
        yield from pa.ipc.open_stream(blob.as_buffer())


def _asks(blobs: pa.Table) -> pa.Table:
    """unit, code, guard: the distinct n-grams of a unit, and in a row of its own a sum over all its places."""
    found, guard = [np.zeros(0, np.int64)], 0
    for batch in _unpack(blobs):
        data, off = columns(batch)
        for i, j in pieces(off, 1 << 21):
            full, place, _ = symbols(data[off[i] : off[j]], off[i : j + 1] - off[i])
            last = code(full, place, ORDER)
            guard = (guard + int(last.view(np.uint64).sum(dtype=np.uint64))) % (1 << 63)
            found.append(pd.unique(grams(full, place[_distinct(last)[1]]).ravel()))
            if len(found) > 8:
                found = [pd.unique(np.concatenate(found))]
    codes = pd.unique(np.concatenate(found))
    unit = blobs.column("unit")[0].as_py()
    n = len(codes)
    return pa.table([
        pa.array(np.full(n + 1, unit)), pa.array(np.append(codes, unit * 31)), pa.array(np.append(np.zeros(n, np.int64), guard), mask=np.arange(n + 1) < n)], ["unit", "code", "guard"])


def _scores(tables: Tables, keep: list[str], names: list[str]):
    """The columns to keep of a unit's rows, and their perplexity, as names."""
    first, unknown, average = tables.first, tables.unknown, tables.average

    def run(blobs: pa.Table, answers: pa.Table) -> pa.Table:
        model = Model(answers.filter(pc.is_null(answers.column("guard"))), first, unknown, average)
        out = []
        for batch in _unpack(blobs):
            data, off = columns(batch)
            ppl = [model.perplexity(data[off[i] : off[j]], off[i : j + 1] - off[i]) for i, j in pieces(off, 1 << 21)]
            out.append(pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(np.concatenate(ppl) if ppl else np.zeros(0), from_pandas=True)], names))
        told = pc.max(answers.column("guard")).as_py()
        if model.guard != told:
            raise ValueError("the texts have changed while they were read; write them to a table first")
        return pa.Table.from_batches(out)

    return run


def scored(docs: DataFrame, tables: Tables, keep: list[str], schema: str) -> DataFrame:
    """The columns to keep of each row of docs and its perplexity, in the given schema."""
    part = fresh_name("part", docs.columns)
    texts = docs.withColumn(part, F.spark_partition_id())
    told = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.coalesce(F.max(part), F.lit(0)).alias("last")).first()
    together = max(1, (told["last"] + 1) // max(UNITS, -(-told["bytes"] // UNIT)))
    # The same units are asked for and scored, so they are shuffled once.
    units = texts.mapInArrow(_pack(part, together), "unit long, blob binary")
    asks = units.groupBy("unit").applyInArrow(_asks, "unit long, code long, guard long")
    answers = asks.join(tables.known, "code", "left").where("p is not null or w is not null or guard is not null").select(F.col("unit").alias("of"), "code", "p", "w", "guard")
    return units.groupBy("unit").cogroup(answers.groupBy("of")).applyInArrow(_scores(tables, keep, [f.name for f in StructType.fromDDL(schema).fields]), schema)


class Classifier:
    """A model's thresholds by language; None has that of all together."""

    def __init__(self, thresholds: dict[str | None, float]) -> None:
        self.thresholds = thresholds

    def threshold(self) -> Column:
        out = F.lit(float(self.thresholds[None]))
        own = {k: v for k, v in self.thresholds.items() if k is not None}
        if not own:
            return out
        return F.coalesce(F.create_map(*(F.lit(x) for kv in own.items() for x in kv))[F.coalesce("lang", F.lit(""))], out)


def fit(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, whole: bool = False) -> tuple[Classifier | None, DataFrame | None, str]:
    """A classifier by all trusted texts, a table of each row of docs with its perplexity, and the name of that column.

    The rows have doc_id and lang, or with whole all their columns. labels(doc_id, quality): a document is trusted if all
    its labels have quality 1. A language with fewer than LEAST trusted texts, and a null one, has the threshold of all
    languages together. Without trusted texts to learn from and others to set thresholds by there is no classifier."""
    trusted = labels.groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1 and doc_id is not null").select("doc_id")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD)) == 0
    tables = train(docs.select("doc_id", "text").join(trusted.where(~held), "doc_id", "left_semi").where("text <> ''"))
    if tables is None:
        return None, None, ""
    rows = docs if whole else docs.select(F.col("doc_id").cast("long"), "lang", "text")
    keep = rows.columns if whole else ["doc_id", "lang"]
    name = fresh_name("perplexity", rows.columns)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*(F.col(f"`{c}`") for c in keep)).schema.fields), f"`{name}` double"])
    found = table(scored(rows, tables, keep, schema), "perplexities")
    good = found.select("doc_id", "lang", F.col(name).alias("p")).where("p is not null").join(trusted.where(held), "doc_id", "left_semi")
    every = good.agg(F.percentile_approx("p", quantile, 100_000)).first()[0]
    if every is None:
        return None, None, ""
    own = good.where("lang is not null").groupBy("lang").agg(F.percentile_approx("p", quantile, 100_000).alias("t"), F.count("*").alias("n")).where(F.col("n") >= LEAST)
    return Classifier({None: every} | {r["lang"]: r["t"] for r in own.collect()}), found, name


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, perplexity, threshold, kept, a row per row of docs.

    A null or empty text has no perplexity and goes. Without trusted texts every other text stays, and perplexity and
    threshold are null. Repeated rows are judged each. docs needs doc_id, text and lang; other columns are ignored."""
    made, found, _ = fit(docs, labels, quantile)
    if made is None:
        return docs.select("doc_id", "lang", F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"), (F.coalesce("text", F.lit("")) != "").alias("kept"))
    return found.withColumn("threshold", made.threshold()).withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))


def kept(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The rows of docs that classify() keeps, with all their columns."""
    made, found, name = fit(docs, labels, quantile, whole=True)
    if made is None:
        return docs.where("text <> ''")
    return found.where(F.col(name) <= made.threshold()).drop(name)


def op9_quality(spark, sf_dir: str) -> DataFrame:
    """All documents, by a model of those labelled as good."""
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
