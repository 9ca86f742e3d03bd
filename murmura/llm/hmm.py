"""A hidden Markov language model: Baum-Welch over all training texts, exact likelihoods by the scaled forward recursion.

A state emits the class of a token (a hash of the word, one of CLASSES; the end of a text has its own), and the class its
word by smoothed counts, so the tables that workers hold are bounded by parameters while word counts stay distributed.
Each round of Baum-Welch adds up expected counts within a partition, then by class across partitions.

Texts train and are scored whole. A long one is worked on in stretches side by side: the product of a stretch's transition
and emission matrices carries the states over it, which gives the exact forward and backward states at its limits, and
what is held at once doesn't grow with the text.

Word counts reach the texts in chunks: a worker numbers the words of some 16 MB of texts, one row for each distinct word
goes to the count join, and the counts come back to the chunk. Rows follow distinct words of chunks, not tokens. A word of
many chunks is spread over several keys of that join.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm._store import table
from murmura.llm._text import columns, mix, pieces, tidy, word_hashes

STATES, CLASSES, ROUNDS = 6, 16384, 4
#: Tokens that one step of the recursions after the other covers; longer texts are several such stretches, joined exactly.
STRETCH = 1024
#: Tokens whose states are held at once.
HELD = 1 << 20
CHUNK_BYTES = 16 << 20
#: Chunks of a word under one key of the count join, if fewer words than COMMON have more.
SPREAD, COMMON = 1000, 50_000
_STAY = 0.95
_PRIOR = 20.0


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


def classes_of(words: list[bytes]) -> np.ndarray:
    """The class of each word; none holds white space."""
    data = np.frombuffer(b" ".join(words), np.uint8)
    h, _ = word_hashes(data, np.array([0, len(data)]))
    return (h & np.uint64(CLASSES - 1)).astype(np.int64)


def planes(row: np.ndarray) -> bytes:
    """32-bit numbers byte by byte: all lowest bytes, then all next ones; small numbers leave planes of zeros, which compress away."""
    return np.ascontiguousarray(row.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def numbers(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


@tidy
def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as numbers of their chunk's words, and the chunk's words with their classes and training counts."""
    names = ["chunk", "is_word", "doc_id", "held_out", "tokens", "word", "lid", "cls", "n"]
    chunk = -1
    vocab: dict[bytes, int] = {b"": 0}
    ids, held, coded, counts, size = [], [], [], np.zeros(1, np.int64), 0

    def flush() -> Iterator[pa.RecordBatch]:
        n = len(ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk] * n, pa.int64()), pa.array([False] * n), pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(coded, pa.binary()),
             pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], names)
        m = len(vocab)
        words = list(vocab)
        cls = np.concatenate(([CLASSES], classes_of(words[1:]) if m > 1 else []))
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk] * m, pa.int64()), pa.array([True] * m), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.binary()),
             pa.array(words, pa.binary()).cast(pa.string()), pa.array(np.arange(m, dtype=np.int32)), pa.array(cls.astype(np.int32)), pa.array(counts[:m])], names)

    for batch in batches:
        if chunk < 0 and len(batch):
            chunk = batch.column("part")[0].as_py() << 24
        texts = batch.column("text").cast(pa.binary())
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
            low = (text.as_py() or b"").lower()
            tokens = [vocab.setdefault(w, len(vocab)) for w in low.split()]
            tokens.append(0)
            row = np.array(tokens, np.uint32)
            out = held_out(doc_id)
            if len(vocab) > len(counts):
                counts = np.concatenate((counts, np.zeros(max(len(vocab), len(counts)), np.int64)))
            if not out:
                counts[: int(row.max()) + 1] += np.bincount(row)
            ids.append(doc_id)
            held.append(out)
            coded.append(planes(row))
            size += len(low)
            if size >= CHUNK_BYTES:
                yield from flush()
                chunk += 1
                vocab, size = {b"": 0}, 0
                ids, held, coded, counts = [], [], [], np.zeros(1, np.int64)
    if ids:
        yield from flush()


class Model:
    """Start, transition (from, to) and emission (class, state) probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def seeded(cls, share: np.ndarray) -> "Model":
        """Every class near its share of the tokens, shifted by a keyed hash so that states differ; states tend to stay."""
        at = np.arange(len(share) * STATES, dtype=np.uint64).reshape(len(share), STATES)
        shift = 0.25 + 1.5 * (mix(at + np.uint64(0x1D8E4E27C47D124F)) >> np.uint64(11)).astype(float) / (1 << 53)
        emit = share[:, None] * shift
        move = np.full((STATES, STATES), (1 - _STAY) / (STATES - 1))
        np.fill_diagonal(move, _STAY)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(0))

    @classmethod
    def counted(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> "Model":
        """Expected counts to probabilities; each table leans on a prior, so nothing is impossible."""
        emit = emit + _PRIOR * share[:, None]
        start, move = start + 1, move + 1
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def stretches(begin: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The stretches of texts, in order: text, number in it, first token, tokens."""
    parts = -(-lens // STRETCH)
    which = np.repeat(np.arange(len(lens)), parts)
    number = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
    return which, number, begin[which] + number * STRETCH, np.minimum(STRETCH, lens[which] - number * STRETCH)


class Steps:
    """Stretches in step: the first token of each, then the second of each that has one, and so on, the longest first."""

    def __init__(self, tokens: np.ndarray, begin: np.ndarray, lens: np.ndarray) -> None:
        self.order = np.argsort(-lens, kind="stable")
        begin, self.lens = begin[self.order], lens[self.order]
        self.active = np.searchsorted(-self.lens, -np.arange(1, int(self.lens[0]) + 1), side="right")
        self.at = np.concatenate(([0], np.cumsum(self.active)))
        self.cls = tokens[np.concatenate([begin[:n] + t for t, n in enumerate(self.active)])]

    def ahead(self, model: Model, into: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Emissions, scaled forward states and scales of each step; into: the states before each stretch's first token."""
        e = model.emit[self.cls]
        a, scale = np.empty_like(e), np.empty(len(e))
        states = into[self.order]
        for n, lo in zip(self.active, self.at):
            row = a[lo : lo + n]
            np.multiply(states[:n], e[lo : lo + n], out=row)
            c = row.sum(1)
            row /= c[:, None]
            scale[lo : lo + n] = c
            states = row @ model.move
        return e, a, scale

    def products(self, model: Model) -> np.ndarray:
        """For each stretch what takes states before its first token to those at its last, but for a factor."""
        n = len(self.lens)
        p = np.zeros((n, STATES, STATES))
        for t, (k, lo) in enumerate(zip(self.active, self.at)):
            e = model.emit[self.cls[lo : lo + k]]
            if t == 0:
                p[:, np.arange(STATES), np.arange(STATES)] = e
            else:
                q = (p[:k].reshape(-1, STATES) @ model.move).reshape(k, STATES, STATES)
                q *= e[:, None, :]
                q /= q.sum((1, 2))[:, None, None]
                p[:k] = q
        out = np.empty_like(p)
        out[self.order] = p
        return out


def limits(model: Model, tokens: np.ndarray, which: np.ndarray, number: np.ndarray, begin: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each stretch the forward states at the token before it (the first of a text: none) and the backward weights at its last token."""
    before, after = np.zeros((len(which), STATES)), np.ones((len(which), STATES))
    last = np.append(which[1:] != which[:-1], True)
    several = np.flatnonzero((number > 0) | ~last)
    if not len(several):
        return before, after
    product = np.empty((len(which), STATES, STATES))
    for part in in_parts(several, lens[several]):
        product[part] = Steps(tokens, begin[part], lens[part]).products(model)
    states = np.tile(model.start, (len(which), 1))
    for k in range(int(number.max())):
        i = np.flatnonzero((number == k) & ~last)
        a = np.einsum("ni,nij->nj", states[i], product[i])
        before[i + 1] = a / a.sum(1, keepdims=True)
        states[i + 1] = before[i + 1] @ model.move
    for k in range(int(number.max()), 0, -1):
        i = np.flatnonzero(number == k)
        b = np.einsum("nij,nj->ni", product[i], after[i]) @ model.move.T
        after[i - 1] = b / b.sum(1, keepdims=True)
    return before, after


def in_parts(items: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Neighbouring items of about HELD tokens together."""
    ends = np.cumsum(sizes)
    a = 0
    while a < len(items):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + HELD, side="right")))
        yield items[a:b]
        a = b


class Expectation:
    """Baum-Welch counts of many whole texts at once."""

    def __init__(self, model: Model) -> None:
        self.m = model
        self.start, self.move = np.zeros(STATES), np.zeros((STATES, STATES))
        self.emit = np.zeros((CLASSES + 1, STATES))

    def add(self, tokens: np.ndarray, begin: np.ndarray, lens: np.ndarray) -> None:
        """tokens: classes; each text is tokens[begin : begin + lens]."""
        which, number, begin, lens = stretches(begin, lens)
        before, after = limits(self.m, tokens, which, number, begin, lens)
        for part in in_parts(np.arange(len(which)), lens):
            self._count(Steps(tokens, begin[part], lens[part]), number[part] == 0, before[part], after[part])

    def _count(self, steps: Steps, first: np.ndarray, before: np.ndarray, after: np.ndarray) -> None:
        into = np.where(first[:, None], self.m.start, before @ self.m.move)
        e, a, scale = steps.ahead(self.m, into)
        first, before, after = first[steps.order], before[steps.order], after[steps.order]
        end = a[steps.at[steps.lens - 1] + np.arange(len(after))]
        after = after / (end * after).sum(1, keepdims=True)
        moved = np.zeros((STATES, STATES))
        back = after[:0]
        for t in range(len(steps.active) - 1, -1, -1):
            n, lo = steps.active[t], steps.at[t]
            back = np.concatenate((back, after[len(back) : n]))
            ahead = a[lo : lo + n]
            weighted = e[lo : lo + n] * back
            weighted /= scale[lo : lo + n, None]
            ahead *= back  # from here on the chance of each state
            if t:
                moved += a[steps.at[t - 1] : steps.at[t - 1] + n].T @ weighted
                back = weighted @ self.m.move.T
            else:
                self.start += ahead[first].sum(0)
                moved += before.T @ weighted  # before the first of a text there is nothing
        self.move += self.m.move * moved
        for s in range(STATES):
            self.emit[:, s] += np.bincount(steps.cls, a[:, s], CLASSES + 1)


def _expect(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exp = Expectation(model)
        held, lens, size = [], [], 0

        def add() -> None:
            n = np.concatenate(lens)
            exp.add(np.concatenate(held), np.cumsum(n) - n, n)

        for batch in batches:
            data, off = columns(batch)
            for i, j in pieces(off):
                h, at = word_hashes(data[off[i] : off[j]], off[i : j + 1] - off[i])
                # a text's classes, then its end
                held.append(np.insert((h & np.uint64(CLASSES - 1)).astype(np.int32), at[1:], CLASSES))
                lens.append(np.diff(at) + 1)
                size += len(held[-1])
                if size >= HELD:
                    add()
                    held, lens, size = [], [], 0
        if size:
            add()
        some = np.flatnonzero(exp.emit.any(1))
        keys = np.concatenate((some, -1 - np.arange(STATES), [-1 - STATES]))
        rows = np.concatenate((exp.emit[some], exp.move, exp.start[None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.astype(np.int32)), *(pa.array(rows[:, s]) for s in range(STATES))], ["k", *(f"s{s}" for s in range(STATES))])

    return tidy(run)


def train(docs: DataFrame, share: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all of docs. What comes to the driver is bounded by (CLASSES + STATES + 2) x STATES numbers."""
    model = Model.seeded(share)
    names = [f"s{s}" for s in range(STATES)]
    for _ in range(rounds):
        counts = docs.select("text").mapInArrow(_expect(model), "k int, " + ", ".join(f"{c} double" for c in names))
        found = counts.groupBy("k").agg(*(F.sum(c).alias(c) for c in names)).toPandas().set_index("k")[names]
        full = found.reindex(range(-1 - STATES, CLASSES + 1), fill_value=0.0).to_numpy()
        move = full[1 : STATES + 1][::-1]
        model = Model.counted(full[0], move, full[STATES + 1 :], share)
    return model


def forward(model: Model, tokens: list[np.ndarray]) -> np.ndarray:
    """The log10 likelihood of each sequence of classes, by the scaled forward recursion."""
    lens = np.array([len(t) for t in tokens])
    flat = np.concatenate(tokens)
    which, number, begin, sizes = stretches(np.cumsum(lens) - lens, lens)
    before, _ = limits(model, flat, which, number, begin, sizes)
    into = np.where((number == 0)[:, None], model.start, before @ model.move)
    out = np.zeros(len(tokens))
    for part in in_parts(np.arange(len(which)), sizes):
        steps = Steps(flat, begin[part], sizes[part])
        _, _, scale = steps.ahead(model, into[part])
        of = which[part][steps.order]
        np.add.at(out, np.concatenate([of[:n] for n in steps.active]), np.log10(scale))
    return out


def _score(model: Model, within: np.ndarray, total: int, distinct: int):
    """within: the smoothed count of each class, that a word's smoothed count is a part of."""
    base = np.log10(total + 0.5 * (distinct + 1))

    def run(texts: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        size = int(words["lid"].max()) + 1 if len(words) else 0
        count, cls = np.zeros(size), np.zeros(size, np.int64)
        count[words["lid"].to_numpy()] = words["total"].to_numpy()
        cls[words["lid"].to_numpy()] = words["cls"].to_numpy()
        own = np.log10(count + 0.5)
        in_class = own - np.log10(within[cls])
        in_class[cls == CLASSES] = 0
        rows = [numbers(t) for t in texts["tokens"]]
        return pd.DataFrame({
            "doc_id": texts["doc_id"], "held_out": texts["held_out"], "n_tokens": [len(r) for r in rows],
            "n_known": [int((count[r] > 0).sum()) for r in rows], "train_tokens": total,
            "base_score": [float(own[r].sum()) - len(r) * base for r in rows],
            "score": forward(model, [cls[r] for r in rows]) + [float(in_class[r].sum()) for r in rows]})

    return run


def scores(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, a row per row of docs.

    Tokens are words with A-Z in lower case, then one end. A text is held out if crc32 of its doc_id as text is 1
    modulo 5. base_score is the log10 probability under smoothed counts of training tokens, score that of the hidden
    Markov model. A null text is empty; a null doc_id counts as an empty text for the fold and stays null; repeated
    rows count each time. Without rows the result is empty."""
    coded = table(docs.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(
        _encode, "chunk long, is_word boolean, doc_id long, held_out boolean, tokens binary, word string, lid int, cls int, n long"), "coded")
    words = coded.where("is_word").select("chunk", "word", "lid", "cls", "n")
    counts = table(words.groupBy("word").agg(F.sum("n").alias("total"), F.first("cls").alias("cls"), F.count("*").alias("chunks")), "counts")
    seen = counts.where("total > 0").groupBy("cls").agg(F.sum("total").alias("c"), F.count("*").alias("v")).toPandas()
    by_class = np.zeros((CLASSES + 1, 2), np.int64)
    by_class[seen["cls"].to_numpy(int)] = seen[["c", "v"]].to_numpy()
    total, distinct = (int(x) for x in by_class.sum(0))
    within = by_class[:, 0] + 0.5 * (by_class[:, 1] + 1)
    learning = docs.where(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 != 1)
    model = train(learning, within / within.sum(), rounds)
    most = max(SPREAD, (counts.agg(F.sum("chunks")).first()[0] or 0) // COMMON)
    keys = F.ceil(F.col("chunks") / most).cast("int")
    common = F.broadcast(counts.where(F.col("chunks") > most).select("word", keys.alias("keys")))  # fewer than COMMON
    asked = words.select("chunk", "word", "lid", "cls").join(common, "word", "left").withColumn(
        "key", F.pmod(F.xxhash64("chunk"), F.coalesce("keys", F.lit(1)).cast("long")).cast("int"))
    told = counts.select("word", "total", F.explode(F.sequence(F.lit(0), keys - 1)).alias("key"))
    counted = asked.join(told, ["word", "key"]).select(F.col("chunk").alias("of"), "lid", "cls", "total")
    texts = coded.where("not is_word").select("chunk", "doc_id", "held_out", "tokens")
    return texts.groupBy("chunk").cogroup(counted.groupBy("of")).applyInPandas(
        _score(model, within, total, distinct),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op7_hmm(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def hmm_counts(spark, sf_dir: str) -> DataFrame:
    """What op7_hmm counts, without the model's score, which SQL can't express."""
    return op7_hmm(spark, sf_dir).drop("score").withColumn("base_score", F.round("base_score", 4))
