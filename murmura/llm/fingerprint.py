"""Document fingerprints from statistically improbable features.

Every window of WIDTH bytes gets an entropy and, from it, a rank by rarity: the farther its entropy is from what
prose has, the lower the rank. In each run of WIDTH neighbouring windows the lowest rank wins (the leftmost of equals);
windows that win VOTES runs or more are the features. They go, in order, into a chain of Bloom filters of BITS bits with
at most LOAD features each. Likeness is the overlap of set bits beyond what chance gives, as a part of what was possible,
averaged over the filters of the shorter chain.
"""
from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm._anchors import sliding_min
from murmura.llm._text import PrefixHash, columns, mix, pieces, tidy

WIDTH, VOTES, BITS, LOAD, HASHES = 64, 16, 2048, 160, 5
#: Entropy of a window in thousandths of its maximum: what is common in prose, its spread, and below which windows are no features.
COMMON, SPREAD, LEAST = 620, 40, 100

_UNIT = 1 << 16
_C = np.arange(WIDTH + 1)
_CLOGC = np.rint(_C * np.log2(np.maximum(_C, 1)) * _UNIT).astype(np.int64)
_STEP = np.concatenate(([0], np.diff(_CLOGC)))
_FULL = int(_CLOGC[WIDTH])
_E = np.arange(1001)
_RANK = np.where(_E < LEAST, 2047, np.rint(1000 * np.exp(-(((_E - COMMON) / SPREAD) ** 2) / 2))).astype(np.int64)
_NONE = 2047


def entropies(data: np.ndarray) -> np.ndarray:
    """The entropy of each window, in thousandths of its maximum; windows share their sums with their neighbours."""
    n = len(data)
    ahead, behind = np.ones(n, np.uint8), np.ones(n, np.uint8)
    step = 1 << 16
    for a in range(0, n, step):
        b = min(a + step, n)
        for k in range(1, WIDTH):
            stop = min(b, n - k)
            if stop > a:
                same = data[a:stop] == data[a + k : stop + k]
                ahead[a:stop] += same
                behind[a + k : stop + k] += same
    gained, lost = np.cumsum(_STEP[behind]), np.cumsum(_STEP[ahead])
    sums = gained[WIDTH - 1 :].copy()
    sums[1:] -= lost[: n - WIDTH]
    return (1000 * (_FULL - sums)) // _FULL


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text index and hash of each feature, in order; equal features of a text count once."""
    lens = np.diff(off)
    docs, hashes = [], []
    prefix = PrefixHash(data)
    short = np.flatnonzero((lens > 0) & (lens < WIDTH))
    docs.append(short)
    hashes.append(mix(prefix.of(off[short], off[short + 1]) + lens[short].astype(np.uint64)))
    long = np.flatnonzero(lens >= WIDTH)
    if len(long):
        n = len(data)
        ranks = n - WIDTH + 1
        valid = np.zeros(n + 1, np.int32)
        np.add.at(valid, off[long], 1)
        np.add.at(valid, off[long + 1] - WIDTH + 1, -1)
        valid = np.cumsum(valid)[:ranks] > 0
        rank = np.where(valid, _RANK[entropies(data)], _NONE)
        bits = max(1, int(n).bit_length())
        key = (rank << bits) | np.arange(ranks)
        # A run never looks beyond its text: what follows a text's windows are WIDTH - 1 windows without a rank.
        low = sliding_min(np.concatenate((key, np.full(WIDTH - 1, (_NONE << bits) | (n - 1)))), WIDTH)
        count = lens[long] - WIDTH + 1
        runs = np.maximum(count - WIDTH + 1, 1)
        begin = np.zeros(n + 1, np.int32)
        np.add.at(begin, off[long], 1)
        np.add.at(begin, off[long] + runs, -1)
        at = np.flatnonzero(np.cumsum(begin)[:ranks] > 0)
        won = low[at]
        pos, rank_won = won & ((1 << bits) - 1), won >> bits
        owner = np.searchsorted(off, at, side="right") - 1
        new = np.concatenate(([True], (pos[1:] != pos[:-1]) | (owner[1:] != owner[:-1])))
        first = np.flatnonzero(new)
        votes = np.diff(np.append(first, len(at)))
        lone = lens[owner[first]] < 2 * WIDTH - 1
        good = (rank_won[first] < _NONE) & ((votes >= VOTES) | lone)
        pos, owner = pos[first][good], owner[first][good]
        bare = np.setdiff1d(long, owner)  # nothing stands out: the first window speaks for the text
        docs += [owner, bare]
        hashes += [mix(prefix.of(pos, pos + WIDTH)), mix(prefix.of(off[bare], off[bare] + WIDTH))]
    doc, h = np.concatenate(docs), np.concatenate(hashes)
    order = np.argsort(doc, kind="stable")
    doc, h = doc[order], h[order]
    by = np.lexsort((np.arange(len(h)), h, doc))
    again = np.zeros(len(h), bool)
    again[by[1:]] = (h[by[1:]] == h[by[:-1]]) & (doc[by[1:]] == doc[by[:-1]])
    return doc[~again], h[~again]


def chains(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """A text's filters as rows of BITS / 64 words; none for an empty text."""
    doc, h = features(data, off)
    n = len(off) - 1
    count = np.bincount(doc, minlength=n)
    filters = -(-count // LOAD)
    base = np.concatenate(([0], np.cumsum(filters)))
    inner = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    row = base[doc] + inner // LOAD
    bits = np.zeros((base[-1], BITS), np.uint8)
    width = BITS.bit_length() - 1
    for k in range(HASHES):
        bits[row, ((h >> np.uint64(k * width)) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    packed = np.packbits(bits, axis=1).view(np.uint64)
    return [packed[base[i] : base[i + 1]] for i in range(n)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1; two chains without filters are alike, one is like no other."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    na, nb = np.bitwise_count(a).sum(1, dtype=np.int64), np.bitwise_count(b).sum(1, dtype=np.int64)
    total = 0.0
    for i in range(len(a)):
        common = np.bitwise_count(a[i] & b).sum(1, dtype=np.int64)
        chance = na[i] * nb / BITS
        most = np.minimum(na[i], nb)
        total += float(np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0, 1).max())
    return total / len(a)


def text_of(chain: np.ndarray) -> str:
    """The fingerprint as text: number of filters, then their bits."""
    return f"{len(chain)}:{base64.b64encode(chain.tobytes()).decode()}"


def chain_of(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text.partition(":")[2]), np.uint64).reshape(-1, BITS // 64)


def _chains(texts: list[bytes]) -> list[np.ndarray]:
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    data = np.frombuffer(b"".join(texts), np.uint8)
    out: list[np.ndarray] = []
    for i, j in pieces(off):
        out += chains(data[off[i] : off[j]], off[i : j + 1] - off[i])
    return out


@tidy
def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprint of each text."""
    for batch in batches:
        data, off = columns(batch)
        out: list[str] = []
        for i, j in pieces(off):
            out += map(text_of, chains(data[off[i] : off[j]], off[i : j + 1] - off[i]))
        keep = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out, pa.string())], [*keep, "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, a row per row of docs. A null text is empty; equal texts have equal fingerprints."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, "doc_id long, fingerprint string")


@tidy
def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over a partition's rows by descending id, the first row of the next one at their end."""
    carry: tuple | None = None
    for batch in batches:
        ids, texts, lent = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("lent").to_pylist()
        step, size, a = [], 0, 0
        for b in range(len(ids)):
            size += len(texts[b] or "")
            if size >= 1 << 19 or b == len(ids) - 1:
                step.append((a, b + 1))
                a, size = b + 1, 0
        for a, b in step:
            raw = [t or "" for t in texts[a:b]]
            own = _chains([t.encode() for t in raw])
            rows = ([carry] if carry else []) + list(zip(ids[a:b], raw, own, lent[a:b]))
            pairs = [(x, y) for x, y in zip(rows[:-1], rows[1:]) if not x[3]]
            carry = rows[-1]
            if not pairs:
                continue
            new = []
            for x, y in pairs:
                cut = len(x[1]) // 3
                new.append((x[1][: len(x[1]) - cut] + y[1][:cut]).encode())
            edited = _chains(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x, _ in pairs], pa.int64()), pa.array([len(x[1]) for x, _ in pairs], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in new]), pa.array([text_of(x[2]) for x, _ in pairs]),
                 pa.array(list(map(text_of, edited))), pa.array([likeness(x[2], e) for (x, _), e in zip(pairs, edited)]),
                 pa.array([likeness(x[2], y[2]) for x, y in pairs])],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """docs dealt to partitions by descending doc_id (null last), each sorted, with the next one's first row lent to it.

    The limits between partitions are ids of the table, so that the rows to lend are known before the shuffle."""
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    stats = docs.select(key.alias("k")).agg(
        F.max("k"), F.percentile_approx("k", [i / parts for i in range(1, parts)] or [0.5], 100 * parts)).first()
    limits = sorted({x for x in stats[1] or [] if x != stats[0]} if parts > 1 else set(), reverse=True)
    at = F.size(F.filter(F.lit(limits), lambda x: x >= F.col("k"))) if limits else F.lit(0)
    last = len(limits)
    rows = docs.select("doc_id", "text", key.alias("k")).withColumn("part", at)
    lends = F.when(F.col("k") == stats[0], F.lit(last)).when(F.lit(False) if not limits else F.col("k").isin(limits), F.col("part") - 1)
    rows = rows.withColumn("to", F.explode(F.array_compact(F.array(
        F.struct(F.col("part").alias("part"), F.lit(False).alias("lent")),
        F.when(lends.isNotNull(), F.struct(lends.alias("part"), F.lit(True).alias("lent")))))))
    return (
        rows.select("doc_id", "text", "k", F.col("to.part").alias("part"), F.col("to.lent").alias("lent"))
        .repartitionById(last + 1, F.col("part"))
        .sortWithinPartitions(F.col("lent"), F.col("k").desc(), "text"))


def fingerprints_of_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text has its last third of code points replaced by the start of the next document by descending
    doc_id (after the last, the first). Rows with the same doc_id follow each other by text; a null doc_id comes
    last; a null text is empty, and two empty texts are alike. An empty table gives no rows."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return with_next(docs, parts).select("doc_id", "text", "lent").mapInArrow(
        _edited, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints_of_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
