"""MinHash near-duplicates by an inverted join over signature coordinates.

Every text becomes the set of its k-word shingles and a signature of COORDS minima. Two sets of Jaccard likeness J
agree in a coordinate with probability J, so pairs above the threshold agree in at least MATCHES of them (the chance
to miss one is below 1e-5 for the thresholds in use). Texts are posted under coordinate-value pairs, but only under
the first COORDS - MATCHES + 1 coordinates: two signatures that agree in MATCHES coordinates agree in one of those
(the prefix). Within a posting list collisions are counted over whole signatures, and texts already connected are
skipped. What is left as a cluster of candidates is confirmed on the full shingle sets, so links are exact.

Texts with equal sets are collapsed to one class first. Neither posting lists nor clusters are expanded into pairs:
each sends on a star of links per connected part. A list above POSTED texts and a cluster above BLOCK classes are
dealt out as pairs of parts.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm._components import components
from murmura.llm._store import table
from murmura.llm._text import columns, mix, pieces, shingle_sets, tidy

COORDS = 64
#: Classes of a cluster that one task compares at most, besides as many again of another block; the blocks that a cluster
#: is cut into at least before they are that large; and the bytes of shingles that a block holds.
BLOCK, BLOCKS, BLOCK_BYTES = 2048, 16, 64 << 20
HOT_PARTS = 1000
#: Texts of a posting list that one task compares at most, besides as many again of another part of the list.
POSTED = 8192
#: Crowded coordinate values that are broadcast at most.
BROADCAST = 100_000

_SEEDS = mix(np.arange(1, 2 * COORDS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_MUL, _ADD = _SEEDS[:COORDS] | np.uint64(1), _SEEDS[COORDS:]


def matches(threshold: float) -> int:
    """Coordinates that must agree: 4.75 standard deviations below what is expected at the threshold."""
    return max(1, int(COORDS * threshold - 4.75 * (COORDS * threshold * (1 - threshold)) ** 0.5))


def signatures(shingles: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The minima of COORDS hash functions for each set; sets must not be empty."""
    out = np.empty((len(at) - 1, COORDS), np.uint32)
    for j in range(COORDS):
        out[:, j] = np.minimum.reduceat(((shingles * _MUL[j] + _ADD[j]) >> np.uint64(32)).astype(np.uint32), at[:-1])
    return out


def _sketch(k: int, posted: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = columns(batch)
            ids = batch.column("doc_id")
            for i, j in pieces(off):
                sh, at = shingle_sets(data[off[i] : off[j]], off[i : j + 1] - off[i], k)
                n = np.diff(at)
                some = np.flatnonzero(n)
                h1, h2 = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
                sig = np.zeros((len(n), COORDS), np.uint8)
                keys = np.zeros((len(some), posted), np.int64)
                if len(some):
                    starts = at[:-1][some]
                    h1[some] = np.add.reduceat(mix(sh), starts).view(np.int64)
                    h2[some] = np.add.reduceat(mix(sh ^ np.uint64(0x5851F42D4C957F2D)), starts).view(np.int64)
                    full = signatures(sh, np.append(starts, len(sh)))
                    sig[some] = full.astype(np.uint8)
                    keys = mix(full[:, :posted].astype(np.uint64) + (np.arange(1, posted + 1, dtype=np.uint64) << np.uint64(32))).view(np.int64)
                width = np.zeros(len(n) + 1, np.int32)
                width[1:][some] = posted
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(n), pa.array(h1), pa.array(h2),
                     pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.arange(0, COORDS * len(n) + 1, COORDS, dtype=np.int32)), pa.py_buffer(sig.tobytes())]),
                     pa.ListArray.from_arrays(pa.array(np.cumsum(width, dtype=np.int32)), pa.array(keys.ravel()))],
                    ["doc_id", "n_shingles", "h1", "h2", "sig", "keys"])

    return tidy(run)


def _stars(adjacent, n: int) -> np.ndarray:
    """For each of n items the first item of its connected part. adjacent(i, rest): which of rest are linked with i.

    Breadth first over what isn't reached yet: what is connected already is never compared again."""
    root = np.full(n, -1)
    rest = np.arange(n)
    while len(rest):
        seed, rest = rest[0], rest[1:]
        root[seed] = seed
        front = [seed]
        while front and len(rest):
            hit = adjacent(front.pop(), rest)
            new = rest[hit]
            root[new] = seed
            front.extend(new.tolist())
            rest = rest[~hit]
    return root


def _posting_links(least: int, percent: int):
    """Over rows sorted by key: a star of links for each part of a posting list that is connected by signatures.

    Texts whose numbers of shingles are too far apart for a link are told by these alone."""

    def groups(batches):
        held = []
        last = None
        for batch in batches:
            key = np.asarray(batch.column("key"))
            ids, sizes = np.asarray(batch.column("rep")), np.asarray(batch.column("n_shingles"))
            sig = batch.column("sig")
            flat = np.frombuffer(sig.buffers()[2], np.uint8)[sig.offset * COORDS :][: len(sig) * COORDS].reshape(-1, COORDS)
            cuts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)])) if len(key) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if last is not None and key[a] != last:
                    yield held
                    held = []
                held.append((ids[a:b], flat[a:b], sizes[a:b]))
                last = key[a]
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for held in groups(batches):
            if len(held) == 1 and len(held[0][0]) == 1:
                continue
            ids = np.concatenate([x[0] for x in held])
            sig, size = (np.concatenate([x[k] for x in held]) for k in (1, 2))

            def adjacent(i: int, rest: np.ndarray, sig=sig, size=size) -> np.ndarray:
                hit = (100 * size[rest] >= percent * size[i]) & (percent * size[rest] <= 100 * size[i])
                some = np.flatnonzero(hit)
                hit[some] = (sig[rest[some]] == sig[i]).sum(1) >= least
                return hit

            root = _stars(adjacent, len(ids))
            away = np.flatnonzero(root != np.arange(len(ids)))
            a.extend(ids[root[away]].tolist())
            b.extend(ids[away].tolist())
            if len(a) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return tidy(run)


def _with_sets(k: int):
    """Candidate texts to their shingle sets and signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = columns(batch)
            for i, j in pieces(off):
                sh, at = shingle_sets(data[off[i] : off[j]], off[i : j + 1] - off[i], k)
                rows = batch.slice(i, j - i)
                raw = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(at * 8), pa.py_buffer(sh.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("cluster"), rows.column("node"), rows.column("x"), rows.column("y"), rows.column("mine"), raw.cast(pa.binary())],
                    ["cluster", "node", "x", "y", "mine", "shingles"])

    return tidy(run)


def _confirm(least: int, percent: int):
    """Links on full sets within a cluster, or between two of its blocks."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", kind="stable")
        ids = pdf["node"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        sizes = np.array([len(x) for x in sets], np.int64)
        at = np.concatenate(([0], np.cumsum(sizes)))
        flat = np.concatenate(sets)
        sig = signatures(flat, at).astype(np.uint8)

        def adjacent(i: int, rest: np.ndarray) -> np.ndarray:
            hit = np.zeros(len(rest), bool)
            n = sizes[i]
            near = np.flatnonzero(
                (100 * np.minimum(n, sizes[rest]) >= percent * np.maximum(n, sizes[rest]))
                & ((sig[rest] == sig[i]).sum(1) >= least))
            own = sets[i]
            for part in np.array_split(near, max(1, len(near) // 256)):
                if len(part):
                    which = rest[part]
                    joined = np.concatenate([sets[w] for w in which])
                    pos = np.minimum(np.searchsorted(own, joined), n - 1)
                    common = np.add.reduceat((own[pos] == joined).astype(np.int64), np.concatenate(([0], np.cumsum(sizes[which])[:-1])))
                    hit[part] = 100 * common >= percent * (n + sizes[which] - common)
            return hit

        root = _stars(adjacent, len(ids))
        away = np.flatnonzero(root != np.arange(len(ids)))
        return pd.DataFrame({"a": ids[root[away]], "b": ids[away]})

    return run


def sketches(docs: DataFrame, k: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, h1, h2 (the set's 128-bit hash), sig, keys."""
    posted = COORDS - matches(threshold) + 1
    return docs.select("doc_id", "text").mapInArrow(
        _sketch(k, posted), "doc_id long, n_shingles long, h1 long, h2 long, sig binary, keys array<long>")


def _dealt(posts: DataFrame, most: int | None = None) -> DataFrame:
    """posts(rep, n_shingles, sig, key) with the lists of crowded keys dealt out as pairs of parts, so that every pair of texts still meets."""
    most = most or POSTED
    parts = F.ceil(F.col("n") / most).cast("int")
    crowded = posts.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most).select("key", parts.alias("parts"))
    known = F.broadcast(crowded) if crowded.limit(BROADCAST + 1).count() <= BROADCAST else crowded
    mine = F.pmod(F.xxhash64("rep"), F.col("parts").cast("long")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.xxhash64("key", F.least(mine, other), F.greatest(mine, other)))
    keys = F.when(F.col("parts").isNull(), F.array("key")).otherwise(pairs)
    return posts.join(known, "key", "left").select("rep", "n_shingles", "sig", F.explode(keys).alias("key"))


def near_duplicates(docs: DataFrame, k: int = 5, threshold: float = 0.8, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id), a row per row of docs.

    Links texts whose sets of distinct k-word shingles have a Jaccard likeness of the threshold (a whole number of
    hundredths) or more. A null, empty or blank text has an empty set, is linked with nothing and is its own
    component. A null doc_id takes no part: its component_id is null, and it is kept. Rows with the same doc_id are
    one document. Other columns are ignored.
    """
    spark = docs.sparkSession
    least, percent = matches(threshold), round(100 * threshold)
    sketched = table(sketches(docs, k, threshold), "sketches")
    some = sketched.where("n_shingles > 0 and doc_id is not null")
    groups = some.groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"))
    # A class posts once, from its first row; the light join leaves the signatures where they were written.
    firsts = some.join(
        groups.select("h1", "h2", "n_shingles", F.col("rep").alias("doc_id")), ["h1", "h2", "n_shingles", "doc_id"], "left_semi"
    ).select(F.col("doc_id").alias("rep"), "n_shingles", "sig", "keys")
    posts = firsts.select("rep", "n_shingles", "sig", F.explode("keys").alias("key"))
    links = table(
        _dealt(posts).repartition("key").sortWithinPartitions("key", "rep")
        .mapInArrow(_posting_links(least, percent), "a long, b long").distinct(), "candidates")
    clusters = table(components(links), "clusters")
    sizes = clusters.join(groups.select(F.col("rep").alias("node"), "n_shingles"), "node").groupBy("label").agg(
        F.count("*").alias("size"), F.sum("n_shingles").alias("shingles"))
    most = F.least(F.lit(block), F.greatest(F.lit(block // 4 + 1), F.col("size") / BLOCKS))
    blocks = F.ceil(F.greatest(F.col("size") / most, 8 * F.col("shingles") / BLOCK_BYTES)).cast("int")
    dealt = clusters.join(sizes, "label").select(
        "node", F.col("label").alias("cluster"), blocks.alias("nb"), F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int").alias("mine"))
    dealt = dealt.select(
        "node", "cluster", "mine",
        F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
    dealt = dealt.select("node", "cluster", "mine", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"))
    texts = docs.select(F.col("doc_id").alias("node"), "text").where("node is not null")
    candidates = texts.join(dealt, "node").mapInArrow(
        _with_sets(k), "cluster long, node long, x int, y int, mine int, shingles binary").where("octet_length(shingles) > 0")
    confirmed = table(
        candidates.groupBy("cluster", "x", "y").applyInPandas(_confirm(least, percent), "a long, b long").distinct(), "links")
    labels = components(confirmed)
    classes = groups.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left").select(
        "h1", "h2", "n_shingles", F.coalesce("label", "rep").alias("component"), "rows")
    return _labelled(sketched, classes)


def _labelled(sketched: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows with their class's component. Classes above a part in HOT_PARTS of the rows, so fewer than HOT_PARTS classes, are broadcast."""
    keys = ["h1", "h2", "n_shingles"]
    light = sketched.select("doc_id", *keys)
    limit = light.count() / HOT_PARTS
    hot = F.broadcast(classes.where(F.col("rows") > limit).drop("rows"))
    found = light.join(hot, keys).unionByName(
        light.join(hot.select(*keys), keys, "left_anti").join(classes.where(F.col("rows") <= limit).drop("rows"), keys, "left"))
    component: Column = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op10_minhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicates of all documents on 3-word shingles at a likeness of 0.85."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=3, threshold=0.85)
