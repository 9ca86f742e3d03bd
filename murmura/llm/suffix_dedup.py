"""Removal of repeated byte strings by a hash-compared suffix sort.

Every byte covered by a string of `window` bytes that also starts earlier (in a document of smaller id, or earlier in
the same one) is removed; strings are judged on the input and never cross documents.

1. Windows are grouped by their anchor (the smallest k-gram hash in them), which only their content decides, so equal
   windows have equal anchors. One row per group of neighbouring windows goes to the shard of its anchor.
   Of equal groups that one worker holds only the first goes there, so what repeats often does not crowd a shard.
2. Groups whose whole content was seen before are removed as they are: within a worker the bytes are compared, between
   workers two independent 64-bit hashes and the length of the content. Only the first group of each content is left, and
   only where its anchor also stands in other content: these are the ends of repeats.
3. The texts of those groups meet in the anchor's shard. Their suffixes are mergesorted; two suffixes are compared by
   the length of their common extension, found by binary search over prefix polynomial hashes. Every two neighbours of
   the result are compared byte by byte; where a collision of hashes has put them in a wrong order, the windows at hand
   are sorted by their bytes. The first of equal windows stays.

An anchor with more than HOT contents is split: each of its windows goes to a shard of its own hash.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm._anchors import anchors, content_check
from murmura.llm._store import table
from murmura.llm._text import BYTE_VALUE, PrefixHash, _power, columns, mix, pieces, tidy

WINDOW = 100
#: Contents under one anchor that one task sorts together.
HOT = 20_000
#: Crowded anchors that are broadcast at most.
BROADCAST = 100_000
#: Bytes of one text whose windows are grouped at once; the windows of a longer text are grouped stretch by stretch.
STRETCH = 1 << 22
_BATCH = 1 << 20


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the size bytes at a and at b are equal, each size above 0."""
    out = np.empty(len(a), bool)
    for i in range(0, len(a), 20_000):
        n = size[i : i + 20_000]
        ends = np.cumsum(n)
        inner = np.arange(ends[-1]) - np.repeat(ends - n, n)
        alike = data[np.repeat(a[i : i + 20_000], n) + inner] == data[np.repeat(b[i : i + 20_000], n) + inner]
        out[i : i + 20_000] = np.logical_and.reduceat(alike, ends - n)
    return out


def _groups(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = columns(batch)
            ids = np.asarray(batch.column("doc_id"))
            for i, j in pieces(off):
                own, at = data[off[i] : off[j]], off[i : j + 1] - off[i]
                if len(at) > 2 or at[-1] <= STRETCH:
                    yield grouped(ids[i:j], own, at, 0)
                else:
                    for a in range(0, len(own) - window + 1, STRETCH):
                        part = own[a : a + STRETCH + window - 1]
                        yield grouped(ids[i:j], part, np.array([0, len(part)]), a)

    def grouped(ids: np.ndarray, data: np.ndarray, off: np.ndarray, begin: int) -> pa.RecordBatch:
        """The groups of the windows of texts, or of a stretch of one text that begins there."""
        row, lo, hi, key, whole = anchors(data, off, window, window // 2)
        at, size = off[row] + lo, hi - lo + window
        check = content_check(data, at, size)
        doc, lo = ids[row], lo + begin
        # Of groups with one content only the first needs its anchor's shard; the others are dealt evenly.
        order = np.lexsort((lo, doc, check, whole))
        new = np.ones(len(order), bool)
        new[1:] = (whole[order][1:] != whole[order][:-1]) | (check[order][1:] != check[order][:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else order
        first = np.empty_like(order)
        first[order] = order[head]
        known = (doc != doc[first]) | (lo != lo[first])
        again = np.flatnonzero(known)
        if len(again):
            known[again] = (size[again] == size[first[again]]) & _same_bytes(data, at[again], at[first[again]], np.minimum(size[again], size[first[again]]))
        key = np.where(known, mix(doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + lo.astype(np.uint64)).view(np.int64), key)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(lo.astype(np.int32)), pa.array((size - window).astype(np.int16)), pa.array(key), pa.array(whole), pa.array(check), pa.array(known)],
            ["doc_id", "lo", "more", "anchor", "content", "check", "known"])

    return tidy(run)


@tidy
def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by anchor, content, check, more, doc_id, lo: which groups repeat whole ones, which may repeat in part.

    Keeps a row for each content of the anchor at hand only while it is its first; memory doesn't follow the group."""
    last_anchor = last_content = None
    first = None  # the first row of the content at hand
    lone = None  # the first content of an anchor, sent on once there is a second
    for batch in batches:
        n = len(batch)
        sure = np.asarray(batch.column("known").cast(pa.int8())).astype(bool)
        if sure.any():
            own = batch.filter(pa.array(sure))
            yield pa.RecordBatch.from_arrays(
                [own.column("doc_id"), own.column("lo"), own.column("more"), pa.array(np.zeros(len(own), bool)), own.column("anchor")], ["doc_id", "lo", "more", "edge", "anchor"])
            batch = batch.filter(pa.array(~sure))
            n = len(batch)
        if not n:
            continue
        anchor, content, check, doc, lo, more = (np.asarray(batch.column(c)) for c in ("anchor", "content", "check", "doc_id", "lo", "more"))
        new_anchor = np.concatenate(([anchor[0] != last_anchor], anchor[1:] != anchor[:-1]))
        new = new_anchor | np.concatenate((
            [(content[0], check[0], more[0]) != last_content], (content[1:] != content[:-1]) | (check[1:] != check[:-1]) | (more[1:] != more[:-1])))
        head = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        hd, hl = doc[head], lo[head]
        if not new[0]:
            hd[head < 0], hl[head < 0] = first
        covered = (doc != hd) | (lo != hl)
        # The first row of a content is an edge if its anchor has another content before or after it.
        at = np.flatnonzero(new)
        edge = np.zeros(n, bool)
        extra = None
        if len(at):
            starts = new_anchor[at]
            edge[at[~starts]] = True
            edge[at[:-1][starts[:-1] & ~starts[1:]]] = True
            if not starts[0]:
                extra = lone
            lone = (doc[at[-1]], lo[at[-1]], more[at[-1]], anchor[at[-1]]) if starts[-1] else None
        last_anchor, last_content = anchor[-1], (content[-1], check[-1], more[-1])
        first = (hd[-1], hl[-1])
        keep = covered | edge
        cols = [doc[keep], lo[keep].astype(np.int32), more[keep].astype(np.int16), edge[keep], anchor[keep]]
        if extra is not None:
            cols = [np.append(c, np.array([x], c.dtype)) for c, x in zip(cols, (*extra[:3], True, extra[3]))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["doc_id", "lo", "more", "edge", "anchor"])


def _contexts(window: int):
    """The bytes under each group, for its anchor's shard; those of a hot anchor window by window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = columns(batch)
            base, doc = off[:-1], np.asarray(batch.column("doc_id"))
            lists = batch.column("groups")
            at = np.asarray(lists.offsets)
            rows = np.repeat(np.arange(len(batch)), np.diff(at))
            own = lists.values.slice(at[0], at[-1] - at[0])
            lo, more, anchor = (np.asarray(own.field(c)) for c in ("lo", "more", "anchor"))
            hot = np.asarray(own.field("hot").cast(pa.int8())).astype(bool)
            cold = np.flatnonzero(~hot)
            out = [(rows[cold], lo[cold].astype(np.int64), more[cold].astype(np.int64), anchor[cold])]
            if hot.any():
                which = np.flatnonzero(hot)
                times = more[which].astype(np.int64) + 1
                r = np.repeat(rows[which], times)
                p = np.repeat(lo[which].astype(np.int64), times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                out.append((r, p, np.zeros(len(r), np.int64), None))
            for r, p, m, key in out:
                for a in range(0, len(r), 20_000):
                    rr, pp, mm = r[a : a + 20_000], p[a : a + 20_000], m[a : a + 20_000]
                    size = mm + window
                    ends = np.concatenate(([0], np.cumsum(size)))
                    take = np.repeat(base[rr] + pp - ends[:-1], size) + np.arange(ends[-1])
                    flat = data[take]
                    raw = pa.Array.from_buffers(pa.binary(), len(rr), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat.tobytes())])
                    shard = key[a : a + 20_000] if key is not None else mix(
                        (BYTE_VALUE[flat].reshape(-1, window) * _power("base", window)).sum(1)).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard), pa.array(doc[rr]), pa.array(pp.astype(np.int32)), raw], ["shard", "doc_id", "lo", "bytes"])

    return tidy(run)


class SuffixOrder:
    """Suffixes of a buffer, compared over their first `most` bytes by prefix hashes."""

    def __init__(self, data: np.ndarray, most: int) -> None:
        self.data, self.most = data, most
        self.sums = PrefixHash(data).sums
        self.power = _power("base", len(data) + 1)

    def same(self, i: np.ndarray, j: np.ndarray, n) -> np.ndarray:
        return (self.sums[i + n] - self.sums[i]) * self.power[j] == (self.sums[j + n] - self.sums[j]) * self.power[i]

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The length of the common extension, at most `most`, by binary search."""
        out = np.full(len(i), self.most)
        differ = np.flatnonzero(~self.same(i, j, self.most))
        a, b = i[differ], j[differ]
        lo, hi = np.zeros(len(a), np.int64), np.full(len(a), self.most - 1)
        for _ in range(int(self.most).bit_length()):
            mid = (lo + hi + 1) >> 1
            ok = self.same(a, b, mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        out[differ] = lo
        return out

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        ext = self.extension(i, j)
        inside = ext < self.most
        ext = np.where(inside, ext, 0)
        return inside & (self.data[i + ext] < self.data[j + ext])

    def mergesort(self, pos: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """A stable sort of pos within each segment (equal neighbours in `segment`), all segments at once.

        Bottom up: where two runs merge, each suffix finds its rank in the other run by binary search."""
        n = len(pos)
        order = pos.copy()
        index = np.arange(n)
        start = np.concatenate(([0], np.flatnonzero(segment[1:] != segment[:-1]) + 1)) if n else index
        sizes = np.diff(np.append(start, n))
        s0, size = np.repeat(start, sizes), np.repeat(sizes, sizes)
        inner = index - s0
        tag = index.copy()
        run = 1
        while n and run < sizes.max():
            at = np.flatnonzero(size > run)
            block = inner[at] // run
            own = s0[at] + block * run
            left = block % 2 == 0
            other = np.where(left, own + run, own - run)
            end = np.minimum(other + run, s0[at] + size[at])
            lone = other >= s0[at] + size[at]
            lo, hi = np.where(lone, other, other), np.where(lone, other, end)
            for _ in range(int(run).bit_length() + 1):
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                mid = (lo[open_] + hi[open_]) >> 1
                x, y, l = order[at[open_]], order[mid], left[open_]
                # from the left run: those of the right that are less; from the right run: those of the left not greater
                below = np.where(l, self.less(y, x), ~self.less(x, y))
                lo[open_] = np.where(below, mid + 1, lo[open_])
                hi[open_] = np.where(below, hi[open_], mid)
            place = np.minimum(own, np.where(lone, own, other)) + (inner[at] - block * run) + (lo - other)
            after, tags = order.copy(), tag.copy()
            after[place], tags[place] = order[at], tag[at]
            order, tag = after, tags
            run *= 2
        return tag


def repeated_windows(data: np.ndarray, ends: np.ndarray, shard: np.ndarray, window: int) -> np.ndarray:
    """Contexts in order of document and start, texts data[ends[i]:ends[i+1]]: True for each window that an earlier context of its shard has.

    Windows are numbered context by context."""
    count = np.diff(ends) - window + 1
    ctx = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(ctx)) - np.repeat(np.cumsum(count) - count, count)
    pos = ends[:-1][ctx] + offset
    # Windows can only be equal with equal anchors, in one shard; those with equal first bytes are sorted together.
    order = np.argsort(shard[ctx], kind="stable")
    sort = SuffixOrder(data, window)
    first = mix(PrefixHash(data).of(pos, pos + window // 2))[order]
    seg_order = np.lexsort((order, first, shard[ctx][order]))
    order, first = order[seg_order], first[seg_order]
    seg_key = shard[ctx][order]
    segment = np.cumsum(np.concatenate(([0], (seg_key[1:] != seg_key[:-1]) | (first[1:] != first[:-1])))) if len(order) else order
    tag = sort.mergesort(pos[order], segment)
    sorted_windows = order[tag]
    p, s = pos[sorted_windows], segment
    out = np.zeros(len(pos), bool)
    if len(p) < 2:
        return out
    views = np.lib.stride_tricks.sliding_window_view(data, window)
    inside = np.flatnonzero(s[1:] == s[:-1])
    for part in np.array_split(inside, max(1, len(inside) // 20_000)):
        differ = views[p[part]] != views[p[part + 1]]
        at = differ.argmax(1)
        equal = ~differ[np.arange(len(part)), at]
        if (~equal & (data[p[part] + at] > data[p[part + 1] + at])).any():
            return _by_bytes(views, pos, shard[ctx])
        out[sorted_windows[part[equal] + 1]] = True
    return out


def _by_bytes(views: np.ndarray, pos: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """The same without any hash, for windows whose hashes collide."""
    seen: set[tuple[int, bytes]] = set()
    out = np.zeros(len(pos), bool)
    for i, (at, own) in enumerate(zip(pos.tolist(), shard.tolist())):
        key = (own, views[at].tobytes())
        out[i] = key in seen
        seen.add(key)
    return out


def _resolve(window: int):
    """Over contexts sorted by shard, doc_id, lo: the windows that an earlier context has."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        shard, doc, lo = (np.concatenate([r[c] for r in rows]) for c in range(3))
        sizes = np.concatenate([r[3] for r in rows])
        data = np.concatenate([r[4] for r in rows])
        ends = np.concatenate(([0], np.cumsum(sizes)))
        gone = repeated_windows(data, ends, shard, window)
        count = sizes - window + 1
        ctx = np.repeat(np.arange(len(count)), count)
        start = lo[ctx] + np.arange(len(ctx)) - np.repeat(np.cumsum(count) - count, count)
        g = np.flatnonzero(gone)
        cut = np.flatnonzero((ctx[g][1:] != ctx[g][:-1]) | (g[1:] != g[:-1] + 1)) + 1
        a, b = (g[np.concatenate(([0], cut))], g[np.concatenate((cut - 1, [len(g) - 1]))]) if len(g) else (g, g)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[ctx[a]]), pa.array(start[a].astype(np.int32)), pa.array((start[b] - start[a]).astype(np.int32))], ["doc_id", "lo", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            shard, doc, lo = (np.asarray(batch.column(c)) for c in ("shard", "doc_id", "lo"))
            raw = batch.column("bytes").cast(pa.large_binary())
            off = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
            data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
            ends = np.concatenate((np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)])) if len(shard) else []
            a = 0
            for b in ends:
                if held and size > _BATCH and held[-1][0][-1] != shard[a]:
                    yield solve(held)
                    held, size = [], 0
                elif size > 16 * _BATCH:  # one window's many places: its first stands for those before
                    done = solve(held)
                    yield done
                    last = held[-1][0][-1]
                    f = next(h for h in held if h[0][-1] == last)
                    at = int(np.flatnonzero(f[0] == last)[0])
                    begin = int(f[3][:at].sum())
                    held = [(f[0][at : at + 1], f[1][at : at + 1], f[2][at : at + 1], f[3][at : at + 1], f[4][begin : begin + int(f[3][at])])]
                    size = int(f[3][at])
                held.append((shard[a:b], doc[a:b], lo[a:b].astype(np.int64), np.diff(off[a : b + 1]), data[off[a] : off[b]]))
                size += int(off[b] - off[a])
                a = b
        if held:
            yield solve(held)

    return tidy(run)


def _merge(lists: pa.ListArray, i: int, window: int, n: int) -> list[tuple[int, int]]:
    own = lists[i].values if lists[i].is_valid else None
    if own is None or not len(own):
        return []
    lo = np.asarray(own.field("lo")).astype(np.int64)
    hi = lo + np.asarray(own.field("more")) + window
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(np.minimum(hi[order], n))
    cut = np.flatnonzero(lo[1:] > hi[:-1]) + 1
    return list(zip(lo[np.concatenate(([0], cut))].tolist(), hi[np.concatenate((cut - 1, [len(lo) - 1]))].tolist()))


def _finish(window: int, names: list[str], whole: bool, ranges: str = "ranges"):
    """Adds removed spans to each row; with `whole`, replaces the text by what is kept (cut at characters only)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = columns(batch)
            lists = batch.column(ranges)
            spans, texts, chars, sizes, gone, sha = [], [], [], [], [], []
            for i in range(len(batch)):
                raw = data[off[i] : off[i + 1]]
                own = _merge(lists, i, window, len(raw))
                if whole:
                    lead = (raw & 0xC0) != 0x80
                    fixed = []
                    for a, b in own:
                        while a < len(raw) and not lead[a]:
                            a += 1
                        while b < len(raw) and not lead[b]:
                            b -= 1
                        if a < b:
                            fixed.append((a, b))
                    own = fixed
                kept, at = [], 0
                for a, b in own:
                    kept.append(raw[at:a].tobytes())
                    at = b
                kept.append(raw[at:].tobytes())
                rest = b"".join(kept)
                if whole:
                    texts.append(rest.decode())
                    chars.append(len(texts[-1]))
                else:
                    sizes.append(len(raw))
                    gone.append(len(raw) - len(rest))
                    spans.append([{"start": a, "end": b} for a, b in own])
                    sha.append(hashlib.sha256(rest).hexdigest())
            if whole:
                null = batch.column("text").is_null()
                new = {"text": pa.array([None if z else t for t, z in zip(texts, null.to_pylist())], pa.string()), "n_chars": pa.array(chars, pa.int64())}
                yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) if c in names else batch.column(c) for c in names], names)
            else:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(sha, pa.string())],
                    ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256"])

    return tidy(run)


def repeats(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """doc_id, lo, more: windows lo..lo+more (from the start of the UTF-8 text) of that document start earlier elsewhere.

    Rows with the same doc_id are one document. A null doc_id takes no part; a null text is empty."""
    texts = docs.select("doc_id", "text").where("doc_id is not null")
    groups = texts.mapInArrow(_groups(window), "doc_id long, lo int, more short, anchor long, content long, check long, known boolean")
    judged = table(
        groups.repartition("anchor").sortWithinPartitions("anchor", "content", "check", "more", "doc_id", "lo")
        .mapInArrow(_judge, "doc_id long, lo int, more short, edge boolean, anchor long"), "repeats")
    edges = judged.where("edge")
    crowded = edges.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("anchor", F.lit(True).alias("hot"))
    # Few anchors are crowded as a rule; only a list of checked size is broadcast.
    edges = edges.join(F.broadcast(crowded) if crowded.limit(BROADCAST + 1).count() <= BROADCAST else crowded, "anchor", "left")
    marked = edges.groupBy("doc_id").agg(
        F.collect_list(F.struct("lo", "more", "anchor", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("groups"))
    contexts = texts.join(marked, "doc_id").mapInArrow(_contexts(window), "shard long, doc_id long, lo int, bytes binary")
    partly = contexts.repartition("shard").sortWithinPartitions("shard", "doc_id", "lo").mapInArrow(
        _resolve(window), "doc_id long, lo int, more int")
    return judged.where("not edge").select("doc_id", "lo", F.col("more").cast("int").alias("more")).unionByName(partly)


def _ranged(docs: DataFrame, window: int) -> tuple[DataFrame, str]:
    """docs with the ranges found in each, under a name that no column of docs has."""
    taken = {c.lower() for c in docs.columns}
    own, ranges = (next(f"{n}{i or ''}" for i in range(len(taken) + 1) if f"{n}{i or ''}" not in taken) for n in ("found_id", "ranges"))
    found = repeats(docs, window).groupBy(F.col("doc_id").alias(own)).agg(F.collect_list(F.struct("lo", "more")).alias(ranges))
    return docs.join(found, F.col("doc_id") == F.col(own), "left").drop(own), ranges


def removed_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal removed byte ranges), kept_sha256, a row per row of docs."""
    return _ranged(docs.select("doc_id", "text"), window)[0].mapInArrow(
        _finish(window, [], False), "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with repeated passages cut from text, and n_chars renewed; only whole characters are cut.

    A null text stays null. Other columns pass through, whatever their names."""
    rows, ranges = _ranged(docs, window)
    return rows.mapInArrow(_finish(window, docs.columns, True, ranges), docs.schema)


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes over all documents."""
    return removed_spans(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
