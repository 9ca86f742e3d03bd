"""SentencePiece byte-pair encoding with seeded merge dropout, and decoding.

Merges are taken from an agenda by score, the leftmost of equals first. A candidate merge is skipped, once and for all,
if a hash keyed by seed, document, the chunk's number in it and the candidate's place is below the dropout rate; so each
occurrence of a chunk is segmented by itself, and reproducibly. No piece of the vocabulary has a space after another
character, or certain marks after a letter, so chunks that begin there are independent and are merged many at a time. What
is remembered of a chunk is its segmentation without dropout and the candidates on the way to it: it holds wherever none
of those is skipped, and the other occurrences are merged anew.

Characters without a piece become byte pieces, as does a literal U+2581 (which pieces use for a space): decoding gives
back every text exactly.
"""
from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from murmura.llm._text import mix, tidy

SEED, RATE = 20_240_229, 0.1
#: Chunks that a worker remembers, and the longest that it merges together with others.
_CACHE, _LONG = 1_500_000, 64
#: Chunks whose candidates are looked at together.
_TOGETHER = 100_000
_WIDTHS = (3, 5, 7, 9, 12, 16, 24, 40, _LONG)
_NONE = np.int32(2**31 - 1)
_C = np.uint64(0x9E3779B97F4A7C15)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class _Known(dict):
    """Ids by chunk and its mark; remembers what it was asked for in vain."""

    def __init__(self) -> None:
        super().__init__()
        self.missed: list[str] = []

    def __missing__(self, key: str) -> None:
        self.missed.append(key)
        self[key] = None


class _Plain(dict):
    """Numbers of chunks, with their ids without dropout and the hashed candidates on the way; 0 is any long chunk."""

    def __init__(self) -> None:
        super().__init__()
        self.missed: list[str] = []
        self.ids: list[bytes] = [b""]
        self.begin = np.zeros(1 << 12, np.int64)
        self.hashes = np.empty(1 << 14, np.uint64)

    def __missing__(self, key: str) -> int:
        if len(key) > _LONG:
            return 0
        self.missed.append(key)
        self[key] = n = len(self) + 1
        return n

    def add(self, ids: list[bytes], counts: np.ndarray, hashes: np.ndarray) -> None:
        """What the chunks asked for in vain have, in their order."""
        n, at = len(self.ids), int(self.begin[len(self.ids)])
        while n + len(ids) >= len(self.begin):
            self.begin = np.concatenate((self.begin, np.zeros_like(self.begin)))
        while at + len(hashes) > len(self.hashes):
            self.hashes = np.concatenate((self.hashes, np.empty_like(self.hashes)))
        self.hashes[at : at + len(hashes)] = hashes
        self.begin[n + 1 : n + 1 + len(ids)] = at + np.cumsum(counts)
        self.ids += ids


class MergeDropout:
    """A model with a seed and a rate. Rate 0 gives the model's own encoding."""

    def __init__(self, path: str, seed: int = SEED, rate: float = RATE) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        self.byte = np.zeros(256, np.int32)
        self.raw: list[bytes] = [b""] * n
        own: dict[str, int] = {}
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                b = int(p[1:-1], 16)
                self.byte[b] = i
                self.raw[i] = bytes([b])
            elif not special[i]:
                own[p] = i
                self.raw[i] = p.replace("▁", " ").encode()
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in own.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.char[0x20] = self.char[0x2581]
        self.char[0x2581] = -1
        if any("▁" in p.lstrip("▁") for p in own) or any("\n" in p for p in own):
            raise ValueError("a piece joins what chunks part")
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in own.values()}, reverse=True))}
        self.rank = np.full(n, _NONE, np.int32)
        for i in own.values():
            self.rank[i] = order[sp.get_score(i)]
        pairs = {}
        for p, i in own.items():
            for k in range(1, len(p)):
                a, b = own.get(p[:k]), own.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * n + b] = i
        self.n, self.pairs = n, pairs
        bits = max(10, (4 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slot_key = np.full(1 << bits, -1, np.int64)
        self.slot_id = np.full(1 << bits, -1, np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        ids = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(keys)
        while len(keys):
            free = self.slot_key[slot] == -1
            self.slot_key[slot[free]] = keys[free]
            placed = self.slot_key[slot] == keys
            self.slot_id[slot[placed]] = ids[placed]
            keys, ids, slot = keys[~placed], ids[~placed], (slot[~placed] + 1) & (len(self.slot_key) - 1)
        self.seed = np.uint64(seed)
        self.limit = int(rate * 2**64) if rate < 1 else 2**64 - 1
        self.known, self.plain = _Known(), _Plain()
        self.noted: list[tuple] | None = None  # candidates, while they are noted and none is skipped
        # Marks that no piece has after a letter: there a chunk may end and another begin.
        letter = re.compile(r"[^\W\d_]").fullmatch
        marks = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") - {y for p in own for x, y in zip(p, p[1:]) if letter(x)}
        m = "".join(map(re.escape, sorted(marks)))
        body = rf"[{m}]*[^ \n{m}]*(?:(?<![^\W\d_])[{m}]+[^ \n{m}]*)*"
        self.chunks = re.compile(rf"(?: +|\n|[{m}]){body}" if m else " +[^ \n]*|\n[^ \n]*").findall

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _C) >> self.shift).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that two symbols make, or -1."""
        out = np.full(len(a), -1, np.int32)
        at = np.flatnonzero((a >= 0) & (b >= 0))
        keys = a[at].astype(np.int64) * self.n + b[at]
        slot = self._slot(keys)
        while len(at):
            have = self.slot_key[slot]
            hit = have == keys
            out[at[hit]] = self.slot_id[slot[hit]]
            go = ~hit & (have != -1)
            at, keys, slot = at[go], keys[go], (slot[go] + 1) & (len(self.slot_key) - 1)
        return out

    def skipped(self, key: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether the candidate merge from begin to end of the chunk with that key is left out."""
        return mix(key + self._place(begin, end)) < np.uint64(self.limit)

    @staticmethod
    def _place(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((begin.astype(np.uint64) << np.uint64(32)) + end.astype(np.uint64))

    def _keys(self, keyed: list[str]) -> np.ndarray:
        """A hash of each chunk with its mark."""
        flat = np.frombuffer("".join(keyed).encode("utf-32-le"), np.uint32).astype(np.uint64)
        ends = np.cumsum([len(k) for k in keyed])
        begin = np.concatenate(([0], ends[:-1]))
        place = np.arange(len(flat)) - np.repeat(begin, ends - begin)
        return mix(np.add.reduceat(mix(flat + (place.astype(np.uint64) << np.uint64(24)) + self.seed), begin) ^ self.seed)

    def _merge(self, sym: np.ndarray, lens: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Merges rows of symbols (lens of each) in place as far as it goes; returns which places still begin a symbol.

        Symbols stay at the place of their first character, linked with the places of those before and after them."""
        n, width = sym.shape
        after = np.tile(np.arange(1, width + 1, dtype=np.int32), (n, 1))
        before = np.tile(np.arange(-1, width, dtype=np.int32), (n, 1))
        made = np.full((n, width), -1, np.int32)
        best = np.full((n, width), _NONE, np.int32)
        begins = np.arange(width)[None] < lens[:, None]

        def offer(r: np.ndarray, c: np.ndarray, d: np.ndarray) -> None:
            """Puts the symbols at places c and d of rows r on the agenda, unless they make no piece or are skipped."""
            new = self.merged(sym[r, c], sym[r, d])
            some = np.flatnonzero(new >= 0)
            r, c, d, new = r[some], c[some], d[some], new[some]
            rank = self.rank[new]
            if (self.limit or self.noted is not None) and len(r):
                end = after[r, d]
                end = np.where(end >= lens[r], 1 << 20, end)  # the last one ends the chunk
                if self.noted is not None:
                    self.noted.append((key[r], self._place(c, end)))
                else:
                    rank[self.skipped(key[r], c, end)] = _NONE
            made[r, c], best[r, c] = new, rank

        r, c = np.nonzero(begins[:, 1:])
        offer(r, c, c + 1)
        rows = np.arange(n)
        while len(rows):
            j = best[rows].argmin(1)
            go = best[rows, j] < _NONE
            rows, j = rows[go], j[go]
            k = after[rows, j]
            end = after[rows, k]
            sym[rows, j] = made[rows, j]
            after[rows, j], before[rows, end] = end, j
            best[rows, j] = best[rows, k] = _NONE
            begins[rows, k] = False
            left = before[rows, j]
            best[rows[left >= 0], left[left >= 0]] = _NONE
            a, b = np.flatnonzero(left >= 0), np.flatnonzero(end < lens[rows])
            offer(np.concatenate((rows[a], rows[b])), np.concatenate((left[a], j[b])), np.concatenate((j[a], end[b])))
        return begins

    def _one(self, ids: list[int], key: np.ndarray) -> list[int]:
        """A long chunk by itself: the same agenda as a heap."""
        n = len(ids)
        sym, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= n:
                return
            made = self.pairs.get(sym[i] * self.n + sym[j], -1) if sym[i] >= 0 and sym[j] >= 0 else -1
            if made < 0:
                return
            end = after[j] if after[j] < n else 1 << 20
            if self.limit and self.skipped(key, np.array([i]), np.array([end]))[0]:
                return
            heapq.heappush(agenda, (int(self.rank[made]), i, j, sym[i], sym[j], made))

        for i in range(n - 1):
            offer(i)
        dead = [False] * n
        while agenda:
            _, i, j, a, b, made = heapq.heappop(agenda)
            if dead[i] or dead[j] or sym[i] != a or sym[j] != b or after[i] != j:
                continue
            sym[i] = made
            dead[j] = True
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        out, i = [], 0
        while i < n:
            out.append(i)
            i = after[i]
        return [(sym[i], i) for i in out]

    def _ids(self, symbols: list[int], chunk: str, starts: list[int] | None) -> bytes:
        """Ids with byte pieces in place of characters that have none (-1)."""
        if -1 not in symbols:
            return np.array(symbols, np.int32).tobytes()
        # a symbol without a piece is one character; pieces say how many they are
        out, at = [], 0
        for s in symbols:
            if s == -1:
                out += self.byte[list(chunk[at].encode())].tolist()
                at += 1
            else:
                out.append(s)
                at += len(self.raw[s].decode())
        return np.array(out, np.int32).tobytes()

    def _segment(self, part: list[str], keys: np.ndarray) -> list[bytes]:
        """The ids of chunks with a mark at their end, which is not read."""
        out: list[bytes] = [b""] * len(part)
        sizes = np.array([len(k) - 1 for k in part])
        flat = self.char[np.frombuffer("".join(part).encode("utf-32-le"), np.uint32)]
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
        low = 0
        for width in _WIDTHS:
            which = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            for b in range(0, len(which), 20_000):
                w = which[b : b + 20_000]
                cols = np.arange(width)
                inside = cols[None] < sizes[w][:, None]
                sym = np.where(inside, flat[np.minimum(begin[w][:, None] + cols, len(flat) - 1)], -2).astype(np.int32)
                begins = self._merge(sym, sizes[w], keys[w])
                strange = (begins & (sym == -1)).any(1)
                lens = begins.sum(1)
                ends = np.cumsum(lens) * 4
                raw = sym[begins].tobytes()
                for i, x, e, odd in zip(w.tolist(), (ends - lens * 4).tolist(), ends.tolist(), strange.tolist()):
                    out[i] = self._ids(np.frombuffer(raw[x:e], np.int32).tolist(), part[i], None) if odd else raw[x:e]
        for i in np.flatnonzero(sizes > _LONG):
            found = self._one(flat[begin[i] : begin[i] + sizes[i]].tolist(), keys[i : i + 1])
            out[i] = self._ids([s for s, _ in found], part[i], None)
        return out

    def learn(self, missed: list[str]) -> None:
        """Segments chunks; the last character of each is a mark."""
        for a in range(0, len(missed), 50_000):
            part = missed[a : a + 50_000]
            self.known.update(zip(part, self._segment(part, self._keys(part))))

    def _note(self) -> None:
        """Merges the chunks that are not known yet without dropout, and notes their candidates."""
        missed, self.plain.missed = self.plain.missed, []
        for a in range(0, len(missed), 50_000):
            part = [c + "\0" for c in missed[a : a + 50_000]]
            self.noted = [(np.empty(0, np.uint64), np.empty(0, np.uint64))]
            try:
                ids = self._segment(part, np.arange(len(part), dtype=np.uint64))
                rows, hashes = map(np.concatenate, zip(*self.noted))
            finally:
                self.noted = None
            rows = rows.astype(np.int64)
            self.plain.add(ids, np.bincount(rows, minlength=len(part)), hashes[np.argsort(rows, kind="stable")])

    def _vary(self, chunks: list[str], key: np.ndarray) -> list[bytes]:
        """The ids of occurrences of chunks, each with its key."""
        plain = self.plain
        number = np.fromiter(map(plain.__getitem__, chunks), np.int64, len(chunks))
        if plain.missed:
            self._note()
        first = plain.begin[number]
        count = plain.begin[number + 1] - first
        count[number == 0] = 0
        ends = np.cumsum(count)
        owner = np.repeat(np.arange(len(chunks)), count)
        at = np.arange(len(owner)) + np.repeat(first - (ends - count), count)
        anew = number == 0
        anew[owner[mix(key[owner] + plain.hashes[at]) < np.uint64(self.limit)]] = True
        out = list(map(plain.ids.__getitem__, number.tolist()))
        which = np.flatnonzero(anew)
        for i, ids in zip(which.tolist(), self._segment([chunks[i] + "\0" for i in which.tolist()], key[which]) if len(which) else []):
            out[i] = ids
        return out

    def encode(self, texts: list[str], keys: list[int]) -> list[bytes]:
        """The ids of each text, as 32-bit numbers; a text's key and a chunk's number say which merges are skipped."""
        split = [self.chunks(" " + text) if text else [] for text in texts]
        if not self.limit:
            return self._undropped(split)
        # few texts of many chunks are looked at in parts, many of few together
        out: list[list[bytes]] = [[] for _ in texts]
        held, own, n = [], [], 0
        for t, (chunks, key) in enumerate(zip(split, keys)):
            base = mix(np.array([key & (2**64 - 1)], np.uint64) + self.seed)
            for a in range(0, len(chunks), _TOGETHER):
                part = chunks[a : a + _TOGETHER]
                held.append((t, part))
                own.append(mix(np.arange(a, a + len(part), dtype=np.uint64) + base))
                n += len(part)
                if n >= _TOGETHER:
                    self._flush(held, own, out)
                    held, own, n = [], [], 0
        if held:
            self._flush(held, own, out)
        return list(map(b"".join, out))

    def _flush(self, held: list[tuple[int, list[str]]], own: list[np.ndarray], out: list[list[bytes]]) -> None:
        if len(self.plain) > _CACHE:
            self.plain = _Plain()
        made, a = self._vary([c for _, part in held for c in part], np.concatenate(own)), 0
        for t, part in held:
            out[t].append(b"".join(made[a : a + len(part)]))
            a += len(part)

    def _undropped(self, split: list[list[str]]) -> list[bytes]:
        """The model's own encoding."""
        if len(self.known) > _CACHE:
            self.known.clear()
        known, found = self.known, []
        split = [[c + "\0" for c in chunks] for chunks in split]
        for chunks in split:
            found.append(list(map(known.__getitem__, chunks)))
        missed, known.missed = known.missed, []
        self.learn(missed)
        for chunks, ids in zip(split, found):
            for i in [i for i, x in enumerate(ids) if x is None]:
                ids[i] = known[chunks[i]]
        out = list(map(b"".join, found))
        for k in missed:
            if len(k) > _LONG:
                del known[k]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of 32-bit ids."""
        return b"".join(map(self.raw.__getitem__, np.frombuffer(ids, np.int32).tolist()))[1:].decode()


@functools.cache
def encoder(path: str, seed: int, rate: float) -> MergeDropout:
    """One for all tasks of a worker."""
    return MergeDropout(path, seed, rate)


def _encode(path: str, seed: int, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, seed, rate)
        for batch in batches:
            for a in range(0, len(batch), 512):
                part = batch.slice(a, 512)
                texts = [t or "" for t in part.column("text").to_pylist()]
                keys = [0 if k is None else k for k in part.column("doc_id").to_pylist()]
                coded = coder.encode(texts, keys)
                sizes = np.concatenate(([0], np.cumsum([len(c) // 4 for c in coded]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.frombuffer(b"".join(coded), np.int32))),
                     pa.array(np.diff(sizes).astype(np.int64)), pa.array([coder.decode(c) == t for c, t in zip(coded, texts)])],
                    ["doc_id", "ids", "n_tokens", "lossless"])

    return tidy(run)


def encode(docs: DataFrame, path: str | None = None, seed: int = SEED, rate: float = RATE) -> DataFrame:
    """doc_id, ids, n_tokens, lossless (decoding gives the text back), a row per row of docs.

    A null or empty text has no ids; a null doc_id counts as 0 for the choice of merges and stays null; repeated rows
    are encoded alike. Other columns are ignored; an empty table gives no rows."""
    return docs.select("doc_id", "text").mapInArrow(
        _encode(path or model_path(), seed, rate), "doc_id long, ids array<int>, n_tokens long, lossless boolean")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, SEED, 0.0)
        for batch in batches:
            texts = [coder.decode(np.array(x or [], np.int32).tobytes()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tidy(run)


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of each row's ids."""
    return coded.select("doc_id", "ids").mapInArrow(_decode(path or model_path()), "doc_id long, text string")


def op2_merge_dropout(spark, sf_dir: str) -> DataFrame:
    """All documents with a tenth of the merges left out."""
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
