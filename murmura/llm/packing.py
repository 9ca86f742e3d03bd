"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Class k takes lengths in (capacity / (k+1), capacity / k], and each of its bins exactly k pieces. Workers fill the bins
of their own rows, without a shuffle. Documents may be cut: whole sequences go off first, and a rest that would leave
more than capacity / SLACK unused in its class gives up a piece of capacity // (k+1), which fits the next class. What
stays in open bins at a worker's end is joined into full sequences and then sequences of powers of two, so at most
capacity tokens of a worker are not in full ones.
"""
from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm._text import tidy

CAPACITY = 4096
END = 2
#: A class's bin may leave capacity / SLACK unused.
SLACK = 128
#: Words that a worker remembers the ids of, and the longest word that stays.
_CACHE, _LONG = 1_200_000, 48


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Latin letters in UTF-8 up to U+024F but the dotted capital I, which becomes two characters in lower case; then ASCII punctuation but the apostrophe.
_LETTERS = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])+)([!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]*)")


class _Known(dict):
    """Ids by word; remembers which words it was asked for in vain."""

    def __init__(self) -> None:
        super().__init__()
        self.missed: list[bytes] = []

    def __missing__(self, word: bytes) -> None:
        self.missed.append(word)
        self[word] = None


class WordTokenizer:
    """A tokenizer that lowers case and whose pieces never cross white space, or letters and punctuation.

    Ids of words are remembered. Words of letters are encoded together: each ends with an id that ends a word."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = _Known()
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def letters(self, words: list[bytes]) -> list[bytes]:
        """The ids of words that are letters below U+0250 only: one piece each."""
        out: list[bytes] = []
        for a in range(0, len(words), 2048):
            part = words[a : a + 2048]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
            cut = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(cut) != len(part):
                out += self.whole([w.decode() for w in part])
                continue
            raw = ids.tobytes()
            ends = cut.tolist()
            out += [raw[i:j] for i, j in zip([0, *ends[:-1]], ends)]
        return out

    def learn(self, new: list[bytes]) -> None:
        """Adds words to the known ones: letters together, what else there is one by one."""
        known = self.known
        plain, other, parts = [], {}, []
        for w in new:
            m = _LETTERS.fullmatch(w)
            if m is None:
                other[w] = None
            elif m.end(1) == len(w):
                plain.append(w)
            else:
                stem, end = m.groups()
                parts.append((w, stem, end))
                if known.get(stem) is None:
                    plain.append(stem)
                other[end] = None
        ids = dict(zip(plain, self.letters(plain)))
        rest = list(other)
        for a in range(0, len(rest), 4096):
            ids.update(zip(rest[a : a + 4096], self.whole([w.decode() for w in rest[a : a + 4096]])))
        for w, stem, end in parts:
            known[w] = (known.get(stem) or ids[stem]) + ids[end]
        for w in new:
            if known[w] is None:
                known[w] = ids[w]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        # A special token's name counts only as it is written, so such texts keep their case.
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        if len(self.known) > _CACHE:
            self.known.clear()
        known = self.known
        found = [list(map(known.__getitem__, words)) for words in split]
        new, known.missed = known.missed, []
        self.learn(new)
        for words, ids in zip(split, found):
            for i in [i for i, x in enumerate(ids) if x is None]:
                ids[i] = known[words[i]]
        out = list(map(b"".join, found))
        for w in new:
            if len(w) > _LONG:
                del known[w]
        return out


@functools.cache
def word_tokenizer(path: str) -> WordTokenizer:
    """One for all tasks of a worker."""
    return WordTokenizer(path)


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Class and length of each piece of a document of n tokens, in order."""
    out = [(1, capacity)] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if (capacity - k * rest) * SLACK <= capacity or rest * 64 < capacity:
            out.append((k, rest))
            break
        piece = capacity // (k + 1)
        out.append((k + 1, piece))
        rest -= piece
    return out


class Packer:
    """The open bins of one worker. A piece: doc_id, start, its ids, the document's tokens."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.open, self.rows = capacity, {}, []
        self.next = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        start = 0
        for k, length in cuts(len(ids), self.capacity):
            piece = (doc_id, start, ids[start : start + length], len(ids))
            start += length
            held = self.open.setdefault(k, [])
            held.append(piece)
            if len(held) == k:
                self.close(self.open.pop(k))

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, n in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids), n, self.next, offset, ids))
            offset += len(ids)
        self.next += 1

    def finish(self) -> None:
        """Joins what is left, cutting at the ends of sequences."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        total = sum(len(p[2]) for p in left)
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in reversed(range(self.capacity.bit_length())) if total % self.capacity >> b & 1]
        held, at = left[::-1], 0
        for size in sizes:
            pieces, room = [], size
            while room:
                doc_id, start, ids, n = held.pop()
                pieces.append((doc_id, start, ids[:room], n))
                if len(ids) > room:
                    held.append((doc_id, start + room, ids[room:], n))
                room -= len(pieces[-1][2])
            self.close(pieces)


def _pack(path: str, capacity: int, end: int | None, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        packer = Packer(capacity)

        def rows() -> pa.RecordBatch:
            cols = list(zip(*packer.rows)) or [[] for _ in range(8)]
            packer.rows = []
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            if with_ids:
                names.append("ids")
                arrays.append(pa.array([x.view(np.int32) for x in cols[7]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names)

        tail = b"" if end is None else np.array([end], "<u4").tobytes()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            if ids and not packer.next:
                packer.next = batch.column("part")[0].as_py() << 32
            for a in range(0, len(ids), 512):
                texts = [t or b"" for t in batch.column("text").slice(a, 512).cast(pa.binary()).to_pylist()]
                for doc_id, coded in zip(ids[a : a + 512], tokenizer.encode(texts)):
                    packer.add(doc_id, np.frombuffer(coded + tail, "<u4"))
                if len(packer.rows) > 10_000:
                    yield rows()
        packer.finish()
        yield rows()

    return tidy(run)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int | None = END, with_ids: bool = True) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for.

    A document's ids are the tokenizer's, and `end`. Pieces of a sequence follow each other without gaps; sequence_id
    holds the number of the partition in its upper half. A null text is empty and packs as its end id alone; a null doc_id
    stays null; rows with the same doc_id are packed one by one. An empty table gives no rows. capacity must be a power of two."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(
        _pack(path or tokenizer_path(), capacity, end, with_ids), schema + (", ids array<int>" if with_ids else ""))


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
