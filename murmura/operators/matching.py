"""All places of many terms in texts, by an Aho-Corasick automaton that travels with the tasks.

A lexicon of at most BROADCAST characters is one automaton, built once and broadcast; texts stay where they are. Of a larger
one, terms go to units of texts: a unit asks for the distinct beginnings of what its texts have, by keys of 32 bits, and gets
the terms that begin with one of them; what a key tells wrongly is only sent in vain. So a text is sent once, and a term once
for each unit that may have it. Texts, keys and terms travel packed.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.sources.scratch import table

#: Characters of a lexicon that are broadcast as one automaton (some 30 bytes each); an automaton of a unit, which one task has, may be so many times larger.
BROADCAST, AUTOMATA = 4_000_000, 3
#: Characters that are followed side by side, and texts of a piece at most.
STRIDE, TEXTS = 128, 100_000
#: Bytes of a unit of texts and of the pieces it is made of, and the units that a smaller table has.
UNIT, FINE, UNITS = 1 << 24, 1 << 20, 16
#: Tokens of the beginnings by which terms meet units: of a term, the most that it has. Characters of a shard of the lexicon, and sizes of terms that are looked up by hash.
LEVELS, SHARD, SIZES = [1, 2, 3, 4, 6, 8], 1 << 20, 32
#: Places of a table of all steps, by state and character, and bytes of texts that are followed at once.
STEPS, PIECE = 1 << 22, 1 << 21
_BITS = 21
_WORD = np.zeros(0x110001, bool)
_WORD[[*range(48, 58), *range(97, 123), 95]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of texts one after the other, each followed by 0x110000, and where each begins (and the last ends)."""
    array = pc.fill_null(texts, "").cast(pa.large_binary())
    off = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
    starts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[off - off[0]]
    at = starts + np.arange(len(starts))
    out = np.full(at[-1], 0x110000, np.int32)
    place = np.ones(len(out), bool)
    place[at[1:] - 1] = False
    out[place] = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.int32)
    return out, at


def pieces(sizes: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `most` bytes (PIECE); a longer row is a range of its own."""
    upto = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    i, most = 0, most or PIECE
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + most, side="right")) - 1)
        yield i, j
        i = j


def distinct(values: np.ndarray) -> np.ndarray:
    """Each value once, in order; by a sort, as np.unique() hashes first, which takes longer."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[: len(values)]]


def widths(texts: pa.Array) -> np.ndarray:
    """Bytes of each text, none of a null."""
    return np.asarray(pc.fill_null(pc.binary_length(texts), 0))


class Automaton:
    """Goto, failure and output links as arrays.

    Nodes are numbered by depth, then by parent and character, so an edge's key (parent and character) stands in order and
    its child is its place plus one."""

    def __init__(self, terms: list[str]) -> None:
        self.terms = terms
        text, at = points(pa.array(terms, pa.large_string()))
        size = np.diff(at) - 1
        self.size = size.astype(np.int32)
        self.longest = int(size.max(initial=0))
        node, keys, first = np.zeros(len(terms), np.int64), [], [0, 1]
        for d in range(self.longest):
            own = np.flatnonzero(size > d)
            key, child = np.unique(node[own] << _BITS | text[at[own] + d], return_inverse=True)
            node[own] = first[-1] + child
            keys.append(key)
            first.append(first[-1] + len(key))
        self.keys = np.concatenate([*keys, [np.iinfo(np.int64).max]]).astype(np.int64)
        nodes = first[-1]
        self.term = np.full(nodes, -1, np.int32)  # the first of equal terms
        self.term[node[::-1]] = np.arange(len(terms), dtype=np.int32)[::-1]
        self.fail, self.link = np.zeros(nodes, np.int32), np.zeros(nodes, np.int32)
        for d in range(self.longest):
            level = np.arange(first[d + 1], first[d + 2])
            if d:
                key = self.keys[level - 1]
                self.fail[level] = self._step(self.fail[key >> _BITS], key & ((1 << _BITS) - 1))
            self.link[level] = np.where(self.term[self.fail[level]] >= 0, self.fail[level], self.link[self.fail[level]])

    def _children(self) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """The characters' numbers, a bit for each character that a node goes on with, and its first child; None, if the terms have more than 64 characters. It doesn't travel."""
        if "children" not in self.__dict__:
            parent, char = self.keys[:-1] >> _BITS, self.keys[:-1] & ((1 << _BITS) - 1)
            chars = np.unique(char)
            self.children = None
            if len(chars) <= 64:
                number = np.full(0x110001, -1, np.int8)
                number[chars] = np.arange(len(chars))
                bits = np.zeros(len(self.fail), np.uint64)
                np.bitwise_or.at(bits, parent, np.uint64(1) << number[char].astype(np.uint64))
                self.children = number, bits, (np.searchsorted(parent, np.arange(len(self.fail))) + 1).astype(np.int32)
        return self.children

    def _walk(self, state: np.ndarray, number: np.ndarray) -> np.ndarray:
        """_step() by the numbers of characters, -1 for others: a node's children stand in their characters' order."""
        _, bits, first = self.children
        out, left = np.zeros(len(state), np.int32), np.flatnonzero(number >= 0)
        state, below = state[left], np.uint64(1) << number[left].astype(np.uint64)
        while len(left):
            own = bits[state]
            found = (own & below) != 0
            yes = state[found]
            out[left[found]] = first[yes] + np.bitwise_count(own[found] & (below[found] - np.uint64(1)))
            on = np.flatnonzero(~found & (state > 0))
            left, state, below = left[on], self.fail[state[on]], below[on]
        return out

    def _step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Where each state goes with its character."""
        out, left = np.zeros(len(state), np.int64), np.arange(len(state))
        state, char = state.astype(np.int64), char.astype(np.int64)
        while len(left):
            key = state << _BITS | char
            at = np.searchsorted(self.keys, key)
            found = self.keys[at] == key
            out[left[found]] = at[found] + 1
            on = ~found & (state > 0)
            left, state, char = left[on], self.fail[state[on]].astype(np.int64), char[on]
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("table", "children")}

    def _table(self) -> tuple[np.ndarray, np.ndarray, int] | None:
        """Where every state goes with every character of the terms (0: any other), one state after the other; the characters' numbers, and how many there are.

        None, if that is too large. It is made where it is used and doesn't travel."""
        if "table" not in self.__dict__:
            chars = np.unique(self.keys[:-1] & ((1 << _BITS) - 1))
            width, nodes = len(chars) + 1, len(self.fail)
            self.table = None
            if nodes * width <= STEPS:
                number = np.zeros(0x110001, np.int32)
                number[chars] = np.arange(1, width)
                parent, child = self.keys[:-1] >> _BITS, np.arange(1, nodes)
                to = np.zeros((nodes, width), np.int32)
                first, last = 0, 1
                while first < last:  # a level at a time
                    to[first:last] = to[self.fail[first:last]]
                    a, b = np.searchsorted(parent, (first, last))
                    to[parent[a:b], number[self.keys[a:b] & ((1 << _BITS) - 1)]] = child[a:b]
                    first, last = last, int(b) + 1
                self.table = to.ravel(), number, width
        return self.table

    def states(self, text: np.ndarray) -> np.ndarray:
        """The node of the longest beginning of a term that ends at each place.

        Parts of the text are followed side by side, each from as many characters before its begin as a term may have."""
        rows = -(-len(text) // STRIDE)
        state, states = np.zeros(rows, np.int64), np.zeros((STRIDE, rows), np.int32)
        begin = np.arange(rows) * STRIDE
        table = self._table()
        children = None if table else self._children()
        if table or children:
            number, none = (table[1], 0) if table else (children[0], -1)
            own = np.full(rows * STRIDE, none, number.dtype)
            own[: len(text)] = number[text]
            own = np.ascontiguousarray(own.reshape(rows, STRIDE).T)
        for t in range(-min(self.longest, len(text)), STRIDE):
            if not table and not children:
                at = begin + t
                inside = (at >= 0) & (at < len(text))
                char = np.where(inside, text[np.clip(at, 0, len(text) - 1)], 0x110000)
                state = self._step(state, char)
            else:
                back = -(t // STRIDE)  # parts before the own one
                char = own[t % STRIDE]
                char = char if not back else np.concatenate((np.full(min(back, rows), none, char.dtype), char[: max(0, rows - back)]))
                state = table[0][state * table[2] + char] if table else self._walk(state, char)
            if t >= 0:
                states[t] = state
        return states.T.ravel()[: len(text)]

    def ends(self, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Where terms end, and their numbers; in no order."""
        states = self.states(text)
        at = np.flatnonzero(states)
        node = states[at]
        node = np.where(self.term[node] >= 0, node, self.link[node])
        while (on := node > 0).any():
            node, at = node[on], at[on]
            yield at, self.term[node]
            node = self.link[node]

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every place of every term: where it begins, and its number; ordered by end, longer ones first."""
        found = list(self.ends(text))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        end, number = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((-self.size[number], end))
        return end[order] - self.size[number[order]] + 1, number[order]


def whole_words(text: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether no letter, digit or _ of ASCII goes on at either end of what is found, where it begins or ends with one."""
    last = begin + size - 1
    before = np.where(begin > 0, text[begin - 1], 0x110000)
    after = text[np.minimum(last + 1, len(text) - 1)]
    return ~(_WORD[text[begin]] & _WORD[before]) & ~(_WORD[text[last]] & _WORD[after])


def leftmost_longest(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which of the places are taken from left to right, the longest at each begin, without overlaps."""
    order = np.lexsort((-size, begin))
    order = order[np.concatenate(([True], begin[order][1:] != begin[order][:-1]))] if len(order) else order
    after = np.searchsorted(begin[order], begin[order] + size[order]).tolist()
    taken, i = [], 0
    while i < len(after):
        taken.append(i)
        i = after[i]
    return order[taken]


def _hits(known: Automaton, texts: pa.Array, longest: bool) -> tuple[np.ndarray, np.ndarray]:
    """The text and number of each distinct term, in order of their first places."""
    text, at = points(texts)
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    begin, number = known.find(text)
    if longest:
        ok = whole_words(text, begin, known.size[number])
        begin, number = begin[ok], number[ok]
        taken = leftmost_longest(begin, known.size[number])
        begin, number = begin[taken], number[taken]
    row = np.searchsorted(at, begin, side="right") - 1
    _, first = np.unique(row * (len(known.terms) + 1) + number, return_index=True)
    first.sort()
    return row[first], number[first]


def _local(known, column: str, name: str, longest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, carried = known.value
        terms = pa.array(automaton.terms, pa.string())
        for whole in batches:
            for i, j in pieces(widths(whole.column(column))):
                batch = whole.slice(i, j - i)
                row, number = _hits(automaton, batch.column(column), longest)
                out = batch.select([c for c in batch.schema.names if c != "__text"]).take(pa.array(row))
                more = [_one(carried, c).take(pa.array(number)) for c in carried.column_names]
                yield pa.RecordBatch.from_arrays([*out.columns, terms.take(pa.array(number)), *more], [*out.schema.names, name, *carried.column_names])

    return run


def _marked(known, column: str, name: str, longest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            found = np.zeros(whole.num_rows, bool)
            for i, j in pieces(widths(whole.column(column))):
                text, at = points(whole.column(column).slice(i, j - i))
                begin, number = known.value.find(text) if len(text) else (np.zeros(0, np.int64), np.zeros(0, np.int32))
                if longest and len(begin):  # a text with whole words has leftmost longest ones
                    begin = begin[whole_words(text, begin, known.value.size[number])]
                found[i + np.searchsorted(at, begin, side="right") - 1] = True
            out = whole.select([c for c in whole.schema.names if c != "__text"])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(found)], [*out.schema.names, name])

    return run


def _packed(made: pa.Table, column: str, encoding: str) -> bytes:
    """A table as the bytes of a Parquet file: rows that are shuffled or stored so take a fraction of their size."""
    out = pa.BufferOutputStream()
    pq.write_table(made, out, compression="zstd", compression_level=3, write_statistics=False, use_dictionary=[c for c in made.column_names if c != column], column_encoding={column: encoding})
    return out.getvalue().to_pybytes()


def _unpacked(blob: pa.BinaryScalar) -> pa.Table:
    return pq.ParquetFile(pa.BufferReader(blob.as_buffer())).read(use_threads=False)


def _pieces(column: str, part: str, size: int, texts: int):
    """part, piece, bytes, rows: a partition's rows one after the other, packed in pieces of some size bytes and at most so many texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, piece, held, count, wide = -1, 0, [], 0, 0

        def told():
            rows = pa.Table.from_batches(held)
            return pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([piece], pa.int64()), pa.array([wide], pa.int64()), pa.array([_packed(rows, column, "DELTA_LENGTH_BYTE_ARRAY")], pa.binary())], ["part", "piece", "bytes", "rows"])

        for whole in batches:
            if not whole.num_rows:
                continue
            own, upto = int(whole.column(part)[0].as_py()), np.cumsum(widths(whole.column(column)), dtype=np.int64)
            whole = whole.select([c for c in whole.schema.names if c != part])
            if own != last:
                if held:
                    yield told()
                last, piece, held, count, wide = own, 0, [], 0, 0
            i = 0
            while i < whole.num_rows:  # up to the row with which the piece is full
                before = int(upto[i - 1]) if i else 0
                j = min(int(np.searchsorted(upto, before + size - wide)) + 1, i + texts - count, whole.num_rows)
                held.append(whole.slice(i, j - i))
                count, wide, i = count + j - i, wide + int(upto[j - 1]) - before, j
                if wide >= size or count >= texts:
                    yield told()
                    piece, held, count, wide = piece + 1, [], 0, 0
        if held:
            yield told()

    return run


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class Windows:
    """Hashes of stretches of code points: each in constant time, from sums over all before."""

    BASE = 0x9E3779B97F4A7C15
    BACK = pow(BASE, -1, 1 << 64)

    def __init__(self, text: np.ndarray) -> None:
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(text.astype(np.uint64) + np.uint64(1)) * _powers(len(text), self.BASE))))
        self.back = _powers(len(text) + 1, self.BACK)

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.back[begin])


def tokens(text: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where tokens begin and, for each, how many tokens from it on lie in its text. A token is a word of ASCII or any other character; without words, each character.

    A term that is found as whole words has the tokens of the text at its place, so both are compared by tokens."""
    begins = np.ones(len(text), bool)
    if words:
        begins[1:] = ~(_WORD[text[1:]] & _WORD[text[:-1]])
    at = np.flatnonzero(begins)
    ends = np.flatnonzero(text[at] == 0x110000)
    return np.append(at, len(text)), ends[np.searchsorted(ends, np.arange(len(at)))] - np.arange(len(at)) if len(at) else np.zeros(0, np.int64)


def _asked(levels: list[tuple[int, bool]], longest: bool, shards: int, column: str):
    """shard, unit, keys: the distinct keys of what begins in the texts of a piece, in order, dealt to the shards of the lexicon."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, found = None, []

        def told():
            keys = distinct(np.concatenate(found))
            shard = keys % np.uint32(shards)
            order = np.argsort(shard, kind="stable")
            keys, ends = keys[order], np.searchsorted(shard[order], np.arange(shards + 1))
            blobs = [_packed(pa.table({"key": pa.array(keys[a:b].view(np.int32))}), "key", "DELTA_BINARY_PACKED") for a, b in zip(ends, ends[1:])]
            return pa.RecordBatch.from_arrays([pa.array(np.arange(shards), pa.int64()), pa.array(np.full(shards, unit), pa.int64()), pa.array(blobs, pa.binary())], ["shard", "unit", "keys"])

        for batch in batches:
            for own, blob in zip(batch.column("unit").to_pylist(), batch.column("rows")):
                if own != unit:
                    if found:
                        yield told()
                    unit, found = own, []
                texts = _one(_unpacked(blob), column)
                for i, j in pieces(widths(texts)):
                    text, _ = points(texts.slice(i, j - i))
                    at, left = tokens(text, longest)
                    windows, word = Windows(text), _WORD[text[at[:-1]]]
                    for n, first in levels:
                        own = np.flatnonzero((left >= n) & (word if first else ~word))
                        found.append(distinct(windows.hashes(at[own], at[own + n]).astype(np.uint32)))
                if len(found) > 64:
                    found = [distinct(np.concatenate(found))]
        if found:
            yield told()

    return run


def _keyed(carry: list[str], longest: bool, shards: int):
    """shard, key: of a term's longest beginning that has a level; level, and whether it begins with a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, at = points(batch.column("term"))
            begin, left = tokens(text, longest)
            own = np.searchsorted(begin, at[:-1])
            level = np.array(LEVELS)[np.searchsorted(LEVELS, left[own], side="right") - 1] if len(own) else np.zeros(0, np.int64)
            keys = Windows(text).hashes(at[:-1], begin[own + level]).astype(np.uint32)
            made = [pa.array(x) for x in ((keys % np.uint32(shards)).astype(np.int64), keys.astype(np.int64), level.astype(np.int32), _WORD[text[at[:-1]]])]
            yield pa.RecordBatch.from_arrays([*made, *(batch.column(c) for c in ["term", *carry])], ["shard", "key", "level", "word", "term", *carry])

    return run


def _answered(carry: list[str]):
    """unit, terms: of a shard of the lexicon, the terms whose keys a unit has asked for, packed."""
    def run(asked: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("term").select(["key", "term", *carry])
        keys = np.asarray(_one(known, "key")).astype(np.uint32)
        order = np.argsort(keys, kind="stable")
        ordered, known = keys[order], known.select(["term", *carry]).combine_chunks()
        out = {}
        for unit, blob in zip(asked.column("unit").to_pylist(), asked.column("keys")):
            own = np.asarray(_one(_unpacked(blob), "key")).view(np.uint32)
            at = np.searchsorted(own, ordered)
            hit = own[np.minimum(at, max(len(own) - 1, 0))] == ordered if len(own) else np.zeros(len(ordered), bool)
            out[unit] = out[unit] | hit if unit in out else hit  # a unit that several tasks have read asks several times
        sent = [(u, _packed(known.take(pa.array(np.sort(order[hit]))), "term", "DELTA_BYTE_ARRAY")) for u, hit in out.items() if hit.any()]
        return pa.table({"unit": pa.array([u for u, _ in sent], pa.int64()), "terms": pa.array([x for _, x in sent], pa.binary())})

    return run


def _looked_up(strings: pa.Array, most: int):
    """A function that finds the places of terms as whole words by their hashes, each compared with its term; None, if terms have more than most sizes in tokens or share a hash."""
    known, at = points(strings)
    begin, left = tokens(known, True)
    size = left[np.searchsorted(begin, at[:-1])]
    hashes, word, tables = Windows(known).hashes(at[:-1], at[1:] - 1), _WORD[known[at[:-1]]], []
    if len(np.unique(size)) > most:
        return None
    for n in np.unique(size).tolist():
        own = np.flatnonzero(size == n)
        own = own[np.argsort(hashes[own])]
        if (hashes[own][1:] == hashes[own][:-1]).any():
            return None
        tables.append((n, own, hashes[own], word[own].any(), not word[own].all()))

    def find(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, left = tokens(text, True)
        windows, first = Windows(text), _WORD[text[start[:-1]]]
        begins, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n, own, ordered, words, others in tables:
            on = np.flatnonzero((left >= n) & (first & words | ~first & others))
            a, b = start[on], start[on + n]
            key = windows.hashes(a, b)
            place = np.minimum(np.searchsorted(ordered, key), len(own) - 1)
            same = ordered[place] == key
            a, b, number = a[same], b[same], own[place[same]]
            width = b - a
            same = width == at[number + 1] - 1 - at[number]
            a, width, number = a[same], width[same], number[same]
            for i, j in pieces(width):  # character by character
                upto = np.cumsum(width[i:j])
                within = np.arange(upto[-1]) - np.repeat(upto - width[i:j], width[i:j])
                differ = text[np.repeat(a[i:j], width[i:j]) + within] != known[np.repeat(at[number[i:j]], width[i:j]) + within]
                ok = np.add.reduceat(differ, upto - width[i:j]) == 0
                begins.append(a[i:j][ok])
                numbers.append(number[i:j][ok])
        return np.concatenate(begins), np.concatenate(numbers)

    return find


def _unit(column: str, keep: list[str], carry: list[str], names: list[str], kinds: list[pa.DataType], longest: bool, room: int, sizes: int):
    """The rows of a unit's texts and the terms that are found in them: by hashes, or by automata of at most room characters one after the other."""
    def run(packed: pa.Table, sent: pa.Table) -> pa.Table:
        if not packed.num_rows or not sent.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names)
        rows, terms = (pa.concat_tables([_unpacked(x) for x in own]).combine_chunks() for own in (packed.column("rows"), sent.column("terms")))
        strings = pc.cast(_one(terms, "term"), pa.string())
        once = np.unique(np.asarray(strings.dictionary_encode().indices), return_index=True)[1]
        strings, terms = strings.take(pa.array(once)), terms.take(pa.array(once))
        size = np.asarray(pc.utf8_length(strings)).astype(np.int32)
        texts = _one(rows, column)
        parts = list(pieces(widths(texts)))
        places = [[] for _ in parts]
        look = _looked_up(strings, sizes) if longest else None
        for a, b in [(0, len(strings))] if look else pieces(size, room):
            known = None if look else Automaton(strings.slice(a, b - a).to_pylist())
            for k, (i, j) in enumerate(parts):
                text, _ = points(texts.slice(i, j - i))
                begin, number = (look or known.find)(text) if len(text) else (np.zeros(0, np.int64), np.zeros(0, np.int32))
                if longest and not look:
                    ok = whole_words(text, begin, known.size[number])
                    begin, number = begin[ok], number[ok]
                places[k].append((begin.astype(np.int32), number.astype(np.int32) + np.int32(a)))
        row, term = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for (i, j), found in zip(parts, places):
            begin, number = (np.concatenate([x[c] for x in found]) if found else np.zeros(0, np.int32) for c in (0, 1))
            if longest:
                taken = leftmost_longest(begin, size[number])
                begin, number = begin[taken], number[taken]
            _, at = points(texts.slice(i, j - i))
            own = np.searchsorted(at, begin, side="right") - 1
            _, first = np.unique(own * (len(size) + 1) + number, return_index=True)
            row.append((own[first] + i).astype(np.int32))
            term.append(number[first])
        row, term = pa.array(np.concatenate(row)), pa.array(np.concatenate(term))
        return pa.table([*(_one(rows, c).take(row) for c in keep), strings.take(term), *(_one(terms, c).take(term) for c in carry)], names)

    return run


def _one(table: pa.Table, name: str) -> pa.Array:
    """A column as one array."""
    own = table.column(name)
    return own.chunk(0) if own.num_chunks == 1 else pa.concat_arrays(own.chunks) if own.num_chunks else pa.array([], own.type)


def _in_units(sentences: DataFrame, terms: DataFrame, text: Column, name: str, longest: bool, carry: list[str], drop: tuple[str, ...], whole: int) -> DataFrame:
    """find() with a lexicon of any size: texts lie in units, to which only terms go whose beginnings the unit's texts have."""
    keep = [c for c in sentences.columns if c not in drop]
    own = sentences.select(*(F.col(f"`{c}`") for c in keep), text.alias("__text"), F.spark_partition_id().cast("long").alias("__part")).where("__text <> ''")
    rows = table(own.mapInArrow(_pieces("__text", "__part", FINE, TEXTS), "part long, piece long, bytes long, rows binary"), "pieces")
    told = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.max("part"), F.lit(0)).alias("last")).first()
    size = min(UNIT, max(FINE, told["bytes"] // UNITS))
    # Small partitions share units, large ones have several.
    together = max(1, size * (told["last"] + 1) // max(1, told["bytes"]))
    unit = F.shiftleft(F.floor(F.col("part") / together).cast("long"), 32) + F.floor(F.col("piece") / max(1, size // FINE)).cast("long")
    rows = rows.select(unit.alias("unit"), "rows")
    kinds = lambda df, columns: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*(F.col(f"`{c}`") for c in columns)).schema.fields)
    shards = max(1, -(-whole // SHARD))
    keyed = terms.select("term", *carry).mapInArrow(_keyed(carry, longest, shards), f"shard long, key long, level int, word boolean, {kinds(terms, ['term', *carry])}")
    levels = sorted((r["level"], r["word"]) for r in keyed.select("level", "word").distinct().collect())
    asked = rows.mapInArrow(_asked(levels, longest, shards, "__text"), "shard long, unit long, keys binary")
    sent = table(asked.groupBy("shard").cogroup(keyed.drop("level", "word").groupBy("shard")).applyInArrow(_answered(carry), "unit long, terms binary"), "answers")
    schema = ", ".join(x for x in (kinds(sentences, keep), f"`{name}` string", kinds(terms, carry)) if x)
    none = [*sentences.select(*(F.col(f"`{c}`") for c in keep)).limit(0).toArrow().schema.types, pa.string(), *terms.select(*carry).limit(0).toArrow().schema.types]
    return rows.groupBy("unit").cogroup(sent.groupBy("unit")).applyInArrow(_unit("__text", keep, carry, [*keep, name, *carry], none, longest, AUTOMATA * BROADCAST, SIZES), schema)


def find(sentences: DataFrame, terms: DataFrame, text: Column, name: str, longest: bool, carry: tuple[str, ...] = (), drop: tuple[str, ...] = ()) -> DataFrame:
    """sentences, without the columns to drop, with a row for each distinct term of terms(term) that the text has, as column name.

    longest: the leftmost longest terms that don't overlap and aren't part of a word of ASCII; else every term that the
    text contains. A null or empty text has none, nor has a null or empty term any place. Repeated terms count once.
    carry: columns of terms that go with each; a term then stands once in terms."""
    known = terms.select("term", *carry).where("term <> ''")
    known = known if carry else known.distinct()
    whole = known.agg(F.coalesce(F.sum(F.length("term")), F.lit(0))).first()[0]
    kept = sentences.drop(*drop)
    if not whole:
        return kept.select("*", F.lit(None).cast("string").alias(name), *(F.lit(None).cast(t).alias(c) for c, t in known.dtypes if c in carry)).limit(0)
    if whole <= BROADCAST:
        held = known.toArrow().sort_by("term")
        made = sentences.sparkSession.sparkContext.broadcast((Automaton(held.column("term").to_pylist()), held.select(list(carry))))
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), f"`{name}` string", *(f"`{c}` {t}" for c, t in known.dtypes if c in carry)])
        return sentences.withColumn("__text", text).drop(*drop).mapInArrow(_local(made, "__text", name, longest), schema)
    return _in_units(sentences, known if carry else table(known, "terms"), text, name, longest, list(carry), drop, whole)


def mark(sentences: DataFrame, terms: DataFrame, text: Column, name: str, longest: bool, drop: tuple[str, ...] = ()) -> DataFrame:
    """sentences, without the columns to drop, with whether find() would find a term in the text, as column name. With a lexicon that is broadcast they stay where they are."""
    known = terms.select("term").where("term <> ''").distinct()
    whole = known.agg(F.coalesce(F.sum(F.length("term")), F.lit(0))).first()[0]
    if whole > BROADCAST:
        rows = table(sentences.withColumn("__id", F.monotonically_increasing_id()), "numbered")
        hit = find(rows.select("__id", text.alias("__own")), known, F.col("__own"), "__term", longest, drop=("__own",)).select("__id").distinct()
        return rows.join(hit.withColumn(name, F.lit(True)), "__id", "left").withColumn(name, F.coalesce(name, F.lit(False))).drop("__id", *drop)
    made = sentences.sparkSession.sparkContext.broadcast(Automaton(sorted(r[0] for r in known.collect())))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in sentences.drop(*drop).schema.fields), f"`{name}` boolean"])
    return sentences.withColumn("__text", text).drop(*drop).mapInArrow(_marked(made, "__text", name, longest), schema)
