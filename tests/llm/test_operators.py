"""Operators against brute force, on edge cases and generated texts."""
from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmura.llm import fingerprint, hmm, licences, merge_dropout, minhash, packing, quality, suffix_dedup, topk, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["alpha", "beta", "Gamma", "delta,", "épsilon", "zeta.", "eta", "theta\n", "日本", "%%"]) + str(rng.randrange(30)) for _ in range(n))


def corpus() -> list[tuple]:
    rng = random.Random(7)
    base = [prose(rng, rng.choice([3, 40, 150, 400])) for _ in range(25)]
    texts: list = [None, "", " \n\t", "a", "x y", *base, base[3], base[3], base[4] + " tail", "head " + base[5], base[6][: len(base[6]) // 2] + base[7], "onhe. " * 200, "word" * 400]
    passage = prose(rng, 60)
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 30)}" for _ in range(6)]
    long = prose(rng, 6000)
    texts += [long, long.replace("alpha1 ", "alpha2 ", 3)]
    return [(i * 3 - 5, t, None if i % 9 == 0 else ["en", "de"][i % 2], f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With columns whose names the operators use themselves."""
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in ("cluster", "label", "rep", "part", "chunk", "ranges", "anchor", "__id", "perplexity"):
        frame = frame.withColumn(c, F.lit(1))
    return frame


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text: str | None, k: int) -> set:
    words = WORD.findall((text or "").encode().lower())
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def near(rows, k, percent):
    """Components by all pairs."""
    sets = {r[0]: shingles(r[1], k) for r in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("k,threshold,block,posted", [(3, 0.85, 2048, 20_000), (5, 0.8, 2048, 20_000), (3, 0.85, 3, 2)])
def test_near_duplicates(docs, rows, k, threshold, block, posted, monkeypatch):
    monkeypatch.setattr(minhash, "POSTED", posted)
    want, sizes = near(rows, k, round(100 * threshold))
    got = minhash.near_duplicates(docs, k, threshold, block).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_edges(spark, none):
    assert minhash.near_duplicates(none).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f", None, None, None), (1, "a b c d e f", None, None, None), (1, "a b c d e f", None, None, None), (2, "A B C D E F", None, None, None)], SCHEMA)
    got = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in minhash.near_duplicates(odd).collect())
    assert got == [(0, None, True), (1, 1, True), (1, 1, True), (2, 1, False)]


def removed(rows, window=100):
    seen: set = set()
    out = {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - window + 1):
            w = raw[p : p + window]
            if w in seen:
                gone[p : p + window] = b"\1" * window
            seen.add(w)
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (not i or not gone[i - 1]))
        out[doc_id] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_dedup(docs, rows, hot, monkeypatch):
    whole = suffix_dedup.repeats
    monkeypatch.setattr(suffix_dedup, "repeats", lambda d, w: whole(d, w, hot))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in suffix_dedup.removed_spans(docs).collect()}
    assert got == removed(rows)


def test_suffix_dedup_applied(spark, docs, none):
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("text is not null and n_chars <> length(text)").count() == 0
    assert suffix_dedup.without_repeats(none).count() == 0 and suffix_dedup.removed_spans(none).count() == 0
    odd = spark.createDataFrame([(None, "z" * 150, None, None, None), (1, "日" * 50, None, None, None), (2, "日" * 50, None, None, None), (3, None, None, None, None)], SCHEMA)
    texts = {r["doc_id"]: r["text"] for r in suffix_dedup.without_repeats(odd).collect()}
    assert texts[None] == "z" * 150 and texts[3] is None and texts[2] == ""
    assert texts[1] == "日"  # it repeats itself


def test_suffix_dedup_with_colliding_hashes(monkeypatch):
    """Prefix hashes that take a third of different strings for equal: the bytes settle it."""
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    data[900:1150] = data[450:700]
    sizes = np.array([150] * 20)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    shard = np.repeat([1, 2], 10)
    want, seen = [], set()
    for i in range(20):
        for p in range(ends[i], ends[i + 1] - 99):
            key = (shard[i], data[p : p + 100].tobytes())
            want.append(key in seen)
            seen.add(key)
    assert suffix_dedup.repeated_windows(data, ends, shard, 100).tolist() == want
    same = suffix_dedup.SuffixOrder.same
    monkeypatch.setattr(suffix_dedup.SuffixOrder, "same", lambda self, i, j, n: same(self, i, j, n) | ((i * 7 + j * 3 + n) % 3 == 0))
    assert suffix_dedup.repeated_windows(data, ends, shard, 100).tolist() == want
    assert any(want)


def test_contents_that_share_a_hash_are_not_repeats(monkeypatch):
    import pyarrow as pa

    text = prose(random.Random(3), 200)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text, text[:700] + "Z" + text[701:]])], ["doc_id", "text"])

    def known():
        out = pa.Table.from_batches(list(suffix_dedup._groups(100)(iter([batch]))))
        return {(r["doc_id"], r["lo"]) for r in out.to_pylist() if r["known"]}, out.to_pylist()

    want, every = known()
    monkeypatch.setattr(suffix_dedup, "content_check", lambda data, at, size: np.zeros(len(at), np.int64))
    whole = suffix_dedup.anchors
    monkeypatch.setattr(suffix_dedup, "anchors", lambda *a: (*whole(*a)[:4], np.zeros(len(whole(*a)[0]), np.int64)))
    got, _ = known()
    assert want and got <= want  # compared with the first of all contents, most are not even candidates; none is wrong
    raw = {1: text.encode(), 2: (text[:700] + "Z" + text[701:]).encode()}
    heads = [(r["doc_id"], r["lo"], r["more"]) for r in every]
    for d, lo in got:
        more = next(m for x, y, m in heads if (x, y) == (d, lo))
        assert any(raw[d][lo : lo + more + 100] == raw[x][y : y + m + 100] for x, y, m in heads if (x, y) < (d, lo))


def test_suffix_dedup_of_texts_above_a_stretch(spark, monkeypatch):
    rng = random.Random(8)
    long = prose(rng, 500)
    rows = [(1, long), (2, prose(rng, 40) + long[300:2500] + prose(rng, 40)), (3, long[:1000] * 3)]
    pieces = []
    grouped = suffix_dedup.anchors
    monkeypatch.setattr(suffix_dedup, "STRETCH", 300)
    monkeypatch.setattr(suffix_dedup, "anchors", lambda data, *a: pieces.append(len(data)) or grouped(data, *a))
    import pyarrow as pa

    found = {1: set(), 2: set(), 3: set()}
    for doc_id, text in rows:  # one text a batch, so that each is above the stretch
        batch = pa.RecordBatch.from_arrays([pa.array([doc_id]), pa.array([text])], ["doc_id", "text"])
        for out in suffix_dedup._groups(100)(iter([batch])):
            for r in out.to_pylist():
                found[doc_id] |= set(range(r["lo"], r["lo"] + r["more"] + 1))
    assert max(pieces) == 399 and all(found[d] == set(range(len(t.encode()) - 99)) for d, t in rows)


def test_mergesort_is_a_stable_suffix_sort():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    pos = rng.permutation(300)
    segment = np.sort(rng.integers(0, 4, 300))
    order = suffix_dedup.SuffixOrder(data, 20).mergesort(pos, segment)
    want = sorted(range(300), key=lambda i: (segment[i], data[pos[i] : pos[i] + 20].tobytes(), i))
    assert order.tolist() == want


def test_fingerprints(docs, rows, none):
    order = sorted(rows, key=lambda r: -r[0])
    got = {r["doc_id"]: r for r in fingerprint.fingerprints_of_edits(docs).collect()}
    assert len(got) == len(rows)
    for i, (doc_id, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + (after[1] or "")[:cut]
        r = got[doc_id]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["edited_fingerprint"] == fingerprint.text_of(fingerprint._chains([edited.encode()])[0])
        own, other = fingerprint.chain_of(r["fingerprint"]), fingerprint.chain_of(got[after[0]]["fingerprint"])
        assert r["near_next"] == pytest.approx(fingerprint.likeness(own, other))
        assert 0 <= r["near_edited"] <= 1
    assert {r["fingerprint"] for d, r in got.items() if d in (-5, -2)} == {"0:"}
    assert fingerprint.fingerprints_of_edits(none).count() == 0 and fingerprint.fingerprints(none).count() == 0


def test_entropies():
    data = np.frombuffer(prose(random.Random(1), 60).encode(), np.uint8)
    for p, e in enumerate(fingerprint.entropies(data)):
        h = -sum(n / 64 * math.log2(n / 64) for n in collections.Counter(data[p : p + 64].tobytes()).values())
        assert abs(e - 1000 * h / 6) <= 1.01


def test_likeness_tells_edits_from_others():
    rng = random.Random(5)
    a, b = (" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(900)) for _ in range(2))
    x, y, z = fingerprint._chains([a.encode(), (a[: len(a) * 2 // 3] + b[: len(b) // 3]).encode(), b.encode()])
    assert fingerprint.likeness(x, x) == 1 and fingerprint.likeness(x, y) > 0.5 > 0.2 > fingerprint.likeness(x, z)


def test_packing(docs, rows, none):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    ids = {r[0]: [*whole.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in rows}
    got = packing.pack(docs).toPandas()
    for doc_id, part in got.groupby("doc_id"):
        part = part.sort_values("start")
        assert [x for p in part["ids"] for x in p] == ids[doc_id]
        assert part["start"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]]
        assert (part["doc_tokens"] == len(ids[doc_id])).all()
        assert part["ids_crc32"].tolist() == [zlib.crc32(np.array(p, "<u4").tobytes()) for p in part["ids"]]
    assert set(got["doc_id"]) == set(ids)
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part["offset"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]] and part["length"].sum() <= 4096
    assert packing.pack(none).count() == 0


def test_cuts_waste_little():
    for n in range(1, 9000, 7):
        pieces = packing.cuts(n)
        assert sum(x for _, x in pieces) == n
        for k, length in pieces:
            assert k * length <= packing.CAPACITY
            assert length < 64 or packing.CAPACITY - k * length <= packing.CAPACITY / packing.SLACK + k


def test_word_tokenizer_equals_whole_texts():
    rng = random.Random(2)
    tokenizer = packing.WordTokenizer(packing.tokenizer_path())
    texts = ["It's DON'T İstanbul ﬁ é", "<|endoftext|> A <|STARTOFTEXT|> b", "x!!'s...y’s — … a… a….", "ſ K Å ǅ", ""]
    texts += ["".join(rng.choice("aB.é'1 !İ́ßK…<|>\n\tx") for _ in range(30)) for _ in range(300)]
    for t, raw, e in zip(texts, tokenizer.encode([t.encode() for t in texts]), tokenizer.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(raw, "<u4").tolist() == e.ids, t


def test_merge_dropout(spark, docs, rows, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=merge_dropout.model_path())
    plain = {r["doc_id"]: r["ids"] for r in merge_dropout.encode(docs, rate=0.0).collect()}
    assert all(plain[r[0]] == sp.encode(r[1] or "") for r in rows)
    coded = merge_dropout.encode(docs)
    got = {r["doc_id"]: r for r in coded.collect()}
    assert all(r["lossless"] and r["n_tokens"] == len(r["ids"]) for r in got.values())
    assert sum(len(r["ids"]) for r in got.values()) > 1.03 * sum(map(len, plain.values()))
    back = {r["doc_id"]: r["text"] for r in merge_dropout.decode(coded).collect()}
    assert all(back[r[0]] == (r[1] or "") for r in rows)
    other = merge_dropout.encode(docs, seed=1).where("n_tokens > 100").first()
    assert other["ids"] != got[other["doc_id"]]["ids"]
    assert merge_dropout.encode(none).count() == 0
    coder = merge_dropout.MergeDropout(merge_dropout.model_path())
    for t in ("a▁b ▁", "\x00\x7f\n\n  x ", "日" * 200 + " y", "x" * 500):
        assert coder.decode(coder.encode([t], [4])[0]) == t


def test_merge_dropout_agrees_with_a_heap():
    rng = random.Random(4)
    coder = merge_dropout.MergeDropout(merge_dropout.model_path(), rate=0.3)
    chunks = [" " + "".join(rng.choice("thenio") for _ in range(rng.randint(1, 30))) + chr(0xF0000 + rng.randint(0, 3)) for _ in range(300)]
    coder.learn(chunks)
    for c in chunks:
        flat = coder.char[[ord(x) for x in c[:-1]]].tolist()
        assert np.frombuffer(coder.known[c], np.int32).tolist() == [s for s, _ in coder._one(flat, coder._keys([c]))]


def test_merge_dropout_varies_every_occurrence():
    coder = merge_dropout.MergeDropout(merge_dropout.model_path())
    word = "international"
    coded = coder.encode([word] * 400, list(range(400)))
    assert len(set(coded)) > 10
    texts = [f"{word} {word}\n日本 {'x' * 100} {word}, thenioth"] * 20
    together = coder.encode(texts, list(range(20)))
    for d, (text, got) in enumerate(zip(texts, together)):
        assert coder.encode([text], [d]) == [got] and coder.decode(got) == text
        want = b""
        for i, c in enumerate(coder.chunks(" " + text)):
            key = merge_dropout.mix(np.array([i], np.uint64) + merge_dropout.mix(np.array([d], np.uint64) + coder.seed))
            want += coder._ids([s for s, _ in coder._one(coder.char[[ord(x) for x in c]].tolist(), key)], c, None)
        assert got == want


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(600)]
    vectors += [(i, vectors[5][1]) for i in range(600, 900)]  # one vector many times
    bad = [(1000, None), (1100, [1.0, None] + [0.0] * 6), (1200, [float("nan")] * 8), (1300, [float("inf")] * 8), (None, [1.0] * 8), (1400, [1.0, 2.0])]
    frame = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<float>").withColumn("r", F.lit(1))
    got = topk.top_k(frame).toPandas()
    x = np.floor(1024 * np.array([v for _, v in vectors], float)).astype(np.int64)
    for q in range(0, 900, 100):
        score = x @ x[q]
        want = sorted((-s, i) for i, s in enumerate(score) if i != q)[:10]
        own = got[got["query_id"] == q].sort_values("rank")
        assert list(zip(-own["score"], own["vec_id"])) == want and own["rank"].tolist() == list(range(1, 11))
    assert set(got["query_id"]) == set(range(0, 900, 100))
    assert topk.top_k(frame.limit(0)).count() == 0


def test_top_k_of_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERIES", 2)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 6)) * np.repeat([1, 20], 250)[:, None]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    y = np.floor(1024 * x).astype(np.int64)
    got = topk.top_k(frame, k=3).toPandas()
    for q in range(0, 500, 100):
        want = sorted((-s, i) for i, s in enumerate(y @ y[q]) if i != q)[:3]
        own = got[got["query_id"] == q].sort_values("rank")
        assert list(zip(-own["score"], own["vec_id"])) == want


def test_licences(spark, none):
    rows = [(1, "Hello\nReleased under the MIT License.\nbye"), (2, "released UNDER the mit license"), (3, None), (4, ""), (5, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0."), (6, "word " * 3000), (7, "the MIT")]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).withColumn("line", F.lit(1)).withColumn("size", F.lit(1))
    got = {(r["doc_id"], r["place"], r["licence"]) for r in licences.scan(frame).where("dice = 1 and unit = 'line'").collect()}
    assert got == {(1, 1, "MIT"), (2, 0, "MIT"), (5, 0, "CC-BY-NC-4.0"), (5, 1, "CC-BY-NC-4.0")}
    assert licences.scan(none).count() == 0
    plan = licences.scan(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_licences_at_the_threshold(spark):
    rows = [(1, "Released under the MIT License. See file"), (2, "under the MIT License"), (3, "a b c d e"), (4, "a b c d e f g h i j k l m"), (5, "a b c d e f g h i j k l m n")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["n_bigrams"], r["common"], r["dice"]) for r in licences.scan(frame).where("unit = 'line'").collect() if r["licence"] == "MIT" and r["template"] == 0]
    assert (1, 6, 4, 0.8) in got
    texts = {"X": ["a b c d e f g"], "Y": ["a b c d e f g h i"]}  # 6 and 8 bigrams
    got = {(r["doc_id"], r["licence"]) for r in licences.scan(frame, texts=texts).where("unit = 'line'").collect()}
    assert got == {(3, "X"), (4, "Y")}


def brute_licences(rows, texts, t=0.8):
    """Every unit against every template, without pruning."""
    norm = lambda x: re.findall("[a-z0-9]+", x.translate(str.maketrans(licences._UPPER, licences._LOWER)))
    two = lambda w: {(a, b) for a, b in zip(w, w[1:])}
    out = set()
    for doc_id, text in rows:
        for licence, ts in texts.items():
            for number, x in enumerate(ts):
                want, size = two(norm(x)), len(norm(x))
                told = lambda b: (len(b), len(b & want), 2 * len(b & want) / (len(b) + len(want)))
                lines, w = (text or "").split("\n"), norm(text or "")
                units = [("line", i, told(two(norm(y)))) for i, y in enumerate(lines)] + [("text", 0, told(two(w)))] * (len(lines) > 1)
                out |= {(doc_id, u, i, licence, number, *d) for u, i, d in units if d[2] >= t}
                runs = [(i, told(two(w[i : i + size]))) for i in range(len(w) - size + 1)]
                runs = [(i, d) for i, d in runs if d[2] >= t]
                out |= {(doc_id, "words", i, licence, number, *d) for i, d in runs
                        if not any(abs(j - i) < size and (e[2] > d[2] or (e[2] == d[2] and j < i)) for j, e in runs)}
    return out


def test_licences_wherever_they_stand(spark):
    rng = random.Random(11)
    mit = licences.TEMPLATES["MIT"][3]
    words = mit.split()
    wrapped = "\n".join(" * " + " ".join(words[i : i + 9]) for i in range(0, len(words), 9))
    code = "\n".join(f"x{i} = f{i}(y{i}, {i})" for i in range(200))
    got = {(r["doc_id"], r["licence"], r["template"]) for r in licences.scan(spark.createDataFrame(
        [(1, wrapped + "\n" + code), (2, code + " " + mit + " " + code), (3, code)], "doc_id long, text string")).where("unit = 'words'").collect()}
    assert got == {(1, "MIT", 3), (2, "MIT", 3)}
    # Any mix of a template's words and others, and a very long text
    texts = {"P": ["alpha beta gamma delta epsilon zeta eta theta"], "Q": ["the of and to"], "R": ["beta gamma beta gamma one"]}
    pool = [w for ts in texts.values() for x in ts for w in x.split()]
    rows = []
    for i in range(120):
        parts = [rng.choice([" ".join(texts["P"][0].split()[a : a + rng.randint(1, 8)]), " ".join(rng.choices(pool, k=4)), texts["Q"][0].upper(), "fill"]) for a in [rng.randrange(8) for _ in range(rng.randint(1, 9))]]
        rows.append((i, "".join(p + rng.choice([" ", "\n", ", "]) for p in parts)))
    rows += [(500, ("fill er " * 20_000) + texts["P"][0] + "\n" + "the of and to " * 3), (501, None), (502, "")]
    found = licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), texts=texts)
    assert {tuple(r) for r in found.collect()} == brute_licences(rows, texts)


def test_hmm(docs, rows, none):
    got = {r["doc_id"]: r for r in hmm.scores(docs, rounds=2).collect()}
    tokens = {r[0]: [*WORD.findall((r[1] or "").encode().lower()), None] for r in rows}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    c = collections.Counter(w for i, ws in tokens.items() if not out[i] for w in ws)
    n, v = sum(c.values()), len(c)
    assert any(out.values())
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        assert math.isfinite(r["score"]) and r["score"] < 0
    assert hmm.scores(none).count() == 0


def test_forward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(0)
    share = rng.random(hmm.CLASSES + 1)
    model = hmm.Model.seeded(share / share.sum())
    for length in (1, 2, 4):
        seq = rng.integers(0, hmm.CLASSES, length)
        total = 0.0
        for path in np.ndindex(*[hmm.STATES] * length):
            p = model.start[path[0]] * model.emit[seq[0], path[0]]
            for t in range(1, length):
                p *= model.move[path[t - 1], path[t]] * model.emit[seq[t], path[t]]
            total += p
        assert hmm.forward(model, [seq])[0] == pytest.approx(math.log10(total))


@pytest.mark.parametrize("stretch,held", [(1024, 1 << 20), (4, 1 << 20), (3, 10), (1, 5)])
def test_baum_welch_counts_whole_texts(stretch, held, monkeypatch):
    """Expected counts and likelihoods by the textbook, without scaling, for texts of one stretch and of many."""
    monkeypatch.setattr(hmm, "STRETCH", stretch)
    monkeypatch.setattr(hmm, "HELD", held)
    rng = np.random.default_rng(0)
    share = rng.random(hmm.CLASSES + 1)
    m = hmm.Model.seeded(share / share.sum())
    lens = np.array([1, 2, 5, 9, 3, 17, 40, 1, 8])
    tokens = rng.integers(0, hmm.CLASSES + 1, lens.sum())
    begin = np.cumsum(lens) - lens
    start, move, emit, told = np.zeros(hmm.STATES), np.zeros((hmm.STATES, hmm.STATES)), np.zeros((hmm.CLASSES + 1, hmm.STATES)), []
    for b, n in zip(begin, lens):
        x = tokens[b : b + n]
        ahead, back = np.zeros((n, hmm.STATES)), np.ones((n, hmm.STATES))
        ahead[0] = m.start * m.emit[x[0]]
        for t in range(1, n):
            ahead[t] = (ahead[t - 1] @ m.move) * m.emit[x[t]]
        for t in range(n - 2, -1, -1):
            back[t] = m.move @ (m.emit[x[t + 1]] * back[t + 1])
        chance = ahead[-1].sum()
        told.append(math.log10(chance))
        start += ahead[0] * back[0] / chance
        np.add.at(emit, x, ahead * back / chance)
        for t in range(1, n):
            move += m.move * np.outer(ahead[t - 1], m.emit[x[t]] * back[t]) / chance
    exp = hmm.Expectation(m)
    exp.add(tokens, begin, lens)
    for a, b in ((exp.start, start), (exp.move, move), (exp.emit, emit), (hmm.forward(m, [tokens[b : b + n] for b, n in zip(begin, lens)]), told)):
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("spread", [1, 2])
def test_words_of_many_chunks_are_spread(docs, spread, monkeypatch):
    want = {r["doc_id"]: r["base_score"] for r in hmm.scores(docs, rounds=1).collect()}
    monkeypatch.setattr(hmm, "SPREAD", spread)
    got = {r["doc_id"]: r["base_score"] for r in hmm.scores(docs, rounds=1).collect()}
    assert got == pytest.approx(want)


def test_baum_welch_never_lowers_the_likelihood(spark):
    rng = random.Random(3)
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    texts = [" ".join(rng.choice(w) for _ in range(30)) for w in (a, b) for _ in range(40)]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    share = np.full(hmm.CLASSES + 1, 1 / (hmm.CLASSES + 1))
    seqs = [np.append(hmm.classes_of([w.encode() for w in t.split()]), hmm.CLASSES) for t in texts]
    told = [hmm.forward(hmm.train(frame, share, n), seqs).sum() for n in (0, 1, 3, 6)]
    assert told == sorted(told) and told[-1] > told[1] + 100


def test_warc(spark, none):
    rows = [(1, "http://a/\r\nx", "same"), (2, None, "same"), (3, "http://b", None), (4, "http://c", ""), (5, "http://d", "ü" * 5000), (None, "http://e", "same"), (5, "http://d", "ü" * 5000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", F.lit("x"))
    index = warc.write_archives(frame)
    assert index.count() == len(rows)
    got = warc.read_records(index).collect()
    digests = {p: warc.digest(p.encode()) for p in ("same", "", "ü" * 5000)}
    told = sorted((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got)
    same, empty, long = digests["same"], digests[""], digests["ü" * 5000]
    assert told == sorted([
        (0, 4, same, "revisit", 2), (1, 4, same, "revisit", 2), (2, 4, same, "response", None), (3, 0, empty, "revisit", 4), (4, 0, empty, "response", None),
        (5, 10000, long, "response", None), (5, 10000, long, "response", None)], key=lambda t: t[:4])
    one = warc.read_records(index.where("page_id = 2")).collect()
    assert len(one) == 1 and one[0]["payload"] == b"same" and one[0]["url"] == "about:blank"
    assert {r["record_type"] for r in warc.read_records(warc.write_archives(frame, 5)).where("payload_bytes = 4").collect()} == {"response"}
    assert warc.write_archives(frame.limit(0)).count() == 0


def test_ranges_are_coalesced():
    assert list(warc.ranges([(0, 10), (10, 5), (100_000, 5), (100_006, 1)])) == [(0, 15, [0, 1]), (100_000, 100_007, [2, 3])]
    assert [len(h) for _, _, h in warc.ranges([(i * warc.SPAN, warc.SPAN) for i in range(3)])] == [1, 1, 1]


def brute_kneser_ney(texts: list[str]):
    """The probability of an n-gram's last symbol by the textbook; symbols are characters, "" is a boundary."""
    order = quality.ORDER
    grams = [collections.Counter() for _ in range(order + 1)]
    for t in texts:
        full = [""] * (order - 1) + list(t) + [""]
        grams[order].update(tuple(full[i : i + order]) for i in range(len(full) - order + 1))
    for n in range(order - 1, 0, -1):
        grams[n].update(g[1:] for g in grams[n + 1])

    def discounts(c):
        k = collections.Counter(c.values())
        if not (k[1] and k[2] and k[3]):
            return 0.5, 1.0, 1.5
        y = k[1] / (k[1] + 2 * k[2])
        return tuple(min(max(i - (i + 1) * y * k[i + 1] / k[i], 0.01), i - 0.01) for i in (1, 2, 3))

    d = [None, *(discounts(grams[n]) for n in range(1, order + 1))]
    cut = lambda n, c: d[n][min(c, 3) - 1]

    def p(g):
        if not g:
            return 1 / (len(grams[1]) + 1)
        n, own = len(g), [(x, c) for x, c in grams[len(g)].items() if x[:-1] == g[:-1]]
        if not own:
            return p(g[1:])
        total = sum(c for _, c in own)
        weight = sum(cut(n, c) for _, c in own) / total
        c = grams[n][g]
        return (c - cut(n, c) if c else 0) / total + weight * p(g[1:])

    return p


def test_kneser_ney(spark):
    texts = [prose(random.Random(i), 20) for i in range(8)] + ["日本語の文章。日本の文", "ABC abc Abc"]
    tables = quality.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    model, p = quality.Model(tables.known.toArrow(), tables.first, tables.unknown, tables.average), brute_kneser_ney(texts)
    asked = [texts[0][:40], "日本人の文", "aBC ABC", "zz\U0001F600日", "x"]
    for t in asked:
        raw = np.frombuffer(t.encode(), np.uint8)
        codes = quality.grams(*quality.symbols(raw, np.array([0, len(raw)]))[:2])
        full = [""] * (quality.ORDER - 1) + list(t) + [""]
        want = [math.log2(p(tuple(full[i : i + quality.ORDER]))) for i in range(len(t) + 1)]
        np.testing.assert_allclose(model.log2(codes), want, rtol=1e-9)
    # capitals and small letters, and two ideographs, are different symbols
    raw = np.frombuffer("aA日本".encode(), np.uint8)
    assert len(set(quality.grams(*quality.symbols(raw, np.array([0, len(raw)]))[:2])[0])) == 5
    # what follows a context adds up to one, the unknown symbol's share with it
    for context in (("a", "l", "p", "h"), ("", "", "", "日")):
        every = {g[-1] for t in texts for g in [(x,) for x in t]} | {"", "unknown"}
        assert sum(p((*context, x)) for x in every) == pytest.approx(1)
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "row long, text string")
    told = quality.scored(frame.repartition(3), tables, ["row"], "row long, perplexity double")
    joined = {r["row"]: r["perplexity"] for r in told.collect()}
    assert "ReusedExchange" in told._jdf.queryExecution().executedPlan().toString()  # the texts are shuffled once
    for i, t in enumerate(asked):
        raw = np.frombuffer(t.encode(), np.uint8)
        assert joined[i] == pytest.approx(model.perplexity(raw, np.array([0, len(raw)]))[0])


@pytest.mark.parametrize("unit,units", [(quality.UNIT, quality.UNITS), (5000, 1)])
def test_classifier(spark, none, unit, units, monkeypatch):
    monkeypatch.setattr(quality, "UNIT", unit)
    monkeypatch.setattr(quality, "UNITS", units)
    rng = random.Random(9)
    good = [(i, prose(rng, 80), ["en", "de", None][i % 3], None, None) for i in range(700)]
    junk = [(1000 + i, "".join(rng.choice("QZ#@|~") for _ in range(300)), "en", None, None) for i in range(30)]
    frame = spark.createDataFrame([*good, *junk, (2000, None, "en", None, None), (2001, "", "en", None, None)], SCHEMA).withColumn("threshold", F.lit(1))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(600)] + [(5, 0, 0), (None, 1, 0), (1000, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classify(frame, labels).collect()}
    assert sum(got[i]["kept"] for i in range(700)) >= 680  # the thresholds come from 120 texts
    assert not any(got[1000 + i]["kept"] for i in range(30)) and not got[2000]["kept"] and not got[2001]["kept"]
    stay = quality.kept(frame, labels)
    assert stay.columns == frame.columns and {r["doc_id"] for r in stay.collect()} == {i for i, r in got.items() if r["kept"]}
    assert quality.classify(frame, labels.limit(0)).where("kept").count() == 730
    assert quality.classify(none, labels).count() == 0 and quality.kept(none, labels).count() == 0


def test_quality_stage_edges(spark, none):
    """Null ids, languages and texts, repeated rows and clashing columns in the stages' input."""
    rng = random.Random(3)
    rows = [(i, prose(rng, 60), "en", "s", 1) for i in range(200)] + [(None, prose(rng, 60), None, None, None), (7, None, None, None, None), (7, "", "en", "s", 0), (8, "dup " * 20_000, "en", "s", 0), (8, "dup " * 20_000, "en", "s", 0)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in ("part", "perplexity", "unit", "blob", "guard"):
        frame = frame.withColumn(c, F.lit("x"))
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")
    got = quality.classify(frame, labels)
    assert got.count() == len(rows) and got.where("perplexity is null").count() == 2
    stay = quality.kept(frame, labels)
    assert stay.columns == frame.columns and stay.count() == got.where("kept").count()
    assert {r["perplexity"] for r in stay.select("perplexity").distinct().collect()} == {"x"}


def test_top_k_of_large_components(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e17, 1e17]), (2, [1e30, -1.0]), (3, [-1e30, 5.0]), (4, [0.5, 0.25]), (100, [3e38, 3e38])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 10).collect()
    whole = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v in rows}
    for q in (0, 100):
        told = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(whole[q], v)))), i) for i, v in whole.items() if i != q)
        assert [(r["vec_id"], -r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [(i, s) for s, i in told]
