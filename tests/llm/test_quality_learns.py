"""the model of op9 learns from every trusted text that isn't held back for thresholds."""
from __future__ import annotations

from pyspark.sql import functions as F

from murmura.llm import quality


def test_learns_from_all(spark, monkeypatch):
    n, seen = 30_000, []
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
    monkeypatch.setattr(quality, "train", lambda texts: seen.append(texts.count()))
    quality.fit(docs, docs.select("doc_id", F.lit(1).alias("quality")))
    assert seen == [docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(5)) != 0).count()] and seen[0] > 20_000


def test_packed_ngrams():
    """What is shuffled of an n-gram are its symbols in two numbers and a count; the hashes of all its parts come from these."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    from murmura.llm import quality

    texts = ["abcab\U0010ffff屏é", "", "ab", "abcabc"]
    raw = [x.encode() for x in texts]
    off = np.cumsum([0, *map(len, raw)])
    full, place, _ = quality.symbols(np.frombuffer(b"".join(raw), np.uint8), off)
    made = list(quality._count(iter([pa.record_batch({"text": texts})])))
    assert made[0].schema.names == ["high", "low", "c"] and sum(pc.sum(x["c"]).as_py() for x in made) == len(place)
    want = {tuple(x) for x in quality.grams(full, place).T.tolist()}
    for n in range(1, quality.ORDER + 1):
        got = next(quality._coded(n)(iter(made)))
        assert set(got["code"].to_pylist()) == {x[n - 1] for x in want}
        if n > 1:
            assert set(zip(*(got[c].to_pylist() for c in ("code", "below", "context")))) == {(x[n - 1], x[n - 2], x[quality.ORDER + n - 2]) for x in want}
