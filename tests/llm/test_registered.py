"""Registered queries: those with SQL against DuckDB, and the pipeline against brute force."""
from __future__ import annotations

import os

import duckdb
import pytest

from murmura.llm import queries, stages, suffix_dedup
from tests.llm.test_operators import near, removed

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    made = queries.QUERIES[name](spark, SF).toPandas()
    told = con.sql(queries.ORACLE_SQL[name]).df()[list(made.columns)]
    keys = list(made.columns)
    a, b = (x.sort_values(keys).reset_index(drop=True).round(9) for x in (made, told))
    a, b = (x.astype(object).where(x.notna(), None) for x in (a, b))
    for c in keys:
        assert a[c].tolist() == b[c].tolist(), c


def test_every_operator_is_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")] == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = stages.drop_unlikely(spark, docs, SF)
    assert clean.columns == docs.columns and 0.7 * docs.count() < clean.count() <= docs.count()
    rows = [tuple(r) for r in clean.collect()]
    single = stages.drop_near_duplicates(spark, clean, SF)
    want, _ = near(rows, 5, 80)
    assert {r["doc_id"] for r in single.collect()} == {i for i, c in want.items() if i == c}
    rows = [tuple(r) for r in single.collect()]
    told = {i: (n, g) for i, (n, g, *_) in removed(rows).items()}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in suffix_dedup.removed_spans(single).collect()}
    assert got == told
    cut = stages.cut_repeats(spark, single, SF)
    for r in cut.collect():
        kept, (n, gone) = len((r["text"] or "").encode()), told[r["doc_id"]]
        assert n - gone <= kept <= n
    packed = stages.pack(spark, cut, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in rows}
    assert stages.run(spark, docs, SF).count() == packed.count()
