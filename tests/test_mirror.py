"""Parts that mirror row groups: commit, abort and runs that go on."""
from __future__ import annotations

import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from murmura.sources import mirror


@pytest.fixture()
def source(tmp_path):
    for name, begin, n in (("a/x", 0, 250), ("b", 1000, 90), ("a/empty", 0, 0)):
        os.makedirs(os.path.dirname(f"{tmp_path}/in/{name}"), exist_ok=True)
        ids = list(range(begin, begin + n))
        pq.write_table(pa.table({"id": pa.array(ids, pa.int64()), "t": pa.array([f"t{i}" for i in ids], pa.string())}), f"{tmp_path}/in/{name}.parquet", row_group_size=100)
    return f"{tmp_path}/in"


def twice(rows):
    return rows.select((F.col("id") * 2).alias("twice"), mirror.FILE, mirror.GROUP)


def parts(target):
    return sorted(os.path.relpath(f, target) for f in glob.glob(f"{target}/**/*.parquet", recursive=True))


def test_row_groups(spark, source):
    got = {(r[mirror.FILE].rpartition("/in/")[2], r[mirror.GROUP], r["rows"]) for r in mirror.row_groups(spark, source).collect()}
    assert got - {("a/empty.parquet", 0, 0)} == {("a/x.parquet", 0, 100), ("a/x.parquet", 1, 100), ("a/x.parquet", 2, 50), ("b.parquet", 0, 90)}


@pytest.mark.parametrize("codec", ["zstd", "none"])
def test_mirror(spark, source, tmp_path, codec):
    target = f"{tmp_path}/out"
    assert mirror.run(spark, source, target, twice, codec) >= 4
    want = ["a/x/rg-00000.parquet", "a/x/rg-00001.parquet", "a/x/rg-00002.parquet", "b/rg-00000.parquet"]
    assert parts(target) == want
    told = {r["file"]: (r["rows"], r["bytes"]) for r in mirror.manifest(spark, target).collect()}
    assert told == {f: (pq.read_metadata(f"{target}/{f}").num_rows, os.path.getsize(f"{target}/{f}")) for f in want}
    assert pq.read_table(f"{target}/b/rg-00000.parquet")["twice"].to_pylist() == [2 * i for i in range(1000, 1090)]
    kind = pq.ParquetFile(f"{target}/{want[0]}").metadata.row_group(0).column(0).compression
    assert kind == {"zstd": "ZSTD", "none": "UNCOMPRESSED"}[codec]
    assert spark.read.option("recursiveFileLookup", "true").parquet(target).count() == 340
    stamps = {f: os.stat(f"{target}/{f}").st_mtime_ns for f in want}
    assert mirror.run(spark, source, target, twice) <= 1  # the empty row group, of which nothing is kept
    assert {f: os.stat(f"{target}/{f}").st_mtime_ns for f in want} == stamps and len(os.listdir(f"{target}/_manifest")) == 1 + (codec == "")


def test_failed_runs_leave_nothing(spark, source, tmp_path):
    target = f"{tmp_path}/out"
    broken = lambda rows: twice(rows.withColumn("id", F.when(F.col("id") == 1050, F.raise_error(F.lit("died")).cast("long")).otherwise(F.col("id"))))
    with pytest.raises(Exception, match="died"):
        mirror.run(spark, source, target, broken)
    assert parts(target) == [] and mirror.manifest(spark, target).count() == 0
    with pytest.raises(Exception, match="died"):
        mirror.run(spark, source, target, broken, batches=8)  # what was committed before stays
    before = parts(target)
    assert "b/rg-00000.parquet" not in before and mirror.manifest(spark, target).count() == len(before)
    read = []

    def seen(rows):
        read.append(rows.select(mirror.FILE, mirror.GROUP).distinct().count())
        return twice(rows)

    mirror.run(spark, source, target, seen)
    assert sum(read) == 4 - len(before) and len(parts(target)) == 4
    assert not os.path.exists(f"{target}/_tmp") or not os.listdir(f"{target}/_tmp")


def test_moved_rows_are_refused(spark, source, tmp_path):
    with pytest.raises(Exception, match="several tasks"):
        mirror.run(spark, source, f"{tmp_path}/out", lambda rows: twice(rows).repartition(3))
    assert parts(f"{tmp_path}/out") == []
    with pytest.raises(Exception, match="codec"):
        mirror.run(spark, source, f"{tmp_path}/out", twice, "lzma")


def test_row_groups_are_dealt(spark, tmp_path):
    """Row groups go to several tasks, though a table of their places is small."""
    rows = spark.range(4000)
    rows.repartition(8).write.parquet(str(tmp_path / "in"))
    groups = mirror.row_groups(spark, str(tmp_path / "in"))
    seen = []

    def step(df):
        seen.append(df.rdd.getNumPartitions())
        return df

    assert mirror.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), step) == groups.count() == 8 and seen == [8]
