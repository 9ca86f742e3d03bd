"""Lines over splits, partitioned folders and first rows, on small files."""
from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from murmura.sources import lines, tables


@pytest.fixture()
def splits(spark):
    """Splits of a few dozen bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before.get("spark.sql.files.maxPartitionBytes", "128m"))
    spark.conf.set("spark.sql.files.openCostInBytes", before.get("spark.sql.files.openCostInBytes", "4m"))


def put(folder, **files: bytes):
    for name, content in files.items():
        (folder / name.replace("__", ".")).write_bytes(content)


def test_lines_over_splits(spark, tmp_path, splits):
    text = "".join(f"line {i}{' long' * (i % 9)}" + ("\r\n" if i % 4 else "\n") + ("\n" if i % 13 == 0 else "") for i in range(300))
    put(tmp_path, one__txt=("﻿" + text).encode(), two__txt=b"a\nb", three__txt=b"", four__txt=b"x\ry\n")
    got = lines.lines(spark, str(tmp_path), "*.txt")
    assert got.select(F.spark_partition_id()).distinct().count() > 20
    by: dict = {}
    for r in got.collect():
        by.setdefault(os.path.basename(r["path"]), []).append((r["number"], r["value"]))
    assert sorted(by["one.txt"]) == list(enumerate(x.removesuffix("\r") for x in text.split("\n")[:-1]))
    assert sorted(by["two.txt"]) == [(0, "a"), (1, "b")] and by["four.txt"] == [(0, "x\ry")] and "three.txt" not in by


def test_json_records(spark, tmp_path, splits):
    rows = "\n".join(["", json.dumps({"id": 1, "t": "ä" * 50}), "{broken", "[" + json.dumps({"id": 2}) + ", 5]", json.dumps({"id": 3}), "7", "  "])
    put(tmp_path, a__jsonl=rows.encode(), b__json=("﻿" + rows).encode(), c__json=json.dumps([{"id": 4}, 1, {"id": 5}], indent=1).encode(),
        d__json=json.dumps({"id": 6, "x": {"y": 1}}, indent=2).encode(), e__json=b'[{"id": 7}, {"id"', f__json=b'[{"id": 8}, {"id": 9}]', g__txt=b'{"id": 10}', h__json=b'{"id": 11}\n{"id": 12}')
    told = lambda legacy: sorted((os.path.basename(r["path"])[0], r["source_line"], r["id"]) for r in lines.json_records(spark, str(tmp_path), legacy).select(
        "path", "source_line", F.try_variant_get("record", "$.id", "int").alias("id")).collect())
    assert told(False) == [("a", 1, 1), ("a", 4, 3), ("b", 1, 1), ("b", 4, 3), ("c", 0, 4), ("c", 2, 5), ("d", 0, 6), ("f", 0, 8), ("f", 1, 9), ("h", 0, 11), ("h", 1, 12)]
    assert told(True) == [("a", 2, 1), ("a", 4, 2), ("a", 5, 3), ("b", 2, 1), ("b", 4, 2), ("b", 5, 3), ("c", 0, 4), ("c", 2, 5), ("d", 0, 6), ("f", 0, 8), ("f", 1, 9), ("h", 1, 11), ("h", 2, 12)]


def test_partitions_are_pruned(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") % 5).alias("shard"), F.when(F.col("id") % 2 == 0, "a b").alias("kind")).write.partitionBy("shard", "kind").parquet(f"{tmp_path}/t")
    rows = tables.hive(spark, f"{tmp_path}/t")
    assert dict(rows.dtypes) == {"id": "bigint", "shard": "string", "kind": "string"}
    some = rows.where("shard = '3' and kind = 'a b'")
    assert sorted(r["id"] for r in some.collect()) == [8, 18, 28, 38, 48, 58, 68, 78, 88, 98]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "shard" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows.where("kind is null").count() == 50


def test_mixed_folders(spark, tmp_path):
    for path, n in (("x/part=1/aspect=a", 2), ("x/part=2/aspect=b", 3), ("part=3", 4), ("", 5)):
        spark.range(n).coalesce(1).write.mode("append").parquet(f"{tmp_path}/m/{path}")
    got = {(r["part"], r["aspect"]): r["count"] for r in tables.hive(spark, f"{tmp_path}/m").groupBy("part", "aspect").count().collect()}
    assert got == {("1", "a"): 2, ("2", "b"): 3, ("3", None): 4, (None, None): 5}
    for path, n in (("part=3", 4), ("", 5)):
        spark.range(n).coalesce(1).write.mode("append").parquet(f"{tmp_path}/n/{path}")
    assert {r["part"]: r["count"] for r in tables.hive(spark, f"{tmp_path}/n").groupBy("part").count().collect()} == {"3": 4, None: 5}


@pytest.mark.parametrize("n", [0, 1, 7, 10, 11, 35, 1000])
def test_first_rows(spark, tmp_path, n):
    where = f"{tmp_path}/f"
    for i, size in enumerate((10, 0, 25)):
        spark.range(size).select((F.col("id") + 100 * i).alias("id")).coalesce(1).write.mode("append").parquet(where)
    files = sorted(f for f in os.listdir(where) if f.endswith(".parquet"))
    every = [r["id"] for f in files for r in spark.read.parquet(f"{where}/{f}").collect()]
    assert sorted(r["id"] for r in tables.first_rows(spark.read.parquet(where), n).collect()) == sorted(every[:n])


def test_days(spark, tmp_path):
    path = f"{tmp_path}/days"
    frame = lambda rows: spark.createDataFrame(rows, "date string, n int")
    first = [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3), ("2024-02-01", 4), (None, 5)]
    tables.load_days(spark, path, frame(first))
    told = lambda: sorted(((r["date"], r["n"]) for r in tables.days(spark, path).collect()), key=str)
    assert told() == sorted(first, key=str)
    stamps = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if "=" in d}
    for _ in range(2):
        tables.load_days(spark, path, frame([("2024-01-01", 10), ("2024-01-03", 30), ("2024-01-03", 31)]))
        assert told() == sorted([("2024-01-01", 10), ("2024-01-03", 30), ("2024-01-03", 31), ("2024-02-01", 4), (None, 5)], key=str)
    after = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if "=" in d}
    assert after["date=2024-02-01"] == stamps["date=2024-02-01"] and "date=2024-01-02" not in after
    assert after["date=2024-01-01"] != stamps["date=2024-01-01"]
    tables.load_days(spark, path, frame([]))
    assert len(told()) == 5


def test_step_log(spark, tmp_path):
    from murmura.sources import steplog

    src, log, out = f"{tmp_path}/in", f"{tmp_path}/log", f"{tmp_path}/out"
    spark.range(100).coalesce(1).write.parquet(src)
    rows = spark.read.parquet(src)
    assert steplog.stale(spark, log, "a", [src])
    made = steplog.logged(rows, "a", out, log, [src], {"even": F.col("id") % 2 == 0})
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert (made["rows"], made["counts"], made["output_files"]) == (100, {"even": 50}, len(parts))
    assert made["output_bytes"] == sum(os.path.getsize(f"{out}/{f}") for f in parts)
    told = steplog.records(spark, log).collect()
    assert [(r["step"], r["status"], r["rows"], r["counts"]["even"]) for r in told] == [("a", "done", 100, 50)]
    import hashlib

    data = [f for f in os.listdir(src) if f.startswith("part-")]
    assert {(os.path.basename(i["path"]), i["size"], i["sha256"]) for i in told[0]["inputs"] if "part-" in i["path"]} >= {
        (f, os.path.getsize(f"{src}/{f}"), hashlib.sha256(open(f"{src}/{f}", "rb").read()).hexdigest()) for f in data}
    assert not steplog.stale(spark, log, "a", [src]) and steplog.stale(spark, log, "b", [src])
    with pytest.raises(Exception, match="broken"):
        steplog.logged(rows.select(F.when(F.col("id") == 50, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id")), "b", out, log)
    assert {(r["step"], r["status"]) for r in steplog.records(spark, log).collect()} == {("a", "done"), ("b", "failed")}
    assert steplog.stale(spark, log, "b", [src])
    spark.range(5).coalesce(1).write.mode("append").parquet(src)
    assert steplog.stale(spark, log, "a", [src])
