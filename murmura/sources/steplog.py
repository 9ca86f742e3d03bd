"""A log of steps: what a step read and wrote, counted while it wrote.

Row counts come from an Observation of the write itself, so no table is read again for them. Input files are listed with
sizes and times, and hashed by their first bytes on the executors. A record is a file of its own in the log, committed by
Spark, so records are added without reading or rewriting what is there.
"""
from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from murmura.sources.mirror import _system

#: Bytes at a file's begin that its hash covers.
HEAD = 1 << 20
SCHEMA = """step string, status string, rows long, counts map<string,long>, seconds double, output string, output_files long, output_bytes long,
inputs array<struct<path:string,size:long,modified:string,sha256:string>>, error string"""


def _heads(head: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = []
            for path in batch.column("path").to_pylist():
                files, where = _system(path)
                with files.open_input_file(where) as f:
                    told.append(hashlib.sha256(f.read(head)).hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(told, pa.string())], ["path", "size", "modified", "sha256"])

    return run


def fingerprints(spark: SparkSession, paths: list[str], head: int = HEAD) -> DataFrame:
    """path, size, modified, sha256 (of the first bytes) of every file below the paths."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return read.select("path", F.col("length").alias("size"), F.col("modificationTime").cast("string").alias("modified")).mapInArrow(
        _heads(head), "path string, size long, modified string, sha256 string")


def _add(spark: SparkSession, log: str, record: dict) -> None:
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("append").text(log)


def logged(df: DataFrame, step: str, output: str, log: str, inputs: list[str] | None = None, counts: dict[str, Column] | None = None, head: int = HEAD) -> dict:
    """Writes df as Parquet and adds a record of the step to the log; the record.

    counts: conditions whose rows are counted by name in passing. A step that fails has a record too, with its error, and
    the error is raised again."""
    spark = df.sparkSession
    seen = Observation(step)
    known = list((counts or {}).items())
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count(F.when(c, 1)).alias(f"c{i}") for i, (_, c) in enumerate(known)))
    record = {"step": step, "output": output, "inputs": [r.asDict() for r in fingerprints(spark, inputs, head).orderBy("path").collect()] if inputs else []}
    began = time.time()
    try:
        watched.write.mode("overwrite").option("compression", "zstd").parquet(output)
    except Exception as e:
        _add(spark, log, record | {"status": "failed", "seconds": round(time.time() - began, 3), "error": str(e).splitlines()[0][:500]})
        raise
    told = seen.get
    where = spark._jvm.org.apache.hadoop.fs.Path(output)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [f for f in files.listStatus(where) if f.getPath().getName().startswith("part-")]
    record |= {
        "status": "done", "rows": told["rows"], "counts": {n: told[f"c{i}"] for i, (n, _) in enumerate(known)}, "seconds": round(time.time() - began, 3),
        "output_files": len(parts), "output_bytes": sum(f.getLen() for f in parts)}
    _add(spark, log, record)
    return record


def records(spark: SparkSession, log: str) -> DataFrame:
    """Every record of the log; a step that ran several times has several."""
    return spark.read.text(log).select(F.from_json("value", SCHEMA).alias("r")).select("r.*")


def stale(spark: SparkSession, log: str, step: str, inputs: list[str], head: int = HEAD) -> bool:
    """Whether a step has to run: it has no record that is done with the same input files."""
    try:
        done = records(spark, log).where((F.col("step") == step) & (F.col("status") == "done"))
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return True
        raise
    now = sorted((r["path"], r["size"], r["sha256"]) for r in fingerprints(spark, inputs, head).collect())
    return all(sorted((i["path"], i["size"], i["sha256"]) for i in r["inputs"]) != now for r in done.select("inputs").collect())
