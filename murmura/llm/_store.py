"""Shared scratch folder and tables that cut lineage.

A task's number is no unique number: a caller may coalesce what an operator returns, and one task then runs the function
over several partitions. Operators that number what they make take spark_partition_id() as a column of their input, which
tells these partitions apart, or a name drawn within the call."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir as a URI, or a local one where it is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = _own.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="murmura-")
        _own[spark.sparkContext.applicationId] = folder
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toUri().toString()
    return ("file:///" + uri[len("file:/") :].lstrip("/") if uri.startswith("file:/") else uri).rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A new path below the scratch folder, in a folder that goes when the application ends."""
    own = f"{scratch(spark)}/murmura/{spark.sparkContext.applicationId}"
    where = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        files.mkdirs(where)
        files.deleteOnExit(where)
    return f"{own}/{name}-{uuid.uuid4().hex}"


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files behind; Spark else keeps them until its driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def table(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the scratch folder as Parquet and reads it again: a lost executor costs no recomputation."""
    path = fresh(df.sparkSession, name)
    with cleaned(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes a table made by table()."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
