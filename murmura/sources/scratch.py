"""Tables in the folder that driver and executors share: they cut lineage and survive lost executors."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of this machine's own only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        folder = _own[app] = _own.get(app) or f"file://{tempfile.mkdtemp(prefix='murmura-')}"
    return folder.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in a folder that goes when the application ends."""
    own = f"{shared(spark)}/murmura-tables/{spark.sparkContext.applicationId}"
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
    """Writes df as Parquet and reads it again."""
    path = fresh(df.sparkSession, name)
    with cleaned(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
