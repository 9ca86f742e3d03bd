"""Results that mirror their input files: a part for each row group, committed as a whole, and runs that go on where they ended.

Footers make a table of row groups; those that the manifest names are done, and only the others are read. A part is
written beside its place; when all tasks of a batch have ended well the driver moves the parts and then adds a file to the
manifest. A task that dies, or one that runs twice, leaves nothing but a file in a folder that goes with the batch.

Files are opened with pyarrow, so both folders must be on a file system that it knows.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pf
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructType

from murmura.sources.scratch import table

#: Columns that tell which row group a row comes from.
FILE, GROUP = "source_file", "source_group"
#: Codecs that a part may have.
CODECS = ("zstd", "snappy", "gzip", "none")


def _system(uri: str) -> tuple[pf.FileSystem, str]:
    return pf.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            files, where = _system(path)
            with files.open_input_file(where) as f:
                told = pq.ParquetFile(f).metadata
            groups = [told.row_group(i) for i in range(told.num_row_groups)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(groups)), pa.array(range(len(groups)), pa.int32()), pa.array([g.num_rows for g in groups], pa.int64()), pa.array([g.total_byte_size for g in groups], pa.int64())],
                [FILE, GROUP, "rows", "bytes"])


def row_groups(spark: SparkSession, source: str) -> DataFrame:
    """source_file, source_group, rows, bytes of every row group below a folder, from the footers alone, read in parallel."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(source)
    return read.select("path").mapInArrow(_footers, f"{FILE} string, {GROUP} int, rows long, bytes long")


def read_groups(groups: DataFrame, schema: StructType, tasks: int | None = None) -> DataFrame:
    """The rows of the given row groups with source_file and source_group, in batches of bounded size."""
    names = schema.fieldNames()
    wanted = to_arrow_schema(schema, timestamp_utc=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, group in zip(batch.column(FILE).to_pylist(), batch.column(GROUP).to_pylist()):
                files, where = _system(path)
                with files.open_input_file(where) as f:
                    for rows in pq.ParquetFile(f).iter_batches(batch_size=8192, row_groups=[group], columns=names):
                        own = pa.Table.from_batches([rows]).select(names).cast(wanted)
                        n = own.num_rows
                        own = own.append_column(FILE, pa.array([path] * n, pa.string())).append_column(GROUP, pa.array([group] * n, pa.int32()))
                        yield from own.combine_chunks().to_batches()

    told = StructType([*schema.fields]).add(FILE, StringType()).add(GROUP, IntegerType())
    dealt = groups.select(FILE, GROUP)
    dealt = dealt.repartition(tasks, FILE, GROUP) if tasks else dealt.repartition(FILE, GROUP)
    return dealt.mapInArrow(run, told)


def tasks(spark: SparkSession, groups: int) -> int:
    """Tasks for so many row groups. A table of their places is so small that Spark would give all of them to one task if it weren't told."""
    return max(1, min(groups, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)))


@dataclass
class Parts(WriterCommitMessage):
    """What a task has written: source file, row group, rows, place to be, and the file as it is now."""

    found: list[tuple[str, int, int, str, str]]


class MirrorWriter(DataSourceArrowWriter):
    """Writes a Parquet file for each row group that the rows come from."""

    def __init__(self, source: str, target: str, codec: str) -> None:
        self.source, self.target, self.codec, self.run = source.rstrip("/"), target.rstrip("/"), codec, uuid.uuid4().hex

    def place(self, path: str, group: int) -> str:
        """The part's path below the target."""
        below = _system(path)[1].removeprefix(_system(self.source)[1].rstrip("/") + "/")
        return f"{below.removesuffix('.parquet')}/rg-{group:05d}.parquet"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        files, root = _system(self.target)
        opened: dict[tuple[str, int], list] = {}
        try:
            for batch in iterator:
                keys = list(zip(batch.column(FILE).to_pylist(), batch.column(GROUP).to_pylist()))
                own = batch.select([c for c in batch.schema.names if c not in (FILE, GROUP)])
                ends = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
                for a, b in zip(ends, ends[1:]):
                    if a == b:
                        continue
                    if keys[a] not in opened:
                        beside = f"{root}/_tmp/{self.run}/{uuid.uuid4().hex}.parquet"
                        files.create_dir(beside.rpartition("/")[0], recursive=True)
                        opened[keys[a]] = [pq.ParquetWriter(beside, own.schema, filesystem=files, compression=self.codec), 0, beside]
                    opened[keys[a]][0].write_batch(own.slice(a, b - a))
                    opened[keys[a]][1] += b - a
        finally:
            for out, _, _ in opened.values():
                out.close()
        return Parts([(path, group, rows, self.place(path, group), beside) for (path, group), (_, rows, beside) in opened.items()])

    def commit(self, messages: list[Parts | None]) -> None:
        files, root = _system(self.target)
        parts = [p for m in messages if m for p in m.found]
        if len({p[3] for p in parts}) < len(parts):
            self.abort(messages)
            raise ValueError("rows of a row group came from several tasks; the step must not move rows")

        def settle(part: tuple[str, int, int, str, str]) -> str:
            path, group, rows, place, beside = part
            files.create_dir(f"{root}/{place}".rpartition("/")[0], recursive=True)
            size = files.get_file_info(beside).size
            files.move(beside, f"{root}/{place}")
            return json.dumps({FILE: path, GROUP: group, "rows": rows, "file": place, "bytes": size})

        with ThreadPoolExecutor(16) as pool:  # calls to a file system wait for it
            lines = list(pool.map(settle, parts))
        if lines:
            beside = f"{root}/_tmp/{self.run}/manifest.json"
            with files.open_output_stream(beside) as out:
                out.write("\n".join(lines).encode())
            files.create_dir(f"{root}/_manifest", recursive=True)
            files.move(beside, f"{root}/_manifest/{self.run}.json")
        self.abort(messages)

    def abort(self, messages: list[Parts | None]) -> None:
        files, root = _system(self.target)
        if files.get_file_info(f"{root}/_tmp/{self.run}").type != pf.FileType.NotFound:
            files.delete_dir(f"{root}/_tmp/{self.run}")


class MirrorSource(DataSource):
    """Sink `mirror`: options source, target and codec."""

    @classmethod
    def name(cls) -> str:
        return "mirror"

    def writer(self, schema: StructType, overwrite: bool) -> MirrorWriter:
        codec = self.options.get("codec", "zstd").lower()
        if codec not in CODECS:
            raise ValueError(f"a codec is one of {', '.join(CODECS)}")
        return MirrorWriter(self.options["source"], self.options["target"], codec)


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """source_file, source_group, rows, file, bytes of every part that has been committed."""
    schema = f"{FILE} string, {GROUP} int, rows long, file string, bytes long"
    files, root = _system(target)
    if files.get_file_info(f"{root}/_manifest").type == pf.FileType.NotFound:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{target.rstrip('/')}/_manifest")


def run(spark: SparkSession, source: str, target: str, step: Callable[[DataFrame], DataFrame], codec: str = "zstd", batches: int = 1, schema: StructType | None = None) -> int:
    """Applies a step to every row group below source that the target doesn't have yet; the number of row groups it read.

    The step gets the rows (of the given columns, or all) with source_file and source_group, keeps both, and doesn't move
    rows between tasks. Row groups are dealt by hash into batches, each committed as a whole. A row group of which the step
    keeps nothing has no part, and is read again by the next run; so is one whose part was taken from the manifest."""
    spark.dataSource.register(MirrorSource)
    schema = schema or spark.read.option("recursiveFileLookup", "true").parquet(source).schema
    # Footers are read once a run, for the questions and the batches.
    opened = table(row_groups(spark, source).join(manifest(spark, target), [FILE, GROUP], "left_anti").select(FILE, GROUP), "opened")
    count = 0
    for i in range(batches):
        part = opened.where(F.pmod(F.xxhash64(FILE, GROUP), F.lit(batches)) == i)
        n = part.count()
        if n:
            step(read_groups(part, schema, tasks(spark, n))).write.format("mirror").option("source", source).option("target", target).option("codec", codec).mode("append").save()
            count += n
    return count
