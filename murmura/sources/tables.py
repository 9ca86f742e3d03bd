"""Tables: scans with several layouts, lexicon files, and sinks."""
from __future__ import annotations

import json
from pathlib import PurePosixPath

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmura.operators.lexicon import SCHEMA
from murmura.sources.scratch import table

#: The largest table that goes into one sheet.
SHEET_ROWS = 1_000_000


def predictions(spark: SparkSession, root: str) -> DataFrame:
    """Predictions below a folder: sharded, flat, or in any depth, whichever is there first."""
    for pattern in ("shard=*/part-*", "shard=*/pred.parquet", "*.parquet"):
        try:
            return spark.read.option("basePath", root).parquet(f"{root}/{pattern}")
        except AnalysisException:
            continue
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(root)


def hive(spark: SparkSession, root: str, depth: int = 6) -> DataFrame:
    """Every Parquet file below a folder, with the columns that name=value folders stand for, as text.

    Where all files lie in folders of the same names, these are Spark's own partitions: files are listed in parallel, and a
    filter or a join on such a column leaves files unopened. Folders may also mix plain names and name=value; then each
    level is a glob, values come from the paths, and files in fewer folders have nulls for the rest."""
    try:
        rows, inside = spark.read.parquet(root), spark.read.option("recursiveFileLookup", "true").parquet(root).columns
        named = {c for c in rows.columns if c not in inside}
        # Spark would leave out files beside partition folders.
        if named and not _any(spark, f"{root}/*.parquet"):
            return rows.select(*(F.col(c).cast("string").alias(c) if c in named else F.col(c) for c in rows.columns))
    except (AnalysisException, SparkRuntimeException, Py4JJavaError):  # folders that Spark can't read as partitions
        pass
    found: DataFrame | None = None
    for n in range(depth + 1):
        try:
            part = spark.read.parquet(root + "/*" * n + "/*.parquet")
        except AnalysisException:
            continue
        path = F.col("_metadata.file_path")
        # The names are looked for on the executors; a row for each comes back.
        names = part.select(F.explode(F.regexp_extract_all(path, F.lit("/([^/=]+)=[^/]*(?=/)"), F.lit(1))).alias("name"), path.alias("p")).where(
            F.expr(f"array_contains(slice(split(p, '/'), -{n + 1}, {n}), concat(name, '=', regexp_extract(p, concat('/', name, '=([^/]*)/'), 1)))") if n else F.lit(False))
        for name in sorted({r["name"] for r in names.select("name").distinct().collect()} - {c.lower() for c in part.columns}):
            value = F.nullif(F.url_decode(F.regexp_extract(path, f"/{name}=([^/]*)/", 1)), F.lit("__HIVE_DEFAULT_PARTITION__"))
            part = part.withColumn(name, F.nullif(value, F.lit("")))
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    if found is None:
        raise FileNotFoundError(f"no Parquet file below {root}")
    return found


def _any(spark: SparkSession, pattern: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return len(where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or []) > 0


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first n rows in the order of files and of their places in these; the rows come in any order.

    How many rows a Parquet file has stands in its footer, so counting them by file reads no column. Files beyond those
    that hold the first n rows aren't opened again."""
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    counts = df.groupBy(path.alias("path")).agg(F.count("*").alias("n"))
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    held = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("start") < n).orderBy("path").collect()  # files, at most n
    if not held:
        return df.limit(0)
    *whole, last = held
    kept = (path == last["path"]) & (place < n - last["start"])
    return df.where(path.isin([r["path"] for r in held]) & (path.isin([r["path"] for r in whole]) | kept if whole else kept))


def columns_of(spark: SparkSession, path: str) -> dict[str, str]:
    """Names and types, without reading rows."""
    return dict(spark.read.parquet(path).dtypes)


# What a manifest calls the path of a file.
MANIFEST_KEYS = ("path", "file", "filepath", "relpath", "uri", "parquet", "part")


def manifest_files(spark: SparkSession, manifest: str, root: str) -> DataFrame:
    """The distinct Parquet files that a manifest names, by a key of an object a line or by the line itself; relative ones are below root."""
    line = F.trim("value")
    record = F.try_parse_json(line)
    named = F.coalesce(*(F.nullif(F.try_variant_get(record, f"$.{k}", "string"), F.lit("")) for k in MANIFEST_KEYS), line)
    path = F.when(named.rlike("^([a-z]+:)?/"), named).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), named))
    rows = spark.read.text(manifest).where(line != "").select(F.regexp_replace(path, "^[a-z]+:/+", "/").alias("path"))
    return rows.where(F.lower("path").endswith(".parquet")).distinct()


def reconciled(spark: SparkSession, manifest: str, root: str) -> DataFrame:
    """One row: files and rows that the manifest names and that are there, those that the folder has, and whether they agree."""
    here = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(root).select(F.regexp_replace(F.col("_metadata.file_path"), "^[a-z]+:/+", "/").alias("path"))
    counts = here.groupBy("path").agg(F.count("*").alias("n"))
    both = counts.join(manifest_files(spark, manifest, root).withColumn("named", F.lit(1)), "path", "left")
    return both.agg(
        F.count("named").alias("manifest_files"), F.coalesce(F.sum(F.col("n") * F.col("named")), F.lit(0)).alias("manifest_rows"),
        F.count("*").alias("folder_files"), F.coalesce(F.sum("n"), F.lit(0)).alias("folder_rows")).withColumn(
        "agree", F.col("manifest_rows") == F.col("folder_rows"))


def folders(spark: SparkSession, root: str) -> list[str]:
    """The names of the folders in a folder, sorted."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(where) if f.isDirectory())


def latest_run(spark: SparkSession, runs: str) -> str:
    """The path of the run whose name sorts last."""
    names = folders(spark, runs)
    if not names:
        raise FileNotFoundError(f"no run below {runs}")
    return f"{runs.rstrip('/')}/{names[-1]}"


def empty_files(spark: SparkSession, root: str) -> int:
    """Parquet files of no bytes below a folder; only their listing is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return found.where("length = 0").select("path").count()


def lexicon(spark: SparkSession, spec: dict, domain: str) -> DataFrame:
    """A lexicon of either dialect as a table; aliases of an l1 are terms of its virtual l2 _L1.

    {"aspects": [{"l1": .., "l2": {name: [terms]}}]} or {"l1": [{"name": .., "aliases": [..], "l2": [{"name": .., "terms": [..]}]}]}"""
    rows: list[tuple] = []
    for group in spec.get("aspects") or []:
        for l2, terms in (group.get("l2") or {}).items():
            rows += [(domain, group.get("l1") or "unnamed", l2, str(t)) for t in terms or []]
    for group in spec.get("l1") or []:
        name = group.get("name") or "unnamed"
        rows += [(domain, name, "_L1", str(t)) for t in group.get("aliases") or []]
        for part in group.get("l2") or []:
            rows += [(domain, name, part.get("name") or "unnamed", str(t)) for t in part.get("terms") or []]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA)


def lexicon_files(spark: SparkSession, folder: str) -> DataFrame:
    """Terms of text files named L1__L2.txt, one a line; # begins a comment."""
    read = spark.read.text(folder, pathGlobFilter="*__*.txt").withColumn("name", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.txt$", 1))
    term = F.trim(F.regexp_replace("value", "#.*$", ""))
    return read.select(F.split("name", "__")[0].alias("l1"), F.split("name", "__")[1].alias("l2"), term.alias("term")).where(F.col("term") != "").distinct()


def word_set(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed lines."""
    return spark.read.text(path).select(F.trim("value").alias("term")).where((F.col("term") != "") & ~F.col("term").startswith("#")).distinct()


def write(df: DataFrame, path: str, *by: str) -> None:
    """A zstd Parquet table, partitioned; rows of a partition come from few tasks."""
    out = df.repartition(*by) if by else df
    writer = out.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_pair(df: DataFrame, path: str) -> None:
    """The same table as Parquet and as CSV with a byte order mark in its header, which spreadsheets look for."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}.parquet")
    header = [F.col(f"`{c}`").alias(("\ufeff" if i == 0 else "") + c) for i, c in enumerate(df.columns)]
    df.select(*header).write.mode("overwrite").option("header", "true").csv(f"{path}.csv")


def write_text(spark: SparkSession, path: str, content: str, append: bool = False) -> None:
    """A small side file in one step: written beside its place and renamed; append keeps what is there."""
    jvm = spark._jvm
    where, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    before = "\n".join(r[0] for r in spark.read.text(path).collect()) if append and files.exists(where) else ""
    out = files.create(beside, True)
    out.write(bytearray((f"{before}\n" if before else "").encode() + content.encode()))
    out.close()
    files.delete(where, False)
    files.rename(beside, where)


def write_sheet(df: DataFrame, path: str) -> bool:
    """A CSV table with a header, unless it is larger than a sheet may be."""
    if df.limit(SHEET_ROWS + 1).count() > SHEET_ROWS:
        return False
    df.write.mode("overwrite").option("header", "true").csv(path)
    return True


def write_json(df: DataFrame, path: str, key: str) -> None:
    """Lines of one object each: the key and the row below it."""
    df.select(F.to_json(F.struct(F.col(key), F.struct("*").alias("value"))).alias("value")).write.mode("overwrite").text(path)


def publish(tables: dict[str, DataFrame], root: str, stamp: str) -> None:
    """A snapshot of tables, and a pointer that names it once all are written."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{stamp}/{name}")
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame([(json.dumps({"latest": stamp, "tables": sorted(tables)}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/latest")


def latest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the snapshot that the pointer names."""
    stamp = json.loads(spark.read.text(f"{root}/latest").first()[0])["latest"]
    return spark.read.parquet(f"{root}/{stamp}/{name}")


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def load_range(spark: SparkSession, root: str, new: DataFrame) -> None:
    """Loads days into a serving table in place of those that it has for the same range; a second load changes nothing.

    The new version is written beside the old one and the pointer moves last."""
    from murmura.operators.serving import replace_range

    try:
        old = latest(spark, root, "daily_stats")
        stamp = str(int(json.loads(spark.read.text(f"{root}/latest").first()[0])["latest"]) + 1)
    except AnalysisException:
        old, stamp = new.limit(0), "1"
    publish({"daily_stats": replace_range(old, new)}, root, stamp)


def load_days(spark: SparkSession, path: str, new: DataFrame, day: str = "date") -> None:
    """Loads days into a table of a folder for each day, in place of all that it has from the first to the last new day.

    Spark stages the new days and moves each over the old one; then the days go that lie in between and have no new rows.
    Other days' files aren't touched, and a load that is done twice changes nothing. A null day is a folder of its own,
    which is replaced where there are new rows for it."""
    new = table(new, "days")  # asked three times
    ends = new.agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    if files.exists(where) and ends["a"] is not None:
        old = days(spark, path, day).select(day).distinct().where(F.col(day).between(ends["a"], ends["b"]))
        gone = [r[0] for r in old.join(new.select(day).distinct(), day, "left_anti").collect()]  # days of the range
    new.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(day).parquet(path)
    for x in gone:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(where, f"{day}={x}"), True)


def days(spark: SparkSession, path: str, day: str = "date") -> DataFrame:
    """The table of days; a filter on the day opens only its files."""
    rows = spark.read.parquet(path)
    return rows.withColumn(day, F.col(day).cast("string"))


def domain_of(path: str, df: DataFrame | None = None, given: str | None = None) -> str:
    """The domain: given, or after outputs/ in the path, or the first that the rows name."""
    parts = PurePosixPath(path).parts
    if given:
        return given
    if "outputs" in parts[:-1]:
        return parts[parts.index("outputs") + 1]
    row = df.select("domain").where(F.col("domain").isNotNull()).first() if df is not None and "domain" in df.columns else None
    return row[0] if row else "domain"
