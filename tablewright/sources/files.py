"""File listings and small file-system helpers, through the Hadoop file system Spark itself uses."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import reduce

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.text import path_extension, size_mb, table_name

_scratch: list[str] = []
FOLLOWED = 10_000  # entries that one task lists before it leaves folders to others
TABLE_FOLDER = r"[^/]+\.(?i:csv|json|parquet)"
CONTENT = ("length", "lines", "sum1", "sum2")
HIDDEN = r"(^|/)(\.|_(?![^/]*=))"  # fixed value: the names that Spark's readers pass over


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    fs, target = _hadoop(spark, path)
    return fs.makeQualified(target).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder."""
    fs, target = _hadoop(spark, path)
    return [e.getPath().getName() for e in fs.listStatus(target) if e.isDirectory()] if fs.exists(target) else []


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, target = _hadoop(spark, path)
    return fs.getContentSummary(target).getLength()


def scratch_path(spark: SparkSession, label: str, extension: str = "") -> str:
    """A new path in the shared folder named by `spark.checkpoint.dir`, removed by `clear_scratch` or when Spark ends.

    Only where that setting is absent, on one machine, a local temporary folder serves.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.gettempdir()
    path = f"{base.rstrip('/')}/tablewright-{label}-{uuid.uuid4().hex}{extension}"
    fs, target = _hadoop(spark, path)
    fs.deleteOnExit(target)
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete what was written to scratch paths so far; results that have not been read or written yet become unreadable."""
    while _scratch:
        remove_path(spark, _scratch.pop())


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder once, for steps that read them several times."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _arrow_store(root: str) -> tuple[arrow_fs.FileSystem, str]:
    """Arrow's file system for a folder, and the folder's path in it."""
    local = re.sub(r"^file:/+", "/", root)
    if local.startswith("/"):
        return arrow_fs.LocalFileSystem(), local
    return arrow_fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", root))


def _readable_by_arrow(root: str) -> bool:
    try:
        store, base = _arrow_store(root)
        return store.get_file_info(base).type == arrow_fs.FileType.Directory
    except (OSError, ValueError, NotImplementedError):  # no driver for this store in Arrow
        return False


def list_files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """inner (the path below `folder`), length and modified of every file, hidden and empty ones too, as stored rows.

    Folders are rows that tasks list. A task follows folders until it has listed FOLLOWED entries; those left over are
    dealt to other tasks in the next round. Nothing but the last round's emptiness reaches the driver. Not `recursive`
    lists the folder itself, and folders in it that are one table of part files. Stores that Arrow has no driver for
    are listed by Spark, which leaves out hidden and empty files.
    """
    root = qualified(spark, folder).rstrip("/")
    if not _readable_by_arrow(root):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        inner = F.substring("path", len(root) + 2, 2**31 - 1)
        listed = found.select(inner.alias("inner"), "length", F.col("modificationTime").alias("modified"))
        return listed if recursive else listed.filter(~F.contains("inner", F.lit("/")) | inner.rlike(f"^{TABLE_FOLDER}/"))

    def run(batches):
        store, base = _arrow_store(root)
        for batch in batches:
            open_folders, listed = batch.column("inner").to_pylist(), []
            while open_folders and len(listed) < FOLLOWED:
                here = open_folders.pop()
                for info in store.get_file_info(arrow_fs.FileSelector(f"{base}/{here}" if here else base)):
                    inner = f"{here}/{info.base_name}" if here else info.base_name
                    if info.type == arrow_fs.FileType.Directory:
                        if recursive or here or re.fullmatch(TABLE_FOLDER, info.base_name):
                            open_folders.append(inner)
                    else:
                        listed.append((inner, info.size, info.mtime))
            rows = [(inner, size, time, False) for inner, size, time in listed]
            rows += [(inner, None, None, True) for inner in open_folders]
            columns = list(zip(*rows)) or [()] * 4
            types = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["inner", "length", "modified", "open"])

    rounds: list[DataFrame] = []
    frontier = spark.createDataFrame([("",)], "inner string").coalesce(1)
    while not rounds or not frontier.isEmpty():
        listed = stored(frontier.mapInArrow(run, "inner string, length long, modified timestamp, open boolean"), "listing")
        rounds.append(listed.filter("NOT open").drop("open"))
        frontier = listed.filter("open").select("inner").repartition(spark.sparkContext.defaultParallelism)
    return reduce(DataFrame.unionByName, rounds)


def file_manifest(
    spark: SparkSession,
    folder: str,
    extensions: tuple[str, ...] | None = None,
    recursive: bool = True,
) -> DataFrame:
    """One row per file below `folder`, hidden and empty ones too; no file is opened.

    `entry` is the table-level file or folder: `x/orders.csv/part-0` belongs to `x/orders.csv`. `hidden` says that
    Spark's readers pass the file over for its name, or that of a folder it is in (`_` or `.` first).
    """
    root = qualified(spark, folder).rstrip("/")
    inner = F.col("inner")
    # a folder that carries an extension is one table made of part files
    outer = F.regexp_extract(inner, rf"^((?:[^/]+/)*?{TABLE_FOLDER})/", 1)
    entry = F.when(outer != "", outer).otherwise(inner)
    listed = list_files(spark, folder, recursive).select(
        F.concat(F.lit(root + "/"), inner).alias("path"),
        F.substring_index(inner, "/", -1).alias("name"),
        entry.alias("entry"),
        path_extension(entry).alias("extension"),
        table_name(entry).alias("table_name"),
        "length",
        size_mb(F.col("length")).alias("size_mb"),
        "modified",
        inner.rlike(HIDDEN).alias("hidden"),
    )
    return listed if extensions is None else listed.filter(F.col("extension").isin(*extensions))


def fingerprints(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """The files of a manifest of `folder` with `lines` and two sums over the hashes of their lines, in any order.

    One pass over the bytes, whatever they mean. Files without lines, and hidden ones, which Spark does not read, have
    zeros.
    """
    value = F.col("value").cast("binary")
    sums = [F.sum(F.xxhash64(F.lit(seed), value).cast("decimal(20,0)")).alias(f"sum{seed}") for seed in (1, 2)]
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(folder).groupBy(
        plain_path(F.col("_metadata.file_path")).alias("plain")).agg(F.count(F.lit(1)).alias("lines"), *sums)
    both = manifest.withColumn("plain", F.regexp_replace("path", "^file:/+", "file:/")).join(lines, "plain", "left").drop("plain")
    return both.fillna({"lines": 0}).withColumns({c: F.coalesce(c, F.lit(0).cast("decimal(30,0)")) for c in ("sum1", "sum2")})


def plain_path(path: Column) -> Column:
    """The path of a file as it is listed, from `_metadata.file_path`: without percent signs, one slash after `file:`."""
    # + stands for itself there
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def not_landed(manifest: DataFrame, landed: DataFrame, key: str | tuple[str, ...] = "name") -> DataFrame:
    """Files of the manifest that the landing area does not hold yet: none there has the same `key`.

    With the columns of `fingerprints` (CONTENT) as key, content decides: a renamed copy has landed, another content
    under the same name has not.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return manifest.join(landed.select(*keys).distinct(), keys, "left_anti")
