"""Table sets: one table per file (or per folder of part files) below a folder."""

from __future__ import annotations

import warnings
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.names import distinct_names
from tablewright.sources.csv_files import scan_csv
from tablewright.sources.files import HIDDEN, file_manifest, qualified

READABLE = (".csv", ".json", ".parquet")
HIDDEN_NAME = "hidden: Spark's readers pass over names that begin with _ or ."
NO_CONTENT = "empty: there is no header and no row"


def is_text_source(path: str) -> bool:
    """Whether the columns of this source arrive as untyped text."""
    return path.lower().endswith(".csv")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    kind = path.lower().rstrip("/").rpartition(".")[2]
    if kind == "csv":
        return scan_csv(spark, path)
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind == "json":
        return spark.read.json(path)
    raise ValueError(f"Unsupported file type: {path}")


def table_entries(files: DataFrame, recursive: bool = False) -> DataFrame:
    """entry, table_name and refusal: the readable files, or folders of part files, of a manifest, one row each.

    refusal is null, or why Spark cannot read the entry: its name is hidden, or all its files are empty.
    """
    inside = files.filter(F.col("extension").isin(*READABLE))
    if not recursive:
        inside = inside.filter(~F.contains("entry", F.lit("/")))
    seen = F.sum(F.when(~F.col("hidden") | F.col("entry").rlike(HIDDEN), F.col("length")).otherwise(0))
    refusal = F.when(F.col("entry").rlike(HIDDEN), HIDDEN_NAME).when(F.col("bytes") == 0, NO_CONTENT)
    found = inside.groupBy("entry", "table_name").agg(seen.alias("bytes"))
    return found.select("entry", "table_name", refusal.alias("refusal"))


class TableSet(NamedTuple):
    paths: dict[str, str]     # by table name, ordered by file name
    refused: dict[str, str]   # entry that Spark cannot read, and why


def table_set(spark: SparkSession, folder: str, recursive: bool = False, files: DataFrame | None = None) -> TableSet:
    """The tables of a folder (or of its manifest `files`). Only names travel to the driver, one for each table."""
    files = file_manifest(spark, folder, recursive=recursive) if files is None else files
    entries = sorted(
        table_entries(files, recursive).collect(), key=lambda e: (e.entry.rpartition("/")[2].lower(), e.entry))
    root = qualified(spark, folder).rstrip("/")
    good = [e for e in entries if e.refusal is None]
    names = distinct_names([e.table_name for e in good])
    return TableSet(
        {n: f"{root}/{e.entry}" for n, e in zip(names, good)}, {e.entry: e.refusal for e in entries if e.refusal})


def table_paths(spark: SparkSession, folder: str, recursive: bool = False) -> dict[str, str]:
    return table_set(spark, folder, recursive).paths


def scan_tables(spark: SparkSession, folder: str, recursive: bool = False) -> dict[str, DataFrame]:
    """The tables of a folder by name; entries that Spark cannot read are named in a warning."""
    found = table_set(spark, folder, recursive)
    if found.refused:
        warnings.warn("not read: " + "; ".join(f"{e} ({why})" for e, why in found.refused.items()), stacklevel=2)
    return {n: read_table(spark, p) for n, p in found.paths.items()}
