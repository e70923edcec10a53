"""Catalog tables: write dispositions, per-table reports, and full refresh of a database."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Collection, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.failures import FAILURES
from tablewright.functions.text import quoted
from tablewright.operators.catalog import UNFINISHED
from tablewright.sources.files import folder_names, path_exists, remove_path
from tablewright.sources.tables import TableSet, is_text_source, read_table, table_set

REPORT_SCHEMA = "table string, success boolean, rows bigint, error string"
TRUNCATE, APPEND, EMPTY = "truncate", "append", "empty"
VERSION = "__v"  # a table's files lie in the database's folder under <table>__v<identifier>
KEPT_BY_CATALOG = ("comment", "owner", "provider", "location", "external", "transient_lastDdlTime", "numFiles",
                   "totalSize", "rawDataSize", "numRows")
TABLES_AT_ONCE = 4  # tables are independent; a few jobs side by side keep a cluster busy


class Loaded(NamedTuple):
    table: str
    success: bool
    rows: int | None
    error: str | None


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{place}")


def load_table(df: DataFrame, database: str, name: str, disposition: str = TRUNCATE) -> Loaded:
    """Write a table and report its row count after the load; any failure becomes the report.

    Truncate writes a new version of the files beside those of the table; one catalog call then points the table to it,
    so that readers find the old rows or the new ones, never none. A load that fails, or whose source is the table
    itself, leaves the old rows; comment and properties stay. The version before is kept until the next load, for
    readers that have begun. A table whose columns change, or that is not a managed Parquet table, is renamed aside,
    the new one renamed in, and the old one dropped last: between the two renames the name is not there.
    """
    spark = df.sparkSession
    table, incoming, replaced = (f"{quoted(database)}.{quoted(name + end)}" for end in ("", *UNFINISHED))
    try:
        ensure_database(spark, database)
        exists = spark.catalog.tableExists(f"{database}.{name}")
        if not exists and spark.catalog.tableExists(f"{database}.{name}{UNFINISHED[1]}"):
            # a load that ended between its two renames
            spark.sql(f"ALTER TABLE {replaced} RENAME TO {table}")
            exists = True
        if disposition == APPEND:
            df.write.mode("append").saveAsTable(table)
            rows = spark.table(table).count()
        elif disposition == EMPTY:
            if exists and not spark.table(table).isEmpty():
                return Loaded(name, False, None, f"Table {database}.{name} already holds rows")
            rows = _counted(df, lambda counted: counted.write.mode("append").saveAsTable(table))
        elif disposition == TRUNCATE:
            held = _stored_files(spark, database, name) if exists else None
            if not exists or (held and _same_columns(spark.table(table).schema, df.schema)):
                rows = _point_to_new_files(df, database, name, held)
            else:
                rows = _counted(df, lambda counted: counted.write.mode("overwrite").saveAsTable(incoming))
                _describe_alike(spark, database, name, table, incoming)
                spark.sql(f"DROP TABLE IF EXISTS {replaced}")
                _rename(spark, table, replaced)
                try:
                    _rename(spark, incoming, table)
                except FAILURES:
                    _rename(spark, replaced, table)
                    raise
                spark.sql(f"DROP TABLE IF EXISTS {replaced}")
        else:
            return Loaded(name, False, None, f"Unknown write disposition: {disposition}")
        return Loaded(name, True, rows, None)
    except FAILURES as problem:
        if disposition == TRUNCATE and spark.catalog.tableExists(f"{database}.{name}"):
            spark.sql(f"DROP TABLE IF EXISTS {incoming}")
        return Loaded(name, False, None, str(problem))


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write the rows and count them on the way."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def _stored_files(spark: SparkSession, database: str, name: str) -> str | None:
    """Where a managed Parquet table has its files; null for tables of another kind."""
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(database)}.{quoted(name)}").collect()}
    managed = about.get("Type") == "MANAGED" and (about.get("Provider") or "").lower() == "parquet"
    return about.get("Location") if managed and "# Partition Information" not in about else None


def _same_columns(stored: T.StructType, given: T.StructType) -> bool:
    return [(f.name, f.dataType.simpleString()) for f in stored] == [(f.name, f.dataType.simpleString()) for f in given]


def _point_to_new_files(df: DataFrame, database: str, name: str, held: str | None) -> int:
    """Write a version of the files and let the table begin there; `held` is where it began, null for a new table."""
    spark = df.sparkSession
    table = f"{quoted(database)}.{quoted(name)}"
    version = f"{_database_folder(spark, database)}/{name}{VERSION}{uuid.uuid4().hex}"
    try:
        rows = _counted(df, lambda counted: counted.write.parquet(version))
        if held is None:
            # managed, so that dropping the table takes the files along; it begins empty in a folder of its own
            spark.createDataFrame([], df.schema).write.format("parquet").saveAsTable(table)
            empty = _stored_files(spark, database, name)
        _set_location(spark, table, version)
    except FAILURES:
        remove_path(spark, version)
        raise
    if held is None:
        remove_path(spark, empty)
    remove_versions(spark, database, name, keep={_last(version), _last(held or version)})
    if held and not _is_version(_last(held), name):
        remove_path(spark, held)  # files of a table that was not loaded by this function
    return rows


def _set_location(spark: SparkSession, table: str, path: str) -> None:
    literal = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{literal}'")


def _database_folder(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def _last(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def _is_version(folder: str, name: str) -> bool:
    return re.fullmatch(re.escape(name + VERSION) + "[0-9a-f]{32}", folder) is not None


def remove_versions(spark: SparkSession, database: str, name: str, keep: Collection[str] = ()) -> None:
    """Delete the files of versions of a table, but those in folders named by `keep`."""
    root = _database_folder(spark, database)
    for folder in folder_names(spark, root):
        if _is_version(folder, name) and folder not in keep:
            remove_path(spark, f"{root}/{folder}")


def drop_table(spark: SparkSession, database: str, name: str) -> None:
    """Drop a table with all versions of its files."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(database)}.{quoted(name)}")
    remove_versions(spark, database, name)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def _describe_alike(spark: SparkSession, database: str, name: str, table: str, incoming: str) -> None:
    """Give the incoming table the comment and the properties users have set on the old one."""
    def literal(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    comment = spark.catalog.getTable(f"{quoted(database)}.{quoted(name)}").description
    if comment:
        spark.sql(f"COMMENT ON TABLE {incoming} IS {literal(comment)}")
    kept = [
        f"{literal(r.key)} = {literal(r.value)}" for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
        if not r.key.startswith(("spark.sql.", "view.")) and r.key not in KEPT_BY_CATALOG
    ]
    if kept:
        spark.sql(f"ALTER TABLE {incoming} SET TBLPROPERTIES ({', '.join(kept)})")


def attempt(name: str, step: Callable[[], Loaded]) -> Loaded:
    try:
        return step()
    except FAILURES as problem:
        return Loaded(name, False, None, str(problem))


def at_once(steps: dict[str, Callable[[], Loaded]]) -> list[Loaded]:
    """Run independent loads a few at a time; one that fails does not stop the others."""
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        return list(pool.map(attempt, steps.keys(), steps.values()))


def report(spark: SparkSession, loaded: list[Loaded]) -> DataFrame:
    return spark.createDataFrame(loaded, REPORT_SCHEMA)


def load_counts(reported: DataFrame) -> DataFrame:
    return reported.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("success").alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
    )


def load_tables(
    spark: SparkSession, tables: dict[str, DataFrame], database: str, disposition: str = TRUNCATE
) -> DataFrame:
    """Load a table set; `(table, success, rows, error)` for each."""
    ensure_database(spark, database)
    steps = {n: (lambda n=n, t=t: load_table(t, database, n, disposition)) for n, t in tables.items()}
    return report(spark, at_once(steps))


def load_folder(
    spark: SparkSession,
    folder: str,
    database: str,
    disposition: str = TRUNCATE,
    prepare: Callable[[DataFrame, bool], DataFrame] | None = None,
    only: Collection[str] | None = None,
    tables: TableSet | None = None,
) -> DataFrame:
    """Load every readable file of a folder, or the paths in `only`, under the name derived from its path.

    Files that Spark cannot read (hidden names, no content) are reported as failed under their file name. `tables` is
    what `table_set` has found in the folder, if known. `prepare(table, untyped)` turns a scan into what is stored; by default text cells are typed.
    """
    from tablewright.operators.normalize import infer_types

    def default(table: DataFrame, untyped: bool) -> DataFrame:
        return infer_types(table) if untyped else table

    make = prepare or default
    if not path_exists(spark, folder):
        raise ValueError(f"Folder not found: {folder}")
    paths, refused = tables or table_set(spark, folder)
    if not paths and not refused:
        raise ValueError(f"No tables found in {folder}")
    paths = {n: p for n, p in paths.items() if only is None or p in only}
    ensure_database(spark, database)

    def step(name: str, path: str) -> Loaded:
        return load_table(make(read_table(spark, path), is_text_source(path)), database, name, disposition)

    loaded = at_once({n: (lambda n=n, p=p: step(n, p)) for n, p in paths.items()})
    return report(spark, loaded + [Loaded(entry, False, None, why) for entry, why in refused.items()])


def refresh_database(
    spark: SparkSession, tables: dict[str, DataFrame], database: str, keep: Iterable[str] = ()
) -> DataFrame:
    """Load the set, then drop stored tables that neither it nor `keep` names."""
    ensure_database(spark, database)
    names = spark.createDataFrame([(n,) for n in {*tables, *keep}], "name string")
    stored = spark.createDataFrame(
        [(t.name,) for t in spark.catalog.listTables(database) if not t.isTemporary and t.tableType != "VIEW"],
        "name string",
    )
    reported = load_tables(spark, tables, database)
    for row in stored.join(names, "name", "left_anti").collect():
        drop_table(spark, database, row.name)
    return reported
