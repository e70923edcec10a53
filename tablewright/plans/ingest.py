"""Jobs over many tables: normalize a set, load it, relate its tables, publish views."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.failures import FAILURES
from tablewright.functions.text import quoted
from tablewright.operators.catalog import LANDED, base_tables, column_catalog, database_catalog
from tablewright.operators.normalize import Normalized, normalize
from tablewright.operators.relations import key_relationships, relationships
from tablewright.operators.views import create_views, drop_views
from tablewright.sinks.csv_files import write_csv
from tablewright.sinks.metadata import write_relationships
from tablewright.sinks.tables import (
    REPORT_SCHEMA, TABLES_AT_ONCE, drop_table, ensure_database, load_counts, load_folder, load_table, refresh_database,
)
from tablewright.sources.files import CONTENT, file_manifest, fingerprints, not_landed, path_exists, qualified
from tablewright.sources.tables import is_text_source, read_table, table_set

STATUS_SCHEMA = "table string, ok boolean, error string"
HELD_COLUMNS = ["table", "path", "length", "modified"]  # of the files that a database was loaded from


class NormalizedSet(NamedTuple):
    tables: dict[str, Normalized]
    status: DataFrame  # (table, ok, error), the true state of each


class SheetSet(NamedTuple):
    tables: dict[str, Normalized]
    relationships: DataFrame | None
    status: DataFrame | None = None  # (sheet, table, state, error); state is kept, empty or failed


class Analysis(NamedTuple):
    catalog: DataFrame
    relationships: DataFrame
    views: DataFrame | None


def normalize_all(
    spark: SparkSession,
    tables: dict[str, DataFrame | str],
    order_by: dict[str, Iterable[str]] | None = None,
) -> NormalizedSet:
    """Normalize each table (a DataFrame, or the path of one); a failure is recorded and the loop goes on."""

    def step(name: str) -> Normalized | str:
        table = tables[name]
        try:
            untyped = isinstance(table, str) and is_text_source(table)
            data = read_table(spark, table) if isinstance(table, str) else table
            return normalize(data, order_by=(order_by or {}).get(name), untyped=untyped)
        except FAILURES as problem:
            return str(problem)

    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        results = dict(zip(tables, pool.map(step, tables)))
    done = {n: r for n, r in results.items() if isinstance(r, Normalized)}
    status = [(n, n in done, None if n in done else r) for n, r in results.items()]
    return NormalizedSet(done, spark.createDataFrame(status, STATUS_SCHEMA))


def normalize_sheets(
    sheets: dict[str, DataFrame], base: str | None = None, order_by: dict[str, Iterable[str]] | None = None
) -> SheetSet:
    """Normalize a named set side by side: empty tables leave it, all-null rows and columns go, key names are related."""
    if not sheets:
        return SheetSet({}, None)

    def step(sheet: str) -> Normalized | str:
        try:
            return normalize(sheets[sheet], order_by=(order_by or {}).get(sheet), drop_empty=True)
        except FAILURES as problem:
            return str(problem)

    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        results = dict(zip(sheets, pool.map(step, sheets)))
    tables, status = {}, []
    for sheet, result in results.items():
        name = sheet.replace(" ", "_").replace("/", "_")
        name = f"{base}_{name}" if base else name
        if isinstance(result, str):
            status.append((sheet, name, "failed", result))
        else:
            status.append((sheet, name, "empty" if result.is_empty else "kept", None))
            if not result.is_empty:
                tables[name] = result
    spark = next(iter(sheets.values())).sparkSession
    reported = spark.createDataFrame(status, "sheet string, table string, state string, error string")
    if not tables:
        return SheetSet({}, None, reported)
    catalog = column_catalog({n: t.data for n, t in tables.items()}, rows=False)
    return SheetSet(tables, key_relationships(catalog), reported)


def write_sheets(
    sheets: dict[str, DataFrame], folder: str, base: str | None = None, order_by: dict[str, Iterable[str]] | None = None
) -> SheetSet:
    """Normalize a set and write it: `<table>.csv` each, and the metadata as `<base>_relationships.json`."""
    done = normalize_sheets(sheets, base, order_by)
    if not done.tables:
        return done
    paths = {n: f"{folder.rstrip('/')}/{n}.csv" for n in done.tables}
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        list(pool.map(lambda n: write_csv(done.tables[n].data, paths[n]), paths))
    reports = reduce(DataFrame.unionByName, [t.report(n).withColumn("path", F.lit(paths[n])) for n, t in done.tables.items()])
    write_relationships(reports, done.relationships, f"{folder.rstrip('/')}/{base or 'sheets'}_relationships.json")
    return done


def normalize_and_load(spark: SparkSession, tables: dict[str, DataFrame | str], database: str) -> DataFrame:
    """Replace the tables of a database by the normalized set; `(total, succeeded, failed)`.

    A table that fails keeps its stored version.
    """
    done = normalize_all(spark, tables)
    loaded = refresh_database(spark, {n: t.data for n, t in done.tables.items()}, database, keep=tables)
    failed = done.status.filter("NOT ok").selectExpr("table", "ok AS success", "CAST(NULL AS BIGINT) AS rows", "error")
    return load_counts(loaded.unionByName(failed))


def analyze(
    spark: SparkSession, database: str, analyze_only: bool = False, limit: int | None = None,
    known_rows: dict[str, int | None] | None = None,
) -> Analysis:
    """Catalog, relationships and, unless `analyze_only`, a view for each related pair.

    Views of earlier runs whose pair is no longer there or no longer related are dropped.
    """
    catalog = database_catalog(spark, database, known_rows)
    found = relationships(column_catalog(base_tables(spark, database), rows=False))
    views = None if analyze_only else create_views(spark, database, found, limit)
    if views is not None:
        drop_views(spark, database, keep={r.view for r in views.filter("created").collect()})
    return Analysis(catalog, found, views)


def missing_files(spark: SparkSession, source: str, landed: str, by_content: bool = False) -> DataFrame:
    """Files of the source folder whose names the landing folder does not hold.

    `by_content` compares what is in the files, whatever their names: a renamed copy has landed, a file with other lines
    under a known name has not. That reads all files of both folders once.
    """
    manifest = file_manifest(spark, source)
    manifest = fingerprints(spark, source, manifest) if by_content else manifest
    if not path_exists(spark, landed):
        return manifest
    held = file_manifest(spark, landed)
    if by_content:
        return not_landed(manifest, fingerprints(spark, landed, held), CONTENT)
    return not_landed(manifest, held)


def snapshot_diff(files: DataFrame, held: DataFrame) -> DataFrame:
    """table, path and state of every file of two snapshots (table, path, length, modified): new, changed, same or gone.

    A file is changed if its length, its time or the name of its table is another one, or not known. A file that moved
    to another table counts for the new one; one that is gone for the table it was in.
    """
    names = ("table", "length", "modified")
    old = held.select("path", *[F.col(c).alias(f"held_{c}") for c in names], F.lit(True).alias("was"))
    now = files.select("path", *names, F.lit(True).alias("is"))
    alike = reduce(lambda a, b: a & b, [F.coalesce(F.col(c) == F.col(f"held_{c}"), F.lit(False)) for c in names])
    state = F.when(F.col("was").isNull(), "new").when(F.col("is").isNull(), "gone").when(alike, "same").otherwise("changed")
    return now.join(old, "path", "full").select(F.coalesce("table", "held_table").alias("table"), "path", state.alias("state"))


def table_changes(files: DataFrame, held: DataFrame) -> DataFrame:
    """table and state of every table of two snapshots of files: new, changed, same or gone.

    gone: no file is left; new: none was there; changed: any file of it is new, changed or gone.
    """
    before = held.select("table").distinct().withColumn("before", F.lit(True))
    counts = snapshot_diff(files, held).groupBy("table").agg(
        F.count_if(F.col("state") != "same").alias("touched"), F.count_if(F.col("state") != "gone").alias("left"))
    state = (F.when(F.col("left") == 0, "gone").when(F.col("before").isNull(), "new")
             .when(F.col("touched") > 0, "changed").otherwise("same"))
    both = counts.join(before, "table", "full").withColumn("left", F.coalesce("left", F.lit(0)))
    return both.select("table", state.alias("state"))


def ingest(
    spark: SparkSession, folder: str, database: str, limit: int | None = None
) -> tuple[DataFrame, Analysis]:
    """Folder to related tables: normalize and load every file, then analyze and publish views.

    The database remembers the files it holds by path, length and time, and is brought in line with the folder as it is
    now: a table of which any file is new, changed or gone is loaded again, one of which no file is left is dropped,
    with its views; other tables are not read. The report has (table, success, rows, error, state) for each table that
    was loaded (new or changed), dropped (gone), or that Spark cannot read (refused). A table that fails keeps its old
    rows and is tried again by the next run.
    """
    if not path_exists(spark, folder):
        raise ValueError(f"Folder not found: {folder}")
    ensure_database(spark, database)
    manifest = file_manifest(spark, folder, recursive=False)
    tables = table_set(spark, folder, files=manifest)
    root = qualified(spark, folder).rstrip("/")
    by_entry = spark.createDataFrame(
        [(n, p[len(root) + 1:]) for n, p in tables.paths.items()], "table string, entry string")
    files = manifest.filter("NOT hidden").join(by_entry, "entry").select(*HELD_COLUMNS)
    name = f"{quoted(database)}.{LANDED}"
    none = spark.createDataFrame([], files.schema)
    held = spark.table(name) if spark.catalog.tableExists(f"{database}.{LANDED}") else none
    if held.columns != HELD_COLUMNS:
        held = none
    states = {r.table: r.state for r in table_changes(files, held).filter("state <> 'same'").collect()}
    changed = {tables.paths[n] for n, state in states.items() if state != "gone"}
    loaded = load_folder(
        spark, folder, database, prepare=lambda table, untyped: normalize(table, untyped=untyped).data, only=changed,
        tables=tables).collect()
    gone = sorted(n for n, state in states.items() if state == "gone")
    for n in gone:
        drop_table(spark, database, n)
    failed = [r.table for r in loaded if not r.success]
    if states:
        # what failed is held without a length, so that the next run finds it changed
        length = F.when(~F.col("table").isin(failed), F.col("length"))
        load_table(files.withColumn("length", length), database, LANDED)
    rows = [(*r, states.get(r.table, "refused")) for r in loaded] + [(n, True, None, None, "gone") for n in gone]
    known = {r.table: r.rows for r in loaded if r.success}
    return spark.createDataFrame(rows, f"{REPORT_SCHEMA}, state string"), analyze(
        spark, database, limit=limit, known_rows=known)
