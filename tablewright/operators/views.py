"""Relationship views: LEFT OUTER equi-joins published under a name."""

from __future__ import annotations

from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.failures import FAILURES
from tablewright.functions.text import quoted
from tablewright.operators.relations import viewable

VIEWS_AT_ONCE = 4
MADE = "tablewright.relationship"  # property of the views that create_views has published
VIEW_REPORT_SCHEMA = "view string, from_table string, to_table string, on_column string, created boolean, error string"


def _sortable(schema: T.StructType, first: str) -> list[str]:
    """The key, then every other column that has an order."""
    rest = [
        f.name for f in schema.fields
        if f.name.lower() != first.lower() and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    return [quoted(n) for n in [first, *rest]]


def _is_number(t: T.DataType) -> bool:
    return isinstance(t, T.NumericType)


def join_sql(
    left: str, right: str, left_schema: T.StructType, right_schema: T.StructType,
    left_key: str, right_key: str, right_name: str, limit: int | None = None,
) -> str:
    """All left columns and the right ones but its key; a right name the left has gets the table's prefix.

    With a limit the result is ordered by the left columns, then the right ones. Every left row
    yields a row, so the first `limit` rows need only the first `limit` left rows, and per key the
    first `limit` right rows. Both are cut that way before the join: neither table is shuffled
    whole, and a key with any number of rows sends `limit` rows per task at most. Which keys the
    right side keeps takes a scan of the left key alone.
    """
    key_types = left_schema[left_key].dataType, right_schema[right_key].dataType
    if key_types[0] != key_types[1] and not all(map(_is_number, key_types)):
        raise TypeError(f"{left_key} and {right_key} have types that do not compare: {key_types}")
    taken = {n.lower() for n in left_schema.names}
    right_columns = []
    for n in right_schema.names:
        if n.lower() == right_key.lower():
            continue
        shown = n if n.lower() not in taken else f"{right_name}_{n}"
        while shown.lower() in taken:
            shown += "_1"
        taken.add(shown.lower())
        right_columns.append((n, shown))
    columns = ", ".join(
        [f"l.{quoted(n)}" for n in left_schema.names]
        + [f"r.{quoted(n)} AS {quoted(shown)}" for n, shown in right_columns]
    )
    lk, rk = quoted(left_key), quoted(right_key)
    if limit is None:
        return f"SELECT {columns} FROM {left} l LEFT JOIN {right} r ON l.{lk} = r.{rk}"
    left_order = _sortable(left_schema, left_key)
    right_order = _sortable(right_schema, right_key)
    final_order = [f"l.{n}" for n in left_order] + [f"r.{n}" for n in right_order[1:]]
    return f"""
        WITH first_left AS (SELECT * FROM {left} ORDER BY {", ".join(left_order)} LIMIT {limit}),
        first_right AS (
            SELECT * FROM (
                SELECT t.*, row_number() OVER (PARTITION BY {rk} ORDER BY {", ".join(right_order)}) AS __place
                FROM {right} t
                WHERE {rk} IN (SELECT {lk} FROM {left} ORDER BY {lk} LIMIT {limit})
            ) WHERE __place <= {limit}
        )
        SELECT {columns} FROM first_left l LEFT JOIN first_right r ON l.{lk} = r.{rk}
        ORDER BY {", ".join(final_order)} LIMIT {limit}
    """


def relationship_view(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None,
    right_name: str = "right", limit: int | None = None,
) -> DataFrame:
    """The join of one relationship as a DataFrame: all of it, or with a limit its first rows."""
    text = join_sql(
        "{left}", "{right}", left.schema, right.schema, left_key, right_key or left_key, right_name, limit
    )
    return left.sparkSession.sql(text, left=left, right=right)


def create_views(
    spark: SparkSession, database: str, found: DataFrame, limit: int | None = None,
    every_column: bool = False,
) -> DataFrame:
    """Publish one view per pair of related tables and report each; a view that fails does not stop the rest.

    Views hold all rows unless a `limit` is given. The names of all pairs are on the driver; their views are made a few
    at a time.

    A pair related by several columns gets `view_<from>_join_<to>` for the first column by name;
    `every_column` adds `..._on_<column>` for the others.
    """
    fit = viewable(found).groupBy("from_table", "to_table").agg(
        F.array_sort(F.collect_set(F.struct("from_column", "to_column"))).alias("keys")
    )
    if not every_column:
        fit = fit.withColumn("keys", F.slice("keys", 1, 1))

    def publish(pair) -> list[list]:
        report = []
        for i, (left_key, right_key) in enumerate(pair["keys"]):
            name = f"view_{pair.from_table}_join_{pair.to_table}" + (f"_on_{left_key}" if i else "")
            left, right = (f"{quoted(database)}.{quoted(t)}" for t in (pair.from_table, pair.to_table))
            row = [f"{database}.{name}", pair.from_table, pair.to_table, left_key]
            try:
                schemas = spark.table(left).schema, spark.table(right).schema
                # relationships carry lower-case names; use the stored spelling
                spelled = [
                    next(n for n in s.names if n.lower() == k.lower()) for s, k in zip(schemas, (left_key, right_key))
                ]
                text = join_sql(left, right, *schemas, *spelled, pair.to_table, limit)
                spark.sql(f"CREATE OR REPLACE VIEW {quoted(database)}.{quoted(name)} TBLPROPERTIES ('{MADE}' = 'true') AS {text}")
                report.append([*row, True, None])
            except FAILURES as problem:
                report.append([*row, False, str(problem)])
        return report

    with ThreadPoolExecutor(VIEWS_AT_ONCE) as pool:
        pairs = fit.orderBy("from_table", "to_table").toLocalIterator()
        made = [row for rows in pool.map(publish, pairs) for row in rows]
    return spark.createDataFrame(made, VIEW_REPORT_SCHEMA)


def drop_views(spark: SparkSession, database: str, keep: Collection[str]) -> list[str]:
    """Drop the views that `create_views` has published in a database, but those named (`database.view`) by `keep`."""
    dropped = []
    for listed in spark.catalog.listTables(database):
        full = f"{quoted(database)}.{quoted(listed.name)}"
        if listed.isTemporary or listed.tableType != "VIEW" or f"{database}.{listed.name}" in keep:
            continue
        if any(r.key == MADE for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()):
            spark.sql(f"DROP VIEW IF EXISTS {full}")
            dropped.append(listed.name)
    return dropped
