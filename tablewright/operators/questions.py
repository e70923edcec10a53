"""Questions over a table set: typed helpers for the common shapes, and SQL for everything else."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.failures import FAILURES
from tablewright.functions.text import float_text, quoted

PREVIEW_ROWS = 100
DIGEST_ROWS = 5
NO_RESULTS = "No results found."
SHOWN = "__shown"  # a row as JSON text, beside its values


def count_by(df: DataFrame, key: str, name: str = "rows") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def top_groups(df: DataFrame, key: str, n: int, name: str = "rows") -> DataFrame:
    """The n most frequent values, ties by value."""
    return count_by(df, key, name).orderBy(F.desc(name), F.asc(key)).limit(n)


def average_by(df: DataFrame, key: str, value: str | Column, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(name))


def sum_by(df: DataFrame, key: str, value: str | Column, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(name))


def highest_groups(df: DataFrame, key: str, value: str | Column, n: int, name: str) -> DataFrame:
    """The n groups with the highest value, ties by key."""
    return df.groupBy(key).agg(F.max(value).alias(name)).orderBy(F.desc(name), F.asc(key)).limit(n)


def top_rows(df: DataFrame, value: str, key: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(value), F.asc(key)).limit(n)


def first_rows(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    return df.orderBy(key).limit(n)


def filtered_average(df: DataFrame, condition: Column, value: str | Column, name: str) -> DataFrame:
    return df.filter(condition).agg(F.avg(value).alias(name))


def has_limit(spark: SparkSession, text: str) -> bool:
    """Whether the statement as a whole has a limit of its own, as Spark parses it."""
    plan = spark.sql(f"EXPLAIN EXTENDED {text.strip().rstrip(';')}").first()[0]
    parsed = plan.partition("== Parsed Logical Plan ==")[2].partition("== Analyzed Logical Plan ==")[0].strip("\n")
    # the outermost operators: those with nothing but one branch above them
    return re.match(r"(?:'?UnresolvedWith[^\n]*\n(?:[: ][^\n]*\n)*|CTE [^\n]*\n(?:: [^\n]*\n)*)?(?:\+- )?'?GlobalLimit", parsed) is not None


def capped(df: DataFrame, text: str, cap: int) -> DataFrame:
    """The query cut at a number of rows, unless the statement has a limit of its own."""
    return df if has_limit(df.sparkSession, text) else df.limit(cap)


def _json_value(name: str, data_type: T.DataType) -> Column:
    value = F.col(quoted(name))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        shown = float_text(name)
    elif isinstance(data_type, (T.IntegralType, T.BooleanType)):
        shown = value.cast("string")
    else:
        if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)):
            value = value.cast("string")
        pair = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
        shown = F.regexp_extract(pair, r'(?s)^\{"v":(.*)\}$', 1)
    return F.when(value.isNull(), F.lit("null")).otherwise(shown)


def row_json(schema: T.StructType) -> Column:
    """A row as indented JSON text."""
    fields = [
        F.concat(F.lit(f'    "{f.name}": '), _json_value(f.name, f.dataType)) for f in schema.fields
    ]
    return F.concat(F.lit("  {\n"), F.concat_ws(",\n", *fields), F.lit("\n  }"))


def digest(df: DataFrame) -> DataFrame:
    """One row `(row_count, digest)`: nothing found, all rows up to five, or the first five and the total."""
    head = df.limit(DIGEST_ROWS).select(
        F.monotonically_increasing_id().alias("place"), row_json(df.schema).alias("shown")
    )
    shown = F.array_sort(F.collect_list(F.struct("place", "shown")))
    first = head.agg(F.array_join(F.transform(shown, lambda s: s["shown"]), ",\n").alias("shown"))
    total = df.agg(F.count(F.lit(1)).alias("row_count"))
    both = first.select(F.lit(None).cast("bigint").alias("row_count"), "shown").unionByName(
        total.select("row_count", F.lit(None).cast("string").alias("shown"))
    ).agg(F.max("row_count").alias("row_count"), F.max("shown").alias("shown"))
    rows = F.concat(F.lit("[\n"), F.col("shown"), F.lit("\n]"))
    long = F.concat(
        F.lit(f"First {DIGEST_ROWS} rows:\n"), rows, F.lit("\n\nTotal rows: "), F.col("row_count").cast("string")
    )
    text = F.when(F.col("row_count") == 0, NO_RESULTS).when(F.col("row_count") <= DIGEST_ROWS, rows).otherwise(long)
    return both.select("row_count", text.alias("digest"))


def _digest_text(rows: int, shown: list[str]) -> str:
    """The text of `digest` for a result whose first rows are on the driver."""
    if not rows:
        return NO_RESULTS
    listed = "[\n" + ",\n".join(shown) + "\n]"
    return listed if rows <= DIGEST_ROWS else f"First {DIGEST_ROWS} rows:\n{listed}\n\nTotal rows: {rows}"


@dataclass
class Answer:
    query: str
    sql: str | None = None
    row_count: int | None = None
    data: list[dict] = field(default_factory=list)
    digest: str | None = None
    error: str | None = None

    @property
    def success(self) -> bool:
        return self.error is None


def answer(
    spark: SparkSession,
    question: str,
    to_sql: Callable[[str], str | None] = lambda text: text,
    tables: dict[str, DataFrame] | None = None,
    mode: str = "data",
    cap: int | None = None,
) -> Answer:
    """Turn a question into SQL, run it over the table set, and return a preview, the full count and a digest.

    `to_sql` writes the SQL; by default the question is SQL already. Mode `sql` stops before running. A `cap` cuts
    what is previewed, not the count. The names of `tables` hold for this question alone.
    """
    if not question:
        return Answer(question, error="The question is empty.")
    text = to_sql(question)
    if not text:
        return Answer(question, error="No SQL came back for the question.")
    if mode == "sql":
        return Answer(question, text)
    try:
        with _named(spark, tables or {}):
            result = spark.sql(text)
            shown = PREVIEW_ROWS if cap is None or has_limit(spark, text) else min(cap, PREVIEW_ROWS)
        # one run gives the preview and the beginning of the digest; a second one counts what is longer than that
        head = result.select("*", row_json(result.schema).alias(SHOWN)).limit(PREVIEW_ROWS + 1).collect()
        rows = len(head) if len(head) <= PREVIEW_ROWS else result.count()
        preview = [r.asDict(recursive=True) for r in head[:shown]]
        for row in preview:
            del row[SHOWN]
        return Answer(question, text, rows, preview, _digest_text(rows, [r[SHOWN] for r in head[:DIGEST_ROWS]]))
    except FAILURES as problem:
        return Answer(question, text, error=f"The query did not run: {problem}")


@contextmanager
def _named(spark: SparkSession, tables: dict[str, DataFrame]) -> Iterator[None]:
    """Tables under a name while a statement is read; views of that name come back after it."""
    hidden = {n: spark.table(n) for n in tables if spark.catalog.tableExists(n) and spark.catalog.getTable(n).isTemporary}
    try:
        for name, table in tables.items():
            table.createOrReplaceTempView(name)
        yield
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, table in hidden.items():
            table.createOrReplaceTempView(name)
