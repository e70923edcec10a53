"""What the rules must know about a table's data, gathered in one aggregate over only the columns
that need it. Everything is a partial + final aggregate with a fixed-size buffer per column.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tablewright.functions import dates, names
from tablewright.functions import text as tx

BIGINT_LIMIT = float(2**63)
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
MOMENTS = (T.TimestampType, T.TimestampNTZType, T.DateType)

EARLY_ROWS = 1000
EARLY_BYTES = 32 << 20
FIRST_ROWS = 100  # rows that names are first looked for in
FIRST_LENGTH = 100  # longer first values are no dates
TEXT, INTEGER, WIDE_INTEGER, DOUBLE, BOOLEAN, EMPTY = (
    "text", "integer", "wide_integer", "double", "boolean", "empty",
)


def with_order(df: DataFrame, order_by: Iterable[str | Column] | None) -> tuple[DataFrame, list[str]]:
    """Add columns that sort as the given keys, or as the rows of the files (else of the partitions)."""
    if order_by is not None:
        keys = [F.col(o) if isinstance(o, str) else o for o in order_by]
        added = [f"__key{i}" for i in range(len(keys))]
        return df.select("*", *[k.alias(a) for k, a in zip(keys, added)]), added
    row = F.monotonically_increasing_id().alias("__row")
    if not has_file_rows(df):
        return df.select("*", row), ["__row"]
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block")]
    return df.select("*", *place, row), ["__file", "__block", "__row"]


def has_file_rows(df: DataFrame) -> bool:
    """Whether each row is one row of a file, with the file's metadata at hand."""
    try:
        return bool(df.select("_metadata.file_path", "_metadata.file_block_start").columns)
    except AnalysisException:
        return False


def first_file(df: DataFrame) -> DataFrame | None:
    """The rows of the first of several files; the other files are not opened."""
    files = df.inputFiles()
    if len(files) < 2 or not has_file_rows(df):
        return None
    head = min(files)
    # the listing writes local files as `file:///x`, the rows as `file:/x`
    return df.filter(F.col("_metadata.file_path").isin(head, head.replace(":///", ":/", 1)))


def has_fraction(v: Column) -> Column:
    """Not a whole number a bigint can hold. `rint`, since `floor` saturates at 2^63."""
    v = F.nanvl(v.cast("double"), F.lit(None).cast("double"))
    return (v != F.rint(v)) | (F.abs(v) >= BIGINT_LIMIT)


# What a text cell may be written as; the cells of a column combine by bitwise or.
WHOLE, MINUS, WIDE, BEYOND, ROUND, FRACTION, WORD, OTHER = (1 << i for i in range(8))
WHOLE_NUMBERS = WHOLE | MINUS | WIDE | BEYOND


def cell_mark(name: str, known: int | None = None) -> str:
    """SQL for the mark of one cell; `known` are marks other cells of the column have for certain.

    Nested conditions keep conversions to the cells that convert. Almost every number is short, and
    then one pattern test and a byte search tell a whole number, one more conversion a fraction.
    """
    c, value = tx.quoted(name), f"try_cast({tx.quoted(name)} AS DOUBLE)"
    number = f"IF({value} != rint({value}) OR abs({value}) >= {BIGINT_LIMIT}D, {FRACTION}, {ROUND})"
    plain = f"""
        CASE WHEN contains({c}, '.') THEN
                 CASE WHEN octet_length({c}) > 17 THEN {number} WHEN {value} % 1 = 0 THEN {ROUND} ELSE {FRACTION} END
             WHEN octet_length({c}) <= 18 OR try_cast({c} AS BIGINT) IS NOT NULL THEN
                 IF(startswith(ltrim({c}), '-'), {WHOLE | MINUS}, {WHOLE})
             WHEN try_cast({c} AS DECIMAL(38, 0)) BETWEEN 0 AND {2**64 - 1} THEN {WIDE}
             ELSE {BEYOND} END
    """
    if known and known & FRACTION:
        plain = str(FRACTION)  # a double whatever its other numbers are
    words = ", ".join(f"'{w}'" for w in tx.BOOLEAN_WORDS)
    return f"""
        CASE WHEN {c} RLIKE r'{tx.PLAIN_NUMBER_PATTERN}' THEN {plain}
             WHEN {c} RLIKE r'{tx.POWER_NUMBER_PATTERN}'
                 THEN IF(abs({value}) = double('Infinity'), {OTHER}, {number})
             WHEN {c} IN ({words}) THEN {WORD}
             WHEN {c} RLIKE r'{tx.INFINITY_PATTERN}' THEN {FRACTION}
             WHEN {c} IS NOT NULL THEN {OTHER} END
    """


def column_marks(name: str, known: int | None = None) -> Column:
    """All marks of a column, 0 for none."""
    return F.expr(f"bit_or(coalesce({cell_mark(name, known)}, 0))")


def early_marks(beginning: DataFrame, columns: list[str]) -> dict[str, int | None]:
    """Marks of the first rows. Marks only add up, so a column that is text here is text.

    A small table is not worth the extra job.
    """
    size = beginning._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if not columns or size < EARLY_BYTES:
        return dict.fromkeys(columns)
    return beginning.select(*columns).limit(EARLY_ROWS).agg(
        *[column_marks(c).alias(c) for c in columns]
    ).first().asDict()


def is_surely_text(marks: int | None) -> bool:
    """Whether no further cell can make the column anything but text."""
    return bool(marks and (marks & OTHER or marks & WORD and marks != WORD))


def text_kind(marks: int | None) -> str:
    """What a text column holds, from the marks of all its cells."""
    if not marks:
        return EMPTY
    if marks == WORD:
        return BOOLEAN
    if is_surely_text(marks):
        return TEXT
    if not marks & ~WHOLE_NUMBERS:
        if marks & BEYOND or marks & WIDE and marks & MINUS:
            return TEXT
        return WIDE_INTEGER if marks & WIDE else INTEGER
    return DOUBLE if marks & (FRACTION | WIDE | BEYOND) else INTEGER


def offset_facts(c: Column) -> dict[str, Column]:
    offset = dates.utc_offset(c)
    return {"low_offset": F.min(offset), "high_offset": F.max(offset)}


def amount_facts(v: Column) -> dict[str, Column]:
    """Enough to tell whether the exact median exceeds the bound, without holding the values."""
    v = F.nanvl(v.cast("double"), F.lit(None).cast("double"))
    above = v > names.AMOUNT_ABOVE
    return {
        "values": F.count(v),
        "above": F.count_if(above),
        "lower": F.max(F.when(~above, v)),
        "upper": F.min(F.when(above, v)),
    }


def median_is_amount(facts: dict) -> bool:
    values, above = facts["values"], facts["above"]
    if 2 * above != values:
        return 2 * above > values
    return values > 0 and (facts["lower"] + facts["upper"]) / 2 > names.AMOUNT_ABOVE


def gather(df: DataFrame, wanted: dict[str, dict[str, Column]]) -> tuple[int | None, dict[str, dict]]:
    """Run all facts of all columns, and the row count, as one aggregate. No facts, no job."""
    flat = [e.alias(f"{c}__{k}") for c, facts in wanted.items() for k, e in facts.items()]
    if not flat:
        return None, {}
    row = df.agg(F.count(F.lit(1)).alias("rows"), *flat).first().asDict()
    return row["rows"], {c: {k: row[f"{c}__{k}"] for k in facts} for c, facts in wanted.items()}


def sample_text(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, MOMENTS):
        return F.substring_index(c.cast("string"), ".", 1)
    return c.cast("string")


def _first_of_each(df: DataFrame, columns: list[str], order: list[str], n: int) -> DataFrame:
    """`(column, found, sample, first)` from the first n values of each column.

    Each column is a top-n of its own: every task keeps n rows, and only those move. A column of
    any length, or all its rows in one file, sends n rows per task.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    tops = [
        df.filter(F.col(c).isNotNull())
        .select(F.lit(c).alias("column"), F.struct(*order).alias("place"), sample_text(F.col(c), types[c]).alias("value"))
        .orderBy("place").limit(n)
        for c in columns
    ]
    ordered = F.array_sort(F.collect_list(F.struct("place", "value")))
    return reduce(DataFrame.unionAll, tops).groupBy("column").agg(
        F.count(F.lit(1)).alias("found"),
        F.array_join(F.transform(ordered, lambda s: s["value"]), " ").alias("sample"),
        F.min_by("value", "place").alias("first"),
    )


def _first_together(df: DataFrame, columns: list[str], order: list[str], n: int) -> DataFrame:
    """The same from the first rows alone, all columns in one scan: exact for columns with n values among them."""
    types = {f.name: f.dataType for f in df.schema.fields}
    first = df.select(F.struct(*order).alias("place"), *[sample_text(F.col(c), types[c]).alias(f"v{i}") for i, c in enumerate(columns)])
    first = first.orderBy("place").limit(FIRST_ROWS)
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias("value")) for i, c in enumerate(columns)]
    cells = first.select("place", F.explode(F.array(*cells)).alias("cell")).select("place", "cell.*").filter("value IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("column").orderBy("place"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "value")))
    return cells.withColumn("rank", rank).filter(F.col("rank") <= n).groupBy("column").agg(
        F.count(F.lit(1)).alias("found"),
        F.array_join(F.transform(ordered, lambda s: s["value"]), " ").alias("sample"),
        F.min_by("value", "place").alias("first"),
    )


def labelled(samples: DataFrame, moments: list[str]) -> DataFrame:
    """`(column, found, before, after, first)`: the labels a column may get, and how its first value starts."""
    # a sample that is all midnights reads as plain dates
    midnight = F.col("column").isin(moments) & (
        F.regexp_count("sample", F.lit(" 00:00:00")) == F.regexp_count("sample", F.lit(r"\d:\d\d:"))
    )
    shown = F.when(midnight, F.substring("first", 1, 10)).otherwise(F.col("first"))
    return samples.withColumn("shown", shown).select(
        "column", "found",
        names.label_before_numbers("sample").alias("before"),
        names.label_after_numbers("sample", "shown").alias("after"),
        F.substring("first", 1, FIRST_LENGTH).alias("first"),
    )


def column_samples(
    table: DataFrame, head: DataFrame | None, columns: list[str], order: list[str]
) -> dict[str, Row]:
    """Labels and first values of columns that need a name.

    `head` is a beginning of the table. The whole is read only for columns of which the head holds
    too few values.
    """
    types = {f.name: f.dataType for f in table.schema.fields}
    moments = [c for c in columns if isinstance(types[c], MOMENTS)]

    def collect(part: DataFrame, wanted: list[str]) -> dict[str, Row]:
        samples = _first_together(part, wanted, order, names.SAMPLE_SIZE)
        found = {r["column"]: r for r in labelled(samples, moments).collect()}
        # columns with few values among the first rows get a top-n of their own
        rare = [c for c in wanted if c not in found or found[c]["found"] < names.SAMPLE_SIZE]
        if rare:
            samples = _first_of_each(part, rare, order, names.SAMPLE_SIZE)
            found |= {r["column"]: r for r in labelled(samples, moments).collect()}
        return found

    if head is None:
        return collect(table, columns)
    found = collect(head, columns)
    short = [c for c in columns if c not in found or found[c]["found"] < names.SAMPLE_SIZE]
    return {**found, **collect(table, short)} if short else found


def first_values(table: DataFrame, head: DataFrame | None, columns: list[str], order: list[str]) -> dict[str, str]:
    """How the first value of each column starts. One pass, one value a column and task."""

    def collect(part: DataFrame, wanted: list[str]) -> dict[str, str]:
        row = part.agg(*[
            F.expr(f"min_by(substring({c}, 1, {FIRST_LENGTH}), IF({c} IS NOT NULL, struct({', '.join(order)}), NULL))")
            .alias(c) for c in wanted
        ]).first()
        return {c: row[c] for c in wanted if row[c] is not None}

    if head is None:
        return collect(table, columns)
    found = collect(head, columns)
    short = [c for c in columns if c not in found]
    return {**found, **collect(table, short)} if short else found
