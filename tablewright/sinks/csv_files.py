"""Normalized CSV: text quoted, numbers bare, every part file with its header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import float_text, quoted
from tablewright.sources.files import total_bytes


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def _cell(name: str, data_type: T.DataType) -> Column:
    value = F.col(quoted(name))
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.coalesce(float_text(name), F.lit(""))
    if isinstance(data_type, T.NumericType):
        return F.coalesce(value.cast("string"), F.lit(""))
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        value = F.to_json(value)
    return _quoted(F.coalesce(value.cast("string"), F.lit("")))


def csv_header(df: DataFrame) -> str:
    return ",".join('"' + n.replace('"', '""') + '"' for n in df.columns)


def csv_lines(df: DataFrame) -> DataFrame:
    """One text line per row. A missing text is written as `""`."""
    return df.select(F.concat_ws(",", *[_cell(f.name, f.dataType) for f in df.schema.fields]).alias("value"))


def write_lines(lines: DataFrame, header: str, path: str) -> None:
    """Write the text column `value`; the header goes before the first line of each partition.

    So every part is a delimited file of its own, and no data moves.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    first = F.lit(header)
    both = F.when(F.col("place") == 0, F.array(first, F.col("value"))).otherwise(F.array("value"))
    placed = lines.select("value", place.alias("place"))
    # a partition must stay one file, or the others would begin without a header
    placed.select(F.explode(both).alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 0).text(path)
    spark = lines.sparkSession
    if total_bytes(spark, path) == 0:
        spark.range(1).select(first.alias("value")).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Write a folder of part files that `scan_csv` reads back as one table."""
    write_lines(csv_lines(df), csv_header(df), path)
